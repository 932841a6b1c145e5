r"""Byte-level BPE encoding and decoding (13) with the tiktoken library and a local rank file.

A text is encoded by the library: its pattern cuts the text into pieces, and each piece is merged by rank.
The library fails on some long texts (its pattern engine gives up on a run of a million blanks), and a
whole text's ids are held at once, so a text above ``LONG`` characters is cut first, at places where a piece
ends in any case:

* before white space that follows another character: no piece goes from the one to the other, and a piece
  never depends on what stands before it;
* before the last blank of a run of two or more that another character follows: all blanks but the last
  are one piece by the pattern's look-ahead, and at the end of a part they are one piece as well.

A part without such a place that is longer than ``SOLO`` characters is cut into its pieces by the same
pattern in the ``regex`` library, whose engine has no such limit, and the pieces are merged by tiktoken
one by one. So nothing is cut inside a piece, however long it is.

Both places belong to the patterns of this family: an optional space before a run of letters, of numbers or of
other marks, then white space with a look-ahead. Decoding joins the bytes of the ids, so it gives back the
bytes of any text, also where a character's bytes are spread over several ids.

Nothing is shuffled: encoding is one narrow pass over the texts.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import byte_slices, pack

#: Texts of more characters than this are cut.
LONG = 1 << 16
#: Parts of more characters than this don't go through the library's own pattern engine.
SOLO = 200_000
#: Where a long text may be cut; the look-behind makes each place one position.
SAFE = regex.compile(
    r"(?<=\P{White_Space})(?=\p{White_Space})|(?<=\p{White_Space})(?=\p{White_Space}\P{White_Space})"
)


def safe_parts(text: str, long: int = LONG) -> list[str]:
    """Parts that are encoded alone with the result of the whole: each the shortest of ``long`` characters or more."""
    parts, at = [], 0
    while len(text) - at > long:
        place = SAFE.search(text, at + long)
        if not place:
            break
        parts.append(text[at : place.start()])
        at = place.start()
    parts.append(text[at:])
    return parts


def alone(text: str, place: int) -> bool:
    """Whether ``place`` is one of the places above."""
    return SAFE.match(text, place) is not None


class Encoder:
    """tiktoken with the ranks of a local file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.library = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # White space in the library's engine is the Unicode property
        self.pieces = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))

    def part(self, text: str) -> list[int]:
        if len(text) <= SOLO:
            return self.library.encode_ordinary(text)
        return self.by_pieces(text)

    def by_pieces(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in self.pieces.finditer(text):
            out += self.library._encode_single_piece(piece[0])
        return out

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        if len(text) <= LONG:
            return np.array(self.library.encode_ordinary(text), dtype="<i4")
        return np.concatenate([np.array(self.part(p), dtype="<i4") for p in self.runs(text)])

    def runs(self, text: str):
        """The safe parts; one that is too long for the library is cut again at every safe place it has."""
        for part in safe_parts(text):
            if len(part) <= SOLO:
                yield part
                continue
            places = [0, *(m.start() for m in SAFE.finditer(part, 1)), len(part)]
            yield from (part[a:b] for a, b in zip(places, places[1:]))

    def decode(self, ids: np.ndarray) -> bytes:
        return self.library.decode_bytes(ids.tolist())


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of this worker process for a rank file."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """Encode every whole text by the ranks at ``path``, pieces by ``pattern``, and decode the ids again.

    ``path`` must name the file on every executor. Returns ``__row`` (the columns of ``docs``, whatever their
    names), ``ids`` array<int> and ``decoded`` binary. There are no special tokens: the string of one is text.
    NULL and empty texts have no ids and decode to no bytes. A very long text is cut at safe places only, so
    its ids are those of the whole. Equal texts of a batch are encoded once; repeated rows give repeated
    results, an empty table none.
    """
    rows = pack(docs).selectExpr("__row", f"__row.`{text_col}` as __text")

    def run(batches):
        coder = encoder(path, pattern)
        for batch, texts in byte_slices(batches, "__text"):
            coded = {}
            for text in texts:
                if text not in coded:
                    ids = coder.encode(text or "")
                    coded[text] = ids, coder.decode(ids)
            ids = [coded[t][0] for t in texts]
            ends = np.cumsum([0] + [len(x) for x in ids])
            lists = pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(np.concatenate(ids), type=pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("__row")),
                    lists,
                    pa.array([coded[t][1] for t in texts], type=pa.binary()),
                ],
                names=["__row", "ids", "decoded"],
            )

    schema = rows.select("__row").schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "binary")
    return rows.mapInArrow(run, schema)
