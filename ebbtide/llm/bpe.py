r"""Byte-pair encoding and decoding (9) with a segment tree over adjacent pair ranks.

A piece (a pre-token) starts as its bytes. The tree's leaf p holds ``rank * width + p`` for the pair
that starts at symbol p, or ``NONE``; every inner node holds the smaller of its children, so the root
is the leftmost pair of lowest rank. A merge changes three leaves (the pair, the one before it and
the one it swallows), each written upwards in log(width) steps, until the root is ``NONE``.

Pieces of like length are encoded together: their trees are rows of one numpy array, and each step
merges the root pair of all rows that have one. A few pieces, or very long ones, use the same tree
on a plain list.

Texts repeat their pieces, so each worker process keeps what it has encoded, about ``2 * KEPT`` pieces;
beyond that, of the older ones only those at hand are kept, and others are encoded again when met.
Ids are decoded by text: the bytes of all tokens lie end to end, and the bytes of many texts are
gathered from there at once.
Nothing is shuffled: encoding is one narrow pass over the texts.
"""

from __future__ import annotations

import gc
import json
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import byte_slices, pack

NONE = np.int64(1) << 62
#: The same in trees of 32 bits.
NONE_32 = 2**31 - 1
#: Pieces remembered by a worker process in each of two generations.
KEPT = 250_000
#: Bytes of text encoded at once: few enough for their chunks to stay in the processor's caches.
SLICE = 1 << 20
#: Cells of the trees that are worked on at once.
CELLS = 1 << 16
#: Fewer pieces of a length class than this are encoded one by one.
FEW = 12
#: Marks that often end a word; any other ending goes through the pattern.
CLOSING = tuple(".,;:!?")

# The pre-token pattern of this family of byte-level vocabularies.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?![^\p{White_Space}])|\p{White_Space}+"
)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file.

    Printable Latin-1 bytes stand for themselves, the others for the characters from 256 on.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]


class Vocabulary:
    """Ranks, ids and bytes of the tokens in a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids = content["model"]["vocab"]
        chars = byte_characters()
        byte_of = {c: b for b, c in enumerate(chars)}
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.bytes = {i: bytes(byte_of[c] for c in t) for t, i in ids.items()}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.lengths = np.zeros(max(self.bytes) + 1, dtype=np.int64)
        for i, raw in self.bytes.items():
            self.lengths[i] = len(raw)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.laid = np.frombuffer(b"".join([self.bytes.get(i, b"") for i in range(len(self.lengths))]), dtype=np.uint8)
        self.first = np.array([ids[c] for c in chars], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        left = np.array([ids[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([ids[b] for _, b in pairs], dtype=np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        self.stride = np.int64(max(*ids.values(), *self.special.values()) + 1)
        keys = left * self.stride + right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.rank_of = dict(zip(keys.tolist(), range(len(pairs))))
        self.find_special = regex.compile("|".join(regex.escape(t) for t in self.special)) if self.special else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, or -1; ids below 0 pair with nothing."""
        keys = left * self.stride + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.order[at], -1)

    def encode_one(self, piece: bytes) -> list[int]:
        """The ids of one piece, its tree in a list."""
        ids = self.first[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(ids)
        width = 1 << max(n - 1, 0).bit_length()
        none, stride, rank_of, merged = int(NONE), int(self.stride), self.rank_of, self.merged
        tree = [none] * (2 * width)

        def leaf(p: int, q: int) -> int:
            rank = rank_of.get(ids[p] * stride + ids[q]) if 0 <= p and q < n else None
            return none if rank is None else rank * width + p

        for p in range(n - 1):
            tree[width + p] = leaf(p, p + 1)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(p: int, value: int) -> None:
            node = width + p
            tree[node] = value
            while node > 1:
                node >>= 1
                value = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == value:
                    return
                tree[node] = value

        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        gone = [False] * n
        while n > 1 and tree[1] < none:
            rank, p = divmod(tree[1], width)
            q = after[p]
            ids[p], gone[q] = int(merged[rank]), True
            after[p] = after[q]
            if after[q] < n:
                before[after[q]] = p
            put(q, none)
            put(p, leaf(p, after[p]))
            if before[p] >= 0:
                put(before[p], leaf(before[p], p))
        return [x for x, dead in zip(ids, gone) if not dead]

    def encode_class(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces of at most ``width`` bytes (a power of two), one after another, and their numbers.

        The pieces' trees are the rows of one array.
        """
        n = len(pieces)
        sizes = np.array([len(p) for p in pieces])
        inside = np.arange(width) < sizes[:, None]
        ids = np.full((n, width + 1), -1, dtype=np.int64)  # the last column is the end of every row
        ids[:, :width][inside] = self.first[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        kind = np.int32 if len(self.keys) * width < NONE_32 else np.int64
        none = kind(NONE_32 if kind is np.int32 else NONE)
        places = np.arange(width, dtype=kind)
        tree = np.full((n, 2 * width), none, dtype=kind)
        pairs = inside[:, 1:].nonzero()
        ranks = self.ranks(ids[:, : width - 1][pairs], ids[:, 1:width][pairs])
        tree[pairs[0], pairs[1] + width] = np.where(ranks >= 0, ranks * width + pairs[1], none)
        node = width
        while node > 1:
            tree[:, node // 2 : node] = np.minimum(tree[:, node : 2 * node : 2], tree[:, node + 1 : 2 * node : 2])
            node //= 2
        after = np.tile(np.arange(1, width + 2, dtype=np.int64), (n, 1))
        after[after > sizes[:, None] - 1] = width
        before = np.tile(np.arange(-1, width, dtype=np.int64), (n, 1))
        # Cell p of row r in these arrays laid flat: r * (width + 1) + p; in the tree: r * 2 * width + p.
        tree, ids, after, before = tree.ravel(), ids.ravel(), after.ravel(), before.ravel()

        def put(base: np.ndarray, p: np.ndarray, value: np.ndarray) -> None:
            node = p + width
            tree[base + node] = value
            for _ in range(width.bit_length() - 1):
                left = base + (node & -2)
                node >>= 1
                tree[base + node] = np.minimum(tree[left], tree[left + 1])

        row = np.flatnonzero(tree[1 :: 2 * width] < none) if width > 1 else np.zeros(0, dtype=np.int64)
        while len(row):
            base, start = row * (2 * width), row * (width + 1)
            rank, p = np.divmod(tree[base + 1], kind(width))
            p = p.astype(np.int64)
            q = after[start + p]
            merged = self.merged[rank]
            ids[start + p] = merged
            ids[start + q] = -1
            following = after[start + q]
            after[start + p] = following
            before[start + following] = p
            ranks = self.ranks(merged, ids[start + following])
            ahead = before[start + p]
            has = np.flatnonzero(ahead >= 0)
            place = ahead[has]
            here = self.ranks(ids[start[has] + place], merged[has])
            bases = np.concatenate([base, base, base[has]])
            values = np.concatenate([
                np.full(len(row), none), np.where(ranks >= 0, ranks * width + p, none), np.where(here >= 0, here * width + place, none)
            ])
            put(bases, np.concatenate([q, p, place]), values.astype(kind))
            row = row[tree[base + 1] < none]
        left = ids.reshape(n, width + 1)[:, :width]
        kept = left >= 0
        return left[kept], kept.sum(1)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """For each piece its ids, as little-endian 32-bit bytes."""
        ids = [b""] * len(pieces)
        classes: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if piece:
                classes.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
        for width, members in classes.items():
            step = max(1, CELLS // width)
            for first in range(0, len(members), step):
                part = members[first : first + step]
                own = [pieces[i] for i in part]
                if len(part) < FEW or width > 1024:
                    lists = [self.encode_one(p) for p in own]
                    values = np.array([x for one in lists for x in one], dtype=np.int64)
                    counts = np.array([len(one) for one in lists])
                else:
                    values, counts = self.encode_class(own, width)
                coded = values.astype("<i4").tobytes()
                at = 0
                for i, end in zip(part, (4 * np.cumsum(counts)).tolist()):
                    ids[i] = coded[at:end]
                    at = end
        return ids

    def decode(self, lists: list[bytes]) -> list[str]:
        """The text of each list of ids (little-endian 32-bit bytes); bytes that are no UTF-8 become U+FFFD."""
        ids = np.frombuffer(b"".join(lists), dtype="<i4")
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        raw = self.laid[np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(sizes.sum())].tobytes()
        last = np.cumsum([0] + [len(x) // 4 for x in lists])
        at = np.concatenate([[0], ends])[last].tolist()
        return [raw[i:j].decode("utf-8", errors="replace") for i, j in zip(at, at[1:])]


def chunk_of(piece: str) -> str:
    """The chunk that is this piece alone: see ``Encoder``. "\\1" marks one without a space before it."""
    return piece[1:] if piece[0] == " " and piece[1:2] not in ("\0", "\1") else "\1" + piece


class Encoder:
    """Encodes and decodes texts, remembering the pieces it has seen.

    A text is cut into chunks where a space stands between two characters that aren't white space:
    no pre-token goes across such a place. Chunks are the pieces that are remembered, each with the
    space before it; a text with wider gaps is cut by the pre-token pattern itself.
    """

    wide = regex.compile(r"\p{White_Space} | \p{White_Space}")

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.pattern = regex.compile(PIECES)
        self.ids: dict[str, bytes] = {}

    def chunks(self, text: str) -> list[str]:
        """What a text is made of: each chunk but the first of a part begins with its space."""
        special = self.vocabulary.find_special
        if special and special.search(text):
            out, at = [], 0
            for m in special.finditer(text):
                out += self.chunks(text[at : m.start()]) if m.start() > at else []
                out.append("\0" + m[0])
                at = m.end()
            return out + (self.chunks(text[at:]) if at < len(text) else [])
        if "\0" in text or "\1" in text or self.wide.search(text):
            return ["\1" + p for p in self.pattern.findall(text)]
        return self.parts(text)

    def parts(self, text: str) -> list[str]:
        """The chunks of a text without special tokens, marks and wider gaps."""
        out = text.split(" ")
        if out[0]:
            out[0] = "\1" + out[0]
        else:
            del out[0]
        return out

    def cut(self, texts: list[str | None]) -> tuple[list[list[str]], set[str]]:
        """The chunks of each text, and all of them. Gaps are looked for in the distinct chunks, not in each text."""
        odd = ["\0", "\1", *self.vocabulary.special]
        plain = [not any(x in t for x in odd) if t else False for t in texts]
        out = [self.parts(t) if p else self.chunks(t) if t else [] for t, p in zip(texts, plain)]
        wanted = set().union(*out)
        gaps = {c for c in wanted if not c or c[-1].isspace() or c[c[0] == "\1" and len(c) > 1].isspace()}
        if not gaps:
            return out, wanted
        out = [self.chunks(t) if p and not gaps.isdisjoint(c) else c for t, p, c in zip(texts, plain, out)]
        return out, set().union(*out)

    def learn(self, chunks: set[str]) -> None:
        """Encode the chunks that aren't remembered. Their pieces are remembered as the chunks of one piece."""
        v, findall, known = self.vocabulary, self.pattern.findall, self.ids
        whole: list[str] = []
        cut: dict[str, list[str]] = {}
        for chunk in chunks:
            if chunk in known:
                continue
            if chunk.isalpha():
                whole.append(chunk)
            elif chunk[-1:] in CLOSING and chunk[:-1].isalpha():  # a word and one mark
                cut[chunk] = [chunk[:-1], "\1" + chunk[-1]]
            elif chunk[:1] == "\0":
                known[chunk] = np.array([v.special[chunk[1:]]]).astype("<i4").tobytes()
            else:
                cut[chunk] = list(map(chunk_of, findall(chunk[1:] if chunk[:1] == "\1" else " " + chunk)))
        names = [n for n in set(chain(whole, chain.from_iterable(cut.values()))) if n not in known]
        known.update(zip(names, v.encode_pieces([(n[1:] if n[:1] == "\1" else " " + n).encode() for n in names])))
        for chunk, parts in cut.items():
            known[chunk] = b"".join([known[p] for p in parts])

    def run(self, texts: list[str | None]) -> tuple[list[bytes], list[str]]:
        """The ids (as little-endian 32-bit bytes) and the decoded text of each text."""
        gc.disable()  # many lists of strings, no cycles: collecting them again and again takes most of the time
        try:
            return self._run(texts)
        finally:
            gc.enable()

    def _run(self, texts: list[str | None]) -> tuple[list[bytes], list[str]]:
        cut, wanted = self.cut(texts)
        if len(self.ids) > 2 * KEPT:
            for chunk in [c for c in islice(self.ids, len(self.ids) - KEPT) if c not in wanted]:
                del self.ids[chunk]
        self.learn(wanted)
        ids = self.ids.__getitem__
        lists = [b"".join(map(ids, c)) for c in cut]
        return lists, self.vocabulary.decode(lists)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_documents(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Encode every whole text with the byte-level BPE file at ``path``, and decode the ids again.

    ``path`` must name the file on every executor. Returns ``__row`` (the columns of ``docs``),
    ``ids`` array<int> and ``decoded`` string. A special token's string in a text becomes its id.
    NULL and empty texts have no ids and decode to ''. Rows are handled alone: repeated rows give
    repeated results, an empty table none.
    """
    rows = pack(docs).selectExpr("__row", f"__row.`{text_col}` as __text")

    def run(batches):
        coder = encoder(path)
        for batch, texts in byte_slices(batches, "__text", SLICE):
            ids, back = coder.run(texts)
            ends = np.cumsum([0] + [len(x) // 4 for x in ids])
            values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"), type=pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("__row")), lists, pa.array(back, type=pa.string())],
                names=["__row", "ids", "decoded"],
            )

    schema = rows.select("__row").schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string")
    return rows.mapInArrow(run, schema)
