r"""Secret scans (6): fixed patterns, and sliding-window Shannon entropy per character class.

A candidate is a longest run of at least ``window`` characters of ``[A-Za-z0-9+/_-]``, with the padding after it. For each
character class (hexadecimal, base 64) a window slides over the longest parts of a candidate that
lie in the class. The window's counts change by one character in and one out, and with them the sum
of n log2 n, from which its entropy follows in constant time. Windows above the class's limit that
hold letters and digits are joined into spans. A span is suppressed when the allow-list knows it:
an expected shape (such as a UUID), or a marker of a placeholder in the candidate. Spans of the fixed
patterns are never suppressed.

Every text is scanned whole, in one narrow pass; nothing is shuffled.
"""

from __future__ import annotations

import bisect
import dataclasses
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import byte_slices, pack

# The patterns that are always looked for, and the least length of what they find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
BASE_KINDS = KINDS[:3]


@dataclasses.dataclass(frozen=True)
class CharacterClass:
    kind: str
    pattern: str
    limit: float  # bits per character


@dataclasses.dataclass(frozen=True)
class Entropy:
    """Settings of the entropy method."""

    window: int = 20
    classes: tuple[CharacterClass, ...] = (
        CharacterClass("entropy_hex", r"[0-9A-Fa-f]", 3.0),
        CharacterClass("entropy_base64", r"[A-Za-z0-9+/_=-]", 3.7),
    )
    allowed_shapes: tuple[str, ...] = (
        r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",  # UUID
        r"sha(?:1|256|384|512)-[A-Za-z0-9+/]+=*",  # integrity digest
    )
    path: str = r"(?:/[A-Za-z0-9_=-]*)+|(?:[A-Za-z0-9_=-]+/)+[A-Za-z0-9_=-]*"
    #: Pieces of a path that are words or numbers: 2024, 1080p, word, WORD, twoWords, word12.
    wordlike: str = r"[0-9]+|[0-9]{1,4}[A-Za-z]{1,3}|[A-Z]+|[A-Z]?[a-z]+(?:[A-Z][a-z]{2,})*|(?:[A-Z]{1,12}|[A-Z]?[a-z]{1,12}(?:[A-Z][a-z]{2,})*)[0-9]{1,4}"
    unknown: float = 0.6  # share of a window
    allowed_words: tuple[str, ...] = ("example", "placeholder", "changeme", "xxxxxxxx", "your_", "dummy", "sample")
    reach: int = 40  # characters


def entropy_windows(text: str, window: int) -> list[float]:
    """The Shannon entropy (bits per character) of each window, by incremental counts."""
    if len(text) < window:
        return []
    weight = [0.0] + [n * math.log2(n) for n in range(1, window + 1)]  # n log2 n
    counts: dict[str, int] = {}
    total = 0.0
    out = []
    top = math.log2(window)
    for i, c in enumerate(text):
        if i >= window:
            gone = text[i - window]
            n = counts[gone]
            total += weight[n - 1] - weight[n]
            counts[gone] = n - 1
        n = counts.get(c, 0)
        total += weight[n + 1] - weight[n]
        counts[c] = n + 1
        if i >= window - 1:
            out.append(top - total / window)
    return out


class Scanner:
    """Finds the spans of one text: (start, kind number, end), sorted."""

    def __init__(self, settings: Entropy):
        self.settings = settings
        self.candidate = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % settings.window)
        self.classes = [
            (KINDS.index(c.kind), re.compile(r"(?:%s){%d,}" % (c.pattern, settings.window)), c.limit)
            for c in settings.classes
        ]
        self.shapes = [re.compile(s) for s in settings.allowed_shapes]
        self.path, self.wordlike = re.compile(settings.path), re.compile(settings.wordlike)
        self.words = re.compile("|".join(map(re.escape, settings.allowed_words)) or r"(?!)", re.IGNORECASE | re.ASCII)
        self.unknown = math.ceil(settings.unknown * settings.window)

    def expected(self, text: str) -> bool:
        return any(s.fullmatch(text) for s in self.shapes)

    def unknown_before(self, path: str) -> list[int]:
        """For each place of a path, the characters before it that no word, number or expected shape explains."""
        out = [0]
        for segment in re.findall(r"[^/]+|/", path):
            known = self.expected(segment)
            for piece in re.findall(r"[A-Za-z0-9]+|[^A-Za-z0-9]", segment):
                step = int(not known and piece.isalnum() and not self.wordlike.fullmatch(piece))
                out += [out[-1] + step * k for k in range(1, len(piece) + 1)]
        return out

    def placeholders(self, run: str) -> list[tuple[int, int]]:
        """The parts of a candidate, in order, that markers of placeholders speak for."""
        out: list[tuple[int, int]] = []
        for m in self.words.finditer(run):
            first, last = m.start() - self.settings.reach, m.end() + self.settings.reach
            out[-1:] = [(out[-1][0], last)] if out and first <= out[-1][1] else [*out[-1:], (first, last)]
        return out

    @staticmethod
    def excuses(parts: list[tuple[int, int]], start: int, end: int) -> bool:
        k = bisect.bisect_right(parts, start, key=lambda p: p[0]) - 1
        return k >= 0 and end <= parts[k][1]

    def entropy_spans(self, text: str) -> list[tuple[int, int, int]]:
        found = []
        window = self.settings.window
        for m in self.candidate.finditer(text):
            run = m[0]
            if run.isalpha() or self.expected(run):
                continue
            unknown = self.unknown_before(run) if "/" in run and self.path.fullmatch(run) else None
            if unknown and unknown[-1] < self.unknown:
                continue
            excused = self.placeholders(run)
            for kind, pattern, limit in self.classes:
                for part in pattern.finditer(run):
                    base, piece = m.start() + part.start(), part[0]
                    start = end = -1
                    for i, bits in enumerate(entropy_windows(piece, window)):
                        if bits < limit:
                            continue
                        inside = piece[i : i + window]
                        if not (any(map(str.isdigit, inside)) and any(map(str.isalpha, inside))):
                            continue
                        at = part.start() + i
                        if unknown and unknown[at + window] - unknown[at] < self.unknown:
                            continue
                        if excused and self.excuses(excused, at, at + window):
                            continue
                        if i <= end:
                            end = i + window
                            continue
                        if end > 0:
                            found.append((base + start, kind, base + end))
                        start, end = i, i + window
                    if end > 0:
                        found.append((base + start, kind, base + end))
        return found

    def scan(self, text: str | None) -> list[tuple[int, int, int]]:
        if not text:
            return []
        found = []
        if ":" in text or "=" in text:
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        return sorted(found + self.entropy_spans(text))


def scan_documents(docs: DataFrame, settings: Entropy = Entropy(), text_col: str = "text") -> DataFrame:
    """Secrets in every whole text: ``__row`` (the columns of ``docs``) and ``spans``.

    ``spans`` is an array of (kind, start, end), code points with the end exclusive, by start and
    kind. NULL, empty and clean texts have no spans. Rows are handled alone: repeated rows give
    repeated results, an empty table none.
    """
    rows = pack(docs).selectExpr("__row", f"__row.`{text_col}` as __text")
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        scanner = Scanner(settings)
        for batch, texts in byte_slices(batches, "__text"):
            found = [
                [{"kind": KINDS[kind], "start": start, "end": end} for start, kind, end in scanner.scan(text)]
                for text in texts
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("__row")), pa.array(found, type=spans)],
                names=["__row", "spans"],
            )

    span = T.StructType().add("kind", "string").add("start", "long").add("end", "long")
    schema = rows.select("__row").schema.add("spans", T.ArrayType(span))
    return rows.mapInArrow(run, schema)
