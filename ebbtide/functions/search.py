"""Many short patterns in many long texts, in one pass over the bytes of a batch."""

from __future__ import annotations

import functools
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes looked at in one go, so that what is computed for each stays in the cache.
PIECE = 1 << 19
_SPREAD = np.uint32(0x9E3779B1)
#: How many bytes of a needle are looked up: its first four, of shorter ones what there is.
_HEAD = 4


class Needles:
    """Plain patterns, alternatives split by ``|``, in the sense of ``text.matches``: ``$`` is in every text, and a
    leading dot stands for any character. A needle is found by the hash of its first bytes, then compared byte by byte."""

    def __init__(self, patterns: Sequence[str]):
        self.always = 0
        #: by the number of first bytes: (needle, bytes of the text that must stand before it, bit)
        self.by_head: dict[int, list[tuple[bytes, int, int]]] = {}
        for place, pattern in enumerate(patterns):
            for part in pattern.split("|"):
                if part == "$":
                    self.always |= 1 << place
                    continue
                needle, before = (part[1:], 1) if part.startswith(".") else (part, 0)
                head = min(_HEAD, len(needle.encode()))
                self.by_head.setdefault(head, []).append((needle.encode(), before, 1 << place))
        self.table = np.zeros(1 << 16, dtype=bool)
        for needle, _, _ in self.by_head.get(_HEAD, []):
            self.table[self._slots(np.array([self._code(needle, _HEAD)], dtype=np.uint32))] = True

    @staticmethod
    def _code(needle: bytes, head: int) -> int:
        return int.from_bytes(needle[:head], "little")

    @staticmethod
    def _slots(codes: np.ndarray) -> np.ndarray:
        return (codes * _SPREAD) >> np.uint32(16)

    def bits(self, texts: pa.Array) -> np.ndarray:
        """For each text the bits of the patterns in it; 0 for NULL."""
        texts = texts.cast(pa.large_binary())
        if not len(texts):
            return np.zeros(0, dtype=np.int64)
        found = np.full(len(texts), self.always, dtype=np.int64)
        if texts.null_count:
            found[np.asarray(texts.is_null().to_numpy(zero_copy_only=False))] = 0
        _, offsets, data = texts.buffers()
        starts = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        size = int(starts[-1] - starts[0])
        if not size:
            return found
        data = np.frombuffer(data, dtype=np.uint8)[starts[0] : starts[-1]]
        starts = starts - starts[0]
        padded = np.concatenate([data, np.zeros(_HEAD, dtype=np.uint8)])
        for first in range(0, size, PIECE):
            last = min(first + PIECE, size)
            here = padded[first : last + _HEAD - 1].astype(np.uint32)
            codes = here[: last - first].copy()
            for head in range(1, _HEAD + 1):
                if head > 1:
                    codes |= here[head - 1 : head - 1 + last - first] << np.uint32(8 * (head - 1))
                if head < _HEAD:
                    for needle, before, bit in self.by_head.get(head, []):
                        at = np.flatnonzero(codes == np.uint32(self._code(needle, head))) + first
                        self._mark(found, starts, at, len(needle), before, bit)
            places = np.flatnonzero(self.table.take(self._slots(codes), mode="clip"))
            codes, places = codes[places], places + first
            for needle, before, bit in self.by_head.get(_HEAD, []):
                at = places[codes == np.uint32(self._code(needle, _HEAD))]
                at = at[at + len(needle) <= size]
                for k in range(_HEAD, len(needle)):
                    at = at[data[at + k] == needle[k]]
                self._mark(found, starts, at, len(needle), before, bit)
        return found

    @staticmethod
    def _mark(found, starts, at, length, before, bit) -> None:
        """Set the bit of the texts that hold a needle's place whole."""
        text = np.searchsorted(starts, at, side="right") - 1
        inside = (at + length <= starts[text + 1]) & (at >= starts[text] + before)
        found[text[inside]] |= bit


@functools.lru_cache(maxsize=8)
def needles(patterns: tuple[str, ...]) -> Needles:
    return Needles(patterns)


def pattern_bits(text: Column, patterns: Sequence[str]) -> Column:
    """A long whose bit k tells whether the k-th plain pattern is in the text; 0 for NULL."""
    patterns = tuple(patterns)

    @F.arrow_udf("long")
    def bits(texts: pa.Array) -> pa.Array:
        return pa.array(needles(patterns).bits(texts), pa.int64())

    return bits(text)
