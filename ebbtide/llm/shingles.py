"""Word shingles of many texts at once, in numpy: what the MinHash near-dedup (10) counts and hashes."""

from __future__ import annotations

import numpy as np

U = np.uint64
_BYTES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = U(0x9E3779B97F4A7C15)
_TURNS = np.random.default_rng(20240502).integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_POWERS = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base, modulo 2^64."""
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 256), _BASE, dtype=np.uint64)
        grown[0] = 1
        _POWERS = np.cumprod(grown, dtype=np.uint64)
    return _POWERS[:n]


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    r"""(hashes, counts): the words of all texts in order, and the number of words of each text.

    Words are longest runs of bytes other than \x20 and \x09-\x0D. NULL texts have none.
    """
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.cumsum([0] + [len(r) + 1 for r in raw])
    counts = np.diff(np.searchsorted(starts, first))
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), counts
    sizes = ends - starts
    begins = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(begins, sizes)
    values = _BYTES[data[inside]] * powers(int(sizes.max()))[place]
    return mixed(np.add.reduceat(values, begins) + sizes.astype(np.uint64)), counts


def weighted_shingles(hashes: np.ndarray, counts: np.ndarray, size: int = 5):
    """(text, shingle, weight) arrays, sorted by text and shingle: each text's multiset of word shingles.

    A text of fewer than ``size`` words has one shingle, of all its words.
    """
    text = np.repeat(np.arange(len(counts)), counts)
    n = len(hashes)
    if n >= size:
        total = np.zeros(n - size + 1, dtype=np.uint64)
        for k in range(size):
            total += hashes[k : n - size + 1 + k] * _TURNS[k]
        whole = text[: n - size + 1] == text[size - 1 :]
        owner, shingle = text[: n - size + 1][whole], mixed(total[whole])
    else:
        owner, shingle = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        place = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
        own = np.isin(text, short)
        sums = np.zeros(len(counts), dtype=np.uint64)
        np.add.at(sums, text[own], hashes[own] * _TURNS[place[own]])
        owner = np.concatenate([owner, short])
        shingle = np.concatenate([shingle, mixed(sums[short] + counts[short].astype(np.uint64))])
    order = np.lexsort((shingle, owner))
    owner, shingle = owner[order], shingle[order]
    if not len(owner):
        return owner, shingle, np.zeros(0, dtype=np.int64)
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(new)
    return owner[at], shingle[at], np.diff(np.append(at, len(owner)))


def bag_signatures(owner, shingle, weight, n_texts: int, m: int) -> np.ndarray:
    """BagMinHash: [n_texts, m] signatures of which two agree in a share equal to the weighted Jaccard index.

    Weights are cut at 1, 2, 4, 8, ... Each interval of an element's weight holds a Poisson process of
    points in time, of rate m per unit of weight; a point falls on one of the m components and on one
    unit of its interval, and counts if the element's weight reaches that unit. A component keeps its
    first point: two bags agree on it just if that point lies in both. Points come in order of time, so
    an element is left as soon as it is past the time by which all components of its text are filled.
    That time is guessed from the text's total weight, and doubled for a text that it leaves unfilled.
    A text without shingles has a signature of infinite times.
    """
    first = np.full(n_texts * m, np.inf)
    total = np.bincount(owner, weights=weight, minlength=n_texts)
    reach = (np.log(m) + 3.0) / np.maximum(total, 1)
    open_texts = total > 0
    while open_texts.any():
        mine = open_texts[owner]
        own, key, most = owner[mine], shingle[mine], weight[mine]
        low, level = 0, 0
        while len(own):
            high = max(1, 2 * low)
            size = high - low
            points(first, own, key, most, low, size, level, reach, m)
            low, level = high, level + 1
            more = most > low
            own, key, most = own[more], key[more], most[more]
        unfilled = np.isinf(first.reshape(n_texts, m)).any(axis=1) & (total > 0)
        late = first.reshape(n_texts, m).max(axis=1) > reach
        open_texts &= unfilled | late
        reach = np.where(open_texts, 2 * reach, reach)
    return first.reshape(n_texts, m)


def points(first, own, key, most, low: int, size: int, level: int, reach, m: int) -> None:
    """Enter the points of one weight interval, up to the time that each text is read to."""
    time = np.zeros(len(own))
    turn = 0
    while len(own):
        bits = mixed(key + U(((level + 1) * 0xD1342543DE82EF95 + (turn + 1) * 0xAF251AF3B0F025B5) % 2**64))
        time = time - np.log(((bits >> U(12)).astype(float) + 0.5) * 2.0**-52) / (m * size)
        near = time <= reach[own]
        own, key, most, time, bits = own[near], key[near], most[near], time[near], bits[near]
        if not len(own):
            return
        more = mixed(bits ^ _BASE)
        component = (more & U(0xFFFFFFFF)) % U(m)
        unit = low + 1 + ((more >> U(32)) % U(size)).astype(np.int64)
        held = unit <= most
        np.minimum.at(first, own[held] * m + component[held].astype(np.int64), time[held])
        turn += 1
