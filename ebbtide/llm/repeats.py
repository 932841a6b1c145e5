"""Repeated byte strings (2): maximal repeats from the common-prefix interval trees of enhanced suffix arrays.

Two documents that share ``length`` bytes share the smallest-hashed 32-byte string inside them. So:

1. Anchors. Every window of ``length`` bytes belongs to the smallest hash of the ``piece``-byte strings in
   it. Neighbouring windows of one smallest hash make a context, the bytes that they cover; equal
   windows, wherever they stand, lie in contexts of one anchor. A text has about two contexts for
   every 70 bytes. Within a batch of documents equal contexts are settled at once, so a passage
   held by a third of all documents reaches the shuffle once for each batch.
2. Equal contexts. Contexts are dealt by anchor and sorted: all but the first of equal contexts are
   removed whole. An anchor with one context is done, unless the context
   may hold equal windows itself. A stream, without holding a group.
3. Suffix arrays. For anchors with different contexts these are fetched, and all their windows' suffixes
   sorted, many anchors at a time: the suffix array, with the common prefixes of neighbours. A stack
   scan over it yields the intervals of the prefix tree of ``length`` or more; one whose members all
   continue the same byte to the left is part of a longer repeat and is passed over. Each of
   the others is a maximal repeat with all its occurrences: all but the first are removed.
   An anchor with more than ``crowd`` different contexts isn't gathered: its windows are compared by
   128-bit hashes in a grouping, which is exact as well and bounded for each task.
4. The removed spans are joined to the documents.

Documents are ordered by id (NULL last). Rows of one id and equal text are one document; rows of
one id and different texts are ordered by their text's hash. Texts travel twice, for contexts and
for the result, in one shared exchange; anchors travel once, as five numbers.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_slices, stage
from .shingles import U, mixed

LAST = 2**63 - 1  # stands for a NULL id
#: Windows of one context at most.
RUN = 128
#: Added to the number of windows of a context that may repeat itself.
OWN = 1 << 16
_RNG = np.random.default_rng(90125)
_TABLE_A, _TABLE_B = (_RNG.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1) for _ in range(2))
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


@dataclasses.dataclass(frozen=True)
class Repeats:
    length: int = 100
    piece: int = 32
    crowd: int = 2000


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            grown = np.full(max(n, 1 << 20), base, dtype=np.uint64)
            grown[0] = 1
            _POWERS[k] = np.cumprod(grown, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def sums(data: np.ndarray, table: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Prefix sums of which differences are hashes of substrings, but for their place."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(table[data] * power, out=out[1:])
    return out


def sliding(values: np.ndarray, width: int, choose) -> np.ndarray:
    """The least or largest value of each ``width`` values in a row, in about log2(width) passes."""
    have = 1
    while 2 * have <= width:
        values = choose(values[:-have], values[have:])
        have *= 2
    return choose(values[: len(values) - (width - have)], values[width - have :])


def contexts(data: np.ndarray, ends: np.ndarray, r: Repeats):
    """(anchor, content hash, start, windows) of the contexts of texts laid end to end in ``data``."""
    none = np.zeros(0, dtype=np.int64)
    n = len(data) - r.length + 1
    if n <= 0:
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    power, inverse = powers(len(data))
    total = sums(data, _TABLE_A, power)
    hashes = mixed((total[r.piece :] - total[: -r.piece]) * inverse[: len(total) - r.piece])
    width = r.length - r.piece + 1
    least = sliding(hashes, width, np.minimum)
    text = np.searchsorted(ends, np.arange(n), side="right")
    valid = np.arange(n) + r.length <= ends[text]
    new = np.ones(n, dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | ~valid[:-1]
    at = np.flatnonzero(new & valid)
    stop = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True)) + 1
    counts = stop - at
    # Where a smallest hash stands twice in a context, its own windows may be equal (periodic texts).
    around = sliding(np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)]), width, np.maximum)
    chosen = np.flatnonzero(around[: len(hashes)] == hashes)
    twice = np.zeros(len(chosen) + 1, dtype=np.int64)
    if len(chosen) > 1:
        twice[2:] = np.cumsum((hashes[chosen[1:]] == hashes[chosen[:-1]]) & (np.diff(chosen) <= width))
    pieces = -(-counts // RUN)
    if (pieces > 1).any():  # the same anchor over many windows: cut evenly, the anchor holds all of them
        turn = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at, counts = np.repeat(at, pieces) + turn * RUN, np.minimum(RUN, np.repeat(counts, pieces) - turn * RUN)
    other = sums(data, _TABLE_B, power)
    content = mixed((other[at + counts - 1 + r.length] - other[at]) * inverse[at] + counts.astype(np.uint64) * U(0xD1342543DE82EF95))
    low, high = np.searchsorted(chosen, at), np.searchsorted(chosen, at + counts + width - 1)
    own = np.where(high > low + 1, twice[high] - twice[np.minimum(low + 1, len(chosen))], 0) > 0
    return mixed(least[at] ^ U(0x5555555555555555)), content, at, counts + own * OWN


MEMBERS = "anchor long, content long, doc long, row long, start long, windows int"


def anchored(docs: DataFrame, r: Repeats) -> DataFrame:
    """Contexts; and, with anchor NULL, spans [start, windows) of a text that are settled already."""

    def run(batches):
        for batch in batches:
            # One slice after another would settle less: texts are taken 8 MB at a time.
            for part, texts in byte_slices([batch], "text", 8 << 20):
                yield from settle(part, texts)

    def settle(batch, texts):
        doc = batch.column(batch.schema.get_field_index("doc")).to_numpy()
        row = batch.column(batch.schema.get_field_index("row")).to_numpy()
        raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        order = np.lexsort((row, doc))
        first_of: dict[bytes, int] = {}
        own: list[int] = []
        spans = []
        for k in order.tolist():
            if len(raw[k]) < r.length:
                continue
            if raw[k] not in first_of:
                first_of[raw[k]] = k
                own.append(k)
            elif doc[k] != doc[first_of[raw[k]]]:
                spans.append((doc[k], row[k], 0, len(raw[k])))
        columns = [[] for _ in range(6)]
        at = 0
        while at < len(own):
            stop, size = at, 0
            while stop < len(own) and (stop == at or size + len(raw[own[stop]]) <= 1 << 20):
                size += len(raw[own[stop]])
                stop += 1
            some = own[at:stop]
            data = np.frombuffer(b"".join(raw[k] for k in some), dtype=np.uint8)
            ends = np.cumsum([len(raw[k]) for k in some])
            anchor, content, start, windows = contexts(data, ends, r)
            text = np.searchsorted(ends, start, side="right")
            begins = ends - np.array([len(raw[k]) for k in some])
            k = np.array(some)[text]
            for column, values in zip(columns, (anchor.view(np.int64), content.view(np.int64), doc[k], row[k], start - begins[text], windows)):
                column.append(values)
            at = stop
        if own:
            anchor, content, d, w, start, windows = (np.concatenate(c) for c in columns)
            order = np.lexsort((start, w, d, content, anchor))
            anchor, content, d, w, start, windows = (c[order] for c in (anchor, content, d, w, start, windows))
            again = np.zeros(len(anchor), dtype=bool)
            again[1:] = (anchor[1:] == anchor[:-1]) & (content[1:] == content[:-1])
            yield table(anchor[~again], content[~again], d[~again], w[~again], start[~again], windows[~again])
            end = start + windows % OWN - 1 + r.length
            spans += zip(d[again].tolist(), w[again].tolist(), start[again].tolist(), end[again].tolist())
        if spans:
            d, w, start, end = (np.array(x, dtype=np.int64) for x in zip(*spans))
            yield table(None, d, d, w, start, end)

    def table(anchor, content, d, w, start, windows):
        first = pa.nulls(len(d), pa.int64()) if anchor is None else pa.array(anchor)
        return pa.RecordBatch.from_arrays(
            [first, *(pa.array(x, pa.int64()) for x in (content, d, w, start)), pa.array(windows, pa.int32())],
            names=["anchor", "content", "doc", "row", "start", "windows"],
        )

    return docs.mapInArrow(run, MEMBERS)


def equal_contexts(members: DataFrame, r: Repeats) -> DataFrame:
    """Spans (anchor NULL), and the contexts to search, each once, at its first place.

    These are the contexts of an anchor that has several, and those that may repeat themselves.
    """
    dealt = members.repartition(F.coalesce("anchor", "doc"))
    dealt = dealt.sortWithinPartitions("anchor", "content", "doc", "row", "start")

    def run(batches):
        pending = None  # the last context's first row, and whether it is given already
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor_column = batch.column(0)
            n_null = anchor_column.null_count
            if n_null:  # NULLs come first
                yield batch.slice(0, n_null)
                batch = batch.slice(n_null)
                if not batch.num_rows:
                    continue
            anchor, content, doc, row, start, windows = (batch.column(i).to_numpy() for i in range(6))
            new = np.ones(len(anchor), dtype=bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
            other = np.ones(len(anchor), dtype=bool)  # a repeated row brings the same context of one document twice
            other[1:] = new[1:] | (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]) | (start[1:] != start[:-1])
            if last is not None:
                new[0] = (anchor[0], content[0]) != last[:2]
                other[0] = (anchor[0], content[0], doc[0], row[0], start[0]) != last
            last = (anchor[-1], content[-1], doc[-1], row[-1], start[-1])
            again = np.flatnonzero(~new & other)
            if len(again):
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(again), pa.int64()), pa.array(content[again]), pa.array(doc[again]), pa.array(row[again]), pa.array(start[again]),
                     pa.array((start + windows % OWN - 1 + r.length)[again].astype(np.int32))],
                    names=batch.schema.names,
                )
            firsts = batch.take(pa.array(np.flatnonzero(new)))
            if not firsts.num_rows:
                continue
            given = np.zeros(firsts.num_rows, dtype=bool)
            if pending is not None:
                firsts = pa.Table.from_batches([pending[0], firsts]).combine_chunks().to_batches()[0]
                given = np.concatenate([[pending[1]], given])
            own = firsts.column(0).to_numpy()
            beside = firsts.column(5).to_numpy() >= OWN
            same = own[1:] == own[:-1]
            beside = beside.copy()
            beside[1:] |= same
            beside[:-1] |= same
            out = np.flatnonzero(beside & ~given)
            if len(out):
                yield firsts.take(pa.array(out))
            pending = firsts.slice(len(own) - 1), bool(beside[-1] or given[-1])

    return dealt.mapInArrow(run, MEMBERS)


def with_content(asked: DataFrame, docs: DataFrame, r: Repeats) -> DataFrame:
    """The contexts asked for, with their bytes."""
    asked = asked.withColumn("windows", F.col("windows") % OWN)
    lists = asked.groupBy("doc", "row").agg(F.collect_list(F.struct("anchor", "start", "windows")).alias("asked"))
    rows = docs.join(lists, ["doc", "row"]).dropDuplicates(["doc", "row"])

    def run(batches):
        for batch, texts in byte_slices(batches, "text", 4 << 20):
            columns: list[list] = [[] for _ in range(6)]
            doc, row, asked_ = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc", "row", "asked"))
            for d, w, text, own in zip(doc, row, texts, asked_):
                raw = text.encode("utf-8", "surrogatepass")
                for a in own:
                    content = raw[a["start"] : a["start"] + a["windows"] - 1 + r.length]
                    for column, value in zip(columns, (a["anchor"], d, w, a["start"], a["windows"], content)):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["anchor", "doc", "row", "start", "windows", "bytes"]
            )

    return rows.mapInArrow(run, "anchor long, doc long, row long, start long, windows int, bytes binary")


class SuffixArray:
    """The enhanced suffix array of the windows of contexts: ``order``, ``common`` and what they belong to.

    ``group`` keeps the suffixes of different anchors apart. Common prefixes end with their contexts.
    """

    def __init__(self, contents: list[bytes], windows: np.ndarray, group: np.ndarray):
        sizes = np.array([len(c) for c in contents])
        data = np.frombuffer(b"".join(contents) + b"\0" * 256, dtype=np.uint8)
        begins = np.cumsum(sizes) - sizes
        self.owner = np.repeat(np.arange(len(contents)), windows)
        self.offset = np.arange(len(self.owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        self.place = begins[self.owner] + self.offset
        self.rest = sizes[self.owner] - self.offset
        n = len(data) - 256
        words = np.zeros(n + 248, dtype=np.uint64)  # eight bytes from each place on, the first the highest
        for k in range(8):
            words = (words << U(8)) | data[k : k + len(words)]
        self.words = words
        ranks = [np.unique(words, return_inverse=True)[1]]  # of 8, 16, 32, 64, 128 bytes
        for width in (8, 16, 32, 64):
            low = ranks[-1]
            pair = low[: len(low) - width].astype(np.int64) * (int(low.max()) + 1) + low[width:]
            ranks.append(np.unique(pair, return_inverse=True)[1])
        self.ranks = ranks
        top, p = ranks[4], self.place
        tail = ranks[4][np.minimum(p + 128, len(top) - 1)]
        self.order = np.lexsort((p, tail, top[p], group[self.owner]))
        i, j = self.order[:-1], self.order[1:]
        a, b = p[i].copy(), p[j].copy()
        common = np.zeros(len(i), dtype=np.int64)
        for width, rank in zip((128, 64, 32, 16, 8), ranks[::-1]):
            limit = len(rank) - 1
            same = (rank[np.minimum(a, limit)] == rank[np.minimum(b, limit)]) & (a <= limit) & (b <= limit)
            common += same * width
            a += same * width
            b += same * width
        limit = len(words) - 1
        apart = words[np.minimum(a, limit)] ^ words[np.minimum(b, limit)]
        leading = np.zeros(len(i), dtype=np.int64)
        for k in range(7, 0, -1):  # equal bytes in front of the first one that differs
            leading += (apart >> U(8 * k)) == 0
        common += leading
        common = np.minimum(common, np.minimum(self.rest[i], self.rest[j]))
        common[group[self.owner[i]] != group[self.owner[j]]] = 0
        self.common = common
        left = data[np.maximum(p - 1, 0)].astype(np.int64)
        self.left = np.where(self.offset == 0, -1 - np.arange(len(p)), left)  # unknown: like no other


def maximal_repeats(array: SuffixArray, length: int):
    """Stack scan: (first, last, size) places in the order of each maximal repeat of ``length`` bytes or more.

    An interval is a node of the common-prefix tree. It is a maximal repeat if its members differ in
    the byte to their left: otherwise all of them continue a longer one.
    """
    common, left = array.common, array.left[array.order]
    joined = common >= length
    if not joined.any():
        return
    edge = np.diff(np.concatenate([[0], joined.astype(np.int8), [0]]))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # members starts .. stops
    change = np.concatenate([[0], np.cumsum(left[1:] != left[:-1])])
    diverse = change[stops] > change[starts]
    for begin, end in zip(starts[diverse].tolist(), stops[diverse].tolist()):
        stack = [(int(common[begin]), begin)]  # (common prefix, first member) of the open intervals
        for k in range(begin + 1, end + 1):
            now = int(common[k]) if k < end else -1
            first = k
            while stack and stack[-1][0] > now:
                size, first = stack.pop()
                if change[k] > change[first]:
                    yield first, k, size
            if k < end and (not stack or stack[-1][0] < now):
                stack.append((now, first))


def later_spans(contents, windows, group, doc, row, start, length: int):
    """(context, begin, end): the bytes of contexts covered by a repeat that occurs earlier, merged."""
    array = SuffixArray(contents, windows, group)
    owner, offset = array.owner, array.offset
    turn = np.empty(len(owner), dtype=np.int64)
    turn[np.lexsort((start[owner] + offset, row[owner], doc[owner]))] = np.arange(len(owner))
    order = array.order
    marks: list[tuple[np.ndarray, int]] = []
    for first, last, size in maximal_repeats(array, length):
        members = order[first : last + 1]
        later = np.delete(members, np.argmin(turn[members]))
        marks.append((later, size))
    if not marks:
        return np.zeros((3, 0), dtype=np.int64)
    member = np.concatenate([m for m, _ in marks])
    size = np.repeat([s for _, s in marks], [len(m) for m, _ in marks])
    begin, end, own = offset[member], offset[member] + size, owner[member]
    order = np.lexsort((begin, own))
    own, begin, end = own[order], begin[order], end[order]
    shifted = end + own * (1 << 40)  # running ends within a context
    reach = np.maximum.accumulate(shifted) - own * (1 << 40)
    new = np.ones(len(own), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (begin[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return np.stack([own[at], begin[at], reach[np.append(at[1:], len(own)) - 1]])


SPANS = "doc long, row long, start long, end long"


def repeat_spans(fetched: DataFrame, r: Repeats) -> DataFrame:
    """Spans of the contexts that a maximal repeat covers and an earlier occurrence repeats."""
    rows = fetched.repartition("anchor").sortWithinPartitions("anchor")

    def solve(part: pa.Table):
        group, doc, row, start = (part[c].to_numpy() for c in ("anchor", "doc", "row", "start"))
        own, begin, end = later_spans(part["bytes"].to_pylist(), part["windows"].to_numpy(), group, doc, row, start, r.length)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc[own], row[own], start[own] + begin, start[own] + end)], names=["doc", "row", "start", "end"])

    def run(batches):
        held, size = [], 0  # whole anchors, about 10,000 contexts at a time
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size > 10_000 + r.crowd:
                whole = pa.Table.from_batches(held)
                anchor = whole["anchor"].to_numpy()
                cut = int(np.searchsorted(anchor, anchor[-1]))
                if cut:
                    for first, stop in pieces(anchor[:cut]):
                        yield solve(whole.slice(first, stop - first))
                rest = whole.slice(cut)
                held, size = rest.to_batches(), rest.num_rows
        if held:
            whole = pa.Table.from_batches(held)
            for first, stop in pieces(whole["anchor"].to_numpy()):
                yield solve(whole.slice(first, stop - first))

    def pieces(anchor: np.ndarray):
        first = 0
        while first < len(anchor):
            stop = min(len(anchor), first + 10_000)
            if stop < len(anchor):
                stop = max(int(np.searchsorted(anchor, anchor[stop])), int(np.searchsorted(anchor, anchor[first], side="right")))
            yield first, stop
            first = stop

    return rows.mapInArrow(run, SPANS)


def crowded_spans(fetched: DataFrame, r: Repeats) -> DataFrame:
    """The same for anchors of many contexts: every window by itself, compared by 128 bits."""

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            start, windows = table["start"].to_numpy(), table["windows"].to_numpy()
            for first in range(0, batch.num_rows, 2000):
                part = slice(first, first + 2000)
                contents = table["bytes"].slice(first, 2000).to_pylist()
                data = np.frombuffer(b"".join(contents), dtype=np.uint8)
                sizes, n = np.array([len(c) for c in contents]), windows[part]
                power, inverse = powers(len(data))
                owner = np.repeat(np.arange(len(contents)), n)
                offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                at = (np.cumsum(sizes) - sizes)[owner] + offset
                hashes = []
                for values in (_TABLE_A, _TABLE_B):
                    total = sums(data, values, power)
                    hashes.append(mixed((total[at + r.length] - total[at]) * inverse[at]).view(np.int64))
                doc, row = (table[c].to_numpy()[part][owner] for c in ("doc", "row"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (*hashes, doc, row, start[part][owner] + offset)], names=["x", "y", "doc", "row", "start"]
                )

    windows = stage(fetched.mapInArrow(run, "x long, y long, doc long, row long, start long"), "repeat-windows")
    firsts = windows.groupBy("x", "y").agg(F.min(F.struct("doc", "row", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
    later = windows.join(firsts.filter("n > 1"), ["x", "y"]).filter("not (doc = first.doc and row = first.row and start = first.start)")
    return later.select("doc", "row", "start", (F.col("start") + r.length).alias("end"))


def repeated_spans(docs: DataFrame, r: Repeats) -> DataFrame:
    """(doc, row, spans): the removed bytes of each document that loses any."""
    settled = stage(equal_contexts(anchored(docs, r), r), "repeat-contexts")
    spans = settled.filter("anchor is null").select("doc", "row", "start", F.col("windows").cast("long").alias("end"))
    asked = settled.filter("anchor is not null")
    crowds = stage(asked.groupBy("anchor").count().filter(F.col("count") > r.crowd).select("anchor"), "repeat-crowds")
    fetched = stage(with_content(asked, docs, r), "repeat-bytes")
    spans = spans.union(repeat_spans(fetched.join(crowds, "anchor", "left_anti"), r))
    if not crowds.isEmpty():
        spans = spans.union(crowded_spans(fetched.join(crowds, "anchor"), r))
    return spans.groupBy("doc", "row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def remove_repeats(docs: DataFrame, r: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts earlier, in any document.

    Returns for every row doc_id, n_bytes, spans (array of start, end: the maximal removed runs of its
    UTF-8 bytes) and kept (the bytes that remain). NULL and empty texts, and those shorter than
    ``length``, lose nothing. Repeated rows are one document and get the same result; a NULL id
    comes after all others. No rows give no rows.
    """
    source = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(F.col(text_col)).alias("row"), F.col(text_col).alias("text")
    )
    spans = repeated_spans(source, r)
    joined = source.join(spans, ["doc", "row"], "left").select("doc", "row", "text", "spans")

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch, texts in byte_slices(batches, "text", 4 << 20):
            raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
            found, kept = [], []
            for own, given in zip(raw, batch.column(batch.schema.get_field_index("spans")).to_pylist()):
                merged: list[list[int]] = []
                for start, end in sorted((s["start"], s["end"]) for s in given or ()):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([start, end])
                found.append([{"start": a, "end": b} for a, b in merged])
                edges = [0, *(x for span in merged for x in span), len(own)]
                kept.append(b"".join(own[a:b] for a, b in zip(edges[::2], edges[1::2])))
            doc = batch.column(batch.schema.get_field_index("doc")).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if d == LAST else d for d in doc], pa.int64()), pa.array([len(x) for x in raw], pa.int64()), pa.array(found, kind), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    span = T.StructType().add("start", "long").add("end", "long")
    schema = T.StructType().add("doc_id", "long").add("n_bytes", "long").add("spans", T.ArrayType(span)).add("kept", "binary")
    return joined.mapInArrow(run, schema)
