r"""Ranked lexical search (12): dense tiles of item weights times dense tiles of document impacts.

Every document gets a score for every item: the sum, over the item's terms, of a term's weight times the
impact of its frequency in the document. Both are whole numbers, so the scores of a tile of documents are
one matrix product, and exact in float64 as long as no partial sum passes 2**53:

1. Items arrive in groups of bounded size (``Search.group_bytes``). A group's distinct terms are its compact
   vocabulary; only they have columns, whatever else the documents say.
2. One pass counts documents, terms, and in how many documents each term of the vocabulary occurs. Tasks send
   one row per term that they met, which Spark sums.
3. A second pass scores. Of each document a task keeps the counts of vocabulary terms; for ``docs`` documents
   and a tile of the vocabulary it fills a matrix of impacts and multiplies it with the items' weights for the
   tile (BLAS). A tile has so many terms that the sum of its weights times the largest impact stays below
   2**53 (``tile_edges``), so the product is exact; products of several tiles are added as 64-bit integers.
4. A task keeps each item's ``k`` best documents. A tile's candidates are all those that reach the item's k-th
   score so far, ties included, and are cut to ``k`` only in the order (score falling, id ascending). The
   tasks' lists meet in two rounds of row numbers, the first by item and a bucket of tasks.

Documents are read in blocks and never shuffled; a group of items is all that is sent to the tasks.
"""

from __future__ import annotations

import dataclasses
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pack

#: Partial sums below this are exact in float64.
EXACT = 1 << 53
#: An impact is ``UNIT * tf // (STEP * tf + TILT * m)``, below ``UNIT / STEP``.
UNIT, STEP, TILT = 1_000_000_000, 1000, 8
TOP_IMPACT = UNIT // STEP
#: Bytes that are no part of a term become blanks, A to Z become a to z, all others stay (UTF-8).
FOLDED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


@dataclasses.dataclass(frozen=True)
class Search:
    k: int = 10
    #: Most items of a group, and the bytes of their terms (an item is never split). Each group is read for twice:
    #: once to count, once to score.
    group_items: int = 4096
    group_bytes: int = 4 << 20
    #: Documents in a tile.
    docs: int = 512
    #: Most terms of a vocabulary tile.
    terms: int = 4096
    #: Most items in one product.
    items: int = 1024
    #: Buckets of tasks in the first round of the last step.
    buckets: int = 64
    #: About so many bytes of a long text are split into terms at once.
    piece: int = 1 << 20


def term_counts(raw: bytes, piece: int = 1 << 20) -> Counter:
    """The terms of a whole UTF-8 text with their numbers, a piece of the text at a time."""
    folded = raw.translate(FOLDED)
    if len(folded) <= piece:
        return Counter(folded.split())
    counts: Counter = Counter()
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + piece)
        end = len(folded) if end < 0 else end
        counts.update(folded[at:end].split())
        at = end
    return counts


def tile_edges(weights: np.ndarray, most: int, top: int = TOP_IMPACT) -> list[int]:
    """Where vocabulary tiles begin and end: at most ``most`` terms, and no product's sum above 2**53."""
    edges, total = [0], 0
    for k, weight in enumerate(weights.tolist()):
        if k > edges[-1] and (k - edges[-1] >= most or total + weight * top >= EXACT):
            edges.append(k)
            total = 0
        total += weight * top
    return [*edges, len(weights)] if len(weights) else [0]


@dataclasses.dataclass
class ItemGroup:
    """A bounded group of items: ids, and the places of their terms in the compact vocabulary."""

    ids: list[int | None]
    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]


def item_groups(items: DataFrame, item_id: str, text: str, options: Search):
    """Groups of items, read in the order of their ids: rows of one id are one item with all their terms."""
    rows = items.select(F.col(item_id).alias("i"), F.col(text).cast("binary").alias("t")).orderBy("i")
    ids, vocabulary, terms, size = [], {}, [], 0
    for row in rows.toLocalIterator(prefetchPartitions=False):
        same = bool(ids) and ids[-1] == row["i"]
        if not same and (size >= options.group_bytes or len(ids) >= options.group_items):
            yield ItemGroup(ids, vocabulary, terms)
            ids, vocabulary, terms, size = [], {}, [], 0
        own = []
        for term in term_counts(bytes(row["t"] or b""), options.piece):
            if term not in vocabulary:
                vocabulary[term] = len(vocabulary)
                size += len(term)
            own.append(vocabulary[term])
        size += 8 * len(own) + 64
        if same:
            terms[-1] = np.union1d(terms[-1], own).astype(np.int64)
        else:
            ids.append(row["i"])
            terms.append(np.array(sorted(own), dtype=np.int64))
    if ids:
        yield ItemGroup(ids, vocabulary, terms)


def corpus_counts(docs: DataFrame, vocabulary: dict[bytes, int], options: Search) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and documents holding each vocabulary term."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    width = len(vocabulary)

    def run(batches):
        known = sent.value
        keys = known.keys()
        found = np.zeros(width, dtype=np.int64)
        n_docs = n_terms = 0
        for batch in batches:
            for raw in batch.column(0):
                text = raw.as_py()
                if not text:
                    continue
                counts = term_counts(text, options.piece)
                if counts:
                    n_docs += 1
                    n_terms += counts.total()
                    for term in counts.keys() & keys:
                        found[known[term]] += 1
        met = np.flatnonzero(found)
        cells = np.concatenate([[-2, -1], met])
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int64()), pa.array(np.concatenate([[n_docs, n_terms], found[met]]), pa.int64())],
            names=["cell", "n"],
        )

    sums = docs.select("__text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    by_cell = {row["cell"]: row["n"] for row in sums.collect()}  # as many rows as the group has terms
    sent.unpersist()
    found = np.array([by_cell.get(k, 0) for k in range(width)], dtype=np.int64)
    return by_cell.get(-2, 0), by_cell.get(-1, 0), found


def term_weights(found: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 * ln((2 N + 2) / (2 df + 1)))."""
    return np.floor(1000.0 * np.log((2.0 * n_docs + 2.0) / (2.0 * found + 1.0))).astype(np.int64)


def length_terms(n: int, n_docs: int, n_terms: int) -> int:
    """A document's m: 100 - 90 + 90 n N / L, rounded down."""
    return 10 + (90 * n * n_docs) // n_terms


class Best:
    """The k best documents of each item so far, in the order (score falling, id ascending, none last)."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.ids: list[list] = [[] for _ in range(n_items)]
        self.values: list[list] = [[] for _ in range(n_items)]
        self.floor = np.ones(n_items, dtype=np.int64)

    def add(self, first: int, scores: np.ndarray, ids: list) -> None:
        """``scores`` (items x documents) of the items from ``first`` on."""
        floor = self.floor[first : first + len(scores), None]
        rows, cols = np.nonzero(scores >= floor)  # a tie with the k-th is a candidate
        if not len(rows):
            return
        cuts = np.flatnonzero(np.diff(rows)) + 1
        for part in np.split(np.arange(len(rows)), cuts):
            item = first + int(rows[part[0]])
            own = scores[rows[part[0]], cols[part]]
            pairs = list(zip(self.values[item], self.ids[item])) + list(zip(own.tolist(), [ids[c] for c in cols[part]]))
            pairs.sort(key=lambda p: (-p[0], p[1] is None, p[1] if p[1] is not None else 0))
            pairs = pairs[: self.k]
            self.values[item] = [p[0] for p in pairs]
            self.ids[item] = [p[1] for p in pairs]
            if len(pairs) == self.k:
                self.floor[item] = pairs[-1][0]


def group_scores(docs: DataFrame, group: ItemGroup, weights: np.ndarray, n_docs: int, n_terms: int, options: Search) -> DataFrame:
    """Each task's best documents of each item: ``item`` (place in the group), ``doc``, ``score``, ``task``."""
    edges = tile_edges(weights, options.terms)
    blocks = []  # the first item, the number of items, and the cells of their weights
    for first in range(0, len(group.ids), options.items):
        some = group.terms[first : first + options.items]
        rows = np.repeat(np.arange(len(some)), [len(t) for t in some])
        cols = np.concatenate(some) if some else np.zeros(0, dtype=np.int64)
        used = np.unique(np.searchsorted(edges, cols, side="right") - 1).tolist()
        blocks.append((first, len(some), rows, cols, used))
    sent = docs.sparkSession.sparkContext.broadcast((group.vocabulary, weights, edges, blocks))
    n_items = len(group.ids)

    def run(batches):
        from pyspark import TaskContext

        known, weight, cuts, parts = sent.value
        keys = known.keys()
        best = Best(n_items, options.k)
        dense = {}  # the items' weights by block and tile, filled once per task

        def item_weights(block: int, tile: int) -> np.ndarray:
            if (block, tile) not in dense:
                _, size, rows, cols, _ = parts[block]
                low, high = cuts[tile], cuts[tile + 1]
                inside = (cols >= low) & (cols < high)
                matrix = np.zeros((size, high - low))
                matrix[rows[inside], cols[inside] - low] = weight[cols[inside]]
                if len(dense) * matrix.nbytes > 128 << 20:
                    dense.clear()
                dense[block, tile] = matrix
            return dense[block, tile]

        def score(ids, columns, impacts, lengths):
            rows = np.repeat(np.arange(len(ids)), lengths)
            columns, impacts = np.concatenate(columns), np.concatenate(impacts)
            tiles = np.searchsorted(cuts, columns, side="right") - 1
            order = np.argsort(tiles, kind="stable")
            rows, columns, impacts, tiles = rows[order], columns[order], impacts[order], tiles[order]
            ends = np.searchsorted(tiles, np.arange(len(cuts)))
            for block, (first, size, _, _, used) in enumerate(parts):
                scores = np.zeros((size, len(ids)), dtype=np.int64)
                for tile in used:
                    own = slice(ends[tile], ends[tile + 1])
                    matrix = np.zeros((cuts[tile + 1] - cuts[tile], len(ids)))
                    matrix[columns[own] - cuts[tile], rows[own]] = impacts[own]
                    scores += (item_weights(block, tile) @ matrix).astype(np.int64)
                best.add(first, scores, ids)

        ids, columns, impacts, lengths = [], [], [], []
        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = raw.as_py()
                if not text:
                    continue
                counts = term_counts(text, options.piece)
                shared = counts.keys() & keys
                if not shared:
                    continue
                m = length_terms(counts.total(), n_docs, n_terms)
                tf = np.fromiter((counts[t] for t in shared), dtype=np.int64, count=len(shared))
                ids.append(doc)
                columns.append(np.fromiter((known[t] for t in shared), dtype=np.int64, count=len(shared)))
                impacts.append((UNIT * tf) // (STEP * tf + TILT * m))
                lengths.append(len(shared))
                if len(ids) == options.docs:
                    score(ids, columns, impacts, lengths)
                    ids, columns, impacts, lengths = [], [], [], []
        if ids:
            score(ids, columns, impacts, lengths)
        task = TaskContext.get().partitionId()
        places = np.repeat(np.arange(n_items), [len(v) for v in best.values])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(places, pa.int64()),
                pa.array([d for own in best.ids for d in own], pa.int64()),
                pa.array([s for own in best.values for s in own], pa.int64()),
                pa.array(np.full(len(places), task), pa.int64()),
            ],
            names=["item", "doc", "score", "task"],
        )

    return docs.select("__doc", "__text").mapInArrow(run, "item long, doc long, score long, task long")


def search(
    docs: DataFrame, items: DataFrame, options: Search = Search(), doc_id="doc_id", text="text", item_id="item_id", item_text="text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0.

    Equal scores stand by ascending document id, a NULL id last. NULL and empty texts have no terms: such a
    document counts nowhere, such an item has no rows. Repeated document rows are documents of their own, each
    counted and ranked; rows that share an item id are one item with the terms of all of them. Very long texts
    are read whole, a piece at a time. Further columns, whatever their names, aren't read. No documents, or no
    items: no rows.
    """
    spark = docs.sparkSession
    rows = pack(docs).select(
        F.col("__row")[doc_id].cast("long").alias("__doc"), F.col("__row")[text].cast("binary").alias("__text")
    )
    source = items.schema[item_id].dataType
    schema = T.StructType().add("item_id", source).add("rank", "integer").add("doc_id", "long").add("score", "long")
    out = spark.createDataFrame([], schema)
    for group in item_groups(items, item_id, item_text, options):
        if not group.vocabulary:
            continue
        n_docs, n_terms, found = corpus_counts(rows, group.vocabulary, options)
        if not n_terms:
            continue
        weights = term_weights(found, n_docs)
        scored = group_scores(rows, group, weights, n_docs, n_terms, options)
        order = [F.desc("score"), F.asc_nulls_last("doc")]
        bucket = Window.partitionBy("item", F.pmod("task", F.lit(options.buckets))).orderBy(*order)
        first = scored.withColumn("__place", F.row_number().over(bucket)).filter(F.col("__place") <= options.k)
        last = F.row_number().over(Window.partitionBy("item").orderBy(*order))
        names = spark.createDataFrame(list(enumerate(group.ids)), T.StructType().add("item", "long").add("item_id", source))
        ranked = first.drop("__place").withColumn("rank", last).filter(F.col("rank") <= options.k)
        # one row per item of a bounded group
        out = out.unionByName(
            ranked.join(F.broadcast(names), "item").select("item_id", "rank", F.col("doc").alias("doc_id"), "score")
        )
    return out
