"""Near-duplicates by BagMinHash signatures (10): band, verify by multiset overlap, join into groups.

1. Texts of the same words are one class. Each class gets a BagMinHash signature of its multiset of
   five-word shingles; r components make a band. Two texts of similarity s share one of b bands with
   probability 1 - (1 - s^r)^b: with r = 4 and b = 32, all but 5 in 10^8 pairs at 0.8.
2. The classes of a bucket have a leader, the smallest one. Each class is compared with the smallest of
   its leaders, not with all classes that share a bucket with it. Pairs are verified on the whole texts: the sum of the smaller counts over the
   sum of the larger ones is at least ``threshold``. Groups are the components of verified pairs.
3. While buckets hold classes of several groups, further leaders, drawn by hash, are compared with the
   members of other groups, one of each group that a class meets, ``more_leaders`` times. What then still lies apart is settled exactly: the
   buckets concerned form clusters, and every class outside its cluster's largest group is compared
   with all classes of other groups in the cluster, in blocks of ``block`` by ``block`` texts. A block
   counts overlaps itself, skips what it has joined, and gives only the links that join groups. So no
   link that the bands show is lost, and no list of the pairs of a bucket is ever made.

Hot buckets are combined per task (leaders are minima); verification is spread by leader
and salt and reads its rows as a stream. Only ids, signatures and the texts to verify are shuffled.
"""

from __future__ import annotations

import dataclasses
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_slices, pack, stage
from .graph import components, joined_components
from .shingles import bag_signatures, mixed, weighted_shingles, word_hashes

SALTS = 64
SLICE = 1 << 18


@dataclasses.dataclass(frozen=True)
class Near:
    threshold: float = 0.8
    shingle: int = 5
    bands: int = 32
    rows: int = 4
    more_leaders: int = 2
    block: int = 1000

    @property
    def width(self) -> int:
        return self.bands * self.rows


def word_keys(hashes: np.ndarray, counts: np.ndarray) -> list[str | None]:
    """A 128-bit name of each text's sequence of words; None without words."""
    ends = np.cumsum(counts)
    return [
        hashlib.md5(hashes[e - n : e].tobytes()).hexdigest() if n else None for e, n in zip(ends.tolist(), counts.tolist())
    ]


def keyed(docs: DataFrame, text_col: str) -> DataFrame:
    """``__row`` and ``key``, the name of the lower-cased text's words (NULL without words)."""
    rows = pack(docs).select("__row", F.lower(F.col("__row")[text_col]).alias("__text"))

    def run(batches):
        for batch, texts in byte_slices(batches, "__text", SLICE):
            keys = pa.array(word_keys(*word_hashes(texts)), type=pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("__row")), keys], names=["__row", "key"]
            )

    return rows.mapInArrow(run, rows.select("__row").schema.add("key", "string"))


def signed(docs: DataFrame, near: Near, id_col: str, text_col: str) -> DataFrame:
    """(id, key, bands): the name of a text's words, and the hashes of its signature's bands."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.lower(F.col(text_col)).alias("__text"))

    def run(batches):
        turns = mixed(np.arange(1, near.rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        lanes = mixed(np.arange(1, near.bands + 1, dtype=np.uint64))
        for batch, texts in byte_slices(batches, "__text", SLICE):
            hashes, counts = word_hashes(texts)
            times = bag_signatures(*weighted_shingles(hashes, counts, near.shingle), len(texts), near.width)
            marks = mixed(times.view(np.uint64))
            bands = (marks.reshape(len(texts), near.bands, near.rows) * turns).sum(axis=2, dtype=np.uint64)
            bands = mixed(bands + lanes).view(np.int64)
            ends = pa.array(np.arange(len(texts) + 1) * near.bands, type=pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("id")),
                    pa.array(word_keys(hashes, counts), type=pa.string()),
                    pa.ListArray.from_arrays(ends, pa.array(bands.ravel())),
                ],
                names=["id", "key", "bands"],
            )

    schema = T.StructType().add("id", "long").add("key", "string").add("bands", T.ArrayType(T.LongType()))
    return rows.mapInArrow(run, schema)


def verified(pairs: DataFrame, texts: DataFrame, near: Near) -> DataFrame:
    """The pairs (a, b) of nodes whose multisets of shingles overlap enough. ``texts``: (node, text)."""
    salt = F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int").alias("salt")
    pairs = pairs.select("a", "b", salt)
    members = pairs.join(texts, F.col("b") == F.col("node")).select("a", "salt", F.lit(1).alias("member"), "b", "text")
    heads = (
        pairs.select("a", "salt").distinct().join(texts, F.col("a") == F.col("node"))
        .select("a", "salt", F.lit(0).alias("member"), F.col("a").alias("b"), "text")
    )
    rows = members.union(heads).repartition("a", "salt").sortWithinPartitions("a", "salt", "member", "b")

    def run(batches):
        head = None  # (a, salt), shingles and weights of the leader whose members follow
        for batch, texts in byte_slices(batches, "text", SLICE):
            owner, shingle, weight = weighted_shingles(*word_hashes(texts), near.shingle)
            ends = np.searchsorted(owner, np.arange(len(texts) + 1))
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("a", "salt", "member", "b")]
            found = []
            for i, (a, salt_, member, b) in enumerate(zip(*columns)):
                own = slice(ends[i], ends[i + 1])
                bag = shingle[own], weight[own]
                if not member:
                    head = (a, salt_), *bag
                    continue
                assert head is not None and head[0] == (a, salt_)
                _, x, y = np.intersect1d(head[1], bag[0], assume_unique=True, return_indices=True)
                both = np.minimum(head[2][x], bag[1][y]).sum()
                if both >= near.threshold * (head[2].sum() + bag[1].sum() - both) - 1e-9:
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in found], type=pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    return rows.mapInArrow(run, "a long, b long")


def overlaps(bag, ids: np.ndarray, weights: np.ndarray, starts: np.ndarray, totals: np.ndarray, names: np.ndarray):
    """The weighted Jaccard index of one bag (shingles, weights) with each of many, laid end to end.

    ``ids`` are places of their shingles in ``names``, the sorted shingles of all.
    """
    own = np.zeros(len(names) + 1, dtype=np.int64)
    at = np.minimum(np.searchsorted(names, bag[0]), len(names) - 1)
    known = names[at] == bag[0]
    own[at[known]] = bag[1][known]
    both = np.add.reduceat(np.minimum(own[ids], weights), starts)
    return both / (totals + bag[1].sum() - both)


def cross_links(members: DataFrame, texts: DataFrame, near: Near) -> DataFrame:
    """Links (a, b) that join different groups of a cluster. ``members``: (cluster, node, component)."""
    sizes = members.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("cluster").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.sum("n").alias("all"), F.max("n").alias("most"))
    parts = sizes.filter("all > most").select(
        "cluster", "largest",
        F.ceil((F.col("all") - F.col("most")) / near.block).cast("int").alias("seek_parts"),
        F.ceil(F.col("all") / near.block).cast("int").alias("parts"),
    )
    rows = members.join(parts, "cluster").join(texts, "node")

    def dealt(part: str, others: str) -> Column:
        own = F.pmod(F.xxhash64("node", F.lit(part)), F.col(part)).cast("int")
        return own, F.explode(F.sequence(F.lit(0), F.col(others) - 1))

    own, other = dealt("seek_parts", "parts")
    seekers = rows.filter("component <> largest").select("cluster", own.alias("i"), other.alias("j"), F.lit(True).alias("seeks"), "node", "component", "text")
    own, other = dealt("parts", "seek_parts")
    targets = rows.select("cluster", other.alias("i"), own.alias("j"), F.lit(False).alias("seeks"), "node", "component", "text")

    def run(group: pa.Table) -> pa.Table:
        node, component = group["node"].to_numpy(), group["component"].to_numpy()
        owner, shingle, weight = weighted_shingles(*word_hashes(group["text"].to_pylist()), near.shingle)
        ends = np.searchsorted(owner, np.arange(len(node) + 1))
        seeks = group["seeks"].to_numpy()
        target = np.flatnonzero(~seeks)
        spans = np.concatenate([np.arange(ends[k], ends[k + 1]) for k in target]) if len(target) else target
        names, ids = np.unique(shingle[spans], return_inverse=True)
        sizes = np.diff(ends)[target]
        starts = np.cumsum(sizes) - sizes
        totals = np.add.reduceat(weight[spans], starts) if len(target) else sizes
        root = {c: c for c in component.tolist()}

        def top(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        found = []
        for k in np.flatnonzero(seeks) if len(target) else ():
            own = slice(ends[k], ends[k + 1])
            alike = overlaps((shingle[own], weight[own]), ids, weight[spans], starts, totals, names)
            for t in target[alike >= near.threshold - 1e-12]:
                x, y = top(int(component[k])), top(int(component[t]))
                if x != y:
                    root[x] = y
                    found.append((int(node[k]), int(node[t])))
        return pa.table({name: pa.array([f[i] for f in found], pa.int64()) for i, name in enumerate("ab")})

    return seekers.union(targets).groupBy("cluster", "i", "j").applyInArrow(run, "a long, b long")


def near_classes(docs: DataFrame, near: Near = Near(), id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, classes): (id, key) of every row, and (key, component_id) of every class.

    ``component_id`` is the smallest id of the documents in the group. Texts without words have key
    NULL and no class. Ids of classes without any id are NULL.
    """
    rows = stage(signed(docs, near, id_col, text_col), "near-signed")
    same = rows.filter("key is not null").groupBy("key").agg(
        F.min("id").alias("id"), F.first("bands").alias("bands")
    )
    classes = stage(same.withColumn("node", F.monotonically_increasing_id()), "near-classes")

    held = classes.select("node", F.explode("bands").alias("bucket"))
    shared = held.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    members = stage(held.join(shared.drop("high"), "bucket"), "near-members")
    pairs = members.groupBy("node").agg(F.min("low").alias("a")).filter("a <> node")
    pairs = stage(pairs.select("a", F.col("node").alias("b")), "near-pairs")

    wanted = members.select("node").distinct().join(classes.select("node", "key", "id"), "node")
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.lower(F.col(text_col)).alias("text"))
    texts = stage(chosen_texts(source.join(wanted, F.col("doc").eqNullSafe(F.col("id")))), "near-texts")

    edges = stage(verified(pairs, texts, near), "near-edges")
    groups = components(edges, "near-groups")
    for turn in range(near.more_leaders + 1):
        grouped = members.select("bucket", "node").join(groups, "node", "left")
        grouped = grouped.withColumn("component", F.coalesce("component", "node"))
        order = F.xxhash64("node", F.lit(turn))
        split = grouped.groupBy("bucket").agg(
            F.min("component").alias("x"), F.max("component").alias("y"), F.min("node").alias("low"),
            F.min_by(F.struct("node", "component"), order).alias("head"),
        )
        apart = stage(grouped.join(split.filter("x < y").drop("x", "y"), "bucket"), "near-apart")
        if apart.isEmpty():
            break
        if turn < near.more_leaders:
            heads = apart.filter("component <> head.component").select("node", "head.*")
            heads = heads.toDF("node", "head", "group").groupBy("node", "group").agg(
                F.min_by("head", F.xxhash64("head", F.lit(turn))).alias("head")
            )
            pairs = heads.selectExpr("least(node, head) as a", "greatest(node, head) as b")
            found = verified(stage(pairs.distinct(), "near-pairs"), texts, near)
        else:
            clusters = components(apart.selectExpr("low as a", "node as b"), "near-clusters")
            inside = apart.select("node", F.col("component").alias("own")).distinct().join(clusters, "node")
            found = cross_links(inside.selectExpr("component as cluster", "node", "own as component"), texts, near)
        groups = joined_components(groups, stage(found, "near-edges"), "near-groups")
    named = classes.join(groups, "node", "left").select("key", "id", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    return rows.select("id", "key"), stage(named.join(least, "component").select("key", "component_id"), "near-named")


def chosen_texts(candidates: DataFrame) -> DataFrame:
    """(node, text): of rows with a class's id those that have its words, one for each class."""

    def run(batches):
        for batch, texts in byte_slices(batches, "text", SLICE):
            keys = word_keys(*word_hashes(texts))
            fits = pa.array([k == own for k, own in zip(keys, batch.column(batch.schema.get_field_index("key")).to_pylist())])
            yield batch.filter(fits).select(["node", "text"])

    rows = candidates.select("node", "key", "text").mapInArrow(run, "node long, text string")
    return rows.dropDuplicates(["node"])


def first_of_group(partition: list[str], order: list[Column]) -> Column:
    from pyspark.sql import Window

    return F.row_number().over(Window.partitionBy(*partition).orderBy(*order)) == 1


def near_duplicates(docs: DataFrame, near: Near = Near(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, component_id, kept) for every row of ``docs``.

    ``component_id`` is the smallest doc_id of the group, ``kept`` marks one row of each group: the one
    of that doc_id (of repeated rows one). A text without words (NULL, empty, white space) is like
    nothing: it is a group of its own and kept, with its own id. A text of fewer than five words has
    one shingle. Ids may be NULL; a group with NULL ids alone keeps one row. No rows give no rows.
    """
    rows, classes = near_classes(docs, near, id_col, text_col)
    joined = rows.join(classes, "key", "left")
    alone = F.col("key").isNull()
    leads = F.col("id").eqNullSafe(F.col("component_id"))
    lead = joined.filter(~alone & leads).withColumn("kept", first_of_group(["component_id"], [F.col("key")]))
    rest = joined.filter(alone | ~leads).withColumn("kept", alone)
    return lead.union(rest).select(
        F.col("id").alias("doc_id"), F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"), "kept"
    )


def without_near_duplicates(docs: DataFrame, near: Near = Near(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` packed as ``__row``, with one row of each group: see ``near_duplicates``."""
    _, classes = near_classes(docs, near, id_col, text_col)
    rows = keyed(docs, text_col)
    joined = rows.join(classes, "key", "left")
    leads = joined.filter(F.col("key").isNotNull() & F.col("__row")[id_col].eqNullSafe(F.col("component_id")))
    one = leads.withColumn("__one", first_of_group(["component_id"], [F.col("key")])).filter("__one")
    return one.select("__row").union(joined.filter("key is null").select("__row"))
