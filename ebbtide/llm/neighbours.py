"""Embedding near-dedup by NN-descent (5).

1. Equal vectors of one label are one node, with their number. Vectors of other labels, or of another
   length, are never compared.
2. First lists: in each of ``trees`` seeded rounds the vectors of a label are dealt into cells by the
   signs of random projections, about ``cell`` to a cell, and each vector gets its nearest ones of the
   cell. A crowded cell is dealt into parts by hash, so no task holds more than a few ``cell``s. The
   larger a label, the more bits name a cell and the more trees it gets: as many as let a pair at the
   threshold share a cell with probability ``share``, at least ``trees``.
3. Descent: every node brings its neighbours, and the nodes whose neighbour it is, together, and pairs
   of them that are nearer than what they have enter their lists; again until nothing changes. A list
   holds ``k`` neighbours. If all of a full list lie above the threshold the list is saturated, and twice
   as long from then on, up to ``k_most``: it brings all of them together. Step 5 needs no list.
4. Audit: one node of each of up to ``audit`` groups, drawn by hash, is compared with all rows by brute
   force, so a large group counts once and nodes without a link are seen. It is drawn again, up to
   ``draws`` times, until ``audit_links`` nodes with links were seen. Links between different groups were
   missed and are added. Further trees are grown and descended from until an audit finds that at least
   ``recall`` of the nodes with links miss none; each audit's recall is logged.
5. Links at or above the threshold join nodes into groups. Within a group all pairs are compared, in
   blocks of ``block`` nodes, and counted, never listed: so a node's number of links is exact
   however many neighbours its list had room for.

Similarities are cosines in double precision. Vectors travel only to the cells, to the pivots whose
neighbour lists name them, and to the blocks of their group.
"""

from __future__ import annotations

import dataclasses
import logging
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage
from .graph import components, joined_components

LOG = logging.getLogger(__name__)
EDGES = T.StructType().add("a", "long").add("b", "long").add("sim", "double")


@dataclasses.dataclass(frozen=True)
class Descent:
    threshold: float = 0.93
    #: Pairs below this cosine lead nowhere: no neighbour of both ends of a link is farther than this from both.
    reach: float = 0.5
    trees: int = 12
    share: float = 0.99
    cell: int = 200
    k: int = 10
    k_most: int = 80
    iterations: int = 6
    audit: int = 2000
    audit_links: int = 200
    draws: int = 4
    recall: float = 0.999
    block: int = 1000
    seed: int = 11


def usable(embedding: str, label: str) -> Column:
    """Whether a row can have links: a label, and a vector of finite components that aren't all 0."""
    value = F.col(embedding)
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    some = F.exists(value, lambda x: x != 0)
    return F.coalesce(F.col(label).isNotNull() & (F.size(value) > 0) & ~bad & some, F.lit(False))


def unit_rows(column: pa.ChunkedArray, size: int) -> np.ndarray:
    """[rows, size] vectors of length 1, in double precision."""
    flat = column.combine_chunks()
    flat = flat.flatten() if isinstance(flat, (pa.ListArray, pa.LargeListArray)) else pa.concat_arrays(flat.chunks).flatten()
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def edge_table(a: np.ndarray, b: np.ndarray, sim: np.ndarray) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "sim": pa.array(sim, pa.float64())})


def trees_for(bits: Column, d: Descent) -> Column:
    """Trees in which a pair at the threshold shares one cell of so many ``bits`` with probability ``share``."""
    same_side = 1 - math.acos(d.threshold) / math.pi
    wanted = F.ceil(F.lit(math.log(1 - d.share)) / F.log1p(-F.pow(F.lit(same_side), bits)))
    return F.greatest(F.lit(d.trees), wanted).cast("int")  # no bits: the logarithm is NULL


def tree_edges(nodes: DataFrame, d: Descent, turn: int) -> DataFrame:
    """(a, b, sim): the ``k`` nearest of each node in its cell of each tree of this turn, no farther than ``reach``."""
    sizes = nodes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("members"))
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("members") / d.cell))).cast("int")
    sizes = sizes.select("label", "size", bits.alias("bits")).withColumn("trees", trees_for(F.col("bits"), d))
    rows = nodes.join(sizes, ["label", "size"])
    names = ["node", "label", "size", "vec", "bits", "trees"]

    def deal(batches):
        planes: dict = {}
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("size")).to_numpy()
            bits = batch.column(batch.schema.get_field_index("bits")).to_numpy()
            vec = pa.chunked_array([batch.column(batch.schema.get_field_index("vec"))])
            trees = batch.column(batch.schema.get_field_index("trees")).to_numpy()
            for size, n_trees in np.unique(np.stack([length, trees]), axis=1).T.tolist():
                at = np.flatnonzero((length == size) & (trees == n_trees))
                x = unit_rows(vec.take(pa.array(at)), size)
                own = batch.take(pa.array(at)).select(["node", "label", "size", "vec"])
                for tree in range(n_trees * turn, n_trees * (turn + 1)):
                    if (size, tree) not in planes:
                        planes[size, tree] = np.random.default_rng([d.seed, size, tree]).standard_normal((size, 48))
                    most = int(bits[at].max())
                    signs = (x @ planes[size, tree][:, :most] > 0) & (np.arange(most) < bits[at][:, None])
                    code = (signs * (1 << np.arange(most, dtype=np.int64))).sum(axis=1) if most else np.zeros(len(at), dtype=np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [*own.columns, pa.array(np.full(len(at), tree), pa.int32()), pa.array(code.astype(np.int64))],
                        names=["node", "label", "size", "vec", "tree", "cell"],
                    )

    schema = rows.select(*names[:4]).schema.add("tree", T.IntegerType()).add("cell", T.LongType())
    dealt = rows.select(*names).mapInArrow(deal, schema)
    cell = ["label", "size", "tree", "cell"]
    crowd = stage(dealt.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 3 * d.cell), "nn-crowded")
    parts = F.coalesce(F.ceil(F.col("n") / (2 * d.cell)), F.lit(1)).cast("int")
    dealt = dealt.join(crowd, cell, "left").withColumn("part", F.pmod(F.xxhash64("node", "tree"), parts)).drop("n")

    def nearest(group: pa.Table) -> pa.Table:
        node = group["node"].to_numpy()
        x = unit_rows(group["vec"], group["size"][0].as_py())
        sims = x @ x.T
        np.fill_diagonal(sims, -2)
        k = min(d.k, len(node) - 1)
        if k < 1:
            return edge_table(node[:0], node[:0], sims[:0, 0])
        best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        value = np.take_along_axis(sims, best, axis=1).ravel()
        kept = value >= d.reach
        return edge_table(np.repeat(node, k)[kept], node[best].ravel()[kept], value[kept])

    return dealt.groupBy(*cell, "part").applyInArrow(nearest, EDGES)


def best_of(edges: DataFrame, lengths: DataFrame) -> DataFrame:
    """The nearest neighbours of each node, as many as its list holds (``lengths``: a, k)."""
    order = Window.partitionBy("a").orderBy(F.col("sim").desc(), "b")
    ranked = edges.groupBy("a", "b").agg(F.max("sim").alias("sim")).join(lengths, "a")
    return ranked.withColumn("turn", F.row_number().over(order)).filter("turn <= k").select("a", "b", "sim")


def pivot_edges(lists: DataFrame, lengths: DataFrame, nodes: DataFrame, d: Descent) -> DataFrame:
    """Pairs met at a pivot: among its neighbours, and up to as many nodes, as its list is long, that have it as one."""
    back = lists.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim")
    some = Window.partitionBy("a").orderBy(F.col("sim").desc(), F.xxhash64("b"))
    back = back.withColumn("turn", F.row_number().over(some)).filter(F.col("turn") <= d.k_most).join(lengths, "a")
    back = back.filter("turn <= k").select(*lists.columns)
    met = lists.union(back).select(F.col("a").alias("pivot"), F.col("b").alias("node")).distinct()
    met = met.join(nodes.select("node", "size", "vec"), "node")

    def pairs(group: pa.Table) -> pa.Table:
        node = group["node"].to_numpy()
        x = unit_rows(group["vec"], group["size"][0].as_py())
        sims = x @ x.T
        np.fill_diagonal(sims, -2)
        i, j = np.nonzero(sims >= d.reach)
        return edge_table(node[i], node[j], sims[i, j])

    return met.groupBy("pivot").applyInArrow(pairs, EDGES)


def descend(edges: DataFrame, nodes: DataFrame, d: Descent) -> DataFrame:
    """Neighbour lists that no further pivot improves, or those of the last iteration."""
    lengths = stage(edges.select("a").distinct().withColumn("k", F.lit(d.k)), "nn-lengths")
    lists = stage(best_of(edges, lengths), "nn-lists")
    for _ in range(d.iterations):
        full = lists.filter(F.col("sim") >= d.threshold).groupBy("a").agg(F.count(F.lit(1)).alias("linked"))
        longer = (F.col("linked") >= F.col("k")) & (F.col("k") < d.k_most)
        lengths = lengths.join(full, "a", "left").select("a", F.when(longer, 2 * F.col("k")).otherwise(F.col("k")).alias("k"))
        lengths = stage(lengths, "nn-lengths")
        better = stage(best_of(lists.union(pivot_edges(lists, lengths, nodes, d)), lengths), "nn-lists")
        changed = better.select("a", "b").join(lists, ["a", "b"], "left_anti")
        done = changed.isEmpty()
        lists = better
        if done:
            break
    return lists


def missed_links(nodes: DataFrame, groups: DataFrame, d: Descent, draw: int) -> tuple[DataFrame, int, int]:
    """(links, missing, linked): of one node each of a bounded sample of groups the links that leave its group,
    the number of nodes that have such links, and of nodes that have any."""
    order = F.xxhash64("node", F.lit(draw))
    joined = nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    joined = stage(joined.select("node", "label", "size", "vec", "component"), "nn-audited")
    heads = joined.groupBy("component").agg(F.min(F.struct(order.alias("turn"), "node")).alias("head"))
    heads = heads.orderBy("head").limit(d.audit).select("head.node")  # bounded by d.audit
    sample = joined.join(F.broadcast(heads), "node").collect()
    known: dict = {}
    for r in sample:
        known.setdefault((r["label"], r["size"]), []).append(r)
    packed = {}
    for (label, size), rows in known.items():
        x = np.array([r["vec"] for r in rows], dtype=np.float64)
        x /= np.abs(x).max(axis=1)[:, None]
        packed[label, size] = (
            np.array([r["node"] for r in rows]), np.array([r["component"] for r in rows]), x / np.sqrt((x * x).sum(axis=1))[:, None]
        )

    def compare(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            label, size = table["label"].to_pylist(), table["size"].to_numpy()
            for key in set(zip(label, size.tolist())) & set(packed):
                at = np.array([k for k, (a, b) in enumerate(zip(label, size)) if (a, b) == key])
                part = table.take(pa.array(at))
                node, group = part["node"].to_numpy(), part["component"].to_numpy()
                own, own_group, x = packed[key]
                sims = unit_rows(part["vec"], key[1]) @ x.T
                i, j = np.nonzero((sims >= d.threshold) & (node[:, None] != own))
                apart = group[i] != own_group[j]
                linked = np.unique(own[j])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(node[i][apart].tolist() + [None] * len(linked), pa.int64()),
                        pa.array(np.concatenate([own[j][apart], linked]), pa.int64()),
                    ],
                    names=["a", "b"],
                )

    found = stage(joined.mapInArrow(compare, "a long, b long"), "nn-audit")
    counts = found.agg(F.countDistinct("b").alias("linked"), F.countDistinct(F.when(F.col("a").isNotNull(), F.col("b"))).alias("missing")).first()
    return found.filter("a is not null"), counts["missing"], counts["linked"]


def audited(nodes: DataFrame, groups: DataFrame, d: Descent, turn: int) -> tuple[DataFrame, bool]:
    """The groups with the missed links that an audit finds, and whether it finds that too few were missed to go on."""
    missing = linked = 0
    for draw in range(d.draws):
        links, n_missing, n_linked = missed_links(nodes, groups, d, d.draws * turn + draw)
        missing, linked = missing + n_missing, linked + n_linked
        if n_missing:
            groups = joined_components(groups, links, "nn-groups")
        if linked >= d.audit_links:
            break
    LOG.info("turn %d: %d of %d audited nodes with links missed one, recall %.4f", turn, missing, linked, 1 - missing / max(1, linked))
    return groups, missing <= (1 - d.recall) * linked


def link_counts(nodes: DataFrame, groups: DataFrame, d: Descent) -> DataFrame:
    """(node, others): the vectors of other nodes of its group that each node links with, by blocks of the group."""
    sizes = groups.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / d.block).cast("int").alias("n"))
    rows = groups.join(sizes, "component").join(nodes.select("node", "size", "vec", "n_rows"), "node")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(
        "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "size", "vec", "n_rows"
    )

    def count(group: pa.Table) -> pa.Table:
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        own, node, weight = group["own"].to_numpy(), group["node"].to_numpy(), group["n_rows"].to_numpy()
        x = unit_rows(group["vec"], group["size"][0].as_py())
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        linked = x[left] @ x[right].T >= d.threshold
        if i == j:
            np.fill_diagonal(linked, False)
            linked = linked & linked.T
            return pa.table({"node": node[left], "others": linked @ weight[right]})
        return pa.table({"node": np.concatenate([node[left], node[right]]), "others": np.concatenate([linked @ weight[right], weight[left] @ linked])})

    counted = rows.groupBy("component", "i", "j").applyInArrow(count, "node long, others long")
    return counted.groupBy("node").agg(F.sum("others").alias("others"))


def linked_vectors(
    embeddings: DataFrame, d: Descent = Descent(), id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: see the module.

    Rows without a label, and vectors that are NULL, empty, zero, or hold NULL or a non-finite
    component, have no link and are groups of their own. Repeated rows and equal vectors link with
    each other. Vectors of different lengths don't. ``component_id`` is NULL only if every id of the
    group is. No rows give no rows.
    """
    rows = embeddings.select(F.col(id_col).alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).alias("vec"))
    rows = rows.withColumn("ok", usable("vec", "label"))
    keys = [F.xxhash64("label", "vec").alias("key_a"), F.xxhash64(F.lit(d.seed), "vec", "label").alias("key_b")]
    good = rows.filter("ok").select("*", *keys)
    nodes = good.groupBy("key_a", "key_b").agg(
        F.first("label").alias("label"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("n_rows"), F.min("vec_id").alias("least")
    )
    nodes = stage(nodes.withColumns({"node": F.monotonically_increasing_id(), "size": F.size("vec")}), "nn-nodes")

    edges = stage(descend(tree_edges(nodes, d, 0), nodes, d), "nn-edges")
    groups = components(edges.filter(F.col("sim") >= d.threshold), "nn-groups")
    turn = 0
    while True:
        groups, enough = audited(nodes, groups, d, turn)
        if enough:
            break
        turn += 1
        edges = stage(descend(edges.union(tree_edges(nodes, d, turn)), nodes, d), "nn-edges")
        groups = joined_components(groups, edges.filter(F.col("sim") >= d.threshold), "nn-groups")

    whole = nodes.select("key_a", "key_b", "node", "n_rows", "least").join(groups, "node", "left")
    whole = whole.join(link_counts(nodes, groups, d), "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    named = whole.join(least, "component").select(
        "key_a", "key_b", "component_id", (F.col("n_rows") - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links")
    )
    linked = good.join(named, ["key_a", "key_b"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
