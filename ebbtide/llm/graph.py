"""Connected components of an edge table, by repeated joins; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: A key that more than 1 / HEAVY_SHARE of the rows hold, and more than HEAVY_LEAST of them, is heavy.
#: So there are fewer than HEAVY_SHARE heavy keys at any size, and their table can be broadcast.
HEAVY_SHARE = 10_000
HEAVY_LEAST = 1_000


def heavy_keys(rows: DataFrame, key: str) -> DataFrame | None:
    """(heavy): the keys of heavy weight, fewer than ``HEAVY_SHARE``; None if there are none. Counted per task before
    the shuffle."""
    n = rows.count()
    if n <= HEAVY_LEAST:
        return None
    limit = max(HEAVY_LEAST, n // HEAVY_SHARE)
    keys = rows.groupBy(F.col(key).alias("heavy")).count().filter(F.col("count") > limit).select("heavy")
    keys = stage(keys, "heavy-keys")
    return None if keys.isEmpty() else keys


def with_label_of(rows: DataFrame, key: str, spare: str, heavy: DataFrame | None, labels: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``name``, the label in ``labels`` (node, label) of the node in ``key``, or itself if it has none.

    Labels of ``heavy`` keys are broadcast. Their rows look up the node in ``spare`` in the join by
    hash, so they spread over all tasks and that answer is not used.
    """
    own_labels = labels.selectExpr("node as at", "label as own_label")
    if heavy is None:
        found = rows.join(own_labels, F.col(key) == F.col("at"), "left")
        return found.select(*rows.columns, F.coalesce("own_label", key).alias(name))
    few = heavy.join(labels, F.col("heavy") == F.col("node"), "left")
    few = few.select("heavy", F.coalesce("label", "heavy").alias("heavy_label"))
    marked = rows.join(F.broadcast(few), F.col(key) == F.col("heavy"), "left")
    marked = marked.withColumn("sought", F.when(F.col("heavy").isNull(), F.col(key)).otherwise(F.col(spare)))
    found = marked.join(own_labels, F.col("sought") == F.col("at"), "left")
    own: Column = F.coalesce("heavy_label", "own_label", key)
    return found.select(*rows.columns, own.alias(name))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): for each node of ``edges`` (a, b) the smallest node that it can reach.

    Every node points at the smallest of itself and its neighbours, then at the end of the way that
    the pointers make, found in the logarithm of its length by taking the pointer of the pointer. The
    ends, and the distinct edges between them, are the next round's graph, until no edge is left; then
    the rounds' pointers are put together, last round first. An end takes in a node or points at another in
    two rounds, so the graph halves at least every two rounds, and an edge is read again only while its
    ends lie apart. Each step is written, so a lost executor costs one step at most. A hub's
    neighbours are combined per task before they are shuffled, and neither the rows that ask for a
    hub's label nor the members of a large group, which ask for the label of one node, meet in one
    task: see ``with_label_of``. No edges give no rows.
    """
    left = stage(apart(edges, "a", "b"), f"{name}-edges")
    rounds = []
    while not rounds or not left.isEmpty():
        both = left.union(left.selectExpr("b as a", "a as b"))
        labels = stage(both.groupBy("a").agg(F.min("b").alias("n")).selectExpr("a as node", "least(a, n) as label"), name)
        while True:
            jumped = with_label_of(labels, "label", "node", heavy_keys(labels, "label"), labels, "jump")
            jumped = stage(jumped, f"{name}-jumped")
            labels = jumped.selectExpr("node", "jump as label")
            if jumped.filter("label <> jump").isEmpty():
                break
        rounds.append(labels)
        half = with_label_of(left, "a", "b", heavy_keys(left, "a"), labels, "x")
        whole = with_label_of(half, "b", "a", heavy_keys(left, "b"), labels, "y")
        left = stage(apart(whole, "x", "y"), f"{name}-edges")
    found = rounds.pop()
    while rounds:
        labels = rounds.pop()
        named = with_label_of(labels, "label", "node", heavy_keys(labels, "label"), found, "end")
        found = stage(named.selectExpr("node", "end as label"), name)
    return found.select("node", F.col("label").alias("component"))


def apart(edges: DataFrame, x: str, y: str) -> DataFrame:
    """(a, b): the distinct edges of two ends, the smaller one first."""
    return edges.filter(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def joined_components(known: DataFrame, links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): ``known``, an answer of ``components``, with ``links`` (a, b) added to its edges.

    Each end of a link is replaced by its component; only links between different components are
    left, and only their components are searched. So the work of the rounds follows the new links,
    and the known groups are read once to be renamed. Nodes that only ``links`` hold are added.
    Links inside the known groups change nothing; with no known groups it is ``components`` of the links.
    """
    labels = known.select("node", F.col("component").alias("label"))
    ends = stage(links.select("a", "b").filter("a <> b"), f"{name}-ends")
    left = with_label_of(ends, "a", "b", heavy_keys(ends, "a"), labels, "x")
    between = stage(with_label_of(left, "b", "a", heavy_keys(ends, "b"), labels, "y"), f"{name}-between")
    merged = components(between.selectExpr("x as a", "y as b"), f"{name}-merged").withColumnRenamed("component", "label")
    fresh = ends.select("a").union(ends.select("b")).distinct().join(known, F.col("a") == F.col("node"), "left_anti")
    whole = stage(known.select("node", "component").union(fresh.selectExpr("a", "a as component")), f"{name}-whole")
    named = with_label_of(whole, "component", "node", heavy_keys(whole, "component"), merged, "merged")
    return stage(named.selectExpr("node", "merged as component"), name)
