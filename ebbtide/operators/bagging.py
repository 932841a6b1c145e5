"""Forests of fully grown trees on class-balanced draws, with out-of-bag scores and importance.

Every tree sees ``s`` rows of each response class, drawn with replacement by seeded digests. The draws are a
table (tree, row, times), so it is known for good which rows a tree has not seen. A tree is grown in
one task from its own sample, which has a stated bound (``options.forest_sample_most`` rows of each
class); the training rows are read once for all trees, and no pass runs over them per level.

Growth has no limit of depth, no bins and no least leaf: at a node some ``sqrt(p)`` variables are drawn, all cuts
between distinct values (for a category: of its levels in the order of their response rate, among which
the best subset of levels always is) compete by Gini impurity, and a node ends when it is pure or none
of the drawn variables can divide it. A score is the share of trees that vote for class 1.
"""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..options import Options
from ..session import stage
from .ranking import running_totals

TREE_SCHEMA = (
    "tree int, variable array<int>, cut array<double>, low array<array<int>>, left array<int>, right array<int>, "
    "vote array<int>, decrease array<double>"
)


# Draws


def sample_size(goods: int, options: Options) -> int:
    """Rows of each class in a tree's sample: a share of the positives, within the bound."""
    return max(1, min(round(goods * options.forest_sample_share), options.forest_sample_most))


def numbered_rows(rows: DataFrame, response: str, id_column: str, seed: int) -> DataFrame:
    """``class, id, position``: rows of each class numbered from 0 in the order of a seeded digest.

    Rows are numbered within range pieces, so no task holds a class.
    """
    identity = F.col(id_column).cast("string")
    key = F.concat(F.md5(F.concat(identity, F.lit(f"|{seed}"))), F.lit("|"), identity)
    labelled = rows.filter(F.col(response).isNotNull()).select(
        F.col(response).cast("int").alias("class"), F.col(id_column).alias("id"), key.alias("_key"), F.lit(1).alias("one")
    )
    return running_totals(labelled, ["class"], "_key", ["one"]).select("class", "id", F.col("one_before").alias("position"))


def draw_rows(
    rows: DataFrame, response: str, id_column: str, trees: int, sizes: tuple[int, int], per_class: int, seed: int
) -> DataFrame:
    """``tree, id, times``: for each tree ``per_class`` draws with replacement from each class.

    ``sizes`` are the rows of class 1 and of class 0. Draw k of a class and tree takes the row whose position is
    a digest of (seed, tree, class, k) modulo the class size.
    """
    goods, bads = sizes
    number = F.col("number")
    draws = rows.sparkSession.range(trees * 2 * per_class).withColumnRenamed("id", "number").select(
        F.floor(number / (2 * per_class)).cast("int").alias("tree"),
        F.floor(F.pmod(number, F.lit(2 * per_class)) / per_class).cast("int").alias("class"),
        F.pmod(number, F.lit(per_class)).alias("k"),
    )
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("tree"), F.col("class"), F.col("k")))
    place = F.pmod(
        F.conv(F.substring(digest, 1, 13), 16, 10).cast("long"), F.when(F.col("class") == 1, goods).otherwise(bads)
    )
    drawn = draws.groupBy("tree", "class", place.alias("position")).agg(F.count(F.lit(1)).cast("int").alias("times"))
    return drawn.join(numbered_rows(rows, response, id_column, seed), ["class", "position"]).select("tree", "id", "times")


# Encoded rows


def encoded(numeric: Sequence[str], levels: dict[str, list[str | None]]) -> Column:
    """All predictors as one array of doubles; a category is the place of its level, -1 if unknown."""
    codes = []
    for name, known in levels.items():
        texts = [v for v in known if v is not None]
        place = F.array_position(F.array(*[F.lit(v) for v in texts]).cast("array<string>"), F.col(name).cast("string"))
        missing = float(len(texts)) if None in known else -1.0
        codes.append(F.coalesce(place.cast("double") - 1.0, F.lit(missing)))
    return F.array(*[F.col(name).cast("double") for name in numeric], *codes)


def matrix_of(values: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    flat = values.combine_chunks().flatten() if isinstance(values, pa.ChunkedArray) else values.flatten()
    return np.nan_to_num(flat.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, width), nan=np.inf)


# Growth


def _purity(ones: np.ndarray, all_: np.ndarray) -> np.ndarray:
    """Sum of squared class weights over the weight: the larger, the purer."""
    zeros = all_ - ones
    return (ones * ones + zeros * zeros) / all_


def _best_cut(values: np.ndarray, ones: np.ndarray, weight: np.ndarray):
    """(purity of both sides, cut) of the best cut between distinct values, or None."""
    order = np.argsort(values, kind="stable")
    x = values[order]
    edges = np.flatnonzero(x[1:] > x[:-1])
    if not len(edges):
        return None
    n, g = np.cumsum(weight[order]), np.cumsum(ones[order])
    left_n, left_g = n[edges], g[edges]
    purity = _purity(left_g, left_n) + _purity(g[-1] - left_g, n[-1] - left_n)
    best = int(np.argmax(purity))
    low, high = x[edges[best]], x[edges[best] + 1]
    middle = low + (high - low) / 2 if np.isfinite(high) else low
    return purity[best], low if middle >= high else middle


def _best_levels(codes: np.ndarray, ones: np.ndarray, weight: np.ndarray):
    """(purity, codes that go left): levels in the order of their response rate, then of their code."""
    present, place = np.unique(codes.astype(np.int64), return_inverse=True)
    if len(present) < 2:
        return None
    n, g = np.bincount(place, weight), np.bincount(place, ones)
    order = np.lexsort((present, g / n))
    left_n, left_g = np.cumsum(n[order])[:-1], np.cumsum(g[order])[:-1]
    purity = _purity(left_g, left_n) + _purity(g.sum() - left_g, n.sum() - left_n)
    best = int(np.argmax(purity))
    return purity[best], sorted(present[order[: best + 1]].tolist())


def grow(
    features: np.ndarray, labels: np.ndarray, times: np.ndarray, categories: int, tries: int, rng, depth: int | None = None
) -> dict:
    """A tree grown to the end, or to a ``depth``. The last ``categories`` columns are codes. Ties go to the variable
    drawn first and to the lowest cut; an even leaf votes for class 1. ``times`` are weights, whole or not."""
    width = features.shape[1]
    weight = times.astype(np.float64)
    ones = weight * (labels == 1)
    out = {name: [] for name in ("variable", "cut", "low", "left", "right", "vote", "decrease")}

    def node(rows) -> int:
        good, total = ones[rows].sum(), weight[rows].sum()
        for name, value in (
            ("variable", -1), ("cut", 0.0), ("low", []), ("left", -1), ("right", -1), ("vote", int(2 * good >= total)), ("decrease", 0.0)
        ):
            out[name].append(value)
        return len(out["vote"]) - 1

    waiting = [(node(np.arange(len(labels))), np.arange(len(labels)), 0)]
    while waiting:
        place, rows, level = waiting.pop()
        if level == depth:
            continue
        own, heavy = ones[rows], weight[rows]
        good, total = own.sum(), heavy.sum()
        if good == 0 or good == total:
            continue
        found = None
        for variable in rng.permutation(width)[:tries].tolist():
            values = features[rows, variable]
            cut = (_best_cut if variable < width - categories else _best_levels)(values, own, heavy)
            if cut and (found is None or cut[0] > found[1]):
                found = variable, *cut
        if found is None:
            continue
        variable, purity, cut = found
        values = features[rows, variable]
        goes = values <= cut if variable < width - categories else np.isin(values, cut)
        left, right = rows[goes], rows[~goes]
        out["variable"][place] = variable
        out["cut" if variable < width - categories else "low"][place] = float(cut) if variable < width - categories else cut
        out["decrease"][place] = float(purity - _purity(np.array([good]), np.array([total]))[0])
        out["left"][place] = node(left)
        out["right"][place] = node(right)
        waiting += [(out["right"][place], right, level + 1), (out["left"][place], left, level + 1)]
    return out


# Votes


class Packed:
    """The trees of a forest in flat arrays; nodes of all trees are numbered through."""

    def __init__(self, trees: list[dict], width: int):
        sizes = [len(t["vote"]) for t in trees]
        self.first = np.cumsum([0, *sizes])[:-1]
        self.width = width
        flat = {name: [v for t in trees for v in t[name]] for name in ("variable", "cut", "vote", "low")}
        self.variable = np.array(flat["variable"], dtype=np.int32)
        self.cut = np.array(flat["cut"], dtype=np.float64)
        self.vote = np.array(flat["vote"], dtype=np.int8)
        here = np.arange(len(self.vote))
        start = np.repeat(self.first, sizes)
        left, right = (np.array([v for t in trees for v in t[name]], dtype=np.int64) for name in ("left", "right"))
        self.left = np.where(left < 0, here, left + start)
        self.right = np.where(right < 0, here, right + start)
        self.used = [sorted({v for v in t["variable"] if v >= 0}) for t in trees]
        by_level = [k for k, low in enumerate(flat["low"]) if len(low)]
        self.row = np.full(len(self.vote), -1, dtype=np.int64)
        self.row[by_level] = np.arange(len(by_level))
        most = max((max(flat["low"][k]) for k in by_level), default=-1) + 1
        self.goes = np.zeros((len(by_level), most + 1), dtype=bool)  # the last column: levels beyond, which go right
        for row, k in enumerate(by_level):
            self.goes[row, list(flat["low"][k])] = True
        self.depth = self._depth(here)

    def _depth(self, here: np.ndarray) -> int:
        depth, at = 0, self.first
        while True:
            at = at[self.left[at] != at]
            if not len(at):
                return depth
            at = np.concatenate([self.left[at], self.right[at]])
            depth += 1

    def leaves(self, features: np.ndarray, trees: np.ndarray, met: np.ndarray | None = None) -> np.ndarray:
        """Node reached by each row (first axis) in each of the trees; only rows still on their way are moved.

        ``met`` (row, variable) is set where a row's way asks for the variable.
        """
        at = np.tile(self.first[trees], len(features))
        going = np.flatnonzero(self.variable[at] >= 0)
        node, row = at[going], going // max(1, len(trees))
        while len(going):
            variable = self.variable[node]
            values = features[row, variable]
            if met is not None:
                met[row, variable] = True
            left = values <= self.cut[node]
            by_level = self.row[node]
            which = np.flatnonzero(by_level >= 0)
            if len(which):
                codes = np.where(np.isfinite(values[which]), values[which], -1).astype(np.int64)
                inside = (codes >= 0) & (codes < self.goes.shape[1] - 1)
                left[which] = self.goes[by_level[which], np.where(inside, codes, -1)]
            node = np.where(left, self.left[node], self.right[node])
            at[going] = node
            on = self.variable[node] >= 0
            going, node, row = going[on], node[on], row[on]
        return at.reshape(len(features), len(trees))

    def votes(self, features: np.ndarray, trees: np.ndarray | None = None) -> np.ndarray:
        """0 or 1 of each row and tree."""
        trees = np.arange(len(self.first)) if trees is None else trees
        out = np.empty((len(features), len(trees)), dtype=np.int8)
        step = max(1, (1 << 18) // max(1, len(trees)))
        for first in range(0, len(features), step):
            out[first : first + step] = self.vote[self.leaves(features[first : first + step], trees)]
        return out


@dataclasses.dataclass
class BaggedForest:
    """A fitted forest: one row per tree in ``trees``; ``draws`` tells which rows each tree has seen."""

    numeric: list[str]
    categorical: list[str]
    levels: dict[str, list[str | None]]
    trees: DataFrame
    draws: DataFrame | None = None

    @property
    def predictors(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    @property
    def features(self) -> Column:
        return encoded(self.numeric, self.levels)

    @functools.cached_property
    def packed(self) -> Packed:
        """At most 4 nodes per sampled row of a class and tree: bounded by the options, whatever the rows."""
        found = self.trees.orderBy("tree").collect()
        return Packed([row.asDict() for row in found], len(self.predictors))

    @functools.cached_property
    def sent(self):
        return self.trees.sparkSession.sparkContext.broadcast(self.packed)

    def score(self) -> Column:
        """The share of votes for class 1, as an expression over the predictors."""
        sent, width = self.sent, len(self.predictors)

        @F.pandas_udf("double")
        def share(features: pd.Series) -> pd.Series:
            if not len(features):
                return pd.Series([], dtype="float64")
            return pd.Series(sent.value.votes(stacked(features, width)).mean(axis=1))

        return share(self.features)


def stacked(features: pd.Series, width: int) -> np.ndarray:
    return np.nan_to_num(np.concatenate(features.to_list()).astype(np.float64).reshape(-1, width), nan=np.inf)


def grown_trees(
    samples: DataFrame, width: int, categories: int, tries: int, seed: int, depth: int | None = None, tasks: int = 1
) -> DataFrame:
    """A row per tree of ``tree, id, label, times, features``; each tree's sample is in one task, in the order of its ids.

    The trees are dealt over ``tasks`` tasks, however small their samples are.
    """
    kinds = {"variable": pa.int32(), "cut": pa.float64(), "low": pa.list_(pa.int32())}
    kinds |= {"left": pa.int32(), "right": pa.int32(), "vote": pa.int32(), "decrease": pa.float64()}

    def grow_one(table: pa.Table) -> pa.Table:
        number = table.column("tree")[0].as_py()
        table = table.sort_by("id")
        features, labels, times = (table.column(n) for n in ("features", "label", "times"))
        rng = np.random.default_rng([seed, number])
        tree = grow(matrix_of(features, width), labels.to_numpy(), times.to_numpy(), categories, tries, rng, depth)
        return pa.table(
            {"tree": pa.array([number], pa.int32())} | {k: pa.array([tree[k]], pa.list_(kind)) for k, kind in kinds.items()}
        )

    return samples.repartition(tasks, "tree").groupBy("tree").applyInArrow(grow_one, TREE_SCHEMA)


def task_count(spark: SparkSession, most: int) -> int:
    """Tasks for ``most`` pieces of work that are heavy for their size: a few for each core."""
    return max(1, min(most, 4 * spark.sparkContext.defaultParallelism))


def fit_bagged(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    response: str,
    sizes: tuple[int, int],
    levels: dict[str, list[str | None]],
    trees: int,
    options: Options,
) -> BaggedForest:
    """``trees`` trees on balanced draws of the labelled rows of ``df``; ``sizes`` are its goods and bads."""
    seed, key = options.learner_seed, options.id_column
    per_class = sample_size(sizes[0], options)
    own = {name: levels[name] for name in categorical}
    draws = stage(draw_rows(df, response, key, trees, sizes, per_class, seed), "draws")
    width, categories = len(numeric) + len(categorical), len(categorical)
    tries = max(1, int(width**0.5))
    rows = df.filter(F.col(response).isNotNull()).select(
        F.col(key).alias("id"), F.col(response).cast("int").alias("label"), encoded(numeric, own).alias("features")
    )

    samples = draws.join(rows, "id").select("tree", "id", "label", "times", "features")
    grown = stage(grown_trees(samples, width, categories, tries, seed, tasks=task_count(df.sparkSession, trees)), "trees")
    return BaggedForest(list(numeric), list(categorical), own, grown, draws)


def with_bags(df: DataFrame, forest: BaggedForest, id_column: str) -> DataFrame:
    """The rows with ``_bags``, the trees that drew them (an array, at most one entry per tree)."""
    bags = forest.draws.groupBy(F.col("id").alias("_id")).agg(F.collect_set("tree").alias("_bags"))
    joined = df.join(bags, F.col(id_column) == F.col("_id"), "left").drop("_id")
    return joined.withColumn("_bags", F.coalesce("_bags", F.array().cast("array<int>")))


def out_of_bag_scores(df: DataFrame, forest: BaggedForest, id_column: str, name: str) -> DataFrame:
    """Training rows with the share of votes of the trees that did not draw them; NULL if all did."""
    sent, width = forest.sent, len(forest.predictors)

    @F.pandas_udf("double")
    def share(features: pd.Series, bags: pd.Series) -> pd.Series:
        if not len(features):
            return pd.Series([], dtype="float64")
        votes = sent.value.votes(stacked(features, width)).astype(np.float64)
        for row, bag in enumerate(bags):
            votes[row, np.asarray(bag, dtype=np.int64)] = np.nan
        known = (~np.isnan(votes)).sum(axis=1)
        return pd.Series(np.where(known > 0, np.nansum(votes, axis=1) / np.maximum(known, 1), np.nan))

    scored = with_bags(df, forest, id_column).select(*df.columns, share(forest.features, "_bags").alias(name))
    return scored.withColumn(name, F.nanvl(name, F.lit(None).cast("double")))


# Importance


def gini_decrease(forest: BaggedForest, spark: SparkSession) -> DataFrame:
    """``variable, mean_decrease_gini``: the impurity that a variable's cuts take away, per tree."""
    each = forest.trees.select(F.explode(F.arrays_zip("variable", "decrease")).alias("n")).select("n.*").filter("variable >= 0")
    sums = each.groupBy("variable").agg(F.sum("decrease").alias("total"))
    names = spark.createDataFrame(list(enumerate(forest.predictors)), "variable int, name string")
    trees = forest.trees.count()
    share = F.coalesce(F.col("total"), F.lit(0.0)) / trees
    # one row per predictor
    return names.join(F.broadcast(sums), "variable", "left").select(F.col("name").alias("variable"), share.alias("mean_decrease_gini"))


def permuted(values: np.ndarray, seed: Sequence[int]) -> np.ndarray:
    return values[np.random.default_rng(list(seed)).permutation(len(values))]


def out_of_bag_importance(
    df: DataFrame, forest: BaggedForest, response: str, options: Options, slice_rows: int = 10_000
) -> DataFrame:
    """``variable, mean_decrease_accuracy, decrease, error``.

    For every tree the rows it has not drawn are classified as they are and with one variable permuted among
    them; the loss of accuracy is averaged over all trees (``decrease``; a tree without the variable loses nothing)
    and divided by its standard error over the trees (``error``), unless that is 0. Values are permuted within
    slices of some ``slice_rows`` rows, dealt by digest, so that no task holds a tree's rows; up to that many rows
    there is one slice, and the permutation runs over all of them.
    """
    seed, key, width = options.learner_seed, options.id_column, len(forest.predictors)
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|slice{seed}")))
    rows = with_bags(df.filter(F.col(response).isNotNull()), forest, key)
    slices = max(1, -(-df.count() // slice_rows))
    # with few slices their trees are shared out as well, so that all cores have work
    tasks = task_count(df.sparkSession, slices * len(forest.packed.first))
    shares = max(1, tasks // slices)
    dealt = rows.select(
        F.pmod(F.xxhash64(digest), F.lit(slices)).cast("int").alias("slice"),
        F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"),
        digest.alias("place"),
        F.col(response).cast("int").alias("label"),
        "_bags",
        forest.features.alias("features"),
    )
    sent = forest.sent

    def measure(table: pa.Table) -> pa.Table:
        packed = sent.value
        table = table.sort_by("place")
        features, labels = matrix_of(table.column("features"), width), table.column("label").to_numpy()
        number = table.column("slice")[0].as_py()
        unseen = np.ones((len(labels), len(packed.first)), dtype=bool)
        for row, bag in enumerate(table.column("_bags").to_pylist()):
            unseen[row, bag] = False
        out = []
        for tree in range(table.column("share")[0].as_py(), len(packed.first), shares):
            own = np.flatnonzero(unseen[:, tree])
            if not len(own):
                continue
            here, truth, one = features[own], labels[own], np.array([tree])
            met = np.zeros(here.shape, dtype=bool)
            right = packed.vote[packed.leaves(here, one, met)[:, 0]] == truth
            for variable in packed.used[tree]:
                # a row whose way does not ask for the variable keeps its leaf
                asked = np.flatnonzero(met[:, variable])
                moved = here[asked]
                moved[:, variable] = permuted(here[:, variable], (seed, number, tree, variable))[asked]
                still = packed.vote[packed.leaves(moved, one)[:, 0]] == truth[asked]
                out.append((tree, variable, int(right[asked].sum()) - int(still.sum())))
            out.append((tree, -1, len(own)))
        columns = list(zip(*out)) if out else [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("tree", "variable", "n"), columns)})

    lost = dealt.repartition(max(tasks, slices), "slice", "share").groupBy("slice", "share").applyInArrow(measure, "tree long, variable long, n long")
    summed = stage(lost.groupBy("tree", "variable").agg(F.sum("n").alias("n")), "importance")
    sizes = summed.filter("variable < 0").select("tree", F.col("n").alias("size"))
    trees = F.lit(float(forest.trees.count()))
    each = summed.filter("variable >= 0").join(sizes, "tree").withColumn("loss", F.col("n") / F.col("size"))
    sums = each.groupBy("variable").agg(F.sum("loss").alias("s"), F.sum(F.col("loss") * F.col("loss")).alias("q"))
    spread = F.sqrt(F.greatest(F.lit(0.0), F.col("q") / trees - F.pow(F.col("s") / trees, 2)) / trees)
    table = sums.select(F.col("variable").cast("int").alias("variable"), (F.col("s") / trees).alias("decrease"), spread.alias("error"))
    names = df.sparkSession.createDataFrame(list(enumerate(forest.predictors)), "variable int, name string")
    zero = F.lit(0.0)
    scaled = F.when(F.col("error") > 1e-12, F.col("decrease") / F.col("error")).otherwise(F.col("decrease"))
    return names.join(F.broadcast(table), "variable", "left").select(
        F.col("name").alias("variable"),
        F.coalesce(scaled, zero).alias("mean_decrease_accuracy"),
        F.coalesce("decrease", zero).alias("decrease"),
        F.coalesce("error", zero).alias("error"),
    )
