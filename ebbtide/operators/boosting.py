"""Adaptive boosting with shrinkage and bagging: row weights live in a column and follow the rounds.

A round draws a share of the rows by digest, grows a small weighted tree on them, measures the tree's weighted error on
all rows (its vote is an expression, so no row leaves the JVM for that), and multiplies the weights of wrong rows
up and of right ones down. With weights that add up to 1 the new total follows from the error alone, so a round
passes over the rows once for its sample and once for its error. Weights are an expression of the last written ones and the trees since; every few rounds
they are written, so the plan stays short and a lost executor repeats few rounds.
"""

from __future__ import annotations

import dataclasses
import functools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import Options
from ..session import stage
from .bagging import Packed, stacked, encoded, grown_trees
from .forest import class_sizes
from .levels import learn_levels

#: An error of 0 counts as this: its tree gets a large say, and no later one is needed.
LEAST_ERROR = 1e-10


def say(error: float, shrinkage: float) -> float:
    """Weight of a vote with this weighted error: 0 at one half, negative above."""
    error = min(max(error, LEAST_ERROR), 1 - LEAST_ERROR)
    return shrinkage * 0.5 * math.log((1 - error) / error)


def weighted_error(rows: DataFrame, wrong: Column, weight: str = "weight") -> float:
    """Share of the weight on rows where ``wrong`` holds."""
    return rows.agg(F.try_divide(F.sum(F.when(wrong, F.col(weight)).otherwise(F.lit(0.0))), F.sum(weight))).first()[0]


def reweighted(wrong: Column, error: float, shrinkage: float, weight: str = "weight") -> Column:
    """Weights after a round, adding up to 1 if they did before."""
    amount = say(error, shrinkage)
    total = error * math.exp(amount) + (1 - error) * math.exp(-amount)
    factor = F.when(wrong, F.lit(math.exp(amount) / total)).otherwise(F.lit(math.exp(-amount) / total))
    return F.col(weight) * factor


def sampled(id_column: str, share: float, round_number: int, seed: int) -> Column:
    """Whether a row is in a round's sample: a digest of its id and the round, as a number, lies below the share."""
    digest = F.md5(F.concat(F.col(id_column).cast("string"), F.lit(f"|{seed}|{round_number}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") < F.lit(round(share * 2**32))


@dataclasses.dataclass
class Boosted:
    """Trees and their say; ``weights`` has the rows' last weights (``id, weight``)."""

    numeric: list[str]
    categorical: list[str]
    levels: dict[str, list[str | None]]
    trees: list[dict]
    says: list[float]
    errors: list[float]
    weights: DataFrame

    @functools.cached_property
    def sent(self):
        context = self.weights.sparkSession.sparkContext
        return context.broadcast((Packed(self.trees, len(self.numeric) + len(self.categorical)), np.array(self.says)))

    def score(self) -> Column:
        """The share of the say that votes for class 1."""
        sent, width = self.sent, len(self.numeric) + len(self.categorical)

        @F.pandas_udf("double")
        def share(features: pd.Series) -> pd.Series:
            if not len(features):
                return pd.Series([], dtype="float64")
            packed, says = sent.value
            return pd.Series(packed.votes(stacked(features, width)) @ says / says.sum())

        return share(encoded(self.numeric, self.levels))


def vote(tree: dict, node: int = 0) -> Column:
    """The vote of one small tree as an expression over the array ``features``; what is missing goes right."""
    variable = tree["variable"][node]
    if variable < 0:
        return F.lit(tree["vote"][node])
    value = F.get("features", F.lit(variable))
    low = tree["low"][node]
    goes = value.isin(*[float(code) for code in low]) if low else value <= F.lit(tree["cut"][node])
    return F.when(goes, vote(tree, tree["left"][node])).otherwise(vote(tree, tree["right"][node]))


def fit_adaboost(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], response: str, options: Options) -> Boosted:
    """Boosted trees on the labelled rows of ``df``.

    ``boost_step`` shrinks every vote, ``boost_sample_share`` of the rows (at most some ``boost_sample_most``) are in a
    round's sample. Rounds end early at a tree without error, which is kept, and at one that is wrong on half the weight
    or more, which is not.
    """
    seed, key = options.learner_seed, options.id_column
    goods, bads = class_sizes(df, response)
    if not goods or not bads:
        raise ValueError("training rows need both response classes")
    levels = learn_levels(df, categorical, options.max_levels)
    width = len(numeric) + len(categorical)
    share = min(options.boost_sample_share, options.boost_sample_most / (goods + bads))
    rows = stage(
        df.filter(F.col(response).isNotNull()).select(
            F.col(key).alias("id"),
            F.col(response).cast("int").alias("label"),
            encoded(numeric, levels).alias("features"),
            F.lit(1.0 / (goods + bads)).alias("weight"),
        ),
        "boost",
    )
    trees, says, errors = [], [], []
    for number in range(options.boost_iterations):
        sample = rows.filter(sampled("id", share, number, seed)).select(
            F.lit(number).alias("tree"), "id", "label", F.col("weight").alias("times"), "features"
        )
        # one row; a limit would end the worker process, and the next round would start another
        grown = grown_trees(sample, width, len(categorical), width, seed, options.boost_depth).collect()
        if not grown:
            continue  # an empty sample
        tree = grown[0].asDict()
        wrong = vote(tree) != F.col("label")
        marked = rows.withColumn("wrong", wrong)
        error = weighted_error(marked, F.col("wrong"))
        if error >= 0.5:
            break
        trees.append(tree)
        errors.append(error)
        says.append(say(error, options.boost_step))
        rows = marked.withColumn("weight", reweighted(F.col("wrong"), error, options.boost_step)).drop("wrong")
        if len(trees) % options.boost_cut_every == 0:
            rows = stage(rows, "boost")
        if error <= LEAST_ERROR:
            break
    if not trees:
        raise ValueError("no tree is better than chance")
    return Boosted(list(numeric), list(categorical), levels, trees, says, errors, rows.select("id", "weight"))
