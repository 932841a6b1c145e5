"""Category levels: rows outside the levels seen in training are out of scope."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .ranking import level_counts


def keep_seen(
    df: DataFrame, train: DataFrame, categorical: Sequence[str], max_levels: int | None = None
) -> DataFrame:
    """Rows whose every category value occurs in ``train``; NULL is a value like any other.

    One pass over ``train`` learns the levels of all categories, and a plain filter applies them, as in
    scoring.
    """
    return keep_known(df, learn_levels(train, categorical, max_levels))


def unseen_values(df: DataFrame, train: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """Distinct (variable, value) pairs of ``df`` that ``train`` lacks."""

    def pairs(frame: DataFrame) -> DataFrame:
        return level_counts(frame, categorical).select("variable", "value")

    return pairs(df).subtract(pairs(train))


def learn_levels(
    train: DataFrame, categorical: Sequence[str], max_levels: int | None = None
) -> dict[str, list[str | None]]:
    """Sorted levels of each classified category.

    Classification leaves at most ``max_levels`` per category, so this is metadata. With the bound
    given, a category that has more is refused before its levels are read.
    """
    if not categorical:
        return {}
    counts = level_counts(train, categorical)
    if max_levels is not None:
        crowded = counts.groupBy("variable").count().filter(F.col("count") > max_levels).select("variable").collect()
        if crowded:
            raise ValueError(f"more than {max_levels} levels: {sorted(row['variable'] for row in crowded)}")
    found: dict[str, list[str | None]] = {name: [] for name in categorical}
    for row in counts.collect():
        found[row["variable"]].append(row["value"])
    return {name: sorted(values, key=lambda v: (v is None, v or "")) for name, values in found.items()}


def known_conditions(levels: Mapping[str, Sequence[str | None]]) -> dict[str, Column]:
    """For each category whether a row's value is one of the learnt levels; NULL is a level like any other."""
    conditions = {}
    for name, values in levels.items():
        texts = [value for value in values if value is not None]
        known = F.col(name).isin(*texts) if texts else F.lit(False)
        conditions[name] = F.col(name).isNull() | known if None in values else F.col(name).isNotNull() & known
    return conditions


def keep_known(
    df: DataFrame, levels: Mapping[str, Sequence[str | None]], observation: Observation | None = None
) -> DataFrame:
    """The same rule with learnt levels: a plain filter, no join.

    With an ``observation`` the rows that come in, those lost, and those with an unseen value of each category are
    counted on the way (metrics ``rows``, ``lost`` and ``unseen:<category>``), without a pass of its own: the numbers
    are there once the result has been computed.
    """
    conditions = known_conditions(levels)
    if not conditions:
        return df if observation is None else df.observe(observation, F.count(F.lit(1)).alias("rows"), F.lit(0).cast("long").alias("lost"))
    kept = functools.reduce(lambda x, y: x & y, conditions.values())
    if observation is not None:
        metrics = [F.count_if(~known).alias(f"unseen:{name}") for name, known in conditions.items()]
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"), F.count_if(~kept).alias("lost"), *metrics)
    return df.filter(kept)


def loss_report(observation: Observation, spark: SparkSession) -> DataFrame:
    """``variable, rows``: rows with an unseen value by category, and under NULL the rows lost in all.

    To be called after the observed frame has been computed, or it waits for that.
    """
    found = observation.get
    rows = [(name.removeprefix("unseen:"), n) for name, n in found.items() if name.startswith("unseen:")]
    return spark.createDataFrame([*rows, (None, found["lost"])], "variable string, rows long")


def constant_by_cohort(df: DataFrame, cohort: str, variables: Sequence[str]) -> DataFrame:
    """(cohort, variable) pairs with a single value, NULL counting as one."""
    counted = (
        df.select(F.col(cohort).cast("string").alias("cohort"), *[F.col(v).cast("string").alias(v) for v in variables])
        .unpivot(["cohort"], list(variables), "variable", "value")
        .groupBy("cohort", "variable", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        counted.groupBy("cohort", "variable")
        .agg(F.count(F.lit(1)).alias("levels"))
        .filter("levels = 1")
        .select("cohort", "variable")
    )
