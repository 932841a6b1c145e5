"""Data profile of a frame and the role of each of its variables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_missing
from ..options import Options
from .ranking import level_counts, order_statistics, ranked_values, reusable, value_counts

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def storage_class(spark_type: str) -> str:
    """``numeric``, ``text`` or ``other`` (dates, flags of type boolean, nested types)."""
    if spark_type in NUMERIC_TYPES or spark_type.startswith("decimal"):
        return "numeric"
    return "text" if spark_type == "string" else "other"


def response_rate(df: DataFrame, category: str, response: str) -> DataFrame:
    """Volume and response rate of each category, highest rate first."""
    return (
        df.groupBy(category)
        .agg(F.count(F.lit(1)).alias("tot"), F.sum(response).alias("res"))
        .withColumn("response_rate", F.col("res") / F.col("tot"))
        .orderBy(F.desc("response_rate"), category)
    )


def distinct_levels(df: DataFrame, variables: Sequence[str], exact: bool = True) -> DataFrame:
    """Number of distinct values per variable; NULL counts as one.

    Exact levels are counted from (variable, value) groups, which shuffle once whatever the
    number of variables; the estimate needs no shuffle of values at all.
    """
    types = dict(df.dtypes)
    if not exact:
        row = df.agg(
            *[
                (F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c)
                for c in variables
            ]
        )
        return row.unpivot([], list(variables), "variable", "levels")
    # integers and decimals as their text, which is exact where a double isn't
    numeric = [c for c in variables if types[c] in ("float", "double")]
    other = [c for c in variables if c not in numeric]
    parts = []
    if numeric:
        parts.append(value_counts(df, numeric).groupBy("variable").agg(F.count(F.lit(1)).alias("levels")))
    if other:
        parts.append(level_counts(df, other).groupBy("variable").agg(F.count(F.lit(1)).alias("levels")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def missing_share(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Share of missing rows per variable, rounded to 2 decimals, in one map-side pass."""
    types = dict(df.dtypes)
    row = df.agg(
        *[F.round(F.avg(is_missing(c, types[c]).cast("double")), 2).alias(c) for c in variables]
    )
    return row.unpivot([], list(variables), "variable", "missing_share")


def numeric_profile(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """n, mean, sd, median, 10 % trimmed mean, mad, min, max, range, skew, kurtosis and se.

    All from one value-count pass over the rows. Skew and kurtosis use the sample sd.
    """
    counts = reusable(value_counts(df, variables))
    present = counts.filter(F.col("value").isNotNull())
    first = present.groupBy("variable").agg(
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    off = F.col("value") - F.col("mean")
    moments = (
        present.join(F.broadcast(first), "variable")
        .groupBy("variable")
        .agg(*[F.sum(F.pow(off, p) * F.col("n")).alias(f"m{p}") for p in (2, 3, 4)])
    )
    order = order_statistics(ranked_values(counts))
    spread = (
        present.join(F.broadcast(order.select("variable", "median")), "variable")
        .groupBy("variable", F.abs(F.col("value") - F.col("median")).alias("value"))
        .agg(F.sum("n").alias("n"))
    )
    mad = order_statistics(ranked_values(spread)).select(
        "variable", (F.col("median") * 1.4826).alias("mad")
    )
    n = F.col("n")
    variance = F.when(n > 1, F.col("m2") / (n - 1))
    whole = first.join(moments, "variable").join(order, "variable").join(mad, "variable")
    return (
        whole.withColumn("sd", F.sqrt(variance))
        .withColumn("varied", F.col("m2") > 0)
        .select(
            "variable",
            "n",
            "mean",
            "sd",
            "median",
            "trimmed",
            "mad",
            "min",
            "max",
            (F.col("max") - F.col("min")).alias("range"),
            F.when(F.col("varied"), F.col("m3") / n / F.pow("sd", F.lit(3))).alias("skew"),
            F.when(F.col("varied"), F.col("m4") / n / F.pow("sd", F.lit(4)) - 3).alias("kurtosis"),
            (F.col("sd") / F.sqrt(n)).alias("se"),
        )
    )


def classify_variables(df: DataFrame, options: Options, response: str = "Response") -> DataFrame:
    """Role of each column: ``num``, ``cat``, ``np``, ``y``, ``id`` or ``other``, with the reason.

    Later rules win: type, non-predictive list, response, id; then constants and categories of
    too many levels become ``np``. A numeric column is constant when its minimum is its maximum
    without a NULL beside it, which one map-side pass tells. Only categories are counted, and
    those far over the limit are told by a sketch: near-unique text is never shuffled.
    The result has one row per column.
    """
    types = dict(df.dtypes)
    roles: dict[str, tuple[str, str]] = {}
    for name, spark_type in df.dtypes:
        kind = storage_class(spark_type)
        roles[name] = {"numeric": ("num", "numeric type"), "text": ("cat", "text type")}.get(
            kind, ("other", "neither number nor text")
        )
        if name in options.non_predictive or any(
            re.search(pattern, name) for pattern in options.non_predictive_patterns
        ):
            roles[name] = ("np", "non-predictive list")
        if name == response:
            roles[name] = ("y", "response")
        if name == options.id_column:
            roles[name] = ("id", "identifier")

    numeric = [c for c, (role, _) in roles.items() if role == "num"]
    text = [c for c, (role, _) in roles.items() if role == "cat"]
    constant = _constant_columns(df, numeric)
    crowded = _crowded(df, text, options.max_levels)
    levels = {**crowded, **_level_numbers(df, [name for name in text if name not in crowded])}
    if options.numeric_to_category is not None and numeric:
        few = _level_numbers(df, numeric)
    else:
        few = {}
    for name in numeric:
        if name in constant:
            roles[name] = ("np", "constant")
        elif few and few[name] <= options.numeric_to_category:
            roles[name] = ("cat", "numeric with few levels")
    for name in text:
        if levels.get(name, 0) <= 1:
            roles[name] = ("np", "constant")
        elif levels[name] > options.max_levels:
            roles[name] = ("np", "too many levels")
    rows = [
        (position, name, types[name], None if name in crowded else levels.get(name), role, reason)
        for position, (name, (role, reason)) in enumerate(roles.items())
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, variable string, class string, levels long, type string, reason string"
    )


def _constant_columns(df: DataFrame, numeric: Sequence[str]) -> set[str]:
    if not numeric:
        return set()
    types = dict(df.dtypes)
    tests = []
    for name in numeric:
        missing = is_missing(name, types[name])
        known = F.when(~missing, F.col(name))
        some_missing = F.max(missing.cast("int"))
        tests.append(
            (
                F.min(known).isNull()
                | ((F.min(known) == F.max(known)) & (some_missing == 0))
            ).alias(name)
        )
    row = df.agg(*tests).first()
    return {name for name in numeric if row[name]}


def _crowded(df: DataFrame, text: Sequence[str], limit: int) -> dict[str, int]:
    """Columns that certainly have more than ``limit`` levels, with a rough number.

    The sketch has 512 registers. Up to 128 values fill at most 128 of them, for which its
    linear count is at most 512 ln(512 / 384) = 147; an estimate over 256 thus proves more than
    128. Larger limits are left to the exact count.
    """
    if not text or limit > 128:
        return {}
    row = df.agg(*[F.approx_count_distinct(name, 0.05).alias(name) for name in text]).first()
    return {name: row[name] for name in text if row[name] > 256}


def _level_numbers(df: DataFrame, variables: Sequence[str]) -> dict[str, int]:
    if not variables:
        return {}
    counted = distinct_levels(df, variables).collect()  # one row per variable
    return {row["variable"]: row["levels"] for row in counted}


def names_of(roles: DataFrame, *types: str) -> list[str]:
    """Column names of the given roles, in the frame's order (one row per column)."""
    rows = roles.filter(F.col("type").isin(*types)).orderBy("position").collect()
    return [row["variable"] for row in rows]


def role_volume(roles: DataFrame) -> DataFrame:
    return roles.groupBy("type").agg(F.count(F.lit(1)).alias("variables"))
