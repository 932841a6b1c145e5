"""Exact ranks, quantile groups and order statistics without one task per variable.

Everything here works on value counts: one row per variable and distinct value with its
number of rows, built with map-side partial sums, so a value shared by a third of all rows
is one row. Running totals over those counts are split by value range, so a variable with
billions of distinct values is spread over many tasks. Ranked frames rest on rows written
once; compute one and use it for several measures.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_missing
from ..session import cut, stage


def value_counts(
    df: DataFrame, variables: Sequence[str], response: str | None = None
) -> DataFrame:
    """Rows per variable and value: ``variable, value, n``.

    With a response also ``known`` (rows that have one) and ``goods`` (their sum). Numeric variables only, as doubles. NULL and NaN are one value, NULL.
    """
    types = dict(df.dtypes)
    columns = [F.when(~is_missing(name, types[name]), F.col(name).cast("double")) for name in variables]
    return _counted(df, columns, variables, response)


def level_counts(
    df: DataFrame, variables: Sequence[str], response: str | None = None
) -> DataFrame:
    """The same for categories, whose ``value`` is text."""
    columns = [F.col(name).cast("string") for name in variables]
    return _counted(df, columns, variables, response)


def _counted(df, columns, variables, response):
    """Unpivot and count. Rows travel with a variable's number; its name is put back at the end."""
    numbers = [str(place) for place in range(len(variables))]
    ids = [] if response is None else [F.col(response).cast("long").alias("_response")]
    short = [column.alias(number) for column, number in zip(columns, numbers)]
    long_form = df.select(*ids, *short).unpivot(
        ["_response"] if ids else [], numbers, "_number", "value"
    )
    sums = [F.count(F.lit(1)).alias("n")]
    if ids:
        sums += [F.count("_response").alias("known"), F.sum("_response").alias("goods")]
    name = F.element_at(F.array(*[F.lit(v) for v in variables]), F.col("_number").cast("int") + 1)
    counted = long_form.groupBy("_number", "value").agg(*sums)
    return counted.select(name.alias("variable"), *[c for c in counted.columns if c != "_number"])


def running_totals(
    counts: DataFrame, by: Sequence[str], order: str, sums: Sequence[str], pieces: int | None = None
) -> DataFrame:
    """Add, for each of ``sums``, its total before the row and over the whole group.

    ``order`` must be unique and not NULL within ``by``. Rows are range-partitioned on both, so
    every piece is an even, contiguous part of the order whatever the groups' sizes, and the
    placed rows are written once: all later steps see the same pieces, also after a lost
    executor. Then each piece is totalled, those few totals (at most pieces plus groups) are run
    along the order, and rows run within their piece.
    """
    by = list(by)
    keys = [*by, order]
    ranged = counts.repartitionByRange(pieces, *keys) if pieces else counts.repartitionByRange(*keys)
    placed = stage(ranged.withColumn("_piece", F.spark_partition_id()), "ranked")
    totals = placed.groupBy(*by, "_piece").agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    along = Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    starts = totals.select(
        *by,
        "_piece",
        *[F.coalesce(F.sum(f"_{s}").over(along), F.lit(0)).alias(f"_{s}_start") for s in sums],
        *[F.sum(f"_{s}").over(whole).alias(f"{s}_total") for s in sums],
    )
    inside = (
        Window.partitionBy(*by, "_piece").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.join(F.broadcast(starts), by + ["_piece"]).select(
        *counts.columns,
        *[
            (F.col(f"_{s}_start") + F.coalesce(F.sum(s).over(inside), F.lit(0))).alias(f"{s}_before")
            for s in sums
        ],
        *[f"{s}_total" for s in sums],
    )


def ranked_values(counts: DataFrame, sums: Sequence[str] = ("n",)) -> DataFrame:
    """Running totals of the non-NULL values of every variable."""
    return running_totals(counts.filter(F.col("value").isNotNull()), ["variable"], "value", sums)


def quantile_group(groups: int):
    """Group number of a ranked value. Ties share a group and numbers may skip."""
    return F.floor(F.col("n_before") * groups / F.col("n_total")).cast("int") + 1


def quantile_groups(ranked: DataFrame, groups: int, sums: Sequence[str] = ("n",)) -> DataFrame:
    """``variable, bin`` with the value range and the summed counts of each group."""
    return ranked.withColumn("bin", quantile_group(groups)).groupBy("variable", "bin").agg(
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        *[F.sum(s).alias(s) for s in sums],
    )


def medians(ranked: DataFrame) -> DataFrame:
    """Exact median of each variable's values, the middle two averaged."""
    return order_statistics(ranked).select("variable", "median")


def exact_medians(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """``variable, median decimal(38,1)`` of whole-number and decimal columns, without passing through doubles.

    A double tells whole numbers apart up to 2**53 only; here values are counted as decimals of 38 digits, so columns
    with digits after the point are refused, and so are other types.
    """
    types = dict(df.dtypes)
    for name in variables:
        if types[name] not in ("tinyint", "smallint", "int", "bigint") and not re.fullmatch(r"decimal\(\d+,0\)", types[name]):
            raise ValueError(f"{name} is {types[name]}, not a whole number")
    counts = _counted(df, [F.col(name).cast("decimal(38,0)") for name in variables], variables, None)
    ranked = ranked_values(counts)
    low, high = (F.floor((F.col("n_total") - k) / 2).cast("long") for k in (1, 0))
    middle = ranked.groupBy("variable").agg(_value_at(low).alias("low"), _value_at(high).alias("high"))
    half = F.when((F.col("high") - F.col("low")) % 2 != 0, F.lit("0.5").cast("decimal(2,1)")).otherwise(F.lit("0.0").cast("decimal(2,1)"))
    whole = (F.col("low") + F.floor((F.col("high") - F.col("low")) / 2)).cast("decimal(37,0)")
    return middle.select("variable", (whole + half).cast("decimal(38,1)").alias("median"))


def _value_at(position):
    """The value whose rows cover a zero-based position."""
    covers = (F.col("n_before") <= position) & (position < F.col("n_before") + F.col("n"))
    return F.max(F.when(covers, F.col("value")))


def order_statistics(ranked: DataFrame, trim: float = 0.1) -> DataFrame:
    """Count, median and trimmed mean per variable from ranked counts, in one pass."""
    total = F.col("n_total")
    low = F.floor((total - 1) / 2).cast("long")
    high = F.floor(total / 2).cast("long")
    cut_off = F.floor(total * trim).cast("long")
    kept = F.greatest(
        F.lit(0),
        F.least(F.col("n_before") + F.col("n"), total - cut_off) - F.greatest("n_before", cut_off),
    )
    return ranked.groupBy("variable").agg(
        F.sum("n").alias("n"),
        ((_value_at(low) + _value_at(high)) / 2).alias("median"),
        (F.sum(F.col("value") * kept) / F.sum(kept)).alias("trimmed"),
    )


def reusable(counts: DataFrame) -> DataFrame:
    """Counts computed once for the several passes above."""
    return cut(counts)


def sketched_quantiles(
    df: DataFrame, variables: Sequence[str], shares: Sequence[float], accuracy: int = 10_000
) -> dict[str, list[float]]:
    """Approximate quantiles of each variable from one pass that shuffles sketches only.

    The relative rank error is 1 / ``accuracy``. Below the accuracy's size they are exact: the smallest value whose cumulative count reaches
    the share. One row of ``len(variables) * len(shares)`` numbers is read.
    """
    types = dict(df.dtypes)
    known = {
        name: F.when(~is_missing(name, types[name]), F.col(name).cast("double")) for name in variables
    }
    row = df.agg(
        *[
            F.percentile_approx(column, list(shares), accuracy).alias(name)
            for name, column in known.items()
        ]
    ).first()
    return {name: list(row[name]) for name in variables if row[name] is not None}
