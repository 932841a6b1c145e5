"""Weight of evidence and information value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_missing
from .ranking import (
    level_counts,
    quantile_groups,
    ranked_values,
    reusable,
    sketched_quantiles,
    value_counts,
)


def binned_numeric(df: DataFrame, numeric: Sequence[str], response: str, groups: int) -> DataFrame:
    """``variable, bin, n, goods`` over quantile groups."""
    return binned_counts(reusable(value_counts(df, numeric, response)), groups)


def binned_counts(counts: DataFrame, groups: int) -> DataFrame:
    """The same from value counts that exist already. Rows without a response are left out."""
    known = counts.filter("known > 0").select("variable", "value", F.col("known").alias("n"), "goods")
    missing = known.filter(F.col("value").isNull()).select(
        "variable", F.lit(None).cast("string").alias("bin"), "n", "goods"
    )
    grouped = quantile_groups(ranked_values(known, ("n", "goods")), groups, ("n", "goods"))
    return grouped.select("variable", F.col("bin").cast("string").alias("bin"), "n", "goods").unionByName(
        missing
    )


def sketch_binned_numeric(
    df: DataFrame, numeric: Sequence[str], response: str, groups: int
) -> DataFrame:
    """Quantile groups cut at approximate quantiles.

    One pass for the cuts, one for the counts; rows become bin numbers before they are counted,
    so at most ``groups + 1`` rows per variable and task are shuffled.
    """
    known = df.filter(F.col(response).isNotNull())
    cuts = sketched_quantiles(known, numeric, [j / groups for j in range(1, groups)])
    types = dict(df.dtypes)
    columns = []
    for name in numeric:
        value = F.col(name).cast("double")
        # ties keep together: a cut met twice moves the bin by two, and numbers skip
        place = sum((F.when(value > F.lit(cut), 1).otherwise(0) for cut in cuts.get(name, [])), F.lit(1))
        columns.append(F.when(~is_missing(name, types[name]), place).alias(name))
    return (
        known.select(F.col(response).cast("long").alias("_response"), *columns)
        .unpivot(["_response"], list(numeric), "variable", "place")
        .groupBy("variable", F.col("place").cast("string").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_response").alias("goods"))
    )


def imputed_counts(counts: DataFrame, median_of: Mapping[str, float]) -> DataFrame:
    """Value counts as they are after median imputation, without another pass over the rows."""
    fill = counts.sparkSession.createDataFrame(
        [(name, value) for name, value in median_of.items()], "variable string, fill double"
    )
    # one row per variable
    return (
        counts.join(F.broadcast(fill), "variable", "left")
        .groupBy("variable", F.coalesce("value", "fill").alias("value"))
        .agg(*[F.sum(name).alias(name) for name in ("n", "known", "goods")])
    )


def binned_categories(df: DataFrame, categorical: Sequence[str], response: str) -> DataFrame:
    """The same with every level as its own bin."""
    return (
        level_counts(df, categorical, response)
        .filter("known > 0")
        .select("variable", F.col("value").alias("bin"), F.col("known").alias("n"), "goods")
    )


def binned(df, numeric, categorical, response, groups, exact: bool = True) -> DataFrame:
    """Bins of all variables, numeric ones in exact or approximate quantile groups."""
    parts = []
    if numeric:
        group = binned_numeric if exact else sketch_binned_numeric
        parts.append(group(df, numeric, response, groups))
    if categorical:
        parts.append(binned_categories(df, categorical, response))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def woe_table(bins: DataFrame) -> DataFrame:
    """Shares, weight of evidence and IV contribution of each bin.

    Response 1 is the good class. A bin without goods or without bads contributes 0.
    The totals joined back hold one row per variable.
    """
    rows = bins.withColumn("bads", F.col("n") - F.col("goods"))
    totals = rows.groupBy("variable").agg(
        F.sum("goods").alias("all_goods"), F.sum("bads").alias("all_bads")
    )
    shares = (
        rows.join(F.broadcast(totals), "variable")
        .withColumn("good_share", F.col("goods") / F.nullif(F.col("all_goods"), F.lit(0)))
        .withColumn("bad_share", F.col("bads") / F.nullif(F.col("all_bads"), F.lit(0)))
    )
    both = (F.col("goods") > 0) & (F.col("bads") > 0)
    log_ratio = F.log(F.col("good_share") / F.col("bad_share"))
    undefined = F.col("good_share").isNull() | F.col("bad_share").isNull()
    part = (F.col("good_share") - F.col("bad_share")) * log_ratio
    return shares.select(
        "variable",
        "bin",
        "n",
        "goods",
        "bads",
        "good_share",
        "bad_share",
        F.when(both, log_ratio).alias("woe"),
        F.when(both, part).when(~undefined, F.lit(0.0)).alias("iv"),
    )


def information_values(woe: DataFrame) -> DataFrame:
    """IV per variable; NULL when a class is absent altogether."""
    return woe.groupBy("variable").agg(F.sum("iv").alias("iv"))


def iv_strength(iv: Column) -> Column:
    """The strength label of an IV. Limits and words are fixed values."""
    return (
        F.when(iv < 0.02, "not useful")
        .when(iv < 0.1, "weak")
        .when(iv < 0.3, "medium")
        .when(iv < 0.5, "strong")
        .when(iv.isNotNull(), "above_range")
    )


def iv_report(woe: DataFrame) -> DataFrame:
    return information_values(woe).withColumn("strength", iv_strength(F.col("iv")))


def iv_failures(iv: DataFrame, floor: float) -> DataFrame:
    """Variables under the floor. An undefined IV is kept in the model."""
    return iv.filter(F.col("iv") < floor).select("variable")
