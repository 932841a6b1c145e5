"""Ranking quality, deciles, thresholds and score distribution.

Rank measures start from :func:`ranked_scores`, one row per distinct score with running class
totals, so ties are handled exactly and no one task holds all scores. Compute it once and use
it for all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..options import Options
from ..session import stage
from .ranking import quantile_group, ranked_values, value_counts


def ranked_scores(df: DataFrame, score: str, response: str) -> DataFrame:
    """Rows and classes per distinct score (``value, n, goods, bads``), before it and in all."""
    y = F.col(response).cast("long")
    counts = (
        df.filter(F.col(response).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("goods"), F.sum(1 - y).alias("bads"))
        .select(F.lit(score).alias("variable"), "value", "n", "goods", "bads")
    )
    return ranked_values(counts, ("n", "goods", "bads"))


def gini(ranked: DataFrame) -> DataFrame:
    """Somers' D of score against response (2 AUC - 1), rounded to 4 decimals; ties count half."""
    below = F.col("bads_before").cast("double") + F.col("bads") / F.lit(2.0)
    pairs = F.max("goods_total").cast("double") * F.max("bads_total").cast("double")
    won = F.sum(F.col("goods").cast("double") * below)
    return ranked.agg(F.round(2 * won / F.nullif(pairs, F.lit(0.0)) - 1, 4).alias("gini"))


def cumulative_shares(ranked: DataFrame) -> DataFrame:
    """Share of goods and bads at or under each distinct score."""
    return ranked.select(
        F.col("value").alias("score"),
        F.try_divide(F.col("goods_before") + F.col("goods"), "goods_total").alias("cum_good"),
        F.try_divide(F.col("bads_before") + F.col("bads"), "bads_total").alias("cum_bad"),
    )


def ks(ranked: DataFrame) -> DataFrame:
    gap = F.abs(F.col("cum_good") - F.col("cum_bad"))
    return cumulative_shares(ranked).agg(F.max(gap).alias("ks"))


def roc_points(ranked: DataFrame, positive: int = 1) -> DataFrame:
    """True and false positive rate when every score at or above ``score`` is called positive.

    ``positive=0`` takes the other class, for which low scores are the positive call.
    """
    if positive == 1:
        hit = F.try_divide(F.col("goods_total") - F.col("goods_before"), "goods_total")
        alarm = F.try_divide(F.col("bads_total") - F.col("bads_before"), "bads_total")
    else:
        hit = F.try_divide(F.col("bads_before") + F.col("bads"), "bads_total")
        alarm = F.try_divide(F.col("goods_before") + F.col("goods"), "goods_total")
    return ranked.select(F.col("value").alias("score"), hit.alias("tpr"), alarm.alias("fpr"))


def decile_ranges(ranked: DataFrame, groups: int = 10) -> DataFrame:
    """At most ``groups`` rows: group number, score range, rows, goods and conversion."""
    return ranked.withColumn("decile", quantile_group(groups)).groupBy("decile").agg(
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.sum("n").alias("n"),
        F.sum("goods").alias("goods"),
    )


def decile_conversion(ranges: DataFrame) -> DataFrame:
    return ranges.select(
        "decile", F.round(F.col("goods") / F.col("n"), 4).alias("conversion")
    ).orderBy(F.desc("decile"))


def assign_deciles(df: DataFrame, score: str, ranges: DataFrame, name: str = "decile") -> DataFrame:
    """Put each row in its group by the groups' lowest scores, of which there are at most ten."""
    edges = ranges.select("low", "decile").orderBy(F.desc("low")).collect()
    group = F.coalesce(
        *[F.when(F.col(score).cast("double") >= F.lit(e["low"]), F.lit(e["decile"])) for e in edges]
    )
    return df.withColumn(name, group)


def top_first_label(ranges: DataFrame) -> DataFrame:
    """Label groups D1 (highest scores), D2, ... without gaps; at most ten rows."""
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("decile")))
    return ranges.select("decile", F.concat(F.lit("D"), rank).alias("label"))


def decile_means(df: DataFrame, decile: str, variables: Sequence[str]) -> DataFrame:
    """Mean of each numeric variable by decile."""
    return df.groupBy(decile).agg(*[F.avg(v).alias(v) for v in variables])


def decile_profile(
    df: DataFrame,
    ranges: DataFrame,
    variables: Sequence[str],
    definitions: DataFrame | None = None,
    decile: str = "decile",
    groups: int = 10,
) -> DataFrame:
    """One row per variable, one column per decile (D1 highest), with its definition if known."""
    means = decile_means(df, decile, variables).unpivot([decile], list(variables), "variable", "mean")
    labelled = means.join(F.broadcast(top_first_label(ranges)), decile)
    wide = (
        labelled.groupBy("variable")
        .pivot("label", [f"D{i}" for i in range(1, groups + 1)])
        .agg(F.first("mean"))
    )
    if definitions is None:
        return wide
    # one row per documented variable
    return wide.join(F.broadcast(definitions.select("variable", "definition")), "variable", "left").select(
        "variable", "definition", *[c for c in wide.columns if c != "variable"]
    )


def confusion(df: DataFrame, score: str, response: str, threshold: float) -> DataFrame:
    """Two rows, one per predicted class, with actual counts and the share that is right."""
    predicted = F.when(F.col(score) >= F.lit(threshold), 1).otherwise(0)
    y = F.col(response)
    sums = (
        df.filter(y.isNotNull() & F.col(score).isNotNull())
        .groupBy(predicted.alias("predicted"))
        .agg(
            F.sum(F.when(y == 0, 1).otherwise(0)).alias("actual_0"),
            F.sum(F.when(y == 1, 1).otherwise(0)).alias("actual_1"),
        )
    )
    right = F.when(F.col("predicted") == 1, F.col("actual_1")).otherwise(F.col("actual_0"))
    return sums.withColumn("accuracy", F.round(right / (F.col("actual_0") + F.col("actual_1")), 2))


def thresholds(options: Options) -> list[float]:
    low, high, step = options.sweep_percent
    return [percent / 100 for percent in range(low, high + 1, step)]


def threshold_sweep(df: DataFrame, score: str, response: str, options: Options) -> DataFrame:
    """Row accuracy of both predicted classes at each threshold.

    Rows are grouped once by how many thresholds their score reaches, which leaves one row
    per step; running sums over those few rows then give every confusion matrix. No row is
    repeated per threshold.
    """
    steps = thresholds(options)
    passed = sum((F.when(F.col(score) >= F.lit(t), 1).otherwise(0) for t in steps), F.lit(0))
    y = F.col(response)
    groups = (
        df.filter(y.isNotNull() & F.col(score).isNotNull())
        .groupBy(passed.alias("step"))
        .agg(
            F.sum(F.when(y == 0, 1).otherwise(0)).alias("bads"),
            F.sum(F.when(y == 1, 1).otherwise(0)).alias("goods"),
        )
    )
    spark = df.sparkSession
    grid = spark.createDataFrame([(0, None)] + list(enumerate(steps, 1)), "step int, threshold double")
    # one row per step; a score reaching k thresholds counts as predicted 1 at steps 1..k
    line = Window.partitionBy(F.lit(0)).orderBy("step")
    under = line.rowsBetween(Window.unboundedPreceding, -1)
    above = line.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    zero = F.lit(0)
    filled = grid.join(groups, "step", "left").select(
        "step",
        "threshold",
        F.coalesce("bads", zero).alias("bads"),
        F.coalesce("goods", zero).alias("goods"),
    )
    counted = filled.select(
        "threshold",
        F.coalesce(F.sum("bads").over(under), zero).alias("true_0"),
        F.coalesce(F.sum("goods").over(under), zero).alias("missed_1"),
        F.sum("goods").over(above).alias("true_1"),
        F.sum("bads").over(above).alias("false_1"),
    )

    def share(part: str, other: str) -> Column:
        whole = F.nullif(F.col(part) + F.col(other), F.lit(0))
        return F.round(F.col(part) / whole, 2)

    return counted.filter(F.col("threshold").isNotNull()).select(
        "threshold",
        share("true_0", "missed_1").alias("non_churn_accuracy"),
        share("true_1", "false_1").alias("churn_accuracy"),
    )


def width_bin(score: str, bins: int = 10) -> Column:
    """Equal-width bin of a score in [0, 1]; the score 1 belongs to the last bin."""
    return F.least(F.floor(F.col(score) * bins).cast("int") + 1, F.lit(bins))


def reliability(df: DataFrame, score: str, response: str, bins: int = 10) -> DataFrame:
    """Observed rate against the bin midpoint."""
    return (
        df.filter(F.col(response).isNotNull() & F.col(score).isNotNull())
        .groupBy(width_bin(score, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(response).cast("double")).alias("observed"))
        .withColumn("midpoint", (F.col("bin") - 0.5) / bins)
    )


def score_histogram(df: DataFrame, score: str, bins: int = 50) -> DataFrame:
    return (
        df.filter(F.col(score).isNotNull())
        .groupBy(width_bin(score, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def score_density(df: DataFrame, score: str, points: int = 512) -> DataFrame:
    """``x, density, bandwidth``: a Gaussian kernel density of the scores on a grid of ``points``.

    The bandwidth is the rule of thumb 0.9 min(sd, IQR / 1.34) n**-0.2 (the sd where the quartiles coincide, and 1 where
    all scores are equal). The grid runs from 3 bandwidths below the least score to 3 above the largest. Each distinct
    score's rows are shared by the two grid points beside it, so what is convolved with the kernel is one number per
    grid point, whatever the rows.
    """
    counts = value_counts(df.filter(F.col(score).isNotNull()), [score])
    ranked = stage(ranked_values(counts).select("value", "n", "n_before", "n_total"), "density")
    x, n = F.col("value"), F.col("n")

    def quartile(share: float) -> Column:
        place = (F.col("n_total") - 1) * F.lit(share)
        at = [
            F.max(F.when((F.col("n_before") <= k) & (k < F.col("n_before") + n), x)) for k in (F.floor(place), F.ceil(place))
        ]
        return at[0] + (at[1] - at[0]) * F.max(place - F.floor(place))

    mean = ranked.agg(F.sum(x * n) / F.sum(n)).scalar()
    spread = F.sqrt(F.try_divide(F.sum((x - mean) * (x - mean) * n), F.sum(n) - 1))
    shape = ranked.agg(
        F.sum(n).alias("total"), F.min(x).alias("low"), F.max(x).alias("high"), spread.alias("sd"), (quartile(0.75) - quartile(0.25)).alias("iqr")
    )
    narrow = F.least(F.col("sd"), F.col("iqr") / 1.34)
    width = F.when(narrow > 0, narrow).when(F.col("sd") > 0, F.col("sd")).otherwise(F.lit(1.0))
    grid = shape.select("total", "low", "high", (F.lit(0.9) * width * F.pow(F.col("total").cast("double"), F.lit(-0.2))).alias("h")).select(
        "total", "h", (F.col("low") - 3 * F.col("h")).alias("start"), ((F.col("high") - F.col("low") + 6 * F.col("h")) / (points - 1)).alias("step")
    ).filter(F.col("total").isNotNull())
    place = (x - F.col("start")) / F.col("step")
    beside = F.floor(place)
    shares = F.array(
        F.struct(beside.alias("i"), (n * (beside + 1 - place)).alias("m")), F.struct((beside + 1).alias("i"), (n * (place - beside)).alias("m"))
    )
    # one row of settings for all
    masses = (
        ranked.join(F.broadcast(grid))
        .select(F.inline(shares))
        .groupBy("i")
        .agg(F.sum("m").alias("m"))
        .agg(F.collect_list(F.struct("i", "m")).alias("masses"))  # at most one entry per grid point
    )
    far = F.col("step") / F.col("h")
    one = masses.join(F.broadcast(grid)).select(
        "start", "step", "h", "total", "masses", far.alias("far"), F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("j")
    )
    kernel = F.aggregate(
        "masses", F.lit(0.0), lambda a, s: a + s["m"] * F.exp(-F.pow((F.col("j") - s["i"]) * F.col("far"), F.lit(2.0)) / 2)
    )
    return one.select(
        (F.col("start") + F.col("j") * F.col("step")).alias("x"),
        (kernel / (F.col("total") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))).alias("density"),
        F.col("h").alias("bandwidth"),
    )


def mean_scores(df: DataFrame, *scores: str) -> DataFrame:
    return df.agg(*[F.avg(score).alias(f"mean_{score}") for score in scores])


def cohort_scores(df: DataFrame, cohort: str, score: str, bins: int = 10) -> DataFrame:
    """Score distribution and mean log score per cohort and score bin."""
    return (
        df.filter(F.col(score).isNotNull())
        .groupBy(cohort, width_bin(score, bins).alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.when(F.col(score) > 0, F.log(score))).alias("mean_log_score"),
        )
    )


def adjust_level(scored: DataFrame, tested: DataFrame, score: str, name: str) -> DataFrame:
    """Scale scores by mean(test) / mean(scored), taken as two scalar subqueries."""
    target = tested.agg(F.avg(score)).scalar()
    actual = scored.agg(F.avg(score)).scalar()
    return scored.withColumn(name, F.col(score) * F.try_divide(target, actual))
