"""Calibration of raw scores and supervised score bins, both on value counts."""

from __future__ import annotations

import bisect
import dataclasses
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .information import woe_table
from .ranking import ranked_values, value_counts


@dataclasses.dataclass(frozen=True)
class Calibration:
    """Logistic curve: 1 / (1 + exp(-(intercept + slope * raw))), with standard errors.

    Where the classes are separated the likelihood has no maximum; its limit is a step: with a ``cut``, ``slope`` is
    infinite, scores on one side of the cut have probability 0, those on the other 1, and the cut itself ``rate``.
    """

    intercept: float
    slope: float
    intercept_error: float = math.nan
    slope_error: float = math.nan
    cut: float | None = None
    rate: float | None = None

    def column(self, raw: str) -> Column:
        if self.cut is None:
            return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(self.intercept) + F.lit(self.slope) * F.col(raw))))
        above = 1.0 if self.slope > 0 else 0.0
        return (
            F.when(F.col(raw) > F.lit(self.cut), F.lit(above))
            .when(F.col(raw) < F.lit(self.cut), F.lit(1.0 - above))
            .when(F.col(raw) == F.lit(self.cut), F.lit(self.rate))
        )


def scored_counts(df: DataFrame, score: str, response: str) -> DataFrame:
    """``value, n, goods`` of the rows with a score and a response: what every fit below works on."""
    known = df.filter(F.col(response).isNotNull() & F.col(score).isNotNull())
    return value_counts(known, [score], response).filter(F.col("value").isNotNull()).select("variable", "value", "n", "goods")


def fit_calibration(df: DataFrame, raw: str, response: str, steps: int = 50) -> Calibration:
    """Unpenalised logistic regression of the response on the raw score, by Newton's method.

    A step is five sums over the distinct scores; it is halved while the deviance grows. One class only, or one
    score only: slope 0 and the logit of the rate. Separated classes: see ``Calibration``.
    """
    counts = stage(scored_counts(df, raw, response).select("value", "n", "goods"), "calibration")
    x, n, g = F.col("value"), F.col("n"), F.col("goods")
    good, bad = g > 0, g < n
    row = counts.agg(
        F.sum("n").alias("n"),
        F.sum("goods").alias("goods"),
        (F.sum(x * n) / F.sum("n")).alias("mean"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.min(F.when(good, x)).alias("good_low"),
        F.max(F.when(good, x)).alias("good_high"),
        F.min(F.when(bad, x)).alias("bad_low"),
        F.max(F.when(bad, x)).alias("bad_high"),
    ).first()
    total, goods = row["n"] or 0, row["goods"] or 0
    if not total:
        raise ValueError("calibration needs rows with a score and a response")
    if goods in (0, total):
        return Calibration(math.inf if goods else -math.inf, 0.0)
    rate = goods / total
    if row["low"] == row["high"]:
        return Calibration(math.log(rate / (1 - rate)), 0.0, math.sqrt(1 / (total * rate * (1 - rate))))
    for lower, upper, slope in ((row["bad_high"], row["good_low"], math.inf), (row["good_high"], row["bad_low"], -math.inf)):
        if lower <= upper:
            cut = (lower + upper) / 2
            own = counts.filter(x == F.lit(cut)).agg(F.sum("goods") / F.sum("n")).first()[0]
            return Calibration(math.nan, slope, cut=cut, rate=0.5 if own is None else own)

    scale = row["high"] - row["low"]
    z = (x - F.lit(row["mean"])) / F.lit(scale)

    def sums(a: float, b: float):
        eta = F.lit(a) + F.lit(b) * z
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))
        w = n * p * (F.lit(1.0) - p)
        fit = g * eta - n * (F.greatest(eta, F.lit(0.0)) + F.log1p(F.exp(-F.abs(eta))))
        found = counts.agg(
            F.sum(fit), F.sum(g - n * p), F.sum((g - n * p) * z), F.sum(w), F.sum(w * z), F.sum(w * z * z)
        ).first()
        return list(found)

    a, b = math.log(rate / (1 - rate)), 0.0
    here = sums(a, b)
    for _ in range(steps):
        _, ga, gb, haa, hab, hbb = here
        whole = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / whole, (haa * gb - hab * ga) / whole
        for _ in range(30):
            there = sums(a + da, b + db)
            if there[0] >= here[0] - 1e-12 * abs(here[0]):
                break
            da, db = da / 2, db / 2
        a, b, here = a + da, b + db, there
        if abs(da) + abs(db) < 1e-11 * (1 + abs(a) + abs(b)):
            break
    _, _, _, haa, hab, hbb = here
    whole = haa * hbb - hab * hab
    shift = row["mean"] / scale
    var_a, var_b, cov = hbb / whole, haa / whole, -hab / whole
    return Calibration(
        a - b * shift,
        b / scale,
        math.sqrt(max(0.0, var_a - 2 * shift * cov + shift * shift * var_b)),
        math.sqrt(var_b) / scale,
    )


@dataclasses.dataclass(frozen=True)
class Part:
    """An interval of scores: those above ``low``, with the rows and goods before and in it."""

    low: float | None
    n_before: int
    goods_before: int
    n: int
    goods: int


def split_statistics(ranked: DataFrame, parts: list[Part], least: int, centre: float) -> DataFrame:
    """For each part: ``part, statistic, cut, cut_statistic, cut_n, cut_goods``.

    ``ranked`` has ``value, n, goods, n_before, goods_before``. ``statistic`` is that of independence of score and
    response under permutation (squared standardised sum of products). A cut divides a part behind one of its scores,
    leaving ``least`` rows on each side; the best one has the largest standardised difference, the lowest of several.
    All parts and all their cuts come out of one pass.
    """
    place = sum((F.when(F.col("value") > F.lit(p.low), 1).otherwise(0) for p in parts if p.low is not None), F.lit(0))

    def of(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>"), F.col("part") + 1)

    total, good = of([p.n for p in parts], "double"), of([p.goods for p in parts], "double")
    left_n = F.col("n_before") + F.col("n") - of([p.n_before for p in parts], "long")
    left_g = F.col("goods_before") + F.col("goods") - of([p.goods_before for p in parts], "long")
    rate = good / total
    spread = F.try_divide(rate * (F.lit(1.0) - rate), total - 1)
    x = F.col("value") - F.lit(centre)
    rows = ranked.withColumn("part", place).select(
        "part",
        "value",
        left_n.alias("left_n"),
        left_g.alias("left_g"),
        (x * F.col("n")).alias("sx"),
        (x * x * F.col("n")).alias("sxx"),
        (x * F.col("goods")).alias("sxy"),
        total.alias("total"),
        rate.alias("rate"),
        spread.alias("spread"),
    )
    away = F.col("left_g") - F.col("left_n") * F.col("rate")
    cut_statistic = F.try_divide(away * away, F.col("spread") * F.col("left_n") * (F.col("total") - F.col("left_n")))
    allowed = (F.col("left_n") >= least) & (F.col("total") - F.col("left_n") >= least) & (F.col("spread") > 0)
    candidate = F.struct(cut_statistic.alias("statistic"), (-F.col("value")).alias("value"), "left_n", "left_g")
    best = F.max(F.when(allowed, candidate))
    grouped = rows.groupBy("part").agg(
        best.alias("best"), *[F.sum(c).alias(c) for c in ("sx", "sxx", "sxy")], *[F.max(c).alias(c) for c in ("total", "rate", "spread")]
    )
    joint = F.col("sxy") - F.col("rate") * F.col("sx")
    width = F.col("spread") * (F.col("total") * F.col("sxx") - F.col("sx") * F.col("sx"))
    return grouped.select(
        "part",
        F.when(width > 0, F.try_divide(joint * joint, width)).otherwise(F.lit(0.0)).alias("statistic"),
        (-F.col("best.value")).alias("cut"),
        F.col("best.statistic").alias("cut_statistic"),
        F.col("best.left_n").alias("cut_n"),
        F.col("best.left_g").alias("cut_goods"),
    )


def ranked_scores(df: DataFrame, score: str, response: str) -> DataFrame:
    """The distinct scores in order, with running totals, written once."""
    ranked = ranked_values(scored_counts(df, score, response), ("n", "goods"))
    return stage(ranked.select("value", "n", "goods", "n_before", "goods_before"), "scores")


def learn_cut_points(
    df: DataFrame, score: str, response: str, min_share: float, significance: float = 0.05, min_split: int = 20, tests: int = 1
) -> list[float]:
    """Upper score of every bin but the last, by conditional inference.

    A part is divided at its best cut if score and response depend on each other in it: the permutation statistic's
    p-value (chi-squared with one degree of freedom, adjusted for ``tests`` variables by Bonferroni) is below
    ``significance``, the part has ``min_split`` rows or more, and a cut leaves ``min_share`` of all rows on
    both sides. The parts of a level are tested in one pass over the distinct scores; there are at most
    1 / min_share parts, whose statistics the driver reads.
    """
    ranked = ranked_scores(df, score, response)
    row = ranked.agg(F.sum("n").alias("n"), F.sum("goods").alias("goods"), (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean")).first()
    if not row["n"]:
        return []
    least = max(1, math.ceil(round(min_share * row["n"], 9)))
    parts, closed, cuts = [Part(None, 0, 0, row["n"], row["goods"])], set(), []
    while len(closed) < len(parts):
        found = split_statistics(ranked, parts, least, row["mean"]).collect()
        split = {}
        for own in found:
            part = parts[own["part"]]
            p = math.erfc(math.sqrt(max(0.0, own["statistic"]) / 2))
            adjusted = -math.expm1(tests * math.log1p(-p)) if p < 1 else 1.0
            if part not in closed and own["cut"] is not None and part.n >= min_split and adjusted < significance:
                split[own["part"]] = own
        following = []
        for place, part in enumerate(parts):
            if place not in split:
                closed.add(part)
                following.append(part)
                continue
            own = split[place]
            left = dataclasses.replace(part, n=own["cut_n"], goods=own["cut_goods"])
            right = Part(own["cut"], part.n_before + left.n, part.goods_before + left.goods, part.n - left.n, part.goods - left.goods)
            bisect.insort(cuts, own["cut"])
            following += [left, right]
        parts = following
    return cuts


def score_bins(df: DataFrame, score: str, response: str, cuts: list[float]) -> DataFrame:
    """Count, rates, WOE and IV of the bins (previous cut, cut]."""
    place: Column = sum((F.when(F.col(score) > F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
    upper = F.try_element_at(F.array(*[F.lit(c) for c in cuts]).cast("array<double>"), F.col("bin").cast("int"))
    counts = (
        df.filter(F.col(response).isNotNull() & F.col(score).isNotNull())
        .groupBy((place + 1).cast("string").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(response).cast("long")).alias("goods"))
        .withColumn("variable", F.lit(score))
    )
    table = woe_table(counts)
    return table.select(
        F.col("bin").cast("int").alias("bin"),
        upper.alias("upper"),
        "n",
        "goods",
        "bads",
        (F.col("goods") / F.col("n")).alias("good_rate"),
        (F.col("bads") / F.col("n")).alias("bad_rate"),
        "woe",
        "iv",
    )


def optimal_bins(df: DataFrame, score: str, response: str, min_share: float) -> DataFrame:
    return score_bins(df, score, response, learn_cut_points(df, score, response, min_share))
