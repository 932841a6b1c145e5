import math
import random

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbtide.operators import ranking as r

from samples import keyed

VALUES = st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-100, 100, width=16)), min_size=1, max_size=60)


def counts_of(spark, values):
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(values)], "x double, y int")
    return r.reusable(r.value_counts(df, ["x"], "y"))


def ranked_of(spark, values):
    return r.ranked_values(counts_of(spark, values))


def brute_bins(values, groups=10):
    known = sorted(v for v in values if v is not None)
    return {v: groups * sum(w < v for w in known) // len(known) + 1 for v in set(known)}


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=VALUES, pieces=st.sampled_from([None, 1, 3, 8]))
def test_groups_and_order_statistics(spark, values, pieces):
    counts = counts_of(spark, values)
    known = [v + 0.0 for v in values if v is not None]
    present = counts.filter("value is not null")
    ranked = r.running_totals(present, ["variable"], "value", ["n", "goods"], pieces).collect()
    assert sum(row["n"] for row in ranked) == len(known)
    for row in ranked:
        assert row["n_before"] == sum(v < row["value"] for v in known)
        assert row["n_total"] == len(known)
        assert row["goods_before"] == sum(1 for i, v in enumerate(values) if v is not None and v < row["value"] and i % 2)
    if not known:
        return
    bins = brute_bins([v + 0.0 for v in known])
    for row in r.quantile_groups(r.ranked_values(counts), 10).collect():
        inside = [v for v in known if bins[v] == row["bin"]]
        assert (row["low"], row["high"], row["n"]) == (min(inside), max(inside), len(inside))
    stats = r.order_statistics(r.ranked_values(counts)).first()
    assert math.isclose(stats["median"], float(np.median(known)), abs_tol=1e-9)
    k = int(len(known) * 0.1)
    assert math.isclose(stats["trimmed"], float(np.mean(sorted(known)[k : len(known) - k])), abs_tol=1e-9)


def test_ties_share_a_group(spark):
    got = r.quantile_groups(r.ranked_values(counts_of(spark, [1.0] * 20 + [2.0] * 5)), 10).orderBy("bin").collect()
    assert [(row["bin"], row["n"]) for row in got] == [(1, 20), (9, 5)]


def test_even_median(spark):
    assert r.medians(ranked_of(spark, [1.0, 2.0, 3.0, 10.0])).first()["median"] == 2.5


def test_nan_is_missing(spark):
    assert r.medians(ranked_of(spark, [float("nan"), None, 4.0])).first()["median"] == 4.0


def test_many_variables_and_partitions(spark):
    rng = random.Random(1)
    rows = [(float(rng.randint(0, 9)), rng.random(), 7.0) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    one = keyed(r.medians(r.ranked_values(r.value_counts(df.coalesce(1), ["a", "b", "c"]))), "variable")
    many = keyed(r.medians(r.ranked_values(r.value_counts(df.repartition(17), ["a", "b", "c"]))), "variable")
    assert one == many
    assert one["b"]["median"] == float(np.median([row[1] for row in rows]))


def test_hot_value_is_one_row(spark):
    df = spark.range(200_000).selectExpr("case when id % 3 = 0 then 0.0 else cast(id as double) end as x")
    counts = r.reusable(r.value_counts(df, ["x"]))
    assert counts.filter("value = 0").first()["n"] == 66667
    ranked = r.ranked_values(counts)
    last = ranked.orderBy("value", ascending=False).first()
    assert last["n_before"] + last["n"] == 200_000


def test_values_spread_over_pieces(spark):
    """No piece, and so no task, holds a large part of a variable's values."""
    df = spark.range(50_000).selectExpr("pow(id, 4) as x", "cast(1 as double) as k")
    counts = r.reusable(r.value_counts(df, ["x", "k"]))
    ranked = r.running_totals(counts, ["variable"], "value", ["n"], pieces=16)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "_piece" in plan and plan.count("SinglePartition") == 0
    placed = counts.repartitionByRange(16, "variable", "value").groupBy(F.spark_partition_id()).count()
    assert max(row["count"] for row in placed.collect()) < 50_000 / 8
    wrong = ranked.filter("variable = 'x' and n_before != round(pow(value, 0.25))")
    assert wrong.count() == 0
