import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ebbtide import Options
from ebbtide.operators import calibration, evaluation as ev, information

from samples import keyed

OPTIONS = Options()


def scored(spark, pairs):
    return spark.createDataFrame([(float(s), y) for s, y in pairs], "score double, Response int")


def counts(spark, pairs):
    return ev.ranked_scores(scored(spark, pairs), "score", "Response")


def test_zero_cell_adds_nothing(spark):
    rows = [("a", 1)] * 3 + [("a", 0)] * 5 + [("b", 0)] * 4 + [(None, 1)] * 2 + [(None, 0)] * 1 + [("a", None)]
    df = spark.createDataFrame(rows, "c string, Response int")
    got = keyed(information.woe_table(information.binned(df, [], ["c"], "Response", 10)), "bin")
    assert got["b"]["iv"] == 0.0 and got["b"]["woe"] is None
    expected = (3 / 5 - 5 / 10) * math.log((3 / 5) / (5 / 10)) + (2 / 5 - 1 / 10) * math.log((2 / 5) / (1 / 10))
    table = information.woe_table(information.binned(df, [], ["c"], "Response", 10))
    assert math.isclose(information.information_values(table).first()["iv"], expected)


def test_undefined_iv_is_kept(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1)], "x double, Response int")
    iv = information.information_values(information.woe_table(information.binned(df, ["x"], [], "Response", 10)))
    assert iv.first()["iv"] is None
    assert information.iv_failures(iv, 0.01).count() == 0


def test_strength_labels(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(v,) for v in (0.019, 0.02, 0.1, 0.3, 0.5)], "iv double")
    got = [row["s"] for row in df.select(information.iv_strength(F.col("iv")).alias("s")).collect()]
    assert got == ["not useful", "weak", "medium", "strong", "above_range"]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 1)), min_size=2, max_size=50))
def test_gini_ks_against_pairs(spark, pairs):
    goods = [s for s, y in pairs if y]
    bads = [s for s, y in pairs if not y]
    table = counts(spark, pairs)
    got = ev.gini(table).first()["gini"]
    if not goods or not bads:
        assert got is None
        return
    wins = sum((g > b) - (g < b) for g in goods for b in bads) / (len(goods) * len(bads))
    assert math.isclose(got, wins, abs_tol=6e-5)
    assert -1 <= got <= 1
    mirrored = ev.gini(counts(spark, [(-s, y) for s, y in pairs])).first()["gini"]
    assert math.isclose(mirrored, -got, abs_tol=1e-9)
    gap = max(
        abs(sum(g <= s for g in goods) / len(goods) - sum(b <= s for b in bads) / len(bads)) for s, _ in pairs
    )
    assert math.isclose(ev.ks(table).first()["ks"], gap, abs_tol=1e-12)


@pytest.mark.parametrize(
    "pairs, expected",
    [
        ([(1, 0), (1, 1), (1, 1)], 0.0),
        ([(1, 0), (2, 0), (3, 1), (4, 1)], 1.0),
        ([(1, 1), (2, 1), (3, 0), (4, 0)], -1.0),
    ],
)
def test_gini_extremes(spark, pairs, expected):
    assert ev.gini(counts(spark, pairs)).first()["gini"] == expected


def test_gini_agrees_with_mllib(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = random.Random(2)
    df = scored(spark, [(rng.random(), int(rng.random() < 0.4)) for _ in range(500)])
    auc = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="Response").evaluate(df)
    got = ev.gini(ev.ranked_scores(df, "score", "Response")).first()["gini"]
    assert math.isclose(got, 2 * auc - 1, abs_tol=1e-4)


def test_roc_of_either_class(spark):
    pairs = [(0.1, 0), (0.4, 1), (0.4, 0), (0.9, 1)]
    ones = {row["score"]: (row["tpr"], row["fpr"]) for row in ev.roc_points(counts(spark, pairs)).collect()}
    assert ones == {0.1: (1.0, 1.0), 0.4: (1.0, 0.5), 0.9: (0.5, 0.0)}
    zeros = {row["score"]: (row["tpr"], row["fpr"]) for row in ev.roc_points(counts(spark, pairs), 0).collect()}
    assert zeros == {0.1: (0.5, 0.0), 0.4: (1.0, 0.5), 0.9: (1.0, 1.0)}


def test_score_on_the_threshold_is_positive(spark):
    got = keyed(ev.confusion(scored(spark, [(0.3, 1), (0.3, 0), (0.29, 0)]), "score", "Response", 0.3), "predicted")
    assert (got[1]["actual_1"], got[1]["actual_0"], got[1]["accuracy"]) == (1, 1, 0.5)
    assert (got[0]["actual_0"], got[0]["accuracy"]) == (1, 1.0)


def test_sweep_equals_confusion_at_each_threshold(spark):
    rng = random.Random(9)
    pairs = [(rng.randint(0, 100) / 100, rng.randint(0, 1)) for _ in range(400)] + [(0.29, 1), (0.5, 0)]
    df = scored(spark, pairs)
    sweep = keyed(ev.threshold_sweep(df, "score", "Response", OPTIONS), "threshold")
    assert sorted(sweep) == [p / 100 for p in range(20, 51)]
    for t, row in sweep.items():
        low = [y for s, y in pairs if s < t]
        high = [y for s, y in pairs if s >= t]
        assert abs(row["non_churn_accuracy"] - low.count(0) / len(low)) < 0.00501
        assert abs(row["churn_accuracy"] - high.count(1) / len(high)) < 0.00501


def test_sweep_without_rows_on_one_side(spark):
    sweep = ev.threshold_sweep(scored(spark, [(0.9, 1)]), "score", "Response", OPTIONS).collect()
    assert all(row["non_churn_accuracy"] is None and row["churn_accuracy"] == 1.0 for row in sweep)


def test_deciles(spark):
    pairs = [(i, int(i >= 50)) for i in range(100)]
    ranges = ev.decile_ranges(counts(spark, pairs))
    assert [(row["decile"], row["conversion"]) for row in ev.decile_conversion(ranges).collect()] == [
        (d, 1.0 if d > 5 else 0.0) for d in range(10, 0, -1)
    ]
    rows = ev.assign_deciles(scored(spark, pairs), "score", ranges).collect()
    assert all(row["decile"] == int(row["score"]) // 10 + 1 for row in rows)


def test_decile_profile_numbers_without_gaps(spark):
    df = spark.createDataFrame([(1.0, 0, 10.0)] * 20 + [(2.0, 1, 30.0)] * 5, "score double, Response int, v double")
    ranges = ev.decile_ranges(ev.ranked_scores(df, "score", "Response"))
    words = spark.createDataFrame([("v", "a value"), ("w", "other")], "variable string, definition string")
    got = ev.decile_profile(ev.assign_deciles(df, "score", ranges), ranges, ["v"], words).collect()
    assert len(got) == 1
    assert (got[0]["definition"], got[0]["D1"], got[0]["D2"], got[0]["D3"]) == ("a value", 30.0, 10.0, None)


def test_reliability_clamps_one(spark):
    got = keyed(ev.reliability(scored(spark, [(1.0, 1), (0.95, 0), (0.0, 0)]), "score", "Response"), "bin")
    assert (got[10]["n"], got[10]["observed"], got[10]["midpoint"]) == (2, 0.5, 0.95)
    assert got[1]["n"] == 1


def newton(x, y):
    b = np.zeros(2)
    design = np.column_stack([np.ones_like(x), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ b))
        b += np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design, design.T @ (y - p))
    return b


def test_calibration_is_the_logistic_fit(spark):
    rng = np.random.default_rng(1)
    x = rng.random(800)
    y = (rng.random(800) < 1 / (1 + np.exp(-(3 * x - 2)))).astype(int)
    df = scored(spark, list(zip(x.tolist(), y.tolist())))
    curve = calibration.fit_calibration(df, "score", "Response")
    assert np.allclose([curve.intercept, curve.slope], newton(x, y), atol=1e-4)
    ordered = [row["c"] for row in df.orderBy("score").select(curve.column("score").alias("c")).collect()]
    assert ordered == sorted(ordered)


def test_optimal_bins(spark):
    rng = random.Random(7)
    pairs = [(i / 1000, int(rng.random() < (0.1 if i < 400 else 0.7))) for i in range(1000)]
    bins = calibration.optimal_bins(scored(spark, pairs), "score", "Response", 0.01).orderBy("bin").collect()
    assert sum(row["n"] for row in bins) == 1000
    assert min(row["n"] for row in bins) >= 10
    assert any(abs(row["upper"] - 0.4) < 0.02 for row in bins if row["upper"] is not None)
    assert bins[-1]["upper"] is None
    assert all(a["upper"] < b["upper"] for a, b in zip(bins, bins[1:-1]))


def test_level_adjustment(spark):
    got = ev.adjust_level(scored(spark, [(0.2, 0), (0.4, 0)]), scored(spark, [(0.6, 0)]), "score", "a").collect()
    assert sorted(round(row["a"], 9) for row in got) == [0.4, 0.8]


def test_one_class_gives_null_not_an_error(spark):
    table = counts(spark, [(0.1, 1), (0.2, 1)])
    assert ev.ks(table).first()["ks"] is None
    assert all(row["fpr"] is None for row in ev.roc_points(table).collect())
    assert all(row["tpr"] is None for row in ev.roc_points(table, 0).collect())
    assert ev.gini(table).first()["gini"] is None


def test_definitions(spark):
    from ebbtide.functions.describe import definition

    assert definition("uu_d3") == "usage units on day 3"
    assert "auction" in definition("tm_auction")
    assert definition("contacts") is None


def test_sketched_groups_equal_exact_ones(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1.0, 2.0, 2.0, 2.0, 3.5, rng.random() * 9]), rng.randint(0, 1)) for _ in range(700)]
    df = spark.createDataFrame(rows + [(5.0, None)], "x double, Response int")
    exact = sorted((r["n"], r["goods"]) for r in information.binned_numeric(df, ["x"], "Response", 10).collect())
    rough = sorted((r["n"], r["goods"]) for r in information.sketch_binned_numeric(df, ["x"], "Response", 10).collect())
    assert exact == rough
