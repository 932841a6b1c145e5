"""What keeps large cohorts and message tables cheap, with the same rows as before."""

import datetime as dt
import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ebbtide import Inputs, Options
from ebbtide.functions import search
from ebbtide.functions.text import KEYWORDS, matches
from ebbtide.operators import bagging, forest, messages as m
from ebbtide.plans import features

from samples import account, accounts, dim, messages, packages, profiles, usage

FIRST = dt.date(2018, 12, 25)


def test_large_cohort_searches_texts_of_its_windows_only(spark, monkeypatch):
    """The window test goes below the join that looks the texts up, also for cohorts too large to be broadcast."""
    stamp = lambda day: dt.datetime(2018, 12, day, 8)
    rows = [(1, 1, 5, "sale", "2", stamp(26)), (2, 1, 5, "sale", "2", stamp(10)), (3, 2, 5, "sale", "2", stamp(26))]
    plain = messages(spark, *[(*row[:4], float(row[4]), row[5]) for row in rows])
    texts = spark.createDataFrame([(k, "store tax") for k in range(3)], "n long, text string")
    sent = plain.join(texts, F.col("id") % 3 == F.col("n")).select(*[F.col("text").alias(c) if c == "message" else c for c in plain.columns])
    seen = []
    search_days = m.message_days

    def spied(found, *args):
        seen.append(found)
        return search_days(found, *args)

    monkeypatch.setattr(features.messages, "message_days", spied)
    base = accounts(spark, account(1, first_usage_units=FIRST), account(4, first_usage_units=FIRST))
    base = base.withColumns({"usage": F.lit("x"), "churn_90d": F.lit(1), "churn_1d": F.lit(0)})
    source = Inputs(base, profiles(spark), dim(spark), usage(spark), packages(spark), sent)
    results = []
    for most in (0, 1000):
        frame = features.add_features(base, source, Options(broadcast_accounts=most))
        results.append(sorted(map(str, frame.collect())))
        assert [row["id"] for row in seen[-1].collect()] == [1]
        plan = seen[-1]._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Join Inner") < plan.index("Join LeftSemi")
    assert results[0] == results[1]


ODD = ["", "a", ".com", "x.com", "com", "é.com", "ta", "x", "tax", "%", "test%", "sp", "ecial", "of the yea", "r", "don't miss", "net", None]


@pytest.mark.parametrize("piece", [1, 3, 7, 1 << 18])
def test_search_equals_patterns(spark, monkeypatch, piece):
    monkeypatch.setattr(search, "PIECE", piece)
    texts = ODD + [a + b if a is not None and b is not None else None for a, b in itertools.product(ODD, ODD)]
    rows = spark.createDataFrame([(k, text) for k, text in enumerate(texts)], "k long, text string")
    tests = [F.coalesce(matches(F.col("text"), p), F.lit(False)).alias(n) for n, p in KEYWORDS.items()]
    wanted = [sum(bool(v) << k for k, v in enumerate(row[1:])) for row in rows.select("k", *tests).orderBy("k").collect()]
    found = search.Needles(tuple(KEYWORDS.values()))
    assert found.bits(pa.array(texts, pa.string())).tolist() == wanted
    assert found.bits(pa.array(["tax", *texts], pa.string()).slice(1)).tolist() == wanted
    assert found.bits(pa.array([], pa.string())).tolist() == []
    if piece > 7:
        bits = rows.select("k", search.pattern_bits(F.col("text"), list(KEYWORDS.values())).alias("b")).orderBy("k")
        assert [row["b"] for row in bits.collect()] == wanted


def _walk(tree, row, categories):
    """Leaf and asked variables of one row, step by step."""
    node, asked = 0, set()
    while tree["variable"][node] >= 0:
        variable = tree["variable"][node]
        asked.add(variable)
        goes = int(row[variable]) in tree["low"][node] if variable >= len(row) - categories else row[variable] <= tree["cut"][node]
        node = tree["left" if goes else "right"][node]
    return node, asked


def test_rows_walk_to_their_leaf_only():
    rng = np.random.default_rng(5)
    features = np.column_stack([rng.normal(size=(300, 3)), rng.integers(0, 4, 300)]).astype(float)
    labels = (features[:, 0] + (features[:, 3] == 2) + rng.normal(size=300) > 0.5).astype(int)
    trees = [bagging.grow(features, labels, np.ones(300), 1, 2, np.random.default_rng(k)) for k in range(4)]
    packed = bagging.Packed(trees, 4)
    for number, tree in enumerate(trees):
        met = np.zeros(features.shape, dtype=bool)
        found = packed.leaves(features, np.array([number]), met)[:, 0] - packed.first[number]
        for row, leaf, asked in zip(features, found, met):
            assert (leaf, set(np.flatnonzero(asked))) == _walk(tree, row, 1)
    every = packed.leaves(features, np.arange(4))
    assert every.shape == (300, 4) and packed.leaves(features[:0], np.arange(4)).shape == (0, 4)
    assert [(every[:, k] == packed.leaves(features, np.array([k]))[:, 0]).all() for k in range(4)] == [True] * 4


def test_permuted_copies_are_scored_by_many_tasks(spark):
    rows = spark.range(400).selectExpr(
        "id as account_id", "cast(id % 2 as int) as Response", "cast(id % 2 + id % 7 as double) as x", "cast(id % 5 as double) as y"
    )
    options = Options(forest_sample_share=0.5)
    model = forest.learn(rows, ["x", "y"], [], "Response", 5, options)
    found = forest.accuracy_importance(rows, model, "Response", "account_id", options)
    assert "RoundRobinPartitioning(10)" in found._jdf.queryExecution().executedPlan().toString()
    assert {row["variable"] for row in found.collect()} == {"x", "y"}


def test_copies_of_a_text_are_not_shuffled(spark):
    """What is shuffled by message has no text; the texts are shuffled once each, and no row is sorted with its text before."""
    stamp = dt.datetime(2018, 12, 26, 8)
    long = "sale " * 2000
    rows = [(k, k % 3, None if k % 2 else 5, None if k % 5 == 0 else f"{long}{k % 2}", 2.0, stamp) for k in range(40)]
    sent = messages(spark, *rows)
    found = m.distinct_messages(sent)
    wanted = {(*row[1:4], str(row[4]), row[5]) for row in rows}
    got = [(r["user_id"], r["recipients_count"], r["message"], r["credits"], r["stamp_to_send"]) for r in found.collect()]
    assert len(got) == len(wanted) and {(*r[:3], str(float(r[3])), r[4]) for r in got} == wanted
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan and "first(message" not in plan


def test_forests_of_mllib_score_after_an_observation(spark):
    rows = spark.range(60).selectExpr("id as account_id", "cast(id % 2 as int) as Response", "cast(id % 2 + id % 7 as double) as x")
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 60
    model = forest.fit_forest(rows, ["x"], [], "Response", 2, Options(forest_sample_share=0.5))
    assert forest.add_scores(rows, model).filter(F.col(forest.RAW).isNotNull()).count() == 60
