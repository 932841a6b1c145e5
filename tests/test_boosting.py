"""Boosting rounds against plain ones: samples, trees, errors, weights and votes."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import boosting
from ebbtide.operators import evaluation as ev

from test_bagging import LEVELS, NUMERIC, OPTIONS as BASE
from test_bagging import frame_of, plain_vote, rows_of, vector

OPTIONS = BASE.replace(boost_iterations=5, boost_cut_every=2, boost_step=0.4, boost_sample_share=0.6, boost_depth=2)


def plain_weighted_tree(sample, order, depth):
    """Every cut of every variable, tried in the given order of variables, with weights that are no whole numbers."""

    def score(rows):
        ones, total = sum(w for _, y, w in rows if y == 1), sum(w for _, _, w in rows)
        return (ones**2 + (total - ones) ** 2) / total

    def build(rows, level):
        ones, total = sum(w for _, y, w in rows if y == 1), sum(w for _, _, w in rows)
        leaf = int(2 * ones >= total)
        if level == depth or len({y for _, y, _ in rows}) == 1:
            return leaf
        best = None
        for v in order(level):
            if v < 3:
                seen = sorted({x[v] for x, _, _ in rows})
                cuts = [(lo + (hi - lo) / 2) for lo, hi in zip(seen, seen[1:])]
                sides = [(c, lambda x, c=c: x[v] <= c) for c in cuts]
            else:
                rate = {}
                for code in {x[v] for x, _, _ in rows}:
                    own = [r for r in rows if r[0][v] == code]
                    rate[code] = (sum(w for _, y, w in own if y == 1) / sum(w for _, _, w in own), code)
                ordered = sorted(rate, key=rate.get)
                sides = [(set(ordered[: k + 1]), lambda x, c=set(ordered[: k + 1]): x[v] in c) for k in range(len(ordered) - 1)]
            for cut, goes in sides:
                gain = score([r for r in rows if goes(r[0])]) + score([r for r in rows if not goes(r[0])])
                if best is None or gain > best[0] + 1e-12:
                    best = gain, v, cut
        if best is None:
            return leaf
        _, v, cut = best
        goes = (lambda x: x[v] <= cut) if v < 3 else (lambda x: x[v] in cut)
        return v, cut, build([r for r in rows if goes(r[0])], level + 1), build([r for r in rows if not goes(r[0])], level + 1)

    return build(sample, 0)


def plain_rounds(rows):
    weight = {r[0]: 1 / len(rows) for r in rows}
    trees, says, errors = [], [], []
    for number in range(OPTIONS.boost_iterations):
        def inside(i):
            return int(hashlib.md5(f"{i}|{OPTIONS.learner_seed}|{number}".encode()).hexdigest()[:8], 16) < round(0.6 * 2**32)

        sample = [(vector(r), r[1], weight[r[0]]) for r in sorted(rows) if inside(r[0])]
        tree = plain_weighted_tree(sample, lambda level: range(5), OPTIONS.boost_depth)
        wrong = {r[0]: plain_vote(tree, vector(r)) != r[1] for r in rows}
        error = sum(weight[i] for i, w in wrong.items() if w)
        alpha = 0.4 * 0.5 * math.log((1 - error) / error)
        weight = {i: w * math.exp(alpha if wrong[i] else -alpha) for i, w in weight.items()}
        total = sum(weight.values())
        weight = {i: w / total for i, w in weight.items()}
        trees.append(tree)
        says.append(alpha)
        errors.append(error)
    return trees, says, errors, weight


@pytest.fixture(scope="module")
def fitted(spark):
    rows = rows_of(260, 9)
    df = frame_of(spark, rows).repartition(4)
    return rows, df, boosting.fit_adaboost(df, NUMERIC, list(LEVELS), "Response", OPTIONS)


def test_rounds_equal_plain_ones(fitted):
    rows, df, model = fitted
    trees, says, errors, weight = plain_rounds(rows)
    assert model.errors == pytest.approx(errors) and model.says == pytest.approx(says)
    got = {r["id"]: r["weight"] for r in model.weights.collect()}
    assert got == pytest.approx(weight) and sum(got.values()) == pytest.approx(1)
    scores = {r[0]: r[1] for r in df.select("account_id", model.score()).collect()}
    for r in rows:
        votes = [plain_vote(t, vector(r)) for t in trees]
        assert scores[r[0]] == pytest.approx(sum(a for a, v in zip(says, votes) if v) / sum(says))


def test_boosting_ranks(fitted):
    _, df, model = fitted
    scored = df.select("Response", model.score().alias("score"))
    assert ev.gini(ev.ranked_scores(scored, "score", "Response")).first()["gini"] > 0.5


def test_rounds_end(spark):
    rows = [(i, int(i >= 50), float(i), 0.0, 1.0, "x", "new") for i in range(100)]
    model = boosting.fit_adaboost(frame_of(spark, rows), NUMERIC, [], "Response", OPTIONS.replace(boost_sample_share=1.0))
    assert model.errors == [0.0] and model.says[0] > 4 * OPTIONS.boost_step
    same = [(i, i % 2, 1.0, 0.0, 1.0, "x", "new") for i in range(100)]
    with pytest.raises(ValueError, match="better than chance"):
        boosting.fit_adaboost(frame_of(spark, same), NUMERIC, [], "Response", OPTIONS)
    with pytest.raises(ValueError, match="both response classes"):
        boosting.fit_adaboost(frame_of(spark, rows[:40]), NUMERIC, [], "Response", OPTIONS)


def test_say_and_weights(spark):
    assert boosting.say(0.5, 1.0) == 0 and boosting.say(0.7, 1.0) == pytest.approx(-boosting.say(0.3, 1.0))
    assert math.isfinite(boosting.say(0.0, 1.0)) and math.isfinite(boosting.say(1.0, 1.0))
    df = spark.createDataFrame([(0.25, True), (0.25, False), (0.5, False)], "weight double, wrong boolean")
    error = boosting.weighted_error(df, F.col("wrong"))
    assert error == 0.25
    got = np.array([r[0] for r in df.select(boosting.reweighted(F.col("wrong"), error, 1.0)).collect()])
    assert got.sum() == pytest.approx(1) and got[0] == pytest.approx(0.5)  # unshrunk, wrong rows get half the weight
