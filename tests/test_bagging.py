"""Balanced draws, fully grown trees, out-of-bag scores and importance, against plain versions."""

import datetime as dt
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide import Options, load_project, save_project, score_accounts, score_output, train
from ebbtide.operators import bagging, evaluation as ev, forest
from ebbtide.plans import training

from samples import keyed

OPTIONS = Options(
    non_predictive=("account_key",),
    forest_trees=(12, 9),
    top_variables=3,
    scope_variables=4,
    forest_sample_share=0.4,
)
NUMERIC, LEVELS = ["a", "b", "c"], {"kind": ["x", "y", "z", None], "era": ["new", "old"]}


def rows_of(n=240, seed=4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b = rng.gauss(0, 1), float(rng.randrange(4))
        kind = rng.choice(["x", "y", "z", None])
        y = int(a + (kind == "y") + rng.gauss(0, 0.8) > 0.6)
        out.append((i * 7 + 1, y, a, b, 1.0, kind, rng.choice(["new", "old"])))
    return out


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "account_id long, Response int, a double, b double, c double, kind string, era string")


@pytest.fixture(scope="module")
def fitted(spark):
    rows = rows_of()
    df = frame_of(spark, rows).repartition(5)
    goods = sum(r[1] for r in rows)
    return rows, df, bagging.fit_bagged(df, NUMERIC, list(LEVELS), "Response", (goods, len(rows) - goods), LEVELS, 25, OPTIONS)


def plain_draws(rows, trees, seed):
    """{(tree, id): times} by sorting each class as a whole."""
    md5 = lambda text: hashlib.md5(text.encode()).hexdigest()
    size = max(1, round(sum(r[1] for r in rows) * OPTIONS.forest_sample_share))
    drawn = Counter()
    for label in (0, 1):
        own = sorted((r[0] for r in rows if r[1] == label), key=lambda i: md5(f"{i}|{seed}") + f"|{i}")
        for tree in range(trees):
            for k in range(size):
                drawn[tree, own[int(md5(f"{seed}|{tree}|{label}|{k}")[:13], 16) % len(own)]] += 1
    return drawn, size


def vector(row):
    return [*row[2:5], float(LEVELS["kind"].index(row[5])), float(LEVELS["era"].index(row[6]))]


def purity(counts):
    return sum(c * c for c in counts) / sum(counts) if sum(counts) else 0.0


def plain_tree(sample, rng, tries):
    """A nested tree of (vector, label, times) rows: every cut of every drawn variable is tried one by one."""

    def counts(rows):
        return [sum(t for _, y, t in rows if y == k) for k in (0, 1)]

    def build(rows):
        own = counts(rows)
        leaf = int(own[1] * 2 >= sum(own))
        if 0 in own:
            return leaf
        best = None
        for v in rng.permutation(5)[:tries].tolist():
            if v < 3:
                seen = sorted({x[v] for x, _, _ in rows})
                splits = [(lo + (hi - lo) / 2, lambda x, c=lo + (hi - lo) / 2: x[v] <= c) for lo, hi in zip(seen, seen[1:])]
            else:
                rate = {}
                for code in {x[v] for x, _, _ in rows}:
                    c = counts([r for r in rows if r[0][v] == code])
                    rate[code] = (c[1] / sum(c), code)
                ordered = sorted(rate, key=rate.get)
                splits = [(set(ordered[: k + 1]), lambda x, c=set(ordered[: k + 1]): x[v] in c) for k in range(len(ordered) - 1)]
            for cut, goes in splits:
                gain = purity(counts([r for r in rows if goes(r[0])])) + purity(counts([r for r in rows if not goes(r[0])]))
                if best is None or gain > best[0]:
                    best = gain, v, cut
        if best is None:
            return leaf
        _, v, cut = best
        goes = (lambda x: x[v] <= cut) if v < 3 else (lambda x: x[v] in cut)
        left = [r for r in rows if goes(r[0])]
        right = [r for r in rows if not goes(r[0])]
        first = build(left)
        return v, cut, first, build(right)

    return build(sample)


def plain_vote(tree, x):
    while not isinstance(tree, int):
        v, cut, left, right = tree
        tree = left if (x[v] <= cut if v < 3 else x[v] in cut) else right
    return tree


def plain_forest(rows, trees=25, seed=OPTIONS.learner_seed):
    drawn, _ = plain_draws(rows, trees, seed)
    by_id = {r[0]: r for r in rows}
    out = []
    for tree in range(trees):
        sample = [(vector(by_id[i]), by_id[i][1], drawn[tree, i]) for i in sorted(by_id) if (tree, i) in drawn]
        out.append(plain_tree(sample, np.random.default_rng([seed, tree]), int(5**0.5)))
    return out, drawn


def test_draws(fitted):
    rows, _, model = fitted
    drawn, size = plain_draws(rows, 25, OPTIONS.learner_seed)
    got = {(r["tree"], r["id"]): r["times"] for r in model.draws.collect()}
    assert got == dict(drawn)
    label = {r[0]: r[1] for r in rows}
    per = Counter()
    for (tree, i), times in got.items():
        per[tree, label[i]] += times
    assert set(per.values()) == {size} and len(per) == 50


def test_trees_equal_plain_ones(fitted):
    rows, df, model = fitted
    trees, _ = plain_forest(rows)
    want = {r[0]: sum(plain_vote(t, vector(r)) for t in trees) / len(trees) for r in rows}
    got = {r["account_id"]: r["raw"] for r in df.select("account_id", model.score().alias("raw")).collect()}
    assert got == pytest.approx(want)
    packed = model.packed
    for tree in range(25):  # grown to the end: every leaf is pure, or its rows agree in what was drawn
        assert packed.depth > 5
    assert all(v in (0, 1) for v in packed.vote.tolist())


def test_out_of_bag_scores(fitted):
    rows, df, model = fitted
    trees, drawn = plain_forest(rows)
    got = {r["account_id"]: r["raw"] for r in bagging.out_of_bag_scores(df, model, "account_id", "raw").collect()}
    for r in rows:
        own = [plain_vote(t, vector(r)) for k, t in enumerate(trees) if (k, r[0]) not in drawn]
        assert got[r[0]] == (pytest.approx(sum(own) / len(own)) if own else None)


def test_out_of_bag_importance(fitted, spark):
    rows, df, model = fitted
    trees, drawn = plain_forest(rows)
    order = sorted(rows, key=lambda r: hashlib.md5(f"{r[0]}|slice{OPTIONS.learner_seed}".encode()).hexdigest())
    names = [*NUMERIC, *LEVELS]

    def used(tree):
        return set() if isinstance(tree, int) else {tree[0]} | used(tree[2]) | used(tree[3])

    losses = {n: [] for n in names}
    for k, tree in enumerate(trees):
        own = [r for r in order if (k, r[0]) not in drawn]
        right = sum(plain_vote(tree, vector(r)) == r[1] for r in own)
        for v, name in enumerate(names):
            if v not in used(tree):
                losses[name].append(0.0)
                continue
            moved = np.random.default_rng([OPTIONS.learner_seed, 0, k, v]).permutation(len(own))
            hit = 0
            for place, r in enumerate(own):
                x = vector(r)
                x[v] = vector(own[moved[place]])[v]
                hit += plain_vote(tree, x) == r[1]
            losses[name].append((right - hit) / len(own))
    got = keyed(bagging.out_of_bag_importance(df, model, "Response", OPTIONS), "variable")
    assert set(got) == set(names)
    for name, own in losses.items():
        error = np.std(own) / len(own) ** 0.5
        assert got[name]["decrease"] == pytest.approx(np.mean(own), abs=1e-12)
        assert got[name]["error"] == pytest.approx(error, abs=1e-9)
        assert got[name]["mean_decrease_accuracy"] == pytest.approx(np.mean(own) / error if error > 1e-12 else 0.0, rel=1e-6)
    assert max(losses, key=lambda n: got[n]["mean_decrease_accuracy"]) == "a"
    assert got["c"]["mean_decrease_accuracy"] == 0.0
    sliced = keyed(bagging.out_of_bag_importance(df, model, "Response", OPTIONS, slice_rows=40), "variable")
    assert abs(sliced["a"]["decrease"] - got["a"]["decrease"]) < 0.05


def test_gini_decrease(fitted, spark):
    rows, _, model = fitted
    trees, drawn = plain_forest(rows)
    by_id = {r[0]: r for r in rows}
    total = Counter()

    def walk(tree, sample):
        if isinstance(tree, int):
            return
        v, cut, left, right = tree
        goes = (lambda x: x[v] <= cut) if v < 3 else (lambda x: x[v] in cut)
        parts = [[r for r in sample if goes(r[0])], [r for r in sample if not goes(r[0])]]
        score = lambda s: purity([sum(t for _, y, t in s if y == k) for k in (0, 1)])
        total[v] += score(parts[0]) + score(parts[1]) - score(sample)
        walk(left, parts[0])
        walk(right, parts[1])

    for k, tree in enumerate(trees):
        walk(tree, [(vector(by_id[i]), by_id[i][1], t) for (n, i), t in drawn.items() if n == k])
    got = keyed(bagging.gini_decrease(model, spark), "variable")
    for v, name in enumerate([*NUMERIC, *LEVELS]):
        assert got[name]["mean_decrease_gini"] == pytest.approx(total[v] / 25)


def test_levels_and_gaps(spark, fitted):
    """A level that no tree has seen goes right, a NULL number as well; nothing fails."""
    _, _, model = fitted
    odd = frame_of(spark, [(1, None, None, 0.0, 1.0, "new level", "old"), (2, 1, 0.1, None, None, None, None)])
    scores = [r[0] for r in odd.select(model.score()).collect()]
    assert all(0 <= s <= 1 for s in scores)
    assert frame_of(spark, []).select(model.score()).collect() == []


def test_sample_has_a_bound():
    assert bagging.sample_size(1000, OPTIONS) == 400
    assert bagging.sample_size(10**9, OPTIONS) == OPTIONS.forest_sample_most
    assert bagging.sample_size(1, OPTIONS.replace(forest_sample_share=0.1)) == 1


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(11)
    rows = []
    for i in range(900):
        role = "sc" if i % 9 == 0 else "md"
        strong = rng.gauss(0, 1)
        kind = rng.choice("abc")
        churn = int(strong + (kind == "a") + rng.gauss(0, 0.7) > 0.5)
        day = dt.date(2018, 1, 1) + dt.timedelta(days=i % 90)
        rows.append((i, i + 5000, day, churn if role == "md" else None, strong, rng.random(), rng.random(), kind, role))
    return spark.createDataFrame(
        rows,
        "account_id long, account_key long, first_usage_units date, churn_90d int, strong double, noise double, "
        "more double, kind string, md_sc_f string",
    )


@pytest.fixture(scope="module")
def trained(frame):
    return train(frame, OPTIONS.replace(iv_floor=-1.0))


def test_project(spark, frame, trained, tmp_path):
    model = trained.model
    assert isinstance(model.forest, bagging.BaggedForest) and "strong" in model.top
    assert ev.gini(ev.ranked_scores(trained.tested, forest.RAW, "Response")).first()["gini"] > 0.5
    shares = {r[0] * 9 for r in trained.tested.select(forest.RAW).distinct().collect()}
    assert all(abs(s - round(s)) < 1e-9 for s in shares)  # votes of nine trees
    done = training.evaluated(trained)
    save_project(done.model, str(tmp_path / "p"), spark)
    again = load_project(spark, str(tmp_path / "p"))
    rows = frame.filter("md_sc_f = 'sc'").drop("churn_90d", "md_sc_f")
    assert keyed(score_accounts(rows, again), "account_id") == keyed(score_accounts(rows, model), "account_id")
    ginis = {r["rows"]: r["gini"] for r in again.tables["gini"].collect()}
    assert set(ginis) == {"train_out_of_bag", "test"} and ginis["train_out_of_bag"] > 0.4
    accuracy = keyed(again.tables["accuracy"], "variable")
    assert max(accuracy, key=lambda v: accuracy[v]["mean_decrease_accuracy"]) == "strong"
    plan = score_output(rows, again, dt.date(2019, 2, 1))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_same_forest_however_rows_are_dealt(frame, trained):
    rows = trained.prepared.train
    sizes = forest.class_sizes(rows, "Response")
    make = lambda df: bagging.fit_bagged(df, ["strong", "noise"], ["kind"], "Response", sizes, {"kind": ["a", "b", "c"]}, 5, OPTIONS)
    first, second = make(rows.repartition(3)), make(rows.repartition(7, "noise"))
    assert keyed(first.trees, "tree") == keyed(second.trees, "tree")


def test_one_class_is_refused(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (2, 1, 2.0)], "account_id long, Response int, x double")
    with pytest.raises(ValueError, match="both response classes"):
        forest.learn(df, ["x"], [], "Response", 2, OPTIONS)
    with pytest.raises(ValueError, match="unknown learner"):
        forest.learn(df, ["x"], [], "Response", 2, OPTIONS.replace(forest_learner="none"))
