import datetime as dt
import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ebbtide import Options
from ebbtide.operators import cleaning, levels, profiling, ranking, splitting

from samples import keyed

OPTIONS = Options(id_column="id", non_predictive=("email",))


def test_levels_count_null(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 1.0), ("a", None)], "c string, n double")
    exact = keyed(profiling.distinct_levels(df, ["c", "n"]), "variable")
    rough = keyed(profiling.distinct_levels(df, ["c", "n"], exact=False), "variable")
    assert exact["c"]["levels"] == exact["n"]["levels"] == rough["c"]["levels"] == rough["n"]["levels"] == 2


def test_roles(spark):
    rows = [
        (i, i % 2, float(i), 5.0, 5.0 if i else None, f"u{i}", "x" if i % 2 else "y", f"c{i}", "only", None, dt.date(2018, 1, 1), True, 1.5, 2)
        for i in range(300)
    ]
    df = spark.createDataFrame(
        rows,
        "id long, Response int, amount double, fixed double, nearly double, email string, kind string, "
        "city string, single string, nothing string, day date, flag boolean, uu_d9 double, md int",
    )
    roles = {k: v["type"] for k, v in keyed(profiling.classify_variables(df, OPTIONS), "variable").items()}
    assert roles == {
        "id": "id", "Response": "y", "amount": "num", "fixed": "np", "nearly": "num", "email": "np",
        "kind": "cat", "city": "np", "single": "np", "nothing": "np", "day": "other", "flag": "other",
        "uu_d9": "np", "md": "np",
    }
    assert profiling.names_of(profiling.classify_variables(df, OPTIONS), "num") == ["amount", "nearly"]


def test_level_limit_is_exact(spark):
    df = spark.createDataFrame([(i, f"a{i % 100}", f"b{i % 101}", f"c{i % 257}") for i in range(2000)], "id long, a string, b string, c string")
    roles = keyed(profiling.classify_variables(df, OPTIONS), "variable")
    assert [roles[c]["type"] for c in "abc"] == ["cat", "np", "np"]
    few = keyed(profiling.classify_variables(df, OPTIONS.replace(max_levels=1000)), "variable")
    assert [few[c]["levels"] for c in "abc"] == [100, 101, 257]


def test_numeric_to_category_option(spark):
    df = spark.createDataFrame([(i, float(i % 3), float(i)) for i in range(50)], "id long, few double, many double")
    off = keyed(profiling.classify_variables(df, OPTIONS), "variable")
    on = keyed(profiling.classify_variables(df, OPTIONS.replace(numeric_to_category=16)), "variable")
    assert (off["few"]["type"], on["few"]["type"], on["many"]["type"]) == ("num", "cat", "num")


def test_missing_edge(spark):
    df = spark.range(1000).selectExpr(
        "if(id < 504, null, id) as kept", "if(id < 506, null, id) as dropped", "if(id < 3, double('nan'), 1.0) as nans"
    )
    share = keyed(profiling.missing_share(df, ["kept", "dropped"]), "variable")
    assert (share["kept"]["missing_share"], share["dropped"]["missing_share"]) == (0.5, 0.51)
    assert cleaning.complete_enough(df, ["kept", "dropped", "nans"], OPTIONS) == ["kept", "nans"]


def test_imputation_and_idempotence(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, None), (3, 3.0, "b"), (4, 10.0, "b"), (5, 2.0, "a")], "id long, x double, c string")
    medians = cleaning.learn_medians(ranking.value_counts(df, ["x"]))
    assert medians == {"x": 2.5}
    clean = cleaning.apply_cleaning(df, ["id"], ["x"], ["c"], medians, OPTIONS)
    got = keyed(clean, "id")
    assert got[2] == {"id": 2, "x": 2.5, "c": None}
    again = cleaning.apply_cleaning(clean, ["id"], ["x"], ["c"], medians, OPTIONS)
    assert keyed(again, "id") == got
    explicit = cleaning.apply_cleaning(df, ["id"], ["x"], ["c"], medians, OPTIONS.replace(explicit_missing_level=True))
    assert keyed(explicit, "id")[2]["c"] == "NA"
    raw = cleaning.apply_cleaning(df, ["id"], ["x"], ["c"], medians, OPTIONS.replace(impute_median=False))
    assert keyed(raw, "id")[2]["x"] is None


def test_profile_matches_numpy(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.lognormal(size=501), 3)
    df = spark.createDataFrame([(float(v), 3.0) for v in x] + [(None, 3.0)], "x double, k double")
    got = keyed(profiling.numeric_profile(df, ["x", "k"]), "variable")
    n, mean, sd = len(x), x.mean(), x.std(ddof=1)
    cutoff = int(n * 0.1)
    expected = dict(
        n=n, mean=mean, sd=sd, median=np.median(x), trimmed=np.sort(x)[cutoff : n - cutoff].mean(),
        mad=np.median(abs(x - np.median(x))) * 1.4826, min=x.min(), max=x.max(), range=x.max() - x.min(),
        skew=((x - mean) ** 3).mean() / sd**3, kurtosis=((x - mean) ** 4).mean() / sd**4 - 3, se=sd / math.sqrt(n),
    )
    for name, value in expected.items():
        assert math.isclose(got["x"][name], value, rel_tol=1e-9), name
    assert (got["k"]["sd"], got["k"]["skew"], got["k"]["mad"]) == (0.0, None, 0.0)


def brute_split(rows, seed, share):
    import hashlib

    taken = set()
    for response in {y for _, y in rows}:
        ids = [i for i, y in rows if y == response]
        order = sorted(ids, key=lambda i: (hashlib.md5(f"{i}|{seed}".encode()).hexdigest(), i))
        taken |= set(order[: math.ceil(share * len(ids))])
    return taken


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(n=st.integers(1, 300), every=st.integers(2, 9), seed=st.integers(0, 99))
def test_split_is_exact(spark, n, every, seed):
    rows = [(i, 1 if i % every == 0 else 0) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, Response int").repartition(5)
    marked = splitting.mark_split(df, "Response", "id", OPTIONS.replace(split_seed=seed)).collect()
    assert len(marked) == n
    assert {row["id"] for row in marked if row["split"] == "train"} == brute_split(rows, seed, 0.7)


def test_split_keeps_unlabelled_rows(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 2) for i in range(40)], "id long, Response int")
    marked = splitting.mark_split(df, "Response", "id", OPTIONS)
    assert marked.count() == 40
    assert marked.filter("split = 'train' and Response is null").count() == 7


def test_downsample(spark):
    df = spark.range(20_000).selectExpr("id", "cast(id % 2 as int) as Response")
    assert splitting.downsample(df, OPTIONS) is df
    plain = splitting.downsample(df, OPTIONS.replace(downsample=True)).groupBy("Response").count()
    assert all(800 < row["count"] < 1200 for row in plain.collect())
    layered = splitting.downsample(df, OPTIONS.replace(downsample=True, stratified_downsample=True))
    got = keyed(layered.groupBy("Response").count(), "Response")
    assert got[1]["count"] == 10_000 and 800 < got[0]["count"] < 1200


def test_unseen_categories(spark):
    train = spark.createDataFrame([("a", "x"), ("b", None)], "c string, d string")
    test = spark.createDataFrame([(1, "a", "x"), (2, "z", "x"), (3, None, "x"), (4, "b", None)], "id long, c string, d string")
    kept = levels.keep_seen(test, train, ["c", "d"])
    assert sorted(row["id"] for row in kept.collect()) == [1, 4]
    learnt = levels.learn_levels(train, ["c", "d"])
    assert learnt == {"c": ["a", "b"], "d": ["x", None]}
    assert sorted(row["id"] for row in levels.keep_known(test, learnt).collect()) == [1, 4]
    pairs = {(row["variable"], row["value"]) for row in levels.unseen_values(test, train, ["c", "d"]).collect()}
    assert pairs == {("c", "z"), ("c", None)}


def test_constant_by_cohort(spark):
    df = spark.createDataFrame([("p", 1, "a"), ("p", 1, "b"), ("q", 1, "a"), ("q", None, "a")], "g string, n int, c string")
    got = {(row["cohort"], row["variable"]) for row in levels.constant_by_cohort(df, "g", ["n", "c"]).collect()}
    assert got == {("p", "n"), ("q", "c")}
