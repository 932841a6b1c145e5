import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide import Options, load_project, prepare, save_project, score_accounts, score_output, train
from ebbtide.operators import components, evaluation as ev, forest, information
from ebbtide.plans import scoring, training
from ebbtide.sources import readers, sinks

from samples import keyed

OPTIONS = Options(
    non_predictive=("account_key",),
    forest_learner="mllib",
    forest_trees=(10, 8),
    top_variables=3,
    scope_variables=4,
    forest_sample_share=0.5,
    out_of_fold=2,
    boost_iterations=3,
)


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(11)
    rows = []
    for i in range(900):
        role = "sc" if i % 9 == 0 else "md"
        strong = rng.gauss(0, 1)
        kind = rng.choice("abc")
        churn = int(strong + (kind == "a") + rng.gauss(0, 0.7) > 0.5)
        rows.append(
            (
                i, i + 5000, dt.date(2018, 1, 1) + dt.timedelta(days=i % 90),
                churn if role == "md" else None,
                None if rng.random() < 0.1 else strong,
                rng.random(),
                None if rng.random() < 0.8 else 1.0,
                4.0,
                kind if rng.random() > 0.02 else None,
                f"city{i}",
                "new" if role == "sc" and i % 2 else "old",
                role,
            )
        )
    return spark.createDataFrame(
        rows,
        "account_id long, account_key long, first_usage_units date, churn_90d int, strong double, noise double, "
        "sparse double, fixed double, kind string, city string, era string, md_sc_f string",
    )


@pytest.fixture(scope="module")
def trained(frame):
    return train(frame, OPTIONS)


def test_preparation(frame):
    sets = prepare(frame, OPTIONS)
    assert sets.numeric[0] == "strong" and "sparse" not in sets.kept_numeric and "fixed" not in sets.kept_numeric
    assert sets.categorical == ["kind"]
    roles = keyed(sets.roles, "variable")
    assert (roles["city"]["type"], roles["era"]["type"], roles["md_sc_f"]["type"]) == ("np", "np", "np")
    assert sets.train.count() + sets.test.count() == 800
    assert sets.train.filter("strong is null").count() == 0
    assert sets.score.count() == 100 and sets.score.filter("Response is not null").count() == 0
    assert set(sets.train.columns) == set(sets.test.columns) == set(sets.score.columns)


def test_information_value_of_imputed_rows(spark, frame):
    """IV from the counts behind the medians equals IV of the cleaned training rows."""
    sets = prepare(frame, OPTIONS.replace(iv_floor=-1.0))
    bins = information.binned(sets.train, sets.numeric, sets.categorical, "Response", 10)
    direct = keyed(information.information_values(information.woe_table(bins)), "variable")
    assert set(direct) == {"strong", "noise", "kind"}
    for name, row in keyed(sets.iv, "variable").items():
        assert abs(row["iv"] - direct[name]["iv"]) < 1e-12


def test_sketches_agree_on_small_data(frame):
    exact = prepare(frame, OPTIONS.replace(iv_floor=-1.0))
    rough = prepare(frame, OPTIONS.replace(iv_floor=-1.0, exact_quantiles=False))
    assert abs(exact.medians["noise"] - rough.medians["noise"]) < 0.01
    left, right = keyed(exact.iv, "variable"), keyed(rough.iv, "variable")
    assert set(left) == set(right)
    assert abs(left["noise"]["iv"] - right["noise"]["iv"]) < 1e-9
    assert abs(left["kind"]["iv"] - right["kind"]["iv"]) < 1e-12


def test_downsampled_preparation(frame):
    sets = prepare(frame, OPTIONS.replace(downsample=True, downsample_share=0.5))
    assert 0 < sets.train.count() < 450 and sets.iv.count() == 3


def test_learning_and_calibration(trained):
    model = trained.model
    assert "strong" in model.top and len(model.top) <= 3
    table = ev.ranked_scores(trained.tested, training.CALIBRATED, "Response")
    assert ev.gini(table).first()["gini"] > 0.5
    raw = ev.ranked_scores(trained.tested, forest.RAW, "Response")
    assert ev.gini(raw).first()["gini"] == ev.gini(table).first()["gini"]  # calibration keeps the order
    row = trained.tested.agg(F.avg("Response"), F.avg(training.CALIBRATED)).first()
    assert abs(row[0] - row[1]) < 0.01


def test_importance(spark, trained):
    sets, model = trained.prepared, trained.model
    accuracy = forest.accuracy_importance(sets.test, model.forest, "Response", "account_id", OPTIONS, slices=4)
    rows = keyed(forest.importance_table(forest.gini_importance(model.forest, spark), accuracy), "variable")
    assert set(rows) == set(model.top)
    assert max(rows.values(), key=lambda r: r["mean_decrease_accuracy"])["variable"] == "strong"
    assert abs(sum(r["mean_decrease_gini"] for r in rows.values()) - 1) < 1e-9


def test_permutation_moves_values_only(spark, trained):
    """Without a shuffle of meaning (one distinct value) a variable's importance is 0."""
    sets = trained.prepared
    flat = sets.test.withColumn("strong", F.lit(0.0))
    got = keyed(
        forest.accuracy_importance(flat, trained.model.forest, "Response", "account_id", OPTIONS, slices=3), "variable"
    )
    assert got["strong"]["mean_decrease_accuracy"] == 0.0


def test_out_of_fold(trained):
    sets = trained.prepared
    numeric, categorical = forest.split_kinds(trained.model.top, sets.categorical)
    scored = forest.out_of_fold_scores(sets.train, numeric, categorical, "Response", "account_id", 5, OPTIONS)
    assert scored.count() == sets.train.count() == scored.select("account_id").distinct().count()
    assert ev.gini(ev.ranked_scores(scored, forest.RAW, "Response")).first()["gini"] > 0.4


def test_boosted_challenger(trained):
    sets = trained.prepared
    model = forest.fit_boosted(sets.train, sets.numeric, sets.categorical, "Response", OPTIONS)
    scored = forest.add_scores(sets.test, model, "boosted")
    assert ev.gini(ev.ranked_scores(scored, "boosted", "Response")).first()["gini"] > 0.5


def test_calibration_holdout(frame, trained):
    held = train(frame, OPTIONS.replace(calibration_holdout=True), trained.prepared)
    assert 0 < held.tested.count() < trained.tested.count()


def test_one_class_is_refused(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0)], "Response int, x double")
    with pytest.raises(ValueError, match="both response classes"):
        forest.fit_forest(df, ["x"], [], "Response", 2, OPTIONS)


def test_scoring_and_roundtrip(spark, frame, trained, tmp_path):
    rows = frame.filter("md_sc_f = 'sc'").drop("churn_90d", "md_sc_f")
    first = score_accounts(rows, trained.model)
    assert first.columns == ["account_id", *trained.model.scope, forest.RAW, training.CALIBRATED]
    assert first.count() == rows.count()
    save_project(trained.model, str(tmp_path / "p"), spark)
    again = load_project(spark, str(tmp_path / "p"))
    assert again.options == trained.model.options
    assert (again.medians, again.levels, again.top) == (trained.model.medians, trained.model.levels, trained.model.top)
    assert keyed(score_accounts(rows, again), "account_id") == keyed(first, "account_id")
    assert again.tables["iv"].count() == trained.model.tables["iv"].count()


def test_unseen_level_is_not_scored(frame, trained):
    rows = frame.filter("md_sc_f = 'sc'").withColumn("kind", F.when(F.col("account_id") == 9, "zzz").otherwise(F.col("kind")))
    scored = score_accounts(rows, trained.model)
    assert scored.filter("account_id = 9").count() == 0 and scored.count() == rows.count() - 1


def test_scoring_needs_no_shuffle(frame, trained):
    rows = frame.filter("md_sc_f = 'sc'")
    for out in (
        score_accounts(rows, trained.model),
        score_output(rows, trained.model, dt.date(2019, 2, 1)),
        scoring.cohort_export(rows, trained.model),
    ):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_evaluation_is_part_of_the_project(spark, trained, tmp_path):
    done = training.evaluated(trained)
    save_project(done.model, str(tmp_path / "project"), spark)
    tables = load_project(spark, str(tmp_path / "project")).tables
    ginis = {r["rows"]: r["gini"] for r in tables["gini"].collect()}
    direct = ev.gini(ev.ranked_scores(trained.tested, training.CALIBRATED, "Response")).first()["gini"]
    assert ginis["test"] == pytest.approx(direct) and 0 < ginis["train_out_of_fold"] < 1
    tested = trained.tested.count()
    for name in ("deciles", "reliability", "bins_test"):
        assert tables[name].agg(F.sum("n")).first()[0] == tested
    assert tables["bins_train"].agg(F.sum("n")).first()[0] == trained.prepared.train.count()
    assert {r["variable"] for r in tables["accuracy"].collect()} == {r["variable"] for r in tables["importance"].collect()}
    assert tables["sweep"].count() == 31 and tables["ks"].count() == 1


def test_guards(frame, trained):
    with pytest.raises(ValueError, match="has no rows"):
        prepare(frame.filter("md_sc_f = 'sc'"), OPTIONS)
    with pytest.raises(ValueError, match="lacks columns"):
        score_accounts(frame.drop("account_id"), trained.model)
    with pytest.raises(ValueError, match="md_sc_f"):
        prepare(frame.drop("md_sc_f"), OPTIONS)


def test_output_and_first_score_stays(spark, frame, trained, tmp_path):
    rows = frame.filter("md_sc_f = 'sc'")
    day = dt.date(2019, 2, 1)
    out = score_output(rows, trained.model, day)
    scored = keyed(score_accounts(rows, trained.model), "account_id")
    source = keyed(rows, "account_id")
    for key, row in keyed(out, "account_id").items():
        assert row["first_usage_units"] == source[key]["first_usage_units"]
        assert row["churn_90d_score"] == scored[key][training.CALIBRATED]
    assert out.columns == ["account_id", "first_usage_units", "churn_90d_score", "efft_d"]
    path = str(tmp_path / "scores")
    sinks.append_scores_path(out.filter("account_id < 450"), path)
    later = out.withColumn("churn_90d_score", F.lit(-1.0)).withColumn("efft_d", F.lit(dt.date(2019, 2, 2)))
    table = keyed(sinks.append_scores_path(later, path), "account_id")
    assert len(table) == rows.count()
    assert all((r["churn_90d_score"] == -1.0) == (k >= 450) for k, r in table.items())
    assert all(r["efft_d"] == (dt.date(2019, 2, 2) if k >= 450 else day) for k, r in table.items())


def test_catalogue_table(spark, frame, trained):
    rows = frame.filter("md_sc_f = 'sc'")
    out = score_output(rows, trained.model, dt.date(2019, 2, 1))
    sinks.create_score_table(spark, "scores_first")
    sinks.create_score_table(spark, "scores_first")
    assert spark.table("scores_first").count() == 0
    sinks.append_scores(out, "scores_first")
    assert sinks.append_scores(out, "scores_first").count() == rows.count()
    assert dict(spark.table("scores_first").dtypes) == {
        "account_id": "bigint", "first_usage_units": "date", "churn_90d_score": "double", "efft_d": "date",
    }


def test_repeated_account_refuses_the_write(spark, frame, trained, tmp_path):
    rows = frame.filter("md_sc_f = 'sc'")
    out = score_output(rows, trained.model, dt.date(2019, 2, 1))
    path = str(tmp_path / "none")
    with pytest.raises(sinks.DuplicateKeys):
        sinks.append_scores_path(out.unionByName(out.limit(1)), path)
    assert not (tmp_path / "none").exists()
    with pytest.raises(sinks.DuplicateKeys):
        sinks.assert_unique(spark.createDataFrame([(None,)], "k int"), ["k"])


def test_export_and_csv(spark, frame, trained, tmp_path):
    rows = frame.filter("md_sc_f = 'sc'")
    out = scoring.cohort_export(rows, trained.model)
    path = str(tmp_path / "csv")
    sinks.export_csv(out, path)
    schema = ", ".join(f"{n} {t}" for n, t in out.dtypes)
    assert keyed(readers.read_csv(spark, path, schema, None), "account_id") == keyed(out, "account_id")


def test_csv_source(spark, tmp_path):
    (tmp_path / "om.csv").write_text('"X","user_id","message","credits"\n"1",7,"a, ""b""\nc",NA\n"2",8,NA,2.5\n')
    got = readers.read_csv(spark, str(tmp_path / "om.csv"), "X string, user_id long, message string, credits double")
    assert [tuple(r) for r in got.orderBy("user_id").collect()] == [(7, 'a, "b"\nc', None), (8, None, 2.5)]


def test_sources(spark, frame, tmp_path):
    frame.write.orc(str(tmp_path / "orc"))
    assert readers.load_source(spark, str(tmp_path / "orc"), "orc").count() == 900
    frame.createOrReplaceTempView("frame_view")
    assert readers.load_source(spark, "frame_view", "table").count() == 900
    both = readers.append_rows(frame.filter("md_sc_f = 'md'"), frame.filter("md_sc_f = 'sc'").select(*reversed(frame.columns)))
    assert both.count() == 900
    assert [r["account_id"] for r in readers.preview(frame, 2, "account_id").collect()] == [0, 1]


def test_options_roundtrip():
    changed = OPTIONS.replace(earliest_start=dt.date(2016, 1, 1), excluded_sites=("a",))
    assert Options.from_json(changed.to_json()) == changed


def test_components_match_svd(spark):
    rng = np.random.default_rng(3)
    n = 400
    a = rng.normal(size=n)
    b = a * 0.8 + rng.normal(size=n)
    c = rng.normal(size=n)
    kind = rng.choice(["x", "y", "z"], size=n, p=[0.5, 0.3, 0.2])
    df = spark.createDataFrame(
        [(i, float(a[i]), float(b[i]), float(c[i]), 1.0, str(kind[i])) for i in range(n)],
        "id long, a double, b double, c double, k double, kind string",
    )
    parts = components.fit_components(df, ["a", "b", "c", "k"], ["kind"], 95)
    columns = [(v - v.mean()) / v.std() for v in (a, b, c)]
    for level in "xyz":
        share = (kind == level).mean()
        columns.append(((kind == level) - share) / np.sqrt(share))
    z = np.column_stack(columns)
    values = np.sort(np.linalg.eigvalsh(z.T @ z / n))[::-1]
    expected = np.cumsum(values) / values.sum() * 100
    assert np.allclose(parts.cumulative, expected, atol=1e-6)
    assert parts.count == int(np.argmax(expected >= 95)) + 1
    rotated = components.rotate(df, parts, ["id"])
    assert rotated.columns == ["id"] + [f"dim{i + 1}" for i in range(parts.count)]
    spread = rotated.agg(F.var_pop("dim1")).first()[0]
    assert abs(spread - values[0]) < 1e-6
    curve = components.variance_curve(parts, spark).orderBy("dimension").collect()
    assert abs(curve[-1]["cumulative_percent"] - 100) < 1e-6
