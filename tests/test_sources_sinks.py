"""Line breaks in large files, two writers of one score table, exact medians, losses while scoring."""

import datetime as dt
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ebbtide.operators import levels, ranking
from ebbtide.sources import readers, sinks

from samples import keyed

CSV = "X string, user_id long, message string, credits double"


def write_csv(folder, files, rows_each, seed=1):
    rng = random.Random(seed)
    pieces = ["plain", 'say ""hi""', "line\nbreak", "two\n\nbreaks", "a, comma", '""\n""', "\n", "NA", "", "ünï 語", "x" * 300]
    for f in range(files):
        lines = ['"X","user_id","message","credits"']
        for k in range(rows_each):
            text = "".join(rng.choice(pieces) + " z" for _ in range(rng.randrange(4)))
            lines.append(f'"{k}",{f * 10_000 + k},' + rng.choice([f'"{text}"', "NA", "bare"]) + "," + rng.choice(["NA", "2.5", "7"]))
        (folder / f"part{f}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_csv_with_breaks_in_many_tasks(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    write_csv(folder, 3, 900)
    want = keyed(readers.read_csv(spark, str(folder), CSV), "user_id")
    assert len(want) == 2700
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1000", "4001", "70000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = readers.read_quoted_csv(spark, str(folder), CSV)
            assert got.columns == ["user_id", "message", "credits"]
            assert keyed(got, "user_id") == want
            assert spark.read.text(str(folder)).rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    (tmp_path / "one.csv").write_text('X,user_id,message,credits\r\n1,7,"a\r\nb",NA\r\n')
    assert [tuple(r) for r in readers.read_quoted_csv(spark, str(tmp_path / "one.csv"), CSV).collect()] == [(7, "a\r\nb", None)]
    (tmp_path / "none.csv").write_text("X,user_id,message,credits\n")
    assert readers.read_quoted_csv(spark, str(tmp_path / "none.csv"), CSV).count() == 0


def scores(spark, accounts, score, day=1):
    rows = [(a, dt.date(2019, 1, 1), score, dt.date(2019, 2, day)) for a in accounts]
    return spark.createDataFrame(rows, "account_id long, first_usage_units date, churn_90d_score double, efft_d date")


def test_two_writers_leave_one_row_per_account(spark, tmp_path):
    path = str(tmp_path / "scores")
    assert sinks.published_scores(spark, path).count() == 0
    turns = []

    def other():  # comes in between the first writer's check and its commit
        if not turns:
            turns.append(1)
            sinks.publish_scores(scores(spark, range(5, 15), 0.9, 2), path)

    table = keyed(sinks.publish_scores(scores(spark, range(10), 0.1), path, pause=other), "account_id")
    assert sorted(table) == list(range(15))
    assert all(table[a]["churn_90d_score"] == (0.9 if a >= 5 else 0.1) for a in table)
    assert sinks.published_scores(spark, path).count() == 15
    again = sinks.publish_scores(scores(spark, range(20), 0.5, 3), path)
    assert again.count() == 20 and again.filter("churn_90d_score = 0.5").count() == 5


def test_a_job_that_dies_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "scores")

    def die():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        sinks.publish_scores(scores(spark, range(4), 0.1), path, pause=die)
    assert sinks.published_scores(spark, path).count() == 0
    assert sinks.publish_scores(scores(spark, range(4), 0.2), path).count() == 4
    with pytest.raises(sinks.DuplicateKeys):
        sinks.publish_scores(scores(spark, [1, 1], 0.2), path)
    with pytest.raises(RuntimeError, match="other writers"):
        sinks.publish_scores(scores(spark, [99], 0.2), path, attempts=0)


def test_exact_medians(spark):
    big, wide = 2**60, 10**30
    rows = [(big + 1, wide + 3, 4), (big + 2, wide + 1, None), (big + 4, wide + 2, 5), (big + 9, None, 7), (-big, None, 1)]
    df = spark.createDataFrame([(a, None if w is None else __import__("decimal").Decimal(w), c) for a, w, c in rows], "a long, w decimal(38,0), c int")
    got = {r["variable"]: str(r["median"]) for r in ranking.exact_medians(df, ["a", "w", "c"]).collect()}
    assert got == {"a": f"{big + 2}.0", "w": f"{wide + 2}.0", "c": "4.5"}
    low = {r["variable"]: str(r["median"]) for r in ranking.exact_medians(spark.createDataFrame([(-4, ), (-1, )], "x int"), ["x"]).collect()}
    assert low == {"x": "-2.5"}
    with pytest.raises(ValueError, match="not a whole number"):
        ranking.exact_medians(spark.createDataFrame([(1.5,)], "d double"), ["d"])


def test_losses_are_counted_on_the_way(spark):
    rows = [("a", "x"), ("b", "x"), ("zz", "x"), (None, "y"), ("a", None), ("zz", "q")]
    df = spark.createDataFrame(rows, "kind string, era string")
    known = {"kind": ["a", "b", None], "era": ["x", "y"]}
    seen = Observation()
    kept = levels.keep_known(df, known, seen)
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(kept.collect(), key=repr) == sorted(levels.keep_known(df, known).collect(), key=repr)
    report = {r["variable"]: r["rows"] for r in levels.loss_report(seen, spark).collect()}
    assert report == {"kind": 2, "era": 2, None: 3}
    empty = Observation()
    assert levels.keep_known(df, {}, empty).count() == 6
    assert {r["variable"]: r["rows"] for r in levels.loss_report(empty, spark).collect()} == {None: 0}
    assert levels.keep_known(df, {"kind": []}).count() == 0
    assert df.filter(F.col("kind").isNull()).count() == 1
