import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ebbtide import Inputs, Options, scoring_frame, training_frame
from ebbtide.operators import activity, names
from ebbtide.operators import messages as message_ops
from ebbtide.sources import sinks

from samples import account, accounts, dim, epoch, keyed, messages, packages, profiles, usage

OPTIONS = Options()
FIRST = dt.date(2018, 6, 1)


def inputs(spark, *rows):
    return Inputs(
        accounts=accounts(spark, *rows),
        profiles=profiles(spark, (7, "Alerts")),
        account_dim=dim(spark, (21, "shop", 7), (22, "shop", 8)),
        usage_fact=usage(spark, (21, epoch(2018, 6, 2, 1, 0), "SMS", 3.0, 0.5)),
        package_log=packages(spark, (7, dt.datetime(2018, 6, 1, 4), 1)),
        messages=messages(
            spark,
            (1, 7, 4, "Sale! call", 2.0, dt.datetime(2018, 6, 3, 4)),
            (2, 7, 4, "Sale! call", 2.0, dt.datetime(2018, 6, 3, 4)),
        ),
    )


def test_training_frame(spark):
    source = inputs(
        spark,
        account(1, account_id=7, industry=None, last_usage_units=FIRST),
        account(2, account_id=7, industry="Food", last_usage_units=None),
        account(3, account_id=8, last_usage_units=FIRST),
        account(4, account_id=9, last_usage_units=FIRST),
        account(5, account_id=9, first_usage_units=None),
    )
    got = keyed(training_frame(source, dt.date(2019, 1, 1), OPTIONS), "account_key")
    assert set(got) == {1, 2, 3, 4}
    assert len(got[1]) == 38 + 3 + 35 + 27
    assert (got[1]["industry"], got[2]["industry"]) == ("NA", "Food")
    for key in (1, 2):  # both keys of account 7
        row = got[key]
        assert (row["uu_d2"], row["pkgs_d1"], row["rpct_d3"], row["capn_d3"]) == (3.0, 1, 8, 2)
        assert (row["tm_sale"], row["tm_call"], row["tm_vote"]) == (2.0, 2.0, 0.0)
    assert (got[1]["churn_90d"], got[2]["churn_90d"], got[2]["last_usage_units"]) == (1, 0, dt.date(2019, 1, 1))
    assert (got[3]["uu_d1"], got[3]["pkgs_d1"], got[3]["tm_sale"]) == (0.0, None, None)  # dim only
    assert (got[4]["uu_d1"], got[4]["capn_d1"]) == (None, None)  # in no table


def test_scoring_frame(spark):
    newest = FIRST + dt.timedelta(weeks=2)
    source = inputs(spark, account(1, account_id=7), account(2, account_id=8, first_usage_units=newest))
    got = keyed(scoring_frame(source, OPTIONS), "account_key")
    assert set(got) == {1}
    assert got[1]["churn_90d"] is None and got[1]["uu_d2"] == 3.0 and "md_sc_f" not in got[1]


def test_repeated_account_key_is_refused(spark):
    source = inputs(spark, account(1, account_id=7), account(1, account_id=8))
    with pytest.raises(sinks.DuplicateKeys):
        training_frame(source, dt.date(2019, 1, 1), OPTIONS)


def test_a_hot_account(spark):
    """A third of all rows under one account, copies included, against plain sums."""
    n = 6000
    facts = [
        (21 if i % 3 == 0 else 22, epoch(2018, 6, 1 + i % 9, 1, 0), "sms" if i % 2 else "MMS", 1.0, 0.5) for i in range(n)
    ]
    sent = [
        (i, 7 if i % 3 == 0 else 8, 2, "call" if i % 5 else "vote", 1.0, dt.datetime(2018, 6, 1 + i % 9, i % 4))
        for i in range(n)
    ]
    source = inputs(spark, account(1, account_id=7, last_usage_units=FIRST), account(2, account_id=8, last_usage_units=FIRST))
    source = dataclasses.replace(source, usage_fact=usage(spark, *facts), messages=messages(spark, *sent))
    got = keyed(training_frame(source, dt.date(2019, 1, 1), OPTIONS), "account_key")
    for key, fact_key, user in ((1, 21, 7), (2, 22, 8)):
        for day in range(7):
            mine = [f for f in facts if f[0] == fact_key and f[1] == epoch(2018, 6, 1 + day, 1, 0)]
            assert got[key][f"uu_d{day + 1}"] == float(len(mine))
            posts = [m for m in sent if m[1] == user and m[5].day == 1 + day]
            assert (got[key][f"capn_d{day + 1}"], got[key][f"rpct_d{day + 1}"]) == (len(posts), 2 * len(posts))
        unique = {m[3:] for m in sent if m[1] == user and m[5].day <= 7}
        assert got[key]["tm_call"] == float(sum(m[0] == "call" for m in unique))
        assert got[key]["tm_vote"] == float(sum(m[0] == "vote" for m in unique))


def test_name_words(spark):
    rows = [(1, "Joe's Pizza, Inc. 24"), (2, None), (3, ""), (4, "NA"), (5, "The Pizza pizza")]
    df = spark.createDataFrame(rows, "account_id long, company_name string")
    got = sorted((r["account_id"], r["word"]) for r in names.name_words(df).collect())
    assert got == [
        (1, "inc"), (1, "joe's"), (1, "pizza"), (2, "namemissing"), (3, "namemissing"), (4, "namemissing"),
        (5, "pizza"), (5, "pizza"), (5, "the"),
    ]
    stops = spark.createDataFrame([("the",), ("inc",)], "word string")
    scores = spark.createDataFrame([("pizza", 0.7)], "word string, score double")
    scored = names.score_words(names.name_words(df), stops, scores).collect()
    assert len(scored) == 7
    assert {(r["word"], r["score"]) for r in scored} == {("pizza", 0.7), ("joe's", None), ("namemissing", None)}


def test_facts_are_reduced_before_they_are_searched_and_summed(spark):
    """A small cohort is sent to the scans; a larger one, or the rule switched off, gives the same frame."""
    source = inputs(spark, account(1, account_id=7, last_usage_units=FIRST), account(2, account_id=8, last_usage_units=FIRST))
    small = training_frame(source, dt.date(2019, 1, 1), OPTIONS)
    large = training_frame(source, dt.date(2019, 1, 1), OPTIONS.replace(broadcast_accounts=0))
    assert keyed(small, "account_key") == keyed(large, "account_key")
    first = source.accounts.select(F.lit(7).cast("long").alias("member"), F.lit(FIRST).alias("first"))
    sent = activity.of_members(source.messages, "user_id", F.to_date("stamp_to_send"), first, OPTIONS)
    plan = message_ops.message_days(sent)._jdf.queryExecution().optimizedPlan().toString()
    semi, digest = plan.index("LeftSemi"), plan.index("sha2")
    assert digest < semi  # the plan is printed from the top: texts are hashed and searched above the join
