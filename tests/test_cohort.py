import datetime as dt

import pytest
from pyspark.sql import functions as F

from ebbtide import Options
from ebbtide.operators import cohort

from samples import account, accounts, keyed, profiles

OPTIONS = Options(excluded_sites=("cold", "Frost"), excluded_email_terms=("internal.test", "partner"))


def ids(df):
    return sorted(row["account_id"] for row in df.collect())


def test_null_and_excluded_emails_drop(spark):
    rows = accounts(
        spark,
        account(1, email=None),
        account(2, email="a@internal.test"),
        account(3, email="A@PARTNER.x"),
        account(4, email="ok@x.y"),
    )
    assert ids(cohort.exclude_accounts(rows, OPTIONS)) == [4]


def test_null_and_excluded_sites_drop(spark):
    rows = accounts(
        spark, account(1, site=None), account(2, site="cold"), account(3, site="FROST"), account(4, site="ez")
    )
    assert ids(cohort.exclude_accounts(rows, OPTIONS)) == [4]


def test_nothing_excluded_keeps_all(spark):
    rows = accounts(spark, account(1, site=None), account(2, email=None))
    assert ids(cohort.exclude_accounts(rows, Options())) == [1, 2]


def test_projection_flags_and_distinct(spark):
    row = account(1, phone=None, email="plain", start_date=dt.date(2018, 5, 3))
    rows = accounts(spark, row, row, account(2, phone="1", email="a@b"))
    users = profiles(spark, (1, "Alerts"), (1, "Alerts"), (9, "x"))
    got = keyed(cohort.select_cohort(rows, users, OPTIONS), "account_key")
    assert len(got[1]) == 38
    assert cohort.select_cohort(rows, users, OPTIONS).count() == 2
    assert (got[1]["phone_f"], got[1]["email_f"], got[1]["usage"], got[1]["start_month"]) == (0, 0, "Alerts", 5)
    assert (got[2]["phone_f"], got[2]["email_f"], got[2]["usage"]) == (1, 1, None)
    assert got[1]["first_usage_units_month"] == 6


def test_scoring_window_is_inclusive(spark):
    newest = dt.date(2019, 1, 6)
    days = [newest, dt.date(2018, 12, 2), dt.date(2018, 12, 1), dt.date(2018, 12, 30), dt.date(2018, 12, 31)]
    rows = accounts(spark, *[account(i, first_usage_units=d) for i, d in enumerate(days)])
    anchor = cohort.read_anchor(rows)
    assert anchor == newest
    window = cohort.scoring_window(OPTIONS, anchor)
    assert window == (dt.date(2018, 12, 2), dt.date(2018, 12, 30))
    assert ids(cohort.select_cohort(rows, profiles(spark), OPTIONS, window)) == [1, 3]


@pytest.mark.parametrize(
    "last, days_90, same_day",
    [(0, 1, 1), (90, 1, 0), (91, 0, 0), (None, 0, 0)],
)
def test_churn_edges(spark, last, days_90, same_day):
    first = dt.date(2018, 1, 1)
    end = None if last is None else first + dt.timedelta(days=last)
    rows = accounts(spark, account(1, first_usage_units=first, last_usage_units=end))
    filled = cohort.fill_last_usage(rows, dt.date(2019, 1, 1))
    got = cohort.label_churn(filled, OPTIONS).first()
    assert (got["churn_90d"], got["churn_1d"]) == (days_90, same_day)


def test_label_needs_first_usage(spark):
    rows = accounts(spark, account(1, first_usage_units=None))
    filled = cohort.fill_last_usage(rows, dt.date(2019, 1, 1))
    got = cohort.label_churn(filled, OPTIONS).first()
    assert (got["last_usage_units"], got["churn_90d"], got["churn_1d"]) == (None, None, None)


def test_role_edges(spark):
    today = dt.date(2019, 1, 31)
    days = {
        1: dt.date(2018, 10, 31),  # three months before: not yet mature
        2: dt.date(2018, 10, 30),
        3: today - dt.timedelta(weeks=5),
        4: today - dt.timedelta(weeks=1),
        5: today,
    }
    rows = accounts(spark, *[account(k, first_usage_units=d, last_usage_units=d) for k, d in days.items()])
    roles = keyed(cohort.assign_role(cohort.label_churn(rows, OPTIONS), today, OPTIONS), "account_key")
    assert [roles[k]["md_sc_f"] for k in days] == ["na", "md", "sc", "sc", "na"]


def test_delete_keeps_null(spark):
    rows = accounts(
        spark,
        account(1, first_usage_units=None),
        account(2, first_usage_units=dt.date(2016, 12, 31)),
        account(3, first_usage_units=dt.date(2017, 1, 1)),
    ).withColumn("md_sc_f", F.lit("md"))
    assert ids(cohort.keep_modelled(rows, OPTIONS)) == [1, 3]
    assert ids(cohort.keep_modelled(rows, OPTIONS.replace(earliest_first_usage=None))) == [1, 2, 3]


def test_optional_start_date_filter(spark):
    rows = accounts(
        spark, account(1, start_date=None), account(2, start_date=dt.date(2015, 1, 1)), account(3, start_date=dt.date(2016, 1, 1))
    )
    assert ids(cohort.drop_early_starts(rows, OPTIONS)) == [1, 2, 3]
    assert ids(cohort.drop_early_starts(rows, OPTIONS.replace(earliest_start=dt.date(2016, 1, 1)))) == [1, 3]


def test_empty_labels_are_typed(spark):
    typed = dict(cohort.empty_labels(accounts(spark, account(1))).dtypes)
    assert typed["churn_90d"] == "int" and typed["churn_1d"] == "int"
