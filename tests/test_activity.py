import datetime as dt

from ebbtide import Options
from ebbtide.functions.dates import epoch_date
from ebbtide.operators import activity

from samples import account, accounts, dim, epoch, keyed, messages, packages, usage

OPTIONS = Options()
FIRST = dt.date(2018, 12, 25)


def cohort(spark, *keys, first=FIRST):
    return accounts(spark, *[account(k, first_usage_units=first) for k in keys])


def usage_grid(spark, base, dims, facts, options=OPTIONS):
    span = activity.observed_span(base, options)
    rows = activity.usage_in_window(base, dims, facts, options, span)
    return keyed(activity.grid(rows, options), "account_key"), rows


def test_accounts_without_usage(spark):
    base = cohort(spark, 1, 2, 3)
    dims = dim(spark, (11, "SHOP", 1), (13, "shop", 3))
    facts = usage(
        spark,
        (13, epoch(2018, 12, 26, 5, 0), "voice", 4.0, 1.0),
        (99, epoch(2018, 12, 26, 5, 0), "sms", 4.0, 1.0),
    )
    grid, _ = usage_grid(spark, base, dims, facts)
    assert set(grid) == {1, 3}  # 2 is not in the dimension
    for key in (1, 3):  # no fact row; only rows of another category
        assert [grid[key][f"uu_d{d}"] for d in range(1, 8)] == [0.0] * 7
        assert [grid[key][f"ud_d{d}"] for d in range(1, 8)] == [0.0] * 7


def test_window_and_month_edges(spark):
    base = cohort(spark, 1)
    dims = dim(spark, (11, "shop", 1))
    days = [(12, 24), (12, 25), (12, 31)]
    facts = [(11, epoch(2018, m, d, 23, 59), "SMS", 1.0 + i, 2.0) for i, (m, d) in enumerate(days)]
    facts.append((11, epoch(2019, 1, 1, 0, 0), "mms", 50.0, 2.0))
    facts.append((11, epoch(2018, 12, 25, 0, 0), "mms", 5.0, 2.5))
    grid, rows = usage_grid(spark, base, dims, usage(spark, *facts))
    assert [grid[1][f"uu_d{d}"] for d in range(1, 8)] == [7.0, 0, 0, 0, 0, 0, 3.0]
    assert grid[1]["ud_d1"] == 4.5
    by_day = keyed(activity.by_day(rows), "account_key", "days_after")
    assert set(by_day) == {(1, 0), (1, 6)}


def test_several_dim_keys_add_up(spark):
    base = cohort(spark, 1)
    dims = dim(spark, (11, "shop", 1), (12, "shop", 1), (13, "other", 1))
    facts = usage(spark, *[(k, epoch(2018, 12, 25, 1, 0), "sms", 1.0, 1.0) for k in (11, 12, 13)])
    grid, _ = usage_grid(spark, base, dims, facts)
    assert grid[1]["uu_d1"] == 2.0


def test_epoch_day_by_zone(spark):
    rows = spark.createDataFrame([(epoch(2018, 12, 26, 3, 0),)], "s long")
    got = rows.select(
        epoch_date("s").alias("utc"), epoch_date("s", "America/New_York").alias("ny")
    ).first()
    assert (got["utc"], got["ny"]) == (dt.date(2018, 12, 26), dt.date(2018, 12, 25))


def test_zone_reaches_the_window(spark):
    base = cohort(spark, 1)
    facts = usage(
        spark,
        (11, epoch(2018, 12, 25, 3, 0), "sms", 1.0, 1.0),  # still the 24th in New York
        (11, epoch(2019, 1, 1, 3, 0), "sms", 2.0, 1.0),  # still the 31st there
    )
    options = OPTIONS.replace(time_zone="America/New_York")
    grid, _ = usage_grid(spark, base, dim(spark, (11, "shop", 1)), facts, options)
    assert (grid[1]["uu_d1"], grid[1]["uu_d7"]) == (0.0, 2.0)


def stamp(day, hour=0):
    return dt.datetime(2018, 12, day, hour)


def test_distinct_packages_per_day(spark):
    base = cohort(spark, 1)
    log = packages(
        spark, (1, stamp(25, 1), 7), (1, stamp(25, 9), 7), (1, stamp(25, 9), 8), (1, stamp(31, 23), 7), (2, stamp(25), 7)
    )
    span = activity.observed_span(base, OPTIONS)
    grid = keyed(activity.grid(activity.packages_in_window(base, log, OPTIONS, span), OPTIONS), "account_key")
    assert set(grid) == {1}
    assert [grid[1][f"pkgs_d{d}"] for d in range(1, 8)] == [2, 0, 0, 0, 0, 0, 1]


def test_null_recipients(spark):
    base = cohort(spark, 1, 2)
    sent = messages(
        spark,
        (1, 1, None, "a", 1.0, stamp(25)),
        (2, 2, None, "a", 1.0, stamp(25)),
        (3, 2, 5, "a", 1.0, stamp(26)),
        (None, 2, 5, "a", 1.0, stamp(26)),
    )
    span = activity.observed_span(base, OPTIONS)
    grid = keyed(activity.grid(activity.campaigns_in_window(base, sent, OPTIONS, span), OPTIONS), "account_key")
    assert grid[1]["rpct_d1"] is None and grid[1]["rpct_d2"] == 0
    assert (grid[2]["rpct_d1"], grid[2]["rpct_d2"]) == (0, 10)
    assert (grid[2]["capn_d1"], grid[2]["capn_d2"]) == (1, 1)  # a NULL id is not a campaign


def test_empty_cohort(spark):
    base = cohort(spark, 1).filter("false")
    assert activity.observed_span(base, OPTIONS) is None
    log = packages(spark, (1, stamp(25), 7))
    assert activity.grid(activity.packages_in_window(base, log, OPTIONS, None), OPTIONS).count() == 0


def test_longer_observation(spark):
    options = OPTIONS.replace(obs_days=14)
    base = cohort(spark, 1)
    facts = usage(spark, (11, epoch(2019, 1, 7, 1, 0), "sms", 3.0, 1.0))
    grid, _ = usage_grid(spark, base, dim(spark, (11, "shop", 1)), facts, options)
    assert grid[1]["uu_d14"] == 3.0 and "uu_d15" not in grid[1]


def test_fact_scan_is_bounded(spark, tmp_path):
    """The span reaches the Parquet reader as a pushed filter on the raw column."""
    path = str(tmp_path / "fact")
    usage(spark, (11, epoch(2018, 12, 25, 1, 0), "sms", 3.0, 1.0)).write.parquet(path)
    base = cohort(spark, 1)
    span = activity.observed_span(base, OPTIONS)
    rows = activity.usage_in_window(base, dim(spark, (11, "shop", 1)), spark.read.parquet(path), OPTIONS, span)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThanOrEqual(processdate_est_key,{epoch(2018, 12, 25, 0, 0)})" in plan
    assert f"LessThan(processdate_est_key,{epoch(2019, 1, 1, 0, 0)})" in plan
