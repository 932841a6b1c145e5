"""First-days activity: usage, packages and campaigns per account and day.

Facts are reduced before they are summed: a cohort of at most ``broadcast_accounts`` accounts is
sent to the scans, which keep its members' window days only; messages, whose texts are searched, are reduced to
them for a larger cohort too, by a join. Then, and for a larger cohort's other facts at once, a fact table is summed to one row per account and calendar day, with map-side partial sums, and
only then joined to the cohort. A day's place in the window depends on the account alone, so the
sums are the same either way, and an account holding a third of the fact table brings at most one row
per day to the join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_number, epoch_date
from ..functions.text import in_list
from ..options import Options


Span = tuple[dt.date, dt.date]


def observed_span(cohort: DataFrame, options: Options) -> Span | None:
    """First and last calendar day any account of the cohort is observed on (one row read).

    The fact scans are bounded by it, as constants that reach partitions and Parquet
    statistics. None for a cohort without first-usage dates.
    """
    row = cohort.agg(
        F.min("first_usage_units").alias("low"), F.max("first_usage_units").alias("high")
    ).first()
    if row["low"] is None:
        return None
    return row["low"], row["high"] + dt.timedelta(days=options.obs_days - 1)


def stamp_bounds(column: str, span: Span | None) -> Column:
    """Rows of a timestamp column inside the span; dates compare as midnights in either type."""
    if span is None:
        return F.lit(False)
    beyond = span[1] + dt.timedelta(days=1)
    return (F.col(column) >= F.lit(span[0])) & (F.col(column) < F.lit(beyond))


def epoch_bounds(column: str, span: Span | None, time_zone: str) -> Column:
    """The same for epoch seconds. Zones other than UTC get a day of slack on both sides; the
    exact window test follows in the join."""
    if span is None:
        return F.lit(False)
    slack = dt.timedelta(days=0 if time_zone == "UTC" else 1)
    low = day_number(span[0] - slack) * 86400
    high = day_number(span[1] + slack + dt.timedelta(days=1)) * 86400
    return (F.col(column) >= F.lit(low)) & (F.col(column) < F.lit(high))


def of_members(
    facts: DataFrame, key: str, day: Column, windows: DataFrame | None, options: Options, send: bool = True
) -> DataFrame:
    """Facts inside the window of their account. ``windows``: (member, first), few enough to be broadcast.

    None leaves the facts as they are: the join after the daily sums decides alone. Without ``send`` windows of
    any number are joined by key.
    """
    if windows is None:
        return facts
    sides = windows.select(F.col("member").alias("_member"), F.col("first").alias("_first")).distinct()
    # names of their own: a name of the facts could be one that lies below the windows
    named = facts.withColumns({"_fact_key": F.col(key), "_fact_day": day})
    key, day, first = F.col("_fact_key").outer(), F.col("_fact_day").outer(), F.col("_first")
    inside = (key == F.col("_member")) & (day >= first) & (day <= F.date_add(first, options.obs_days - 1))
    found = (F.broadcast(sides) if send else sides).where(inside)
    # as a predicate it goes below the joins that the facts are made by; a semi join stays above them
    return named.where(found.exists()).drop("_fact_key", "_fact_day")


def messages_of_members(messages: DataFrame, cohort: DataFrame, options: Options, members: int | None) -> DataFrame:
    """Messages of the cohort's first days, whatever its size: a text is long to search.

    A larger cohort than is broadcast joins by key, before texts are looked up where they are in a table of their own.
    """
    windows = cohort.select(F.col("account_id").alias("member"), F.col("first_usage_units").alias("first"))
    send = members is not None and members <= options.broadcast_accounts
    return of_members(messages, "user_id", F.to_date("stamp_to_send"), windows, options, send)


def member_windows(cohort: DataFrame, key: str, options: Options, members: int | None) -> DataFrame | None:
    """The cohort's (member, first day), or None if it has more rows than are broadcast. ``members``: its counted rows."""
    if members is None or members > options.broadcast_accounts:
        return None
    return cohort.select(F.col(key).alias("member"), F.col("first_usage_units").alias("first"))


def usage_days(
    usage_fact: DataFrame, options: Options, bounds: Column | None = None, windows: DataFrame | None = None
) -> DataFrame:
    """Usage units and dollars per fact key and day, for the wanted categories only."""
    rows = usage_fact.filter(in_list("category", options.usage_categories))
    if bounds is not None:
        rows = rows.filter(bounds)
    rows = of_members(rows, "account_key", epoch_date("processdate_est_key", options.time_zone), windows, options)
    return rows.groupBy(
        F.col("account_key").alias("fact_key"),
        epoch_date("processdate_est_key", options.time_zone).alias("day"),
    ).agg(F.sum("usage_units").alias("usage_units_d"), F.sum("usage_dollars").alias("usage_dollars_d"))


def package_days(package_log: DataFrame, bounds: Column | None = None) -> DataFrame:
    """Distinct packages per user and day; repeats collapse before the shuffle."""
    rows = package_log if bounds is None else package_log.filter(bounds)
    return rows.groupBy(
        F.col("userid").alias("fact_key"), F.to_date("createdat").alias("day")
    ).agg(F.countDistinct("packageid").alias("pkgs_d"))


def campaign_days(messages: DataFrame, bounds: Column | None = None) -> DataFrame:
    """Recipients and campaigns per user and day. A day of NULL recipients only stays NULL."""
    rows = messages if bounds is None else messages.filter(bounds)
    return rows.groupBy(
        F.col("user_id").alias("fact_key"), F.to_date("stamp_to_send").alias("day")
    ).agg(F.sum("recipients_count").alias("rpct_d"), F.count("id").alias("capn_d"))


def _in_window(options: Options) -> Column:
    first = F.col("first_usage_units")
    return (F.col("day") >= first) & (F.col("day") <= F.date_add(first, options.obs_days - 1))


def usage_in_window(
    cohort: DataFrame,
    account_dim: DataFrame,
    usage_fact: DataFrame,
    options: Options,
    span: Span | None,
    members: int | None = None,
) -> DataFrame:
    """Cohort accounts found in the dimension, with their usage days (or one empty row)."""
    keys = cohort.select(
        "account_key", F.lower("site").alias("site_text"), "account_id", "first_usage_units"
    )
    dim = account_dim.select(
        F.col("account_key").alias("dim_key"), F.lower("site").alias("site_text"), "account_id"
    )
    found = keys.join(dim, ["site_text", "account_id"])
    bounds = epoch_bounds("processdate_est_key", span, options.time_zone)
    days = usage_days(usage_fact, options, bounds, member_windows(found, "dim_key", options, members))
    return (
        found.join(days, (F.col("dim_key") == F.col("fact_key")) & _in_window(options), "left")
        .withColumn("days_after", F.datediff("day", "first_usage_units"))
        .select("account_key", "days_after", "usage_units_d", "usage_dollars_d")
    )


def events_in_window(cohort: DataFrame, days: DataFrame, options: Options) -> DataFrame:
    """Cohort accounts with the given days inside their window; accounts without any drop out."""
    keys = cohort.select("account_key", "account_id", "first_usage_units")
    measures = [name for name in days.columns if name not in ("fact_key", "day")]
    return (
        keys.join(days, (F.col("account_id") == F.col("fact_key")) & _in_window(options))
        .withColumn("days_after", F.datediff("day", "first_usage_units"))
        .select("account_key", "days_after", *measures)
    )


def packages_in_window(
    cohort: DataFrame, package_log: DataFrame, options: Options, span: Span | None, members: int | None = None
) -> DataFrame:
    windows = member_windows(cohort, "account_id", options, members)
    rows = of_members(package_log, "userid", F.to_date("createdat"), windows, options)
    return events_in_window(cohort, package_days(rows, stamp_bounds("createdat", span)), options)


def campaigns_in_window(
    cohort: DataFrame, messages: DataFrame, options: Options, span: Span | None, members: int | None = None
) -> DataFrame:
    windows = member_windows(cohort, "account_id", options, members)
    rows = of_members(messages, "user_id", F.to_date("stamp_to_send"), windows, options)
    return events_in_window(cohort, campaign_days(rows, stamp_bounds("stamp_to_send", span)), options)


def by_day(in_window: DataFrame) -> DataFrame:
    """One row per account and relative day."""
    measures = [name for name in in_window.columns if name not in ("account_key", "days_after")]
    return in_window.groupBy("account_key", "days_after").agg(
        *[F.sum(name).alias(name) for name in measures]
    )


# Measure -> feature prefix.
GRID_PREFIX = {
    "usage_units_d": "uu_d",
    "usage_dollars_d": "ud_d",
    "pkgs_d": "pkgs_d",
    "rpct_d": "rpct_d",
    "capn_d": "capn_d",
}


def grid(in_window: DataFrame, options: Options) -> DataFrame:
    """One row per account, one column per measure and day.

    A day without rows is 0 when the account has any row at all; a NULL measure is skipped.
    ``pivot`` would leave such days NULL.
    """
    measures = [name for name in in_window.columns if name in GRID_PREFIX]
    return in_window.groupBy("account_key").agg(
        *[
            F.sum(F.when(F.col("days_after") == day, F.col(name)).otherwise(0)).alias(
                f"{GRID_PREFIX[name]}{day + 1}"
            )
            for name in measures
            for day in range(options.obs_days)
        ]
    )
