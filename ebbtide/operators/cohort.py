"""Cohort selection, outcome labels and model / score roles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date, months_before, weeks_before
from ..functions.text import contains_any, in_list
from ..options import Options

# The account columns of the cohort, in order. Computed ones follow below.
LEADING = (
    "account_key", "site", "account_id", "first_usage_units", "last_usage_units",
    "company_name", "company_id",
)
MIDDLE = (
    "phone", "email", "attribution_source", "mobile_signup", "brand_used", "industry",
    "city", "state", "country",
)
TRAILING = (
    "first_month_revenue", "contacts", "number_of_contacts", "is_freemium_at_signup",
    "customer_satisfaction_pendo", "customer_service_survey_rating", "keywords_all",
    "keywords_purchased", "keyword_optins", "sms_keyword_in", "primary_sms_usecase",
    "example_sms", "google_sms_example", "google_sms_class", "google_sms_class_confidence",
)


def latest_first_usage(accounts: DataFrame) -> DataFrame:
    """One row: the newest first-usage date, the anchor of the scoring window."""
    return accounts.agg(F.max("first_usage_units").alias("max_first_usage"))


def read_anchor(accounts: DataFrame) -> dt.date:
    """That date as a value (one aggregated row)."""
    return latest_first_usage(accounts).first()["max_first_usage"]


def scoring_window(options: Options, anchor: dt.date) -> tuple[dt.date, dt.date]:
    """Both (inclusive) ends of the scoring window.

    Plain dates, so that the account scan receives constants to skip files by.
    """
    return (
        anchor - dt.timedelta(weeks=options.score_from_weeks),
        anchor - dt.timedelta(weeks=options.score_to_weeks),
    )


def exclude_accounts(accounts: DataFrame, options: Options) -> DataFrame:
    """Drop excluded sites and system e-mail addresses.

    As with NOT IN and NOT LIKE, a NULL site or e-mail drops too once its list is given.
    """
    kept = accounts
    if options.excluded_sites:
        kept = kept.filter(~in_list("site", options.excluded_sites))
    if options.excluded_email_terms:
        kept = kept.filter(~contains_any("email", options.excluded_email_terms))
    return kept


def presence_flags() -> list[Column]:
    return [
        F.when(F.col("phone").isNotNull(), 1).otherwise(0).alias("phone_f"),
        F.when(F.col("email").like("%@%"), 1).otherwise(0).alias("email_f"),
    ]


def select_cohort(
    accounts: DataFrame,
    profiles: DataFrame,
    options: Options,
    window: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """Distinct cohort rows with their stated usage from the profile table.

    Both sides are made distinct before the join (copies collapse map-side), so the joined
    rows are distinct already and the wide result is not shuffled a second time for it.
    """
    kept = exclude_accounts(accounts, options)
    if window is not None:
        first = F.col("first_usage_units")
        kept = kept.filter((first >= F.lit(window[0])) & (first <= F.lit(window[1])))
    left = kept.select(
        *LEADING,
        *MIDDLE,
        F.month("start_date").alias("start_month"),
        "is_api",
        "is_api_developer",
        F.month("first_usage_units").alias("first_usage_units_month"),
        *TRAILING,
        *presence_flags(),
    ).distinct()
    right = profiles.select(F.col("userid").alias("account_id"), "usage").distinct()
    joined = left.join(right, "account_id", "left")
    rest = [name for name in left.columns if name not in LEADING]
    return joined.select(*LEADING, "usage", *rest)


def fill_last_usage(cohort: DataFrame, as_of) -> DataFrame:
    """An account that started and has no last usage is still active on the run date."""
    first, last = F.col("first_usage_units"), F.col("last_usage_units")
    return cohort.withColumn(
        "last_usage_units", F.when(last.isNull() & first.isNotNull(), as_date(as_of)).otherwise(last)
    )


def _survival() -> Column:
    return F.datediff("last_usage_units", "first_usage_units")


def label_churn(cohort: DataFrame, options: Options) -> DataFrame:
    """``churn_90d`` (stopped within the horizon) and ``churn_1d`` (stopped the same day)."""
    started = F.col("first_usage_units").isNotNull()
    within = F.when(_survival() <= options.churn_days, 1).otherwise(0)
    same_day = F.when(_survival() == 0, 1).otherwise(0)
    return cohort.withColumn("churn_90d", F.when(started, within)).withColumn(
        "churn_1d", F.when(started, same_day)
    )


def empty_labels(cohort: DataFrame) -> DataFrame:
    """Typed NULL labels, so that scoring rows carry the training schema."""
    return cohort.withColumn("churn_90d", F.lit(None).cast("int")).withColumn(
        "churn_1d", F.lit(None).cast("int")
    )


def assign_role(cohort: DataFrame, as_of, options: Options) -> DataFrame:
    """``md`` for rows old enough to be labelled, ``sc`` for the scoring window, else ``na``."""
    first, today = F.col("first_usage_units"), as_date(as_of)
    mature = (first < months_before(today, options.label_gap_months)) & F.col("churn_90d").isNotNull()
    recent = (first >= weeks_before(today, options.score_from_weeks)) & (
        first <= weeks_before(today, options.score_to_weeks)
    )
    return cohort.withColumn("md_sc_f", F.when(mature, "md").when(recent, "sc").otherwise("na"))


def drop_where(df: DataFrame, condition: Column) -> DataFrame:
    """Remove rows where ``condition`` is true; rows where it is NULL stay, as DELETE leaves them."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def keep_modelled(cohort: DataFrame, options: Options) -> DataFrame:
    """Rows with a role and not older than the first cohort of interest."""
    kept = cohort.filter(F.col("md_sc_f") != "na")
    if options.earliest_first_usage is not None:
        kept = drop_where(kept, F.col("first_usage_units") < F.lit(options.earliest_first_usage))
    return kept


def drop_early_starts(accounts: DataFrame, options: Options) -> DataFrame:
    """Optional exclusion on the raw start date, which the cohort itself does not carry."""
    if options.earliest_start is None:
        return accounts
    return drop_where(accounts, F.col("start_date") < F.lit(options.earliest_start))


def volume_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("accounts"))
