"""Schemas of the logical input tables and of the score table."""

from __future__ import annotations

from pyspark.sql import DataFrame

ACCOUNTS = (
    "account_key long, site string, account_id long, first_usage_units date, last_usage_units date, "
    "company_name string, company_id long, phone string, email string, attribution_source string, "
    "mobile_signup int, brand_used string, industry string, city string, state string, "
    "country string, start_date date, is_api int, is_api_developer int, first_month_revenue double, "
    "contacts double, number_of_contacts double, is_freemium_at_signup int, "
    "customer_satisfaction_pendo double, customer_service_survey_rating double, keywords_all double, "
    "keywords_purchased double, keyword_optins double, sms_keyword_in double, "
    "primary_sms_usecase string, example_sms string, google_sms_example string, "
    "google_sms_class string, google_sms_class_confidence double"
)
PROFILES = "userid long, usage string"
ACCOUNT_DIM = "account_key long, site string, account_id long"
USAGE_FACT = (
    "account_key long, processdate_est_key long, category string, usage_units double, usage_dollars double"
)
PACKAGE_LOG = "userid long, createdat timestamp_ntz, packageid long"
MESSAGES = (
    "id long, user_id long, recipients_count long, message string, credits double, "
    "stamp_to_send timestamp_ntz"
)
SCORES = "account_id long, first_usage_units date, churn_90d_score double, efft_d date"


def column_names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(",")]


def require(df: DataFrame, *names: str) -> DataFrame:
    """The frame, or an error naming the columns it lacks."""
    lacking = [name for name in names if name not in df.columns]
    if lacking:
        raise ValueError(f"input lacks columns: {', '.join(lacking)}")
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The frame, or an error when it has no row (one short task)."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows; build it first")
    return df
