"""The logical input tables, derived from the given tables.

Two sets of accounts exist. *Customers* use orders and lineitem as their activity; 52 days of
the order calendar count as one logical day, so that the years of orders fit the weeks that
cohorts are made of. *Users* are those of ``events``, with its real timestamps. Documents are the
message texts of both. Missing values come from value rules, since the tables have none.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide import Inputs, Options
from ebbtide.operators.cohort import read_anchor

START = dt.date(1995, 1, 1)
DAYS_PER_LOGICAL_DAY = 52

OPTIONS = Options(
    excluded_sites=("nation_3", "nation_7"),
    excluded_email_terms=("internal.example", "partner.example"),
    label_gap_months=1,
    churn_days=35,
    earliest_first_usage=dt.date(1995, 1, 2),
)
USER_OPTIONS = OPTIONS.replace(usage_categories=("click", "view"))


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the file footer is read for its schema once per session."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def logical_day(column: str) -> Column:
    days = F.datediff(F.col(column).cast("date"), F.lit(START))
    return F.date_add(F.lit(START), F.floor(days / DAYS_PER_LOGICAL_DAY).cast("int"))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    spans = orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_ts"),
        F.max("o_orderdate").alias("last_ts"),
        F.count(F.lit(1)).cast("double").alias("n_orders"),
        F.countDistinct("o_orderpriority").cast("double").alias("n_priorities"),
        F.max("o_totalprice").alias("top_price"),
        F.min("o_totalprice").alias("low_price"),
        F.sum(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("n_filled"),
        F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", 1.0).otherwise(0.0)).alias("n_urgent"),
    )
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    rows = (
        table(spark, sf_dir, "customer")
        .join(spans, F.col("c_custkey") == F.col("o_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    bal, key, nation = F.col("c_acctbal"), F.col("c_custkey"), F.col("c_nationkey")
    first = logical_day("first_ts")
    email = (
        F.when(bal > 9700, None)
        .when(nation == 5, F.concat(F.lit("U"), key, F.lit("@INTERNAL.example")))
        .when((F.col("c_mktsegment") == "FURNITURE") & (bal < 1000), "unknown")
        .otherwise(F.concat(F.lit("u"), key, F.lit("@mail.example")))
    )
    text = F.lit(None).cast("string")
    return rows.select(
        (key + 1000000).alias("account_key"),
        F.col("n_name").alias("site"),
        key.alias("account_id"),
        first.alias("first_usage_units"),
        F.when(F.col("last_ts") < F.lit("2001-06-01").cast("timestamp_ntz"), logical_day("last_ts")).alias(
            "last_usage_units"
        ),
        F.concat("c_name", F.lit(", "), "c_mktsegment", F.lit(". "), "n_name").alias("company_name"),
        nation.cast("long").alias("company_id"),
        F.when(bal >= 500, F.concat(F.lit("+1-"), key)).alias("phone"),
        email.alias("email"),
        F.col("r_name").alias("attribution_source"),
        F.when(nation < 12, 1).otherwise(0).alias("mobile_signup"),
        F.lit("main").alias("brand_used"),
        F.when(bal >= 0, F.col("c_mktsegment")).alias("industry"),
        F.col("c_name").alias("city"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("country"),
        F.date_sub(first, 3).alias("start_date"),
        F.when(nation < 3, 1).otherwise(0).alias("is_api"),
        F.lit(0).alias("is_api_developer"),
        F.when(bal >= 0, bal).alias("first_month_revenue"),
        F.col("n_orders").alias("contacts"),
        F.col("n_priorities").alias("number_of_contacts"),
        F.when(bal < 3000, 1).otherwise(0).alias("is_freemium_at_signup"),
        F.when(bal > 6000, F.floor(bal / 1000).cast("double")).alias("customer_satisfaction_pendo"),
        F.when(bal > 3000, F.floor(bal / 2500).cast("double")).alias("customer_service_survey_rating"),
        F.col("top_price").alias("keywords_all"),
        F.col("low_price").alias("keywords_purchased"),
        F.col("n_filled").alias("keyword_optins"),
        F.col("n_urgent").alias("sms_keyword_in"),
        F.when(F.col("n_priorities") >= 5, "mixed").otherwise("narrow").alias("primary_sms_usecase"),
        F.col("c_name").alias("example_sms"),
        text.alias("google_sms_example"),
        F.lower("c_mktsegment").alias("google_sms_class"),
        (bal / 10000).alias("google_sms_class_confidence"),
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("userid"),
        F.when(F.col("s_acctbal") > 4500, "Marketing").otherwise("Alerts").alias("usage"),
    )


def account_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers above a balance; the rest are absent from the dimension."""
    found = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 500)
    named = found.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select(
        (F.col("c_custkey") + 1000000).alias("account_key"),
        F.lower("n_name").alias("site"),
        F.col("c_custkey").alias("account_id"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", logical_day("o_orderdate").alias("day")
    )
    return table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def usage_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = F.datediff("day", F.lit(dt.date(1970, 1, 1))).cast("long")
    return order_lines(spark, sf_dir).select(
        (F.col("o_custkey") + 1000000).alias("account_key"),
        (days * 86400 + F.col("l_linenumber") * 3600).alias("processdate_est_key"),
        F.when(F.col("l_returnflag") == "A", "SMS")
        .when(F.col("l_returnflag") == "N", "mms")
        .otherwise("voice")
        .alias("category"),
        F.col("l_quantity").alias("usage_units"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("usage_dollars"),
    )


def package_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.col("day").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("l_linenumber"))
    return order_lines(spark, sf_dir).select(
        F.col("o_custkey").alias("userid"), moment.alias("createdat"), F.col("l_suppkey").alias("packageid")
    )


def _document_credits() -> Column:
    return (
        F.when(F.col("lang") == "de", "NA")
        .when(F.col("lang") == "es", None)
        .otherwise(F.col("n_chars").cast("string"))
    )


def sending(spark: SparkSession, sf_dir: str, rows: DataFrame, number: str) -> DataFrame:
    """``rows`` with the document that each sends: its number, counted around the documents' numbers."""
    documents = table(spark, sf_dir, "documents")
    last = documents.agg(F.max("doc_id")).first()[0]  # one value, from the statistics of the files
    around = F.pmod(F.col(number), F.lit((last or 0) + 1))
    return rows.withColumn("sent", around).join(documents, F.col("sent") == F.col("doc_id"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of an order sends the document of the order's number: copies but for the id."""
    lines = order_lines(spark, sf_dir)
    return sending(spark, sf_dir, lines, "o_orderkey").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.floor(F.col("o_totalprice") / 1000).cast("long")).alias(
            "recipients_count"
        ),
        F.col("text").alias("message"),
        _document_credits().alias("credits"),
        F.col("day").cast("timestamp_ntz").alias("stamp_to_send"),
    )


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(
        accounts=accounts(spark, sf_dir),
        profiles=profiles(spark, sf_dir),
        account_dim=account_dim(spark, sf_dir),
        usage_fact=usage_fact(spark, sf_dir),
        package_log=package_log(spark, sf_dir),
        messages=messages(spark, sf_dir),
    )


def as_of(source: Inputs) -> dt.date:
    """The run date: the newest first usage."""
    return read_anchor(source.accounts)


# --- users of the event stream ------------------------------------------------------------


def _prop() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def user_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.to_date(F.min("ts")).alias("first_usage_units"), F.to_date(F.max("ts")).alias("last_usage_units"))
        .select(
            F.col("user_id").alias("account_key"),
            F.lit("Main").alias("site"),
            F.col("user_id").alias("account_id"),
            "first_usage_units",
            "last_usage_units",
        )
    )


def user_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    return users.select(
        F.col("user_id").alias("account_key"), F.lit("main").alias("site"), F.col("user_id").alias("account_id")
    )


def user_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = (
        F.datediff(F.col("ts").cast("date"), F.lit(dt.date(1970, 1, 1))).cast("long") * 86400
        + F.hour("ts") * 3600
        + F.minute("ts") * 60
        + F.second("ts")
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("account_key"),
        seconds.alias("processdate_est_key"),
        F.upper("event_type").alias("category"),
        F.col("value").alias("usage_units"),
        (F.col("value") * _prop()).alias("usage_dollars"),
    )


def user_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("userid"), F.col("ts").alias("createdat"), _prop().alias("packageid")
    )


def user_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "purchase")
        .select(
            F.col("event_id").alias("id"),
            "user_id",
            F.when(_prop() >= 20, _prop()).alias("recipients_count"),
            F.col("ts").alias("stamp_to_send"),
        )
    )


def user_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event sends the document of its number."""
    events = table(spark, sf_dir, "events")
    return sending(spark, sf_dir, events, "event_id").select(
        F.col("event_id").alias("id"),
        "user_id",
        F.when(_prop() >= 20, _prop()).alias("recipients_count"),
        F.col("text").alias("message"),
        _document_credits().alias("credits"),
        F.col("ts").alias("stamp_to_send"),
    )


# --- rows with a given score, for the evaluation measures ---------------------------------


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items: returned or not, scored by price."""
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("Response"),
        F.least(F.lit(1.0), F.col("l_extendedprice") / 110000).alias("score"),
        "l_quantity",
        "l_discount",
        "l_tax",
        F.col("l_linestatus").alias("cohort"),
    )
