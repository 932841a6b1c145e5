"""Keyword features of outgoing messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.search import pattern_bits
from ..functions.text import KEYWORDS, UNSUMMED, credits_value, matches
from ..options import Options

SUMMED = tuple(name for name in KEYWORDS if name not in UNSUMMED)


def keyword_flags(messages: DataFrame) -> DataFrame:
    """Each message with its credits under every keyword it contains, 0 elsewhere."""
    text, paid = F.col("message_lower"), F.col("credits_value")
    return (
        messages.withColumn("message_lower", F.lower("message"))
        .withColumn("credits_value", credits_value("credits"))
        .select(
            *messages.columns,
            *[F.when(matches(text, p), paid).otherwise(0.0).alias(n) for n, p in KEYWORDS.items()],
        )
    )


def distinct_messages(messages: DataFrame) -> DataFrame:
    """Messages that differ in more than their id.

    They are compared by the SHA-256 digest of the text. Messages travel without it; each text does once for each
    task that reads it, and is put back by its digest.
    """
    digest = F.unhex(F.sha2("message", 256))
    narrow = messages.select("user_id", "recipients_count", digest.alias("digest"), "credits", "stamp_to_send").distinct()
    # texts are grouped as keys, which a hash table holds; as values they would be sorted with all their copies
    texts = messages.select("message").filter(F.col("message").isNotNull()).distinct()
    texts = texts.select(digest.alias("_digest"), "message")
    joined = narrow.join(texts, F.col("digest") == F.col("_digest"), "left")
    return joined.select("user_id", "recipients_count", "message", "credits", "stamp_to_send")


def _keyword_mask(lowered: Column) -> Column:
    return pattern_bits(lowered, [KEYWORDS[name] for name in SUMMED])


def message_days(messages: DataFrame, bounds: Column | None = None) -> DataFrame:
    """Campaign counts and keyword credits per user and day, from one scan of the messages.

    Whole texts are searched where they are read, a batch at a time; what is shuffled for the duplicate check is
    the 32-byte SHA-256 digest of the text and a bit per keyword, never the text. Equal
    messages count once for keywords and each for campaigns. A user's rows spread over the
    digest, then collapse to one row per day.
    """
    rows = messages if bounds is None else messages.filter(bounds)
    once = (
        rows.select(
            F.col("user_id").alias("fact_key"),
            "recipients_count",
            F.unhex(F.sha2("message", 256)).alias("digest"),
            "credits",
            "stamp_to_send",
            _keyword_mask(F.lower("message")).alias("mask"),
            "id",
        )
        .groupBy("fact_key", "recipients_count", "digest", "credits", "stamp_to_send", "mask")
        .agg(F.count("id").alias("campaigns"), F.count(F.lit(1)).alias("copies"))
    )
    paid = credits_value("credits")
    return once.groupBy("fact_key", F.to_date("stamp_to_send").alias("day")).agg(
        F.sum(F.col("recipients_count") * F.col("copies")).alias("rpct_d"),
        F.sum("campaigns").alias("capn_d"),
        *[
            F.sum(F.when(F.col("mask").bitwiseAND(F.lit(1 << place)) != 0, paid).otherwise(0.0)).alias(
                name
            )
            for place, name in enumerate(SUMMED)
        ],
    )


def keyword_features(cohort: DataFrame, days: DataFrame, options: Options) -> DataFrame:
    """Keyword credits per account id over its first days.

    A semi join: an account id with several keys and overlapping windows counts a message once.
    """
    windows = cohort.select("account_id", "first_usage_units").distinct()
    first = F.col("first_usage_units")
    inside = (
        (F.col("fact_key") == F.col("account_id"))
        & (F.col("day") >= first)
        & (F.col("day") <= F.date_add(first, options.obs_days - 1))
    )
    return (
        days.join(windows, inside, "left_semi")
        .groupBy(F.col("fact_key").alias("account_id"))
        .agg(*[F.sum(name).alias(name) for name in SUMMED])
    )
