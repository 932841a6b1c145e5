"""Company-name words and their scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def name_words(accounts: DataFrame) -> DataFrame:
    """One row per account and word of its cleaned name, repeats kept."""
    name = F.lower("company_name")
    blank = F.col("company_name").isNull() | (F.col("company_name") == "NA") | (name == "") | (name == "na")
    cleaned = F.regexp_replace(
        F.regexp_replace(F.when(blank, "namemissing").otherwise(name), r"[.,]", " "), r"[0-9]", ""
    )
    words = F.regexp_extract_all(cleaned, F.lit(r"[\p{L}\p{N}']+"), F.lit(0))
    return accounts.select("account_id", "company_name", F.explode(words).alias("word"))


def score_words(words: DataFrame, stop_words: DataFrame, word_scores: DataFrame) -> DataFrame:
    """Drop stop words, then look up each word's score; unknown words keep a NULL score."""
    return words.join(stop_words.select("word"), "word", "left_anti").join(word_scores, "word", "left")
