"""One row per account: base columns, activity grids and keyword features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_activity(cohort: DataFrame, *grids: DataFrame) -> DataFrame:
    """Left joins on the account key. An account missing from a grid keeps NULLs, not zeros."""
    joined = cohort
    for grid in grids:
        joined = joined.join(grid, "account_key", "left")
    return joined


def join_keywords(base: DataFrame, keywords: DataFrame) -> DataFrame:
    """Left join on the account id, which several account keys may share.

    Keywords are first given their account keys on narrow rows. The wide base, whose key is
    unique, then joins on the account key like every grid and is not shuffled again.
    """
    keyed = base.select("account_key", "account_id").join(keywords, "account_id").drop("account_id")
    return base.join(keyed, "account_key", "left")


def explicit_industry(base: DataFrame, column: str = "industry", level: str = "NA") -> DataFrame:
    """A missing industry becomes a level of its own."""
    return base.withColumn(column, F.coalesce(F.col(column), F.lit(level)))
