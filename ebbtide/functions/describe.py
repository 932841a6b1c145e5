"""Words for variable names, for the profile tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .text import KEYWORDS

MEASURES = {
    "uu": "usage units",
    "ud": "usage dollars",
    "pkgs": "distinct packages",
    "rpct": "message recipients",
    "capn": "campaigns sent",
}


def definition(variable: str) -> str | None:
    """What a feature holds, or None for a plain account column."""
    if variable in KEYWORDS:
        return f"credits spent on messages with: {KEYWORDS[variable]}"
    prefix, _, day = variable.partition("_d")
    if prefix in MEASURES and day.isdigit():
        return f"{MEASURES[prefix]} on day {day}"
    return None


def definitions(spark: SparkSession, variables: Sequence[str]) -> DataFrame:
    rows = [(name, definition(name)) for name in variables]
    return spark.createDataFrame(rows, "variable string, definition string")
