"""Missing-share cut and median imputation, learnt on training rows and applied anywhere."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_missing
from ..options import Options
from .profiling import missing_share
from .ranking import medians, ranked_values, sketched_quantiles


def complete_enough(df: DataFrame, variables: Sequence[str], options: Options) -> list[str]:
    """Variables whose rounded missing share does not exceed the cut."""
    if not variables:
        return []
    rows = missing_share(df, variables).collect()  # one row per variable
    share = {row["variable"]: row["missing_share"] for row in rows}
    return [name for name in variables if not share[name] or share[name] <= options.max_missing_share]


def learn_medians(counts: DataFrame) -> dict[str, float]:
    """Exact medians by variable name, from value counts."""
    rows = medians(ranked_values(counts)).collect()  # one row per variable
    return {row["variable"]: row["median"] for row in rows}


def sketch_medians(df: DataFrame, numeric: Sequence[str]) -> dict[str, float]:
    """Approximate medians from one pass; no value is shuffled."""
    return {name: value for name, (value,) in sketched_quantiles(df, numeric, [0.5]).items()}


def apply_cleaning(
    df: DataFrame,
    keys: Sequence[str],
    numeric: Sequence[str],
    categorical: Sequence[str],
    median_of: Mapping[str, float],
    options: Options,
) -> DataFrame:
    """Keys, imputed numerics and categories as one narrow projection."""
    types = dict(df.dtypes)
    columns = [F.col(name) for name in keys]
    for name in numeric:
        value = F.col(name).cast("double")
        if options.impute_median and median_of.get(name) is not None:
            value = F.when(is_missing(name, types[name]), F.lit(float(median_of[name]))).otherwise(value)
        columns.append(value.alias(name))
    for name in categorical:
        level = F.col(name).cast("string")
        if options.explicit_missing_level:
            level = F.coalesce(level, F.lit("NA"))
        columns.append(level.alias(name))
    return df.select(*columns)
