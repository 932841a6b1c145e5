"""Principal components of mixed numeric and categorical variables."""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import level_counts


@dataclasses.dataclass(frozen=True)
class Components:
    numeric: tuple[str, ...]
    centre: dict[str, tuple[float, float]]
    shares: dict[str, dict[str, float]]
    model: PCAModel
    count: int
    cumulative: tuple[float, ...]


def _scaled(df: DataFrame, keep, numeric, centre, shares) -> DataFrame:
    """Standardised numerics, and indicators centred and divided by the root of their share."""
    columns = []
    for name in numeric:
        mean, sd = centre[name]
        columns.append(((F.col(name) - mean) / sd).alias(f"n__{name}"))
    for name, levels in shares.items():
        for place, (level, share) in enumerate(levels.items()):
            hit = F.when(F.col(name) == level, 1.0).otherwise(0.0)
            columns.append(((hit - share) / F.sqrt(F.lit(share))).alias(f"c__{name}__{place}"))
    scaled = df.select(*keep, *columns)
    inputs = [c for c in scaled.columns if c not in keep]
    return VectorAssembler(inputCols=inputs, outputCol="features").transform(scaled).select(*keep, "features")


def fit_components(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], percent: float
) -> Components:
    """Components up to ``percent`` of the variance.

    Categories must be classified ones, and numerics imputed: a row with a missing one is refused.
    """
    stats = train.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count(c).alias(f"{c}__k") for c in numeric],
        *[F.avg(c).alias(f"{c}__m") for c in numeric],
        *[F.stddev_pop(c).alias(f"{c}__s") for c in numeric],
    ).first()
    gaps = [c for c in numeric if stats[f"{c}__k"] < stats["_n"]]
    if gaps:
        raise ValueError(f"impute before the components are fitted: missing values in {gaps}")
    varied = [c for c in numeric if stats[f"{c}__s"]]
    centre = {c: (float(stats[f"{c}__m"]), float(stats[f"{c}__s"])) for c in varied}
    shares: dict[str, dict[str, float]] = {name: {} for name in categorical}
    known = level_counts(train, categorical).filter("value is not null") if categorical else None
    for row in known.orderBy("variable", "value").collect() if known is not None else ():  # classified levels
        shares[row["variable"]][row["value"]] = row["n"] / stats["_n"]
    vectors = _scaled(train, [], varied, centre, shares).cache()
    try:
        width = vectors.first()["features"].size
        model = PCA(k=width, inputCol="features", outputCol="components").fit(vectors)
        cumulative = np.cumsum(model.explainedVariance.toArray()) * 100
        count = int(np.argmax(cumulative >= percent - 1e-9)) + 1
    finally:
        vectors.unpersist()
    return Components(tuple(varied), centre, shares, model, count, tuple(float(c) for c in cumulative))


def rotate(df: DataFrame, parts: Components, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns and one column per component; all cohorts in one pass."""
    scaled = _scaled(df, list(keep), parts.numeric, parts.centre, parts.shares)
    values = vector_to_array("components")
    return parts.model.transform(scaled).select(
        *keep, *[values[i].alias(f"dim{i + 1}") for i in range(parts.count)]
    )


def variance_curve(parts: Components, spark) -> DataFrame:
    rows = [(i + 1, share) for i, share in enumerate(parts.cumulative)]
    return spark.createDataFrame(rows, "dimension int, cumulative_percent double")
