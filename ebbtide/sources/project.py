"""A trained project on disk: metadata and trees as Parquet, or the forest as an MLlib model."""

from __future__ import annotations

import dataclasses

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators.bagging import BaggedForest
from ..operators.calibration import Calibration
from ..options import Options


@dataclasses.dataclass
class PropensityModel:
    """Everything scoring needs, and the tables that document the build."""

    options: Options
    numeric: list[str]  # survivors, before the top-variable choice
    categorical: list[str]
    kept_numeric: list[str]  # all cleaned columns, for parity of the cleaning step
    medians: dict[str, float]
    levels: dict[str, list[str | None]]
    top: list[str]
    scope: list[str]
    forest: BaggedForest | PipelineModel
    calibration: Calibration
    # roles, iv, importance: one row per variable; once evaluated, its evaluation tables as well
    tables: dict[str, DataFrame]


def save_project(model: PropensityModel, path: str, spark: SparkSession) -> None:
    def put(name: str, rows: list, schema: str) -> None:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")

    lists = {
        "numeric": model.numeric,
        "categorical": model.categorical,
        "kept_numeric": model.kept_numeric,
        "top": model.top,
        "scope": model.scope,
    }
    put(
        "lists",
        [(kind, place, name) for kind, names in lists.items() for place, name in enumerate(names)],
        "kind string, place int, variable string",
    )
    put("medians", list(model.medians.items()), "variable string, median double")
    put(
        "levels",
        [(name, place, value) for name, values in model.levels.items() for place, value in enumerate(values)],
        "variable string, place int, level string",
    )
    put(
        "settings",
        [(model.options.to_json(), *dataclasses.astuple(model.calibration))],
        "options string, intercept double, slope double, intercept_error double, slope_error double, cut double, rate double",
    )
    for name, table in model.tables.items():
        table.write.mode("overwrite").parquet(f"{path}/table-{name}")
    put("tables", [(name,) for name in model.tables], "name string")
    if isinstance(model.forest, BaggedForest):
        model.forest.trees.write.mode("overwrite").parquet(f"{path}/forest-trees")
        put("forest-predictors", list(enumerate(model.forest.predictors)), "place int, variable string")
    else:
        model.forest.write().overwrite().save(f"{path}/forest")


def load_project(spark: SparkSession, path: str) -> PropensityModel:
    def get(name: str, *order: str) -> list:
        return spark.read.parquet(f"{path}/{name}").orderBy(*order).collect()  # metadata

    lists: dict[str, list[str]] = {k: [] for k in ("numeric", "categorical", "kept_numeric", "top", "scope")}
    for row in get("lists", "kind", "place"):
        lists[row["kind"]].append(row["variable"])
    levels: dict[str, list[str | None]] = {}
    for row in get("levels", "variable", "place"):
        levels.setdefault(row["variable"], []).append(row["level"])
    settings = get("settings", "options")[0]
    options = Options.from_json(settings["options"])
    if options.forest_learner == "bagged":
        names = [row["variable"] for row in get("forest-predictors", "place")]
        forest = BaggedForest(
            numeric=[n for n in names if n not in levels],
            categorical=[n for n in names if n in levels],
            levels={n: levels[n] for n in names if n in levels},
            trees=spark.read.parquet(f"{path}/forest-trees"),
        )
    else:
        forest = PipelineModel.load(f"{path}/forest")
    return PropensityModel(
        options=options,
        numeric=lists["numeric"],
        categorical=lists["categorical"],
        kept_numeric=lists["kept_numeric"],
        medians={row["variable"]: row["median"] for row in get("medians", "variable")},
        levels=levels,
        top=lists["top"],
        scope=lists["scope"],
        forest=forest,
        calibration=Calibration(*settings[1:]),
        tables={
            row["name"]: spark.read.parquet(f"{path}/table-{row['name']}") for row in get("tables", "name")
        },
    )
