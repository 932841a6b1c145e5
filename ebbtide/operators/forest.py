"""Forest learners, variable importance and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..options import Options
from .bagging import BaggedForest, fit_bagged, gini_decrease, task_count
from .levels import learn_levels
from .splitting import split_hash

RAW = "raw_score"


def class_sizes(df: DataFrame, response: str) -> tuple[int, int]:
    row = df.agg(
        F.count(F.when(F.col(response) == 1, 1)).alias("goods"),
        F.count(F.when(F.col(response) == 0, 1)).alias("bads"),
    ).first()
    return row["goods"], row["bads"]


def _inputs(numeric: Sequence[str], categorical: Sequence[str]) -> list[str]:
    return list(numeric) + [f"{name}__level" for name in categorical]


def _stages(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    stages = []
    if categorical:
        stages.append(
            StringIndexer(
                inputCols=list(categorical),
                outputCols=[f"{name}__level" for name in categorical],
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            )
        )
    stages.append(
        VectorAssembler(inputCols=_inputs(numeric, categorical), outputCol="features", handleInvalid="keep")
    )
    return stages


def _weighted(df: DataFrame, response: str, options: Options) -> tuple[DataFrame, float]:
    """Rows with class weights of equal total, and the share of rows each tree draws.

    A tree is meant to see ``s = share * positives`` rows of each class. MLlib draws one rate for
    all rows, so the rate is ``2 s / n`` and the weights even out the classes.
    """
    goods, bads = class_sizes(df, response)
    if not goods or not bads:
        raise ValueError("training rows need both response classes")
    wanted = max(1, round(goods * options.forest_sample_share))
    rate = min(1.0, 2.0 * wanted / (goods + bads))
    weight = F.when(F.col(response) == 1, F.lit((goods + bads) / (2.0 * goods))).otherwise(
        F.lit((goods + bads) / (2.0 * bads))
    )
    rows = df.filter(F.col(response).isNotNull())
    return rows.withColumn("label", F.col(response).cast("double")).withColumn("weight", weight), rate


def learn(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], response: str, trees: int, options: Options
) -> BaggedForest | PipelineModel:
    """A forest by the learner that the options name."""
    if options.forest_learner == "mllib":
        return fit_forest(df, numeric, categorical, response, trees, options)
    if options.forest_learner != "bagged":
        raise ValueError(f"unknown learner: {options.forest_learner}")
    goods, bads = class_sizes(df, response)
    if not goods or not bads:
        raise ValueError("training rows need both response classes")
    levels = learn_levels(df, categorical, options.max_levels)
    return fit_bagged(df, numeric, categorical, response, (goods, bads), levels, trees, options)


def fit_forest(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    response: str,
    trees: int,
    options: Options,
) -> PipelineModel:
    rows, rate = _weighted(df, response, options)
    forest = RandomForestClassifier(
        labelCol="label",
        featuresCol="features",
        weightCol="weight",
        numTrees=trees,
        maxDepth=options.forest_depth,
        maxBins=max(32, options.max_levels + 2),
        subsamplingRate=rate,
        featureSubsetStrategy="sqrt",
        maxMemoryInMB=options.forest_memory_mb,
        seed=options.learner_seed,
    )
    model = Pipeline(stages=[*_stages(numeric, categorical), forest]).fit(
        rows.select(*numeric, *categorical, "label", "weight")
    )
    # the summary holds the session, which can't be sent with the model once anything in it was observed
    model.stages[-1]._java_obj.setSummary(df.sparkSession._jvm.scala.Option.empty())
    return model


def fit_boosted(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], response: str, options: Options
) -> PipelineModel:
    """The boosted-tree challenger."""
    rows, _ = _weighted(df, response, options)
    boosted = GBTClassifier(
        labelCol="label",
        featuresCol="features",
        maxIter=options.boost_iterations,
        stepSize=options.boost_step,
        subsamplingRate=options.boost_sample_share,
        maxDepth=options.forest_depth,
        maxBins=max(32, options.max_levels + 2),
        maxMemoryInMB=options.forest_memory_mb,
        seed=options.learner_seed,
    )
    return Pipeline(stages=[*_stages(numeric, categorical), boosted]).fit(
        rows.select(*numeric, *categorical, "label")
    )


def predictors(model: BaggedForest | PipelineModel) -> list[str]:
    """Column names a fitted model reads, in feature order."""
    if isinstance(model, BaggedForest):
        return model.predictors
    assembler = next(stage for stage in model.stages if isinstance(stage, VectorAssembler))
    return [name.removesuffix("__level") for name in assembler.getInputCols()]


def gini_importance(model: BaggedForest | PipelineModel, spark) -> DataFrame:
    """``variable, mean_decrease_gini``: one row per predictor. MLlib's add up to 1."""
    if isinstance(model, BaggedForest):
        return gini_decrease(model, spark)
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(weight)) for name, weight in zip(predictors(model), weights)]
    return spark.createDataFrame(rows, "variable string, mean_decrease_gini double")


def top_variables(importance: DataFrame, n: int) -> list[str]:
    ordered = importance.orderBy(F.desc("mean_decrease_gini"), "variable").limit(n)
    return [row["variable"] for row in ordered.collect()]


def add_scores(df: DataFrame, model: BaggedForest | PipelineModel, name: str = RAW) -> DataFrame:
    """Probability of class 1, keeping only the caller's columns."""
    if isinstance(model, BaggedForest):
        return df.select(*df.columns, model.score().alias(name))
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(name))


def out_of_fold_scores(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    response: str,
    id_column: str,
    trees: int,
    options: Options,
) -> DataFrame:
    """Training rows scored by forests that have not seen them (``options.out_of_fold`` folds)."""
    fold = F.pmod(F.xxhash64(split_hash(id_column, options.learner_seed)), F.lit(options.out_of_fold))
    marked = df.withColumn("_fold", fold)
    parts = []
    for k in range(options.out_of_fold):
        model = fit_forest(marked.filter(F.col("_fold") != k), numeric, categorical, response, trees, options)
        parts.append(add_scores(marked.filter(F.col("_fold") == k).drop("_fold"), model))
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    return scored


def accuracy_importance(
    df: DataFrame,
    model: BaggedForest | PipelineModel,
    response: str,
    id_column: str,
    options: Options,
    slices: int | None = None,
) -> DataFrame:
    """``variable, mean_decrease_accuracy``: accuracy lost when one variable is permuted.

    All variables are permuted in one shuffle: rows are hashed into slices, put in a seeded
    random order there, and every variable's value moves to the next row (the last row's to the
    first). Each row is then scored as it is and once per variable with the moved value; the rows are dealt over
    all cores for that, since the slices are few and small, and the copies are made after it and never leave their task.
    """
    names = predictors(model)
    if slices is None:
        slices = max(1, -(-df.count() // 10_000))  # so a slice's size doesn't grow with the rows
    shuffled = F.md5(F.concat_ws("|", F.col(id_column).cast("string"), F.lit(f"permute{options.learner_seed}")))
    rows = df.filter(F.col(response).isNotNull()).select(
        F.col(response).cast("double").alias("_truth"),
        F.pmod(F.xxhash64(shuffled), F.lit(slices)).alias("_slice"),
        shuffled.alias("_order"),
        F.struct(*names).alias("_own"),
    )
    line = Window.partitionBy("_slice").orderBy("_order")
    first_of_slice = F.first("_own").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    moved = rows.withColumn("_moved", F.coalesce(F.lead("_own").over(line), first_of_slice))
    variants = [F.struct(F.lit("").alias("variable"), F.col("_own").alias("v"))]
    for changed in names:
        values = [F.col(f"_moved.{n}" if n == changed else f"_own.{n}").alias(n) for n in names]
        variants.append(F.struct(F.lit(changed).alias("variable"), F.struct(*values).alias("v")))
    moved = moved.drop("_slice", "_order").repartition(max(slices, task_count(df.sparkSession, 10 * slices)))
    copies = moved.select("_truth", F.explode(F.array(*variants)).alias("_x")).select(
        "_truth", "_x.variable", "_x.v.*"
    )
    right = F.avg(((F.col(RAW) >= 0.5).cast("double") == F.col("_truth")).cast("double"))
    accuracy = add_scores(copies, model).groupBy("variable").agg(right.alias("accuracy"))
    base = F.max(F.when(F.col("variable") == "", F.col("accuracy"))).over(Window.partitionBy(F.lit(0)))
    # one row per variable
    return (
        accuracy.withColumn("mean_decrease_accuracy", base - F.col("accuracy"))
        .filter(F.col("variable") != "")
        .select("variable", "mean_decrease_accuracy")
    )


def split_kinds(names: Sequence[str], categorical: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numeric and categorical names of a mixed list, each in the list's order."""
    known = set(categorical)
    return [n for n in names if n not in known], [n for n in names if n in known]


def importance_table(gini_rows: DataFrame, accuracy_rows: DataFrame | None = None) -> DataFrame:
    if accuracy_rows is None:
        return gini_rows.orderBy(F.desc("mean_decrease_gini"), "variable")
    return gini_rows.join(accuracy_rows, "variable", "left").orderBy(
        F.desc("mean_decrease_gini"), "variable"
    )
