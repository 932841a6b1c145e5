"""End-to-end model build."""

from __future__ import annotations

import dataclasses
import logging
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import (
    bagging,
    calibration,
    cleaning,
    evaluation,
    forest,
    information,
    levels,
    profiling,
    ranking,
    splitting,
)
from ..options import Options
from ..session import cut, stage
from ..sources.project import PropensityModel
from ..sources.schemas import require, require_rows

log = logging.getLogger(__name__)

RESPONSE = "Response"
CALIBRATED = "calibrated_score"


@dataclasses.dataclass
class Prepared:
    """Cleaned, in-scope train / test / score frames and what was learnt on the way."""

    train: DataFrame
    test: DataFrame
    score: DataFrame
    numeric: list[str]
    categorical: list[str]
    kept_numeric: list[str]
    medians: dict[str, float]
    levels: dict[str, list[str | None]]
    roles: DataFrame
    iv: DataFrame


def prepare(frame: DataFrame, options: Options, keep: Sequence[str] = ()) -> Prepared:
    """Split, classify, clean, scope and reduce variables.

    ``keep`` names extra columns carried along untouched (a cohort, for instance).
    """
    require(frame, options.response, options.id_column, "md_sc_f")
    renamed = frame.withColumnRenamed(options.response, RESPONSE)
    staged = stage(renamed, "frame")
    modelling = require_rows(splitting.by_role(staged, "md"), "the modelling part of the frame")
    marked = stage(splitting.mark_split(modelling, RESPONSE, options.id_column, options), "split")
    train_rows = marked.filter(F.col("split") == "train").drop("split")
    test_rows = marked.filter(F.col("split") == "test").drop("split")

    roles = profiling.classify_variables(train_rows, options, RESPONSE)
    log.info("classification done")

    numeric = cleaning.complete_enough(train_rows, profiling.names_of(roles, "num"), options)
    categorical = cleaning.complete_enough(train_rows, profiling.names_of(roles, "cat"), options)
    counts = None
    medians: dict[str, float] = {}
    if numeric and options.exact_quantiles:
        counts = stage(ranking.value_counts(train_rows, numeric, RESPONSE), "counts")
        medians = cleaning.learn_medians(counts)
    elif numeric:
        medians = cleaning.sketch_medians(train_rows, numeric)
    keys = [RESPONSE, options.id_column, *keep]

    def clean(rows: DataFrame) -> DataFrame:
        return cleaning.apply_cleaning(rows, keys, numeric, categorical, medians, options)

    log.info("cleaning done")
    train = splitting.downsample(clean(train_rows), options, RESPONSE)
    known = levels.learn_levels(train, categorical, options.max_levels)
    test = levels.keep_known(clean(test_rows), known)
    score = levels.keep_known(clean(splitting.by_role(staged, "sc")), known)
    log.info("final sets done")

    if options.downsample or counts is None or not categorical:
        bins = information.binned(
            train, numeric, categorical, RESPONSE, options.iv_groups, options.exact_quantiles
        )
    else:
        # the counts behind the medians serve again: the rows are not unpivoted twice
        filled = information.imputed_counts(counts, medians if options.impute_median else {})
        bins = information.binned_counts(cut(filled), options.iv_groups).unionByName(
            information.binned_categories(train, categorical, RESPONSE)
        )
    iv = stage(information.iv_report(information.woe_table(bins)), "iv")
    failed = {row["variable"] for row in information.iv_failures(iv, options.iv_floor).collect()}
    log.info("variable reduction done: %d variables dropped", len(failed))
    return Prepared(
        train=train.drop(*failed),
        test=test.drop(*failed),
        score=score.drop(*failed),
        numeric=[n for n in numeric if n not in failed],
        categorical=[n for n in categorical if n not in failed],
        kept_numeric=numeric,
        medians=medians,
        levels={n: v for n, v in known.items() if n not in failed},
        roles=roles,
        iv=iv,
    )


@dataclasses.dataclass
class Trained:
    model: PropensityModel
    prepared: Prepared
    tested: DataFrame  # test rows with raw and calibrated scores
    first: bagging.BaggedForest | PipelineModel | None = None  # the forest on all surviving variables


def train(frame: DataFrame, options: Options, prepared: Prepared | None = None) -> Trained:
    """Two forests, importance and calibration.

    The first forest ranks all surviving variables; the second, on the best of them, scores.
    Calibration is fitted on the test rows, or on a held-out half of them.
    """
    sets = prepared or prepare(frame, options)
    spark = sets.train.sparkSession
    rows = stage(sets.train, "train")
    first_size, second_size = options.forest_trees
    raw = forest.learn(rows, sets.numeric, sets.categorical, RESPONSE, first_size, options)
    importance = forest.gini_importance(raw, spark)
    top = forest.top_variables(importance, options.top_variables)
    scope = forest.top_variables(importance, options.scope_variables)
    numeric, categorical = forest.split_kinds(top, sets.categorical)
    final = forest.learn(rows, numeric, categorical, RESPONSE, second_size, options)
    log.info("learning done")

    tested = stage(forest.add_scores(sets.test.filter(F.col(RESPONSE).isNotNull()), final), "tested")
    half = F.substring(splitting.split_hash(options.id_column, options.split_seed), 4, 1) < "8"
    fit_rows = tested.filter(half) if options.calibration_holdout else tested
    curve = calibration.fit_calibration(fit_rows, forest.RAW, RESPONSE)
    if options.calibration_holdout:
        tested = tested.filter(~half)
    tested = tested.withColumn(CALIBRATED, curve.column(forest.RAW))
    model = PropensityModel(
        options=options,
        numeric=sets.numeric,
        categorical=sets.categorical,
        kept_numeric=sets.kept_numeric,
        medians=sets.medians,
        levels=sets.levels,
        top=top,
        scope=scope,
        forest=final,
        calibration=curve,
        tables={"roles": sets.roles, "iv": sets.iv, "importance": importance},
    )
    return Trained(model, sets, tested, raw)


def unseen_results(done: Trained) -> tuple[str, DataFrame, DataFrame]:
    """Training rows scored by trees that have not seen them, and the first forest's loss of accuracy by variable."""
    model, sets, options = done.model, done.prepared, done.model.options
    if isinstance(model.forest, bagging.BaggedForest):
        scores = bagging.out_of_bag_scores(sets.train, model.forest, options.id_column, forest.RAW)
        return "out_of_bag", scores, bagging.out_of_bag_importance(sets.train, done.first, RESPONSE, options)
    numeric, categorical = forest.split_kinds(model.top, sets.categorical)
    scores = forest.out_of_fold_scores(
        sets.train, numeric, categorical, RESPONSE, options.id_column, options.forest_trees[1], options
    )
    accuracy = forest.accuracy_importance(sets.test, done.first, RESPONSE, options.id_column, options)
    return "out_of_fold", scores, accuracy


def evaluated(done: Trained) -> Trained:
    """The same project with its evaluation among its tables, saved and loaded with it.

    ``accuracy`` is the first forest's second importance measure: out of bag, or on the test rows for MLlib's trees.
    ``gini`` has the out-of-bag (MLlib: out-of-fold) scores of the training rows and the scores of the test rows;
    ``bins_train`` and ``bins_test`` are the optimal bins of both. ``ks``, ``deciles``, ``reliability`` and
    ``sweep`` are those of the test rows. All are a few rows, written once; the test scores are ranked once for
    them all.
    """
    model, sets, options = done.model, done.prepared, done.model.options
    kind, unseen, accuracy = unseen_results(done)
    unseen = stage(unseen.select(RESPONSE, forest.RAW).filter(F.col(forest.RAW).isNotNull()), kind)
    ranked = evaluation.ranked_scores(done.tested, CALIBRATED, RESPONSE)
    ginis = [
        evaluation.gini(rows).select(F.lit(label).alias("rows"), "gini")
        for label, rows in (
            (f"train_{kind}", evaluation.ranked_scores(unseen, forest.RAW, RESPONSE)),
            ("test", ranked),
        )
    ]
    tables = {
        "accuracy": accuracy,
        "gini": ginis[0].unionByName(ginis[1]),
        "ks": evaluation.ks(ranked),
        "deciles": evaluation.decile_ranges(ranked),
        "reliability": evaluation.reliability(done.tested, forest.RAW, RESPONSE),
        "sweep": evaluation.threshold_sweep(done.tested, CALIBRATED, RESPONSE, options),
        "bins_train": calibration.optimal_bins(unseen, forest.RAW, RESPONSE, options.optimal_bin_min_share),
        "bins_test": calibration.optimal_bins(done.tested, CALIBRATED, RESPONSE, options.optimal_bin_min_share),
    }
    kept = {name: stage(table, f"evaluation-{name}") for name, table in tables.items()}
    return dataclasses.replace(done, model=dataclasses.replace(model, tables={**model.tables, **kept}))
