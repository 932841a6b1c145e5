"""Batch scoring with a trained project."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dates import as_date
from ..operators import cleaning, forest, levels
from ..session import stage
from ..sources.project import PropensityModel
from ..sources.schemas import require, require_rows
from .features import Inputs, scoring_frame
from .training import CALIBRATED


CARRIED = "_carried"


def score_accounts(
    frame: DataFrame, model: PropensityModel, carried: Sequence[str] = (), losses: Observation | None = None
) -> DataFrame:
    """``account_id`` with the scope variables, the raw and the calibrated score.

    One narrow plan: impute with the training medians, keep rows whose categories were seen in
    training, score, calibrate. Nothing is shuffled and no row reaches the driver. Columns that are
    ``carried`` come along as they were before cleaning, in the struct ``_carried``. ``losses`` counts accounts that are
    left out for a value that training has not seen (see ``levels.loss_report``) while the scores are computed.
    """
    options = model.options
    require(frame, options.id_column, *model.numeric, *model.categorical)
    if carried:
        frame = frame.withColumn(CARRIED, F.struct(*carried))
    kept = [options.id_column, *([CARRIED] if carried else [])]
    cleaned = cleaning.apply_cleaning(frame, kept, model.numeric, model.categorical, model.medians, options)
    in_scope = levels.keep_known(cleaned, model.levels, losses)
    wanted = in_scope.select(*kept, *dict.fromkeys([*model.scope, *model.top]))
    scored = forest.add_scores(wanted, model.forest)
    return scored.withColumn(CALIBRATED, model.calibration.column(forest.RAW))


def score_output(
    frame: DataFrame, model: PropensityModel, efft_d: dt.date | None = None, losses: Observation | None = None
) -> DataFrame:
    """Rows of the score table, scored where they are read; the effective date defaults to today."""
    day = as_date(efft_d) if efft_d is not None else F.current_date()
    return score_accounts(frame, model, ["first_usage_units"], losses).select(
        "account_id", f"{CARRIED}.first_usage_units", F.col(CALIBRATED).alias("churn_90d_score"), day.alias("efft_d")
    )


def score_cohort(
    inputs: Inputs,
    model: PropensityModel,
    efft_d: dt.date | None = None,
    anchor: dt.date | None = None,
    losses: Observation | None = None,
) -> DataFrame:
    """The daily job: rows of the score table for the current scoring cohort.

    The feature frame is written once, since it is checked for rows before it is scored.
    """
    frame = stage(scoring_frame(inputs, model.options, anchor), "scoring")
    require_rows(frame, "the scoring cohort")
    return score_output(frame, model, efft_d, losses)


def cohort_export(frame: DataFrame, model: PropensityModel) -> DataFrame:
    """Scored accounts with their top variables as they were before cleaning."""
    scored = score_accounts(frame, model, model.top)
    return scored.select("account_id", *[F.col(CARRIED)[v].alias(v) for v in model.top], CALIBRATED)
