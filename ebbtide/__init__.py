"""Early-churn propensity on Spark: features, model build, evaluation and batch scoring."""

from .options import Options
from .plans.features import Inputs, scoring_frame, training_frame
from .plans.scoring import cohort_export, score_accounts, score_cohort, score_output
from .plans.training import prepare, train
from .sources.project import load_project, save_project

__all__ = [
    "Inputs",
    "Options",
    "cohort_export",
    "load_project",
    "prepare",
    "save_project",
    "score_accounts",
    "score_cohort",
    "score_output",
    "scoring_frame",
    "train",
    "training_frame",
]
