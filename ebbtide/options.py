"""Settings of one propensity project, as one immutable value."""

from __future__ import annotations

import dataclasses
import datetime as dt
import json

# Columns that identify, date or describe an account and are never predictors.
NON_PREDICTIVE = (
    "account_key",
    "first_usage_units",
    "last_usage_units",
    "company_name",
    "email",
    "phone",
    "example_sms",
    "attribution_source",
    "first_usage_units_month",
)


@dataclasses.dataclass(frozen=True)
class Options:
    # columns
    response: str = "churn_90d"
    id_column: str = "account_id"
    non_predictive: tuple[str, ...] = NON_PREDICTIVE
    # predictors whose name matches any of these are kept out (later-day activity)
    non_predictive_patterns: tuple[str, ...] = (r"_d(8|9|10|11|12|13|14)",)

    # cohort
    excluded_sites: tuple[str, ...] = ()
    excluded_email_terms: tuple[str, ...] = ()
    score_from_weeks: int = 5
    score_to_weeks: int = 1
    label_gap_months: int = 3
    churn_days: int = 90
    earliest_first_usage: dt.date | None = dt.date(2017, 1, 1)
    earliest_start: dt.date | None = None

    # first-days activity
    obs_days: int = 7
    usage_categories: tuple[str, ...] = ("sms", "mms")
    # cohorts up to this size are broadcast to the fact scans, larger ones are joined by key
    broadcast_accounts: int = 1_000_000
    time_zone: str = "UTC"

    # data preparation
    train_share: float = 0.7
    split_seed: int = 1
    max_levels: int = 100
    numeric_to_category: int | None = None  # described upstream of the model, off by default
    explicit_missing_level: bool = False
    max_missing_share: float = 0.5
    impute_median: bool = True
    downsample: bool = False
    downsample_seed: int = 13579
    downsample_share: float = 0.10
    stratified_downsample: bool = False
    exact_quantiles: bool = True  # False: medians and IV groups from mergeable sketches
    iv_groups: int = 10
    iv_floor: float = 0.01

    # learners
    forest_trees: tuple[int, int] = (400, 200)
    # "bagged": fully grown trees on balanced draws; "mllib": bounded depth, level by level over all rows
    forest_learner: str = "bagged"
    forest_sample_share: float = 0.1  # of the positives, drawn from each class for each tree
    forest_sample_most: int = 20_000  # at most so many of each class: a tree's sample fits in a task
    forest_depth: int = 5  # of MLlib's trees
    forest_memory_mb: int = 1024
    top_variables: int = 15
    scope_variables: int = 30
    learner_seed: int = 13579
    out_of_fold: int = 3
    boost_iterations: int = 100
    boost_step: float = 0.1
    boost_sample_share: float = 0.5
    boost_sample_most: int = 50_000  # rows of a round's sample: its tree is grown in a task
    boost_depth: int = 3
    boost_cut_every: int = 5  # rounds between two writings of the row weights

    # evaluation
    calibration_holdout: bool = False
    threshold: float = 0.3
    sweep_percent: tuple[int, int, int] = (20, 50, 1)
    optimal_bin_min_share: float = 0.01
    component_share: float = 95.0

    def replace(self, **changes) -> "Options":
        return dataclasses.replace(self, **changes)

    def to_json(self) -> str:
        return json.dumps(
            dataclasses.asdict(self),
            default=lambda day: {"date": day.isoformat()},
            sort_keys=True,
        )

    @classmethod
    def from_json(cls, text: str) -> "Options":
        def restore(value):
            if isinstance(value, list):
                return tuple(value)
            if isinstance(value, dict) and set(value) == {"date"}:
                return dt.date.fromisoformat(value["date"])
            return value

        return cls(**{name: restore(value) for name, value in json.loads(text).items()})
