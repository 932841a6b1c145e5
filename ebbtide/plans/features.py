"""Training and scoring frames: cohort, labels, activity and keywords as one lazy plan."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import activity, assembly, cohort, messages
from ..options import Options
from ..session import stage
from ..sources.sinks import assert_unique


@dataclasses.dataclass(frozen=True)
class Inputs:
    """The logical source tables."""

    accounts: DataFrame
    profiles: DataFrame
    account_dim: DataFrame
    usage_fact: DataFrame
    package_log: DataFrame
    messages: DataFrame


CAMPAIGN_MEASURES = ("rpct_d", "capn_d")


def add_features(cohort_rows: DataFrame, inputs: Inputs, options: Options, labelled: bool = False) -> DataFrame:
    """Activity grids and keyword features for every row of a cohort.

    The cohort is written once, since every join below reads it, and its key is checked. So are
    the messages' daily sums (one row per sender and day), which give both campaign grids and
    keyword features: texts are read and searched once, and those of the cohort's first days
    alone. The rest is one lazy plan. With
    ``labelled`` only messages of labelled accounts count, as in the training build.
    """
    base = assert_unique(stage(cohort_rows, "cohort"), ["account_key"])
    span = activity.observed_span(base, options)
    members = base.count()
    usage = activity.usage_in_window(base, inputs.account_dim, inputs.usage_fact, options, span, members)
    packages = activity.packages_in_window(base, inputs.package_log, options, span, members)
    bounds = activity.stamp_bounds("stamp_to_send", span)
    sent = activity.messages_of_members(inputs.messages, base, options, members)
    days = stage(messages.message_days(sent, bounds), "message-days")
    campaigns = activity.events_in_window(base, days.select("fact_key", "day", *CAMPAIGN_MEASURES), options)
    writers = base
    if labelled:
        writers = base.filter(F.col("churn_90d").isNotNull() | F.col("churn_1d").isNotNull())
    keywords = messages.keyword_features(writers, days, options)
    grids = [activity.grid(part, options) for part in (usage, packages, campaigns)]
    joined = assembly.join_activity(base, *grids)
    return assembly.explicit_industry(assembly.join_keywords(joined, keywords))


def labelled_cohort(inputs: Inputs, as_of, options: Options) -> DataFrame:
    """Cohort rows with labels and a model or score role."""
    accounts = cohort.drop_early_starts(inputs.accounts, options)
    base = cohort.select_cohort(accounts, inputs.profiles, options)
    filled = cohort.fill_last_usage(base, as_of)
    roles = cohort.assign_role(cohort.label_churn(filled, options), as_of, options)
    return cohort.keep_modelled(roles, options)


def training_frame(inputs: Inputs, as_of, options: Options) -> DataFrame:
    return add_features(labelled_cohort(inputs, as_of, options), inputs, options, labelled=True)


def scoring_cohort(inputs: Inputs, options: Options, anchor=None) -> DataFrame:
    """Recent accounts with typed empty labels; the anchor defaults to the newest first usage."""
    window = cohort.scoring_window(options, anchor or cohort.read_anchor(inputs.accounts))
    return cohort.empty_labels(cohort.select_cohort(inputs.accounts, inputs.profiles, options, window))


def scoring_frame(inputs: Inputs, options: Options, anchor=None) -> DataFrame:
    return add_features(scoring_cohort(inputs, options, anchor), inputs, options)
