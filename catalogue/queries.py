"""Every registered query: the Spark side, the columns compared and the SQL side."""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.describe import definitions
from ebbtide.functions.text import KEYWORDS
from ebbtide.operators import (
    activity,
    calibration,
    cleaning,
    cohort,
    components,
    evaluation,
    forest,
    information,
    levels,
    messages,
    names,
    profiling,
    ranking,
    splitting,
)
from ebbtide.plans import features, scoring, training
from ebbtide.session import shared_folder, stage
from ebbtide.sources import project, readers, sinks

from . import bindings as b
from . import oracle as o
from .columns import shape, shape_sql, spec

RESPONSE = training.RESPONSE
EFFECTIVE = dt.date(2024, 2, 1)


@dataclasses.dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def add(name: str, columns: str | None, sql: str | None = None):
    """Register a query; with ``columns`` both sides are shaped alike."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            result = build(spark, sf_dir)
            return shape(result, columns) if columns else result

        QUERIES[name] = Query(run, None if sql is None else o.query(shape_sql(sql, columns)))
        return build

    return register


# Steps shared by many queries are computed once per session and data folder.
_STEPS: dict[tuple, object] = {}


def once(step):
    @functools.wraps(step)
    def remembered(spark: SparkSession, sf_dir: str):
        key = (step.__name__, spark.sparkContext.applicationId, sf_dir)
        if key not in _STEPS:
            _STEPS[key] = step(spark, sf_dir)
        return _STEPS[key]

    return remembered


@once
def modelled(spark, sf_dir) -> DataFrame:
    """The work table of labelled accounts, which every activity step joins."""
    source = b.inputs(spark, sf_dir)
    return stage(features.labelled_cohort(source, b.as_of(source), b.OPTIONS), "modelled")


@once
def users(spark, sf_dir) -> DataFrame:
    return stage(b.user_accounts(spark, sf_dir), "users")


@once
def training_frame(spark, sf_dir) -> DataFrame:
    source = b.inputs(spark, sf_dir)
    return stage(features.training_frame(source, b.as_of(source), b.OPTIONS), "training")


@once
def model_rows(spark, sf_dir) -> DataFrame:
    rows = training_frame(spark, sf_dir).withColumnRenamed(b.OPTIONS.response, RESPONSE)
    return stage(splitting.mark_split(splitting.by_role(rows, "md"), RESPONSE, "account_id", b.OPTIONS), "rows")


def train_rows(spark, sf_dir) -> DataFrame:
    return model_rows(spark, sf_dir).filter("split = 'train'").drop("split")


def test_rows(spark, sf_dir) -> DataFrame:
    return model_rows(spark, sf_dir).filter("split = 'test'").drop("split")


@once
def trained(spark, sf_dir) -> training.Trained:
    return training.train(training_frame(spark, sf_dir), b.OPTIONS)


@once
def scored_accounts(spark, sf_dir) -> DataFrame:
    value = F.floor(
        1000
        * (
            0.5 * (1 - F.least("contacts", F.lit(20.0)) / 20.0)
            + 0.5 * F.coalesce("first_month_revenue", F.lit(0.0)) / 10000.0
        )
    )
    return stage(
        modelled(spark, sf_dir).select(
            "account_id",
            F.col("churn_90d").alias(RESPONSE),
            "contacts",
            "keywords_all",
            "number_of_contacts",
            F.col("md_sc_f").alias("cohort"),
            (value / 1000.0).alias("score"),
        ),
        "scored",
    )


# --- cohort, labels, roles -----------------------------------------------------------------

_KINDS = {
    "account_key": "i", "account_id": "i", "company_id": "i", "first_usage_units": "t",
    "last_usage_units": "t", "start_month": "i", "is_api": "i", "is_api_developer": "i",
    "first_usage_units_month": "i", "phone_f": "i", "email_f": "i", "mobile_signup": "i",
    "is_freemium_at_signup": "i", "first_month_revenue": "d4", "contacts": "d4",
    "number_of_contacts": "d4", "customer_satisfaction_pendo": "d4",
    "customer_service_survey_rating": "d4", "keywords_all": "d4", "keywords_purchased": "d4",
    "keyword_optins": "d4", "sms_keyword_in": "d4", "google_sms_class_confidence": "d6",
    "churn_90d": "n", "churn_1d": "n",
}
COHORT_SPEC = ", ".join(f"{c} {_KINDS.get(c, 's')}" for c in o.COHORT_COLUMNS)
GRID_SPEC = spec("d4", *o.GRID_NAMES)
KEYWORD_SPEC = spec("d4", *o.SUMMED)
FRAME_SPEC = f"{COHORT_SPEC}, churn_90d n, churn_1d n, {GRID_SPEC}, {KEYWORD_SPEC}"


@add("latest_first_usage", "max_first_usage t", "select max(first_usage_units) as max_first_usage from accounts")
def _(spark, sf_dir):
    return cohort.latest_first_usage(b.accounts(spark, sf_dir))


@add("cohort_accounts", COHORT_SPEC, "select * from all_cohort")
def _(spark, sf_dir):
    return cohort.select_cohort(b.accounts(spark, sf_dir), b.profiles(spark, sf_dir), b.OPTIONS)


@add("scoring_cohort", f"{COHORT_SPEC}, churn_90d n, churn_1d n", "select * from scoring")
def _(spark, sf_dir):
    return features.scoring_cohort(b.inputs(spark, sf_dir), b.OPTIONS)


@add(
    "account_flags",
    "phone_f i, email_f i, accounts i",
    "select phone_f, email_f, count(*) as accounts from all_cohort group by 1, 2",
)
def _(spark, sf_dir):
    rows = cohort.select_cohort(b.accounts(spark, sf_dir), b.profiles(spark, sf_dir), b.OPTIONS)
    return rows.groupBy("phone_f", "email_f").agg(F.count(F.lit(1)).alias("accounts"))


def _labelled(spark, sf_dir):
    source = b.inputs(spark, sf_dir)
    base = cohort.select_cohort(source.accounts, source.profiles, b.OPTIONS)
    return cohort.label_churn(cohort.fill_last_usage(base, b.as_of(source)), b.OPTIONS), source


@add(
    "churn_labels",
    "account_key i, last_usage_units t, churn_90d n, churn_1d n",
    "select account_key, last_usage_units, churn_90d, churn_1d from labelled",
)
def _(spark, sf_dir):
    return _labelled(spark, sf_dir)[0]


@add("role_assignment", "account_key i, md_sc_f s", "select account_key, md_sc_f from with_role")
def _(spark, sf_dir):
    rows, source = _labelled(spark, sf_dir)
    return cohort.assign_role(rows, b.as_of(source), b.OPTIONS)


@add(
    "modelled_accounts",
    "account_key i, first_usage_units t, md_sc_f s",
    "select account_key, first_usage_units, md_sc_f from modelled",
)
def _(spark, sf_dir):
    return modelled(spark, sf_dir)


@add("role_volume", "md_sc_f s, accounts i", "select md_sc_f, count(*) as accounts from modelled group by 1")
def _(spark, sf_dir):
    return cohort.volume_by(modelled(spark, sf_dir), "md_sc_f")


for _label in ("churn_90d", "churn_1d"):

    @add(
        f"{_label}_volume",
        f"{_label} n, accounts i",
        f"select {_label}, count(*) as accounts from modelled where md_sc_f <> 'sc' group by 1",
    )
    def _(spark, sf_dir, label=_label):
        return cohort.volume_by(modelled(spark, sf_dir).filter("md_sc_f <> 'sc'"), label)


# --- activity ------------------------------------------------------------------------------


def _customer_windows(spark, sf_dir):
    source, base = b.inputs(spark, sf_dir), modelled(spark, sf_dir)
    span, members = activity.observed_span(base, b.OPTIONS), base.count()
    return {
        "usage": lambda: activity.usage_in_window(base, source.account_dim, source.usage_fact, b.OPTIONS, span, members),
        "package": lambda: activity.packages_in_window(base, source.package_log, b.OPTIONS, span, members),
        "campaign": lambda: activity.campaigns_in_window(base, source.messages, b.OPTIONS, span, members),
    }


def _user_windows(spark, sf_dir):
    base, options = users(spark, sf_dir), b.USER_OPTIONS
    span, members = activity.observed_span(base, options), base.count()
    return {
        "usage": lambda: activity.usage_in_window(
            base, b.user_dim(spark, sf_dir), b.user_usage(spark, sf_dir), options, span, members
        ),
        "package": lambda: activity.packages_in_window(base, b.user_packages(spark, sf_dir), options, span, members),
        "campaign": lambda: activity.campaigns_in_window(base, b.user_campaigns(spark, sf_dir), options, span, members),
    }


_MEASURES = {
    "usage": ["usage_units_d", "usage_dollars_d"],
    "package": ["pkgs_d"],
    "campaign": ["rpct_d", "capn_d"],
}
for _suffix, _windows, _sql_name in (("", _customer_windows, "modelled"), ("_users", _user_windows, "users")):
    for _kind, _columns in _MEASURES.items():

        @add(
            f"{_kind}_by_day{_suffix}",
            "account_key i, days_after n, " + spec("d4", *_columns),
            f"select * from {_kind}_day_{_sql_name}",
        )
        def _(spark, sf_dir, kind=_kind, windows=_windows):
            return activity.by_day(windows(spark, sf_dir)[kind]())

        _grid_names = [f"{activity.GRID_PREFIX[m]}{d}" for m in _columns for d in range(1, 8)]

        @add(
            f"{_kind}_grid{_suffix}",
            "account_key i, " + spec("d4", *_grid_names),
            f"select account_key, {o.grid_columns(_columns)} from {_kind}_day_{_sql_name} group by 1",
        )
        def _(spark, sf_dir, kind=_kind, windows=_windows):
            return activity.grid(windows(spark, sf_dir)[kind](), b.OPTIONS)


@add("feature_assembly", f"{FRAME_SPEC}, md_sc_f s", "select * from training_frame")
def _(spark, sf_dir):
    source = b.inputs(spark, sf_dir)
    return features.training_frame(source, b.as_of(source), b.OPTIONS)


@add("scoring_assembly", FRAME_SPEC, "select * from scoring_frame")
def _(spark, sf_dir):
    return features.scoring_frame(b.inputs(spark, sf_dir), b.OPTIONS)


# --- messages ------------------------------------------------------------------------------

_MESSAGE_SPEC = "user_id i, recipients_count n, digest s, credits s, stamp s"
_MESSAGE_SQL = (
    "select user_id, recipients_count, md5(message) as digest, credits, "
    "strftime(stamp_to_send, '%Y-%m-%d %H:%M:%S') as stamp from (select distinct user_id, "
    "recipients_count, message, credits, stamp_to_send from {source})"
)
for _suffix, _source, _sql_name in (("", b.messages, "messages"), ("_users", b.user_messages, "user_messages")):

    @add(f"message_dedup{_suffix}", _MESSAGE_SPEC, _MESSAGE_SQL.format(source=_sql_name))
    def _(spark, sf_dir, source=_source):
        return messages.distinct_messages(source(spark, sf_dir)).select(
            "user_id",
            "recipients_count",
            F.md5("message").alias("digest"),
            "credits",
            F.date_format("stamp_to_send", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        )


_TEXTS = {
    # name: (key columns, table, text column, credits as text in both engines)
    "documents": (["doc_id"], "documents", "text", "n_chars"),
    "conversations": (["conv_id", "turn"], "conversations", "text", "turn + 1"),
    "pages": (["page_id"], "pages", "html", "page_id + 1"),
}
for _name, (_keys, _table, _text, _credits) in _TEXTS.items():

    @add(
        f"keyword_flags_{_name}",
        spec("i", *_keys) + ", " + spec("d4", *KEYWORDS),
        "select "
        + ", ".join(_keys)
        + ", "
        + ", ".join(f"{o.keyword_case(n)} as {n}" for n in KEYWORDS)
        + f" from (select *, {_text} as message, cast({_credits} as double) as paid from {_table})",
    )
    def _(spark, sf_dir, keys=_keys, name=_table, text=_text, credits=_credits):
        rows = b.table(spark, sf_dir, name).select(
            *keys, F.col(text).alias("message"), F.expr(credits).alias("credits")
        )
        return messages.keyword_flags(rows)


def _keywords(base, sent, options):
    span = activity.observed_span(base, options)
    sent = activity.messages_of_members(sent, base, options, base.count())
    days = messages.message_days(sent, activity.stamp_bounds("stamp_to_send", span))
    return messages.keyword_features(base, days, options)


@add("keyword_features", "account_id i, " + KEYWORD_SPEC, "select * from keywords_modelled")
def _(spark, sf_dir):
    return _keywords(modelled(spark, sf_dir), b.messages(spark, sf_dir), b.OPTIONS)


@add("keyword_features_users", "account_id i, " + KEYWORD_SPEC, "select * from keywords_users")
def _(spark, sf_dir):
    return _keywords(users(spark, sf_dir), b.user_messages(spark, sf_dir), b.USER_OPTIONS)


# --- profile and roles ----------------------------------------------------------------------

TEXT_COLUMNS = [
    "site", "usage", "brand_used", "industry", "city", "state", "country", "primary_sms_usecase",
    "google_sms_example", "google_sms_class", "md_sc_f",
]
NUMBER_COLUMNS = [
    "company_id", "mobile_signup", "start_month", "is_api", "is_api_developer", "first_month_revenue",
    "contacts", "number_of_contacts", "is_freemium_at_signup", "customer_satisfaction_pendo",
    "customer_service_survey_rating", "keywords_all", "keywords_purchased", "keyword_optins",
    "sms_keyword_in", "google_sms_class_confidence", "phone_f", "email_f", "churn_1d",
    *o.GRID_NAMES, *o.SUMMED,
]
LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union(parts) -> str:
    return " union all ".join(parts)


def _levels_sql(columns, source) -> str:
    return _union(
        f"select '{c}' as variable, count(distinct {_exact(c)}) + max(case when {c} is null then 1 else 0 end) as levels "
        f"from {source}"
        for c in columns
    )


def _exact(column: str) -> str:
    """Sums of doubles may differ in the last bit between engines, and their distinct count with it."""
    return f"round({column}, 4)" if column.startswith("ud_d") else column


@add(
    "response_rate_by_industry",
    "industry s, tot i, res i, response_rate d6",
    "select industry, count(*) as tot, sum(Response) as res, sum(Response) * 1.0 / count(*) as response_rate "
    "from (select industry, churn_90d as Response from training_frame) group by 1",
)
def _(spark, sf_dir):
    return profiling.response_rate(training_frame(spark, sf_dir), "industry", "churn_90d")


@add("variable_levels", "variable s, levels i", _levels_sql(TEXT_COLUMNS + NUMBER_COLUMNS, "train_rows"))
def _(spark, sf_dir):
    rows = train_rows(spark, sf_dir)
    rows = rows.withColumns({c: F.expr(_exact(c)) for c in NUMBER_COLUMNS if _exact(c) != c})
    return profiling.distinct_levels(rows, TEXT_COLUMNS + NUMBER_COLUMNS)


_BIG = "select 9007199254740992 + l_orderkey as big, cast(l_orderkey as decimal(38, 0)) * 100000000000000000000 + l_linenumber as wide from lineitem"


@add("variable_levels_big", "variable s, levels i", _levels_sql(["big", "wide"], f"({_BIG})"))
def _(spark, sf_dir):
    """Integers and decimals that a double can't tell apart."""
    rows = b.table(spark, sf_dir, "lineitem").selectExpr(
        "9007199254740992 + l_orderkey as big",
        "cast(cast(l_orderkey as decimal(17, 0)) * 100000000000000000000 + l_linenumber as decimal(38, 0)) as wide",
    )
    return profiling.distinct_levels(rows, ["big", "wide"])


@add("variable_levels_lines", "variable s, levels i", _levels_sql(LINE_COLUMNS + ["l_returnflag"], "lineitem"))
def _(spark, sf_dir):
    return profiling.distinct_levels(b.table(spark, sf_dir, "lineitem"), LINE_COLUMNS + ["l_returnflag"])


def _missing_sql(columns, source) -> str:
    return _union(
        f"select '{c}' as variable, cast(round(cast(avg(case when {c} is null then 1.0 else 0.0 end) as "
        f"decimal(38,12)), 2) as double) as missing_share from {source}"
        for c in columns
    )


@add("missing_share", "variable s, missing_share d2", _missing_sql(TEXT_COLUMNS + NUMBER_COLUMNS, "train_rows"))
def _(spark, sf_dir):
    return profiling.missing_share(train_rows(spark, sf_dir), TEXT_COLUMNS + NUMBER_COLUMNS)


def _medians_sql(columns, source) -> str:
    return _union(f"select '{c}' as variable, median({c}) as median from {source}" for c in columns)


@add(
    "medians",
    "variable s, median d4",
    f"select * from ({_medians_sql(NUMBER_COLUMNS, 'train_rows')}) where median is not null",
)
def _(spark, sf_dir):
    return ranking.medians(ranking.ranked_values(ranking.value_counts(train_rows(spark, sf_dir), NUMBER_COLUMNS)))


@add("medians_lines", "variable s, median d4", _medians_sql(LINE_COLUMNS, "lineitem"))
def _(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem")
    return ranking.medians(ranking.ranked_values(ranking.value_counts(lines, LINE_COLUMNS)))


def _profile_sql(columns, source) -> str:
    return _union(
        f"""select '{c}' as variable, n, mean, sd, median, trimmed, mad, low as min, high as max,
          high - low as range, case when m2 > 0 then m3 / n / power(sd, 3) end as skew,
          case when m2 > 0 then m4 / n / power(sd, 4) - 3 end as kurtosis, sd / sqrt(n) as se
        from (select count(x) as n, any_value(a.mean) as mean,
            case when count(x) > 1 then sqrt(sum(power(x - a.mean, 2)) / (count(x) - 1)) end as sd,
            any_value(a.median) as median, median(abs(x - a.median)) * 1.4826 as mad,
            avg(x) filter (where place > floor(a.n * 0.1) and place <= a.n - floor(a.n * 0.1)) as trimmed,
            min(x) as low, max(x) as high, sum(power(x - a.mean, 2)) as m2,
            sum(power(x - a.mean, 3)) as m3, sum(power(x - a.mean, 4)) as m4
          from (select cast({c} as double) as x, row_number() over (order by {c}) as place
                from {source} where {c} is not null) v
          cross join (select avg({c}) as mean, median({c}) as median, count({c}) as n from {source}) a)
        where n > 0"""
        for c in columns
    )


PROFILE_SPEC = (
    "variable s, n i, mean d4, sd d4, median d4, trimmed d4, mad d4, min d4, max d4, range d4, "
    "skew d4, kurtosis d4, se d4"
)
PROFILE_COLUMNS = NUMBER_COLUMNS


@add("numeric_profile", PROFILE_SPEC, _profile_sql(PROFILE_COLUMNS, "train_rows"))
def _(spark, sf_dir):
    return profiling.numeric_profile(train_rows(spark, sf_dir), PROFILE_COLUMNS)


@add("numeric_profile_lines", PROFILE_SPEC, _profile_sql(LINE_COLUMNS, "lineitem"))
def _(spark, sf_dir):
    return profiling.numeric_profile(b.table(spark, sf_dir, "lineitem"), LINE_COLUMNS)


_ROLE_SQL = (
    "select variable, case when kind = 'num' and levels = 1 then 'np' "
    f"when kind = 'cat' and (levels = 1 or levels > {b.OPTIONS.max_levels}) then 'np' else kind end as type from ("
    + _union(
        [
            f"select '{c}' as variable, 'num' as kind, count(distinct {c}) + max(case when {c} is null then 1 else 0 end) "
            "as levels from train_rows"
            for c in NUMBER_COLUMNS
        ]
        + [
            f"select '{c}', 'cat', count(distinct {c}) + max(case when {c} is null then 1 else 0 end) from train_rows"
            for c in TEXT_COLUMNS
        ]
        + [f"select '{c}', 'np', 2" for c in b.OPTIONS.non_predictive]
        + ["select 'Response', 'y', 2", "select 'account_id', 'id', 2"]
    )
    + ")"
)


@once
def roles(spark, sf_dir) -> DataFrame:
    return profiling.classify_variables(train_rows(spark, sf_dir), b.OPTIONS, RESPONSE)


@add("variable_roles", "variable s, type s", _ROLE_SQL)
def _(spark, sf_dir):
    return roles(spark, sf_dir)


@add("role_counts", "type s, variables i", f"select type, count(*) as variables from ({_ROLE_SQL}) group by 1")
def _(spark, sf_dir):
    return profiling.role_volume(roles(spark, sf_dir))


# --- split, cleaning, scope -------------------------------------------------------------------

IMPUTED = NUMBER_COLUMNS
# city has more levels than a category may have: classification keeps it out of the model
CATEGORIES = [c for c in TEXT_COLUMNS if c != "city"]


@add("split_train_test", "account_id i, Response n, split s", "select account_id, Response, split from split_rows")
def _(spark, sf_dir):
    return model_rows(spark, sf_dir)


@add(
    "split_events",
    "event_id i, is_purchase i, split s",
    "select event_id, is_purchase, case when row_number() over (partition by is_purchase order by "
    f"md5(cast(event_id as varchar) || '|{b.OPTIONS.split_seed}'), event_id) <= ceil(0.7 * count(*) over "
    "(partition by is_purchase)) then 'train' else 'test' end as split from (select event_id, "
    "case when event_type = 'purchase' then 1 else 0 end as is_purchase from events)",
)
def _(spark, sf_dir):
    rows = b.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("is_purchase")
    )
    return splitting.mark_split(rows, "is_purchase", "event_id", b.OPTIONS)


def _imputed_sql(source: str) -> str:
    columns = ", ".join(f"coalesce({c}, (select median({c}) from train_rows)) as {c}" for c in IMPUTED)
    return f"select account_id, {columns} from {source}"


@once
def learnt_medians(spark, sf_dir) -> dict:
    return cleaning.learn_medians(ranking.value_counts(train_rows(spark, sf_dir), IMPUTED))


def _imputed(spark, sf_dir, rows):
    return cleaning.apply_cleaning(rows, ["account_id"], IMPUTED, [], learnt_medians(spark, sf_dir), b.OPTIONS)


for _part, _rows in (("train", train_rows), ("test", test_rows)):

    @add(f"impute_{_part}", "account_id i, " + spec("d4", *IMPUTED), _imputed_sql(f"{_part}_rows"))
    def _(spark, sf_dir, rows=_rows):
        return _imputed(spark, sf_dir, rows(spark, sf_dir))


# Training rows of one region leave the other region's sites and countries unseen.
_SEEN_CTE = "(select * from train_rows where country <> 'ASIA')"


@add(
    "seen_categories",
    "account_id i, " + spec("s", *CATEGORIES),
    "select account_id, "
    + ", ".join(CATEGORIES)
    + " from test_rows t where "
    + " and ".join(
        f"exists (select 1 from {_SEEN_CTE} r where r.{c} is not distinct from t.{c})" for c in CATEGORIES
    ),
)
def _(spark, sf_dir):
    train = train_rows(spark, sf_dir).filter("country <> 'ASIA'")
    return levels.keep_seen(test_rows(spark, sf_dir), train, CATEGORIES, b.OPTIONS.max_levels)


@add(
    "unseen_values",
    "variable s, value s",
    _union(
        f"(select '{c}' as variable, {c} as value from test_rows except select '{c}', {c} from {_SEEN_CTE})"
        for c in CATEGORIES
    ),
)
def _(spark, sf_dir):
    train = train_rows(spark, sf_dir).filter("country <> 'ASIA'")
    return levels.unseen_values(test_rows(spark, sf_dir), train, CATEGORIES)


@add(
    "downsample",
    "account_id i, Response n",
    "select account_id, Response from train_rows where "
    f"cast('0x' || substr(md5(cast(account_id as varchar) || '|{b.OPTIONS.downsample_seed}'), 1, 8) as bigint) "
    f"< {round(b.OPTIONS.downsample_share * 2**32)}",
)
def _(spark, sf_dir):
    picked = splitting.downsample(train_rows(spark, sf_dir), b.OPTIONS.replace(downsample=True))
    return picked.select("account_id", RESPONSE)


@add(
    "constant_by_cohort",
    "cohort s, variable s",
    "select cohort, variable from ("
    + _union(
        f"select site as cohort, '{c}' as variable, count(distinct {c}) + max(case when {c} is null then 1 else 0 end) "
        "as levels from train_rows group by site"
        for c in TEXT_COLUMNS + NUMBER_COLUMNS
        if c != "site"
    )
    + ") where levels = 1",
)
def _(spark, sf_dir):
    variables = [c for c in TEXT_COLUMNS + NUMBER_COLUMNS if c != "site"]
    return levels.constant_by_cohort(train_rows(spark, sf_dir), "site", variables)


# --- information value ------------------------------------------------------------------------

IV_NUMERIC = NUMBER_COLUMNS


def _bins_sql(columns, source, response, groups=10) -> str:
    return _union(
        f"""select '{c}' as variable, bin, count(*) as n, sum(y) as goods, min(x) as low, max(x) as high from (
          select {c} as x, {response} as y, cast(floor({groups}.0 * (rank() over (order by {c}) - 1)
            / count(*) over ()) as int) + 1 as bin from {source} where {c} is not null) group by bin"""
        for c in columns
    )


def _woe_sql(columns, categories, source, response) -> str:
    numeric = f"select variable, cast(bin as varchar) as bin, n, goods from ({_bins_sql(columns, source, response)})"
    missing = [
        f"select '{c}', cast(null as varchar), count(*), sum({response}) from {source} where {c} is null having count(*) > 0"
        for c in columns
    ]
    text = [
        f"select '{c}', cast({c} as varchar), count(*), sum({response}) from {source} group by {c}"
        for c in categories
    ]
    return f"""
    select variable, bin, n, goods, bads, pg as good_share, pb as bad_share,
      case when goods > 0 and bads > 0 then ln(pg / pb) end as woe,
      case when goods > 0 and bads > 0 then (pg - pb) * ln(pg / pb)
           when pg is not null and pb is not null then 0.0 end as iv
    from (select *, goods * 1.0::double / nullif(sum(goods) over (partition by variable), 0) as pg,
            bads * 1.0::double / nullif(sum(bads) over (partition by variable), 0) as pb
          from (select *, n - goods as bads from ({_union([numeric, *missing, *text])})))"""


WOE_SPEC = "variable s, bin s, n i, goods i, bads i, good_share d6, bad_share d6, woe d6, iv d6"
_WOE = _woe_sql(IV_NUMERIC, TEXT_COLUMNS, "train_rows", "Response")
_IV = f"select variable, sum(iv) as iv from ({_WOE}) group by 1"


@once
def woe(spark, sf_dir) -> DataFrame:
    bins = information.binned(train_rows(spark, sf_dir), IV_NUMERIC, TEXT_COLUMNS, RESPONSE, b.OPTIONS.iv_groups)
    return stage(information.woe_table(bins), "woe")


@add(
    "quantile_bins",
    "variable s, bin i, n i, goods i, low d4, high d4",
    _bins_sql(IV_NUMERIC, "train_rows", "Response"),
)
def _(spark, sf_dir):
    counts = ranking.value_counts(train_rows(spark, sf_dir), IV_NUMERIC, RESPONSE)
    ranked = ranking.ranked_values(counts, ("n", "goods"))
    return ranking.quantile_groups(ranked, b.OPTIONS.iv_groups, ("n", "goods"))


@add("woe_table", WOE_SPEC, _WOE)
def _(spark, sf_dir):
    return woe(spark, sf_dir)


@add(
    "iv_table",
    "variable s, iv d6, strength s",
    "select variable, iv, case when iv < 0.02 then 'not useful' when iv < 0.1 then 'weak' when iv < 0.3 then 'medium' "
    f"when iv < 0.5 then 'strong' when iv is not null then 'above_range' end as strength from ({_IV})",
)
def _(spark, sf_dir):
    return information.iv_report(woe(spark, sf_dir))


@add("iv_failures", "variable s", f"select variable from ({_IV}) where iv < {b.OPTIONS.iv_floor}")
def _(spark, sf_dir):
    return information.iv_failures(information.information_values(woe(spark, sf_dir)), b.OPTIONS.iv_floor)


_LINES = "(select *, case when l_returnflag = 'R' then 1 else 0 end as returned from lineitem)"


def _returned_lines(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem")
    return lines.withColumn("returned", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))


@add(
    "quantile_bins_lines",
    "variable s, bin i, n i, goods i, low d4, high d4",
    _bins_sql(LINE_COLUMNS, _LINES, "returned"),
)
def _(spark, sf_dir):
    counts = ranking.value_counts(_returned_lines(spark, sf_dir), LINE_COLUMNS, "returned")
    ranked = ranking.ranked_values(counts, ("n", "goods"))
    return ranking.quantile_groups(ranked, 10, ("n", "goods"))


@add("woe_lines", WOE_SPEC, _woe_sql(LINE_COLUMNS, ["l_linestatus"], _LINES, "returned"))
def _(spark, sf_dir):
    rows = _returned_lines(spark, sf_dir)
    return information.woe_table(information.binned(rows, LINE_COLUMNS, ["l_linestatus"], "returned", 10))


_QUALITY = "(select d.lang, d.source, d.n_chars, l.toxic from documents d join labels l on d.doc_id = l.doc_id)"


@add("woe_documents", WOE_SPEC, _woe_sql(["n_chars"], ["lang", "source"], _QUALITY, "toxic"))
def _(spark, sf_dir):
    rows = b.table(spark, sf_dir, "documents").join(b.table(spark, sf_dir, "labels"), "doc_id")
    return information.woe_table(information.binned(rows, ["n_chars"], ["lang", "source"], "toxic", 10))


# --- evaluation on given scores -----------------------------------------------------------------

_CUM = """
    select score, g, n - g as b, n, sum(g) over w as cg, sum(n - g) over w as cb, sum(n) over w as cn,
      sum(g) over () as tg, sum(n - g) over () as tb, sum(n) over () as tn
    from (select score, count(*) as n, sum(Response) as g from {source} where Response is not null group by 1)
    window w as (order by score)"""


def _gini_sql(source):
    return (
        f"select 2 * sum(g * 1.0::double * (cb - b + b / 2.0::double)) / (max(tg) * 1.0::double * max(tb)) - 1 as gini "
        f"from ({_CUM.format(source=source)})"
    )


def _decile_sql(source):
    return f"""
    select bin as decile, min(score) as low, max(score) as high, count(*) as n, sum(Response) as goods,
      sum(Response) * 1.0::double / count(*) as conversion
    from (select *, cast(floor(10.0 * (rank() over (order by score) - 1) / count(*) over ()) as int) + 1 as bin
          from {source} where Response is not null) group by 1"""


def _sweep_sql(source):
    return f"""
    select t / 100.0::double as threshold,
      sum(case when score < t / 100.0::double and Response = 0 then 1 else 0 end) * 1.0::double
        / nullif(sum(case when score < t / 100.0::double then 1 else 0 end), 0) as non_churn_accuracy,
      sum(case when score >= t / 100.0::double and Response = 1 then 1 else 0 end) * 1.0::double
        / nullif(sum(case when score >= t / 100.0::double then 1 else 0 end), 0) as churn_accuracy
    from {source} cross join range(20, 51) r(t) where Response is not null group by t"""


_BIN10 = "least(cast(floor(score * 10) as int) + 1, 10)"

for _suffix, _source, _sql_name in (
    ("", scored_accounts, "scored_accounts"),
    ("_lines", b.scored_lines, "scored_lines"),
):
    _cum = _CUM.format(source=_sql_name)

    def _ranked(spark, sf_dir, source=_source):
        return evaluation.ranked_scores(source(spark, sf_dir), "score", RESPONSE)

    @add(f"gini_exact{_suffix}", "gini d4", _gini_sql(_sql_name))
    def _(spark, sf_dir, ranked=_ranked):
        return evaluation.gini(ranked(spark, sf_dir))

    @add(
        f"cumulative_shares{_suffix}",
        "score d6, cum_good d6, cum_bad d6",
        f"select score, cg * 1.0::double / tg as cum_good, cb * 1.0::double / tb as cum_bad from ({_cum})",
    )
    def _(spark, sf_dir, ranked=_ranked):
        return evaluation.cumulative_shares(ranked(spark, sf_dir))

    @add(
        f"ks{_suffix}",
        "ks d6",
        f"select max(abs(cg * 1.0::double / tg - cb * 1.0::double / tb)) as ks from ({_cum})",
    )
    def _(spark, sf_dir, ranked=_ranked):
        return evaluation.ks(ranked(spark, sf_dir))

    @add(
        f"roc_points{_suffix}",
        "score d6, tpr d6, fpr d6",
        f"select score, (tg - cg + g) * 1.0::double / tg as tpr, (tb - cb + b) * 1.0::double / tb as fpr from ({_cum})",
    )
    def _(spark, sf_dir, ranked=_ranked):
        return evaluation.roc_points(ranked(spark, sf_dir))

    @add(
        f"score_deciles{_suffix}",
        "decile i, low d6, high d6, n i, goods i",
        _decile_sql(_sql_name),
    )
    def _(spark, sf_dir, ranked=_ranked):
        return evaluation.decile_ranges(ranked(spark, sf_dir))

    @add(
        f"decile_conversion{_suffix}",
        "decile i, conversion d4",
        _decile_sql(_sql_name),
    )
    def _(spark, sf_dir, ranked=_ranked):
        return evaluation.decile_conversion(evaluation.decile_ranges(ranked(spark, sf_dir)))

    @add(
        f"confusion_at{_suffix}",
        "predicted i, actual_0 i, actual_1 i, accuracy d2",
        f"""select predicted, actual_0, actual_1, (case when predicted = 1 then actual_1 else actual_0 end)
          * 1.0::double / (actual_0 + actual_1) as accuracy from (
          select case when score >= 0.3 then 1 else 0 end as predicted,
            sum(case when Response = 0 then 1 else 0 end) as actual_0,
            sum(case when Response = 1 then 1 else 0 end) as actual_1
          from {_sql_name} where Response is not null group by 1)""",
    )
    def _(spark, sf_dir, source=_source):
        return evaluation.confusion(source(spark, sf_dir), "score", RESPONSE, b.OPTIONS.threshold)

    @add(
        f"threshold_sweep{_suffix}",
        "threshold d2, non_churn_accuracy d2, churn_accuracy d2",
        _sweep_sql(_sql_name),
    )
    def _(spark, sf_dir, source=_source):
        return evaluation.threshold_sweep(source(spark, sf_dir), "score", RESPONSE, b.OPTIONS)

    @add(
        f"reliability{_suffix}",
        "bin i, n i, observed d6, midpoint d4",
        f"select {_BIN10} as bin, count(*) as n, avg(Response) as observed, ({_BIN10} - 0.5::double) / 10 as midpoint "
        f"from {_sql_name} where Response is not null group by 1",
    )
    def _(spark, sf_dir, source=_source):
        return evaluation.reliability(source(spark, sf_dir), "score", RESPONSE)

    @add(
        f"score_histogram{_suffix}",
        "bin i, n i",
        f"select least(cast(floor(score * 50) as int) + 1, 50) as bin, count(*) as n from {_sql_name} group by 1",
    )
    def _(spark, sf_dir, source=_source):
        return evaluation.score_histogram(source(spark, sf_dir), "score")

    @add(f"mean_score{_suffix}", "mean_score d6", f"select avg(score) as mean_score from {_sql_name}")
    def _(spark, sf_dir, source=_source):
        return evaluation.mean_scores(source(spark, sf_dir), "score")

    @add(
        f"cohort_stability{_suffix}",
        "cohort s, bin i, n i, mean_log_score d6",
        f"select cohort, {_BIN10} as bin, count(*) as n, avg(case when score > 0 then ln(score) end) as mean_log_score "
        f"from {_sql_name} group by 1, 2",
    )
    def _(spark, sf_dir, source=_source):
        return evaluation.cohort_scores(source(spark, sf_dir), "cohort", "score")

    @add(
        f"score_bins_fixed{_suffix}",
        "bin i, upper d4, n i, goods i, bads i, good_rate d6, bad_rate d6, woe d6, iv d6",
        f"""select bin, case bin when 1 then 0.2 when 2 then 0.45 when 3 then 0.7 end as upper, n, goods, n - goods as bads,
          goods * 1.0::double / n as good_rate, (n - goods) * 1.0::double / n as bad_rate,
          case when goods > 0 and n > goods then ln(pg / pb) end as woe,
          case when goods > 0 and n > goods then (pg - pb) * ln(pg / pb) else 0 end as iv
        from (select *, goods * 1.0::double / sum(goods) over () as pg,
              (n - goods) * 1.0::double / sum(n - goods) over () as pb
          from (select case when score <= 0.2 then 1 when score <= 0.45 then 2 when score <= 0.7 then 3 else 4 end as bin,
                count(*) as n, sum(Response) as goods from {_sql_name} where Response is not null group by 1))""",
    )
    def _(spark, sf_dir, source=_source):
        return calibration.score_bins(source(spark, sf_dir), "score", RESPONSE, [0.2, 0.45, 0.7])


_PROFILED = {"": ["contacts", "keywords_all", "number_of_contacts"], "_lines": ["l_quantity", "l_discount", "l_tax"]}
for _suffix, _source, _sql_name in (
    ("", scored_accounts, "scored_accounts"),
    ("_lines", b.scored_lines, "scored_lines"),
):
    _columns = _PROFILED[_suffix]
    _labels = [f"D{i}" for i in range(1, 11)]

    @add(
        f"decile_profile{_suffix}",
        "variable s, " + spec("d4", *_labels),
        f"""select variable, {', '.join(f"max(case when label = {i} then mean end) as D{i}" for i in range(1, 11))}
        from (select *, dense_rank() over (order by bin desc) as label from (
          select bin, variable, avg(value) as mean from (
            select bin, unnest([{', '.join(f"'{c}'" for c in _columns)}]) as variable,
              unnest([{', '.join(f'cast({c} as double)' for c in _columns)}]) as value
            from (select *, cast(floor(10.0 * (rank() over (order by score) - 1) / count(*) over ()) as int) + 1 as bin
                  from {_sql_name} where Response is not null)) group by 1, 2)) group by 1""",
    )
    def _(spark, sf_dir, source=_source, columns=_columns):
        rows = source(spark, sf_dir).filter(F.col(RESPONSE).isNotNull())
        ranges = stage(evaluation.decile_ranges(evaluation.ranked_scores(rows, "score", RESPONSE)), "deciles")
        return evaluation.decile_profile(evaluation.assign_deciles(rows, "score", ranges), ranges, columns)


@add(
    "level_adjust",
    "account_id i, adjusted d6",
    "select account_id, score * ((select avg(score) from scored_accounts where cohort = 'md') / "
    "(select avg(score) from scored_accounts where cohort = 'sc')) as adjusted from scored_accounts where cohort = 'sc'",
)
def _(spark, sf_dir):
    rows = scored_accounts(spark, sf_dir)
    return evaluation.adjust_level(
        rows.filter("cohort = 'sc'"), rows.filter("cohort = 'md'"), "score", "adjusted"
    )


# --- learners ------------------------------------------------------------------------------------


@add("forest_importance", None)
def _(spark, sf_dir):
    model = trained(spark, sf_dir).model
    return forest.importance_table(model.tables["importance"])


@add("top_variables", None)
def _(spark, sf_dir):
    model = trained(spark, sf_dir).model
    return model.tables["importance"].filter(F.col("variable").isin(*model.top))


@add("accuracy_importance", None)
def _(spark, sf_dir):
    done = trained(spark, sf_dir)
    return forest.accuracy_importance(done.prepared.test, done.model.forest, RESPONSE, "account_id", b.OPTIONS)


@add("forest_scores", None)
def _(spark, sf_dir):
    return trained(spark, sf_dir).tested.select("account_id", RESPONSE, forest.RAW)


@add("calibrated_scores", None)
def _(spark, sf_dir):
    return trained(spark, sf_dir).tested.select("account_id", RESPONSE, forest.RAW, training.CALIBRATED)


@add("forest_gini", None)
def _(spark, sf_dir):
    done = trained(spark, sf_dir)
    kind, unseen, _ = training.unseen_results(done)
    unseen = unseen.filter(F.col(forest.RAW).isNotNull())
    parts = [
        evaluation.gini(evaluation.ranked_scores(rows, forest.RAW, RESPONSE)).select(F.lit(label).alias("rows"), "gini")
        for label, rows in ((f"train_{kind}", unseen), ("test", done.tested))
    ]
    return parts[0].unionByName(parts[1])


@add("forest_reliability", None)
def _(spark, sf_dir):
    return evaluation.reliability(trained(spark, sf_dir).tested, forest.RAW, RESPONSE)


@add("optimal_bins", None)
def _(spark, sf_dir):
    tested = trained(spark, sf_dir).tested
    return calibration.optimal_bins(tested, training.CALIBRATED, RESPONSE, b.OPTIONS.optimal_bin_min_share)


@add("optimal_bins_lines", None)
def _(spark, sf_dir):
    return calibration.optimal_bins(b.scored_lines(spark, sf_dir), "score", RESPONSE, b.OPTIONS.optimal_bin_min_share)


@add("forest_decile_profile", None)
def _(spark, sf_dir):
    done = trained(spark, sf_dir)
    numeric, _ = forest.split_kinds(done.model.top, done.prepared.categorical)
    counts = evaluation.ranked_scores(done.tested, training.CALIBRATED, RESPONSE)
    ranges = stage(evaluation.decile_ranges(counts), "deciles")
    rows = evaluation.assign_deciles(done.tested, training.CALIBRATED, ranges)
    return evaluation.decile_profile(rows, ranges, numeric, definitions(spark, numeric))


@add("boosted_challenger", None)
def _(spark, sf_dir):
    done = trained(spark, sf_dir)
    numeric, categorical = forest.split_kinds(done.model.scope, done.prepared.categorical)
    model = forest.fit_boosted(done.prepared.train, numeric, categorical, RESPONSE, b.OPTIONS)
    return forest.add_scores(done.prepared.test, model, "boosted_score").select(
        "account_id", RESPONSE, "boosted_score"
    )


@once
def saved_project(spark, sf_dir):
    """The evaluated project, written to disk and read back."""
    path = f"{shared_folder(spark)}/project-{uuid.uuid4().hex}"
    project.save_project(training.evaluated(trained(spark, sf_dir)).model, path, spark)
    return project.load_project(spark, path)


for _table in ("accuracy", "gini", "ks", "deciles", "reliability", "sweep", "bins_train", "bins_test"):

    @add(f"project_{_table}", None)
    def _(spark, sf_dir, name=_table):
        return saved_project(spark, sf_dir).tables[name]


def _without_gaps(spark, sf_dir, rows) -> DataFrame:
    """All variables of a row, imputed, with a level for missing categories."""
    options = b.OPTIONS.replace(explicit_missing_level=True)
    medians = {c: v if v is not None else 0.0 for c, v in learnt_medians(spark, sf_dir).items()}
    medians = {c: medians.get(c, 0.0) for c in NUMBER_COLUMNS}
    return cleaning.apply_cleaning(rows, ["account_id", RESPONSE], NUMBER_COLUMNS, CATEGORIES, medians, options)


@once
def fitted_components(spark, sf_dir) -> components.Components:
    rows = _without_gaps(spark, sf_dir, train_rows(spark, sf_dir))
    return components.fit_components(rows, NUMBER_COLUMNS, CATEGORIES, b.OPTIONS.component_share)


@add("pca_scores", None)
def _(spark, sf_dir):
    rows = _without_gaps(spark, sf_dir, test_rows(spark, sf_dir))
    return components.rotate(rows, fitted_components(spark, sf_dir), ["account_id", RESPONSE])


@add("pca_curve", None)
def _(spark, sf_dir):
    return components.variance_curve(fitted_components(spark, sf_dir), spark)


# --- scoring, sources, sinks ------------------------------------------------------------------------


@once
def scoring_rows(spark, sf_dir) -> DataFrame:
    return stage(features.scoring_frame(b.inputs(spark, sf_dir), b.OPTIONS), "scoring")


@add("score_batch", None)
def _(spark, sf_dir):
    return scoring.score_accounts(scoring_rows(spark, sf_dir), trained(spark, sf_dir).model)


@add("score_output", None)
def _(spark, sf_dir):
    return scoring.score_output(scoring_rows(spark, sf_dir), trained(spark, sf_dir).model, EFFECTIVE)


@add("score_sink_append", None)
def _(spark, sf_dir):
    """Two runs of the same day leave one score per account."""
    path = f"{shared_folder(spark)}/sink-{uuid.uuid4().hex}"
    rows = scoring.score_cohort(b.inputs(spark, sf_dir), trained(spark, sf_dir).model, EFFECTIVE)
    sinks.append_scores_path(rows, path)
    return sinks.append_scores_path(rows, path)


@add("export_csv_roundtrip", None)
def _(spark, sf_dir):
    model = trained(spark, sf_dir).model
    out = scoring.cohort_export(scoring_rows(spark, sf_dir), model)
    path = f"{shared_folder(spark)}/export-{uuid.uuid4().hex}"
    sinks.export_csv(out, path)
    schema = ", ".join(f"{name} {kind}" for name, kind in out.dtypes)
    return readers.read_csv(spark, path, schema, index_column=None)


@add("model_roundtrip", None)
def _(spark, sf_dir):
    """Scores of a project written to disk and read back."""
    path = f"{shared_folder(spark)}/project-{uuid.uuid4().hex}"
    project.save_project(trained(spark, sf_dir).model, path, spark)
    return scoring.score_accounts(scoring_rows(spark, sf_dir), project.load_project(spark, path))


@add(
    "union_sources",
    "account_id i, churn_90d n, part s",
    "select account_id, churn_90d, 'md' as part from training_frame union all "
    "select account_id, churn_90d, 'sc' as part from scoring_frame",
)
def _(spark, sf_dir):
    first = training_frame(spark, sf_dir).withColumn("part", F.lit("md")).drop("md_sc_f")
    second = scoring_rows(spark, sf_dir).withColumn("part", F.lit("sc"))
    return readers.append_rows(first, second)


@add("preview", "account_key i, site s, contacts d4", "select account_key, site, contacts from all_cohort order by account_key limit 20")
def _(spark, sf_dir):
    rows = cohort.select_cohort(b.accounts(spark, sf_dir), b.profiles(spark, sf_dir), b.OPTIONS)
    return readers.preview(rows, 20, "account_key")


@add(
    "repeated_keys",
    "user_id i, stamp s, rows i",
    "select user_id, strftime(stamp_to_send, '%Y-%m-%d %H:%M:%S') as stamp, count(*) as rows from messages "
    "group by user_id, stamp_to_send having count(*) > 1",
)
def _(spark, sf_dir):
    found = sinks.repeated_keys(b.messages(spark, sf_dir), ["user_id", "stamp_to_send"])
    return found.withColumn("stamp", F.date_format("stamp_to_send", "yyyy-MM-dd HH:mm:ss"))


# --- company names ------------------------------------------------------------------------------------

_WORDS = """
    select account_id, unnest(regexp_extract_all(regexp_replace(regexp_replace(lower(company_name), '[.,]', ' ', 'g'),
      '[0-9]', '', 'g'), '[\\p{L}\\p{N}'']+')) as word from accounts"""


@add("name_words", "account_id i, word s", _WORDS)
def _(spark, sf_dir):
    return names.name_words(b.accounts(spark, sf_dir))


@add(
    "name_scores",
    "account_id i, word s, score d6",
    f"""select w.account_id, w.word, s.score from ({_WORDS}) w left join (
      select lower(c_mktsegment) as word, avg(c_acctbal) as score from customer group by 1) s on w.word = s.word
    where w.word not in (select lower(regexp_replace(n_name, '[0-9]', '', 'g')) from nation)""",
)
def _(spark, sf_dir):
    words = names.name_words(b.accounts(spark, sf_dir))
    stops = b.table(spark, sf_dir, "nation").select(
        F.lower(F.regexp_replace("n_name", "[0-9]", "")).alias("word")
    )
    scores = (
        b.table(spark, sf_dir, "customer")
        .groupBy(F.lower("c_mktsegment").alias("word"))
        .agg(F.avg("c_acctbal").alias("score"))
    )
    return names.score_words(words, stops, scores)
