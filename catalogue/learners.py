"""Queries about the learners, the fits on scores, the prepared frames and the way back from disk."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ebbtide.operators import bagging, boosting, calibration, evaluation, forest, levels, ranking
from ebbtide.plans import scoring, training
from ebbtide.session import shared_folder, stage
from ebbtide.sources import project, readers, sinks

from . import bindings as b
from . import queries as q
from .queries import QUERIES, RESPONSE, add, once

__all__ = ["QUERIES"]

OPTIONS = b.OPTIONS

# --- draws and trees ------------------------------------------------------------------------------

_TREES = OPTIONS.forest_trees[0]


@add(
    "forest_draws",
    "tree i, account_id i, times i",
    f"""
    with labelled as (select account_id, Response as class from train_rows where Response is not null),
    sizes as (select class, count(*) as n from labelled group by 1),
    per as (select greatest(1, least(round_even(sum(class) * {OPTIONS.forest_sample_share}::double, 0),
      {OPTIONS.forest_sample_most}))::bigint as s from labelled),
    numbered as (
      select *, row_number() over (partition by class order by
        md5(account_id || '|{OPTIONS.learner_seed}') || '|' || account_id) - 1 as position from labelled),
    draws as (select tree, class, unnest(range(s)) as k from range({_TREES}) t(tree), sizes, per)
    select tree, account_id, count(*) as times from (
      select tree, d.class,
        ('0x' || substr(md5('{OPTIONS.learner_seed}|' || tree || '|' || d.class || '|' || k), 1, 13))::bigint % n as position
      from draws d join sizes using (class)) join numbered using (class, position) group by 1, 2""",
)
def _(spark, sf_dir):
    rows = q.train_rows(spark, sf_dir)
    sizes = forest.class_sizes(rows, RESPONSE)
    per_class = bagging.sample_size(sizes[0], OPTIONS)
    drawn = bagging.draw_rows(rows, RESPONSE, "account_id", _TREES, sizes, per_class, OPTIONS.learner_seed)
    return drawn.withColumnRenamed("id", "account_id")


@add("out_of_bag_scores", None)
def _(spark, sf_dir):
    done = q.trained(spark, sf_dir)
    scored = bagging.out_of_bag_scores(done.prepared.train, done.model.forest, "account_id", forest.RAW)
    return scored.select("account_id", RESPONSE, forest.RAW)


@add("out_of_bag_importance", None)
def _(spark, sf_dir):
    done = q.trained(spark, sf_dir)
    accuracy = bagging.out_of_bag_importance(done.prepared.train, done.first, RESPONSE, OPTIONS)
    return accuracy.join(bagging.gini_decrease(done.first, spark), "variable")


# --- boosting -------------------------------------------------------------------------------------


@add("adaboost_challenger", None)
def _(spark, sf_dir):
    done = q.trained(spark, sf_dir)
    numeric, categorical = forest.split_kinds(done.model.scope, done.prepared.categorical)
    model = boosting.fit_adaboost(done.prepared.train, numeric, categorical, RESPONSE, OPTIONS)
    return done.prepared.test.select("account_id", RESPONSE, model.score().alias("boosted_score"))


#: Rules whose votes stand for three rounds' trees, alike in both engines.
_RULES = ["l_quantity > 25", "l_linestatus = 'F'", "l_partkey % 40 > 20"]
_LINES = """select l_quantity, l_linestatus, l_partkey,
  case when l_quantity + case when l_linestatus = 'F' then 20 else 0 end + l_partkey % 40 > 60 then 1 else 0 end as Response,
  (l_quantity + case when l_linestatus = 'F' then 20 else 0 end + 50 * l_tax) / 80 as score from lineitem"""


@once
def separable_lines(spark, sf_dir) -> DataFrame:
    """Line items with a response that a score from quantity, status and tax tells something about."""
    b.table(spark, sf_dir, "lineitem").createOrReplaceTempView("separable_source")
    return stage(spark.sql(_LINES.replace("from lineitem", "from separable_source")), "separable")


def _rounds_sql(shrinkage: float) -> str:
    steps = [f"w0 as (select l.*, 1.0::double / count(*) over () as weight from ({_LINES}) l)"]
    for k, rule in enumerate(_RULES):
        steps.append(
            f"e{k} as (select sum(case when ({rule}) <> (Response = 1) then weight else 0 end) / sum(weight) as e from w{k})"
        )
        steps.append(f"a{k} as (select e, {shrinkage}::double * 0.5 * ln((1 - e) / e) as a from e{k})")
        steps.append(
            f"w{k + 1} as (select w{k}.* replace (weight * case when ({rule}) <> (Response = 1) then exp(a) else exp(-a) end "
            f"/ (e * exp(a) + (1 - e) * exp(-a)) as weight) from w{k}, a{k})"
        )
    last = len(_RULES)
    return (
        "with "
        + ", ".join(steps)
        + f" select l_quantity, l_linestatus, Response, count(*) as n, sum(weight) * 1000 as weight from w{last} group by 1, 2, 3"
    )


@add("boost_rounds_lines", "l_quantity d2, l_linestatus s, Response i, n i, weight d6", _rounds_sql(0.5))
def _(spark, sf_dir):
    rows = separable_lines(spark, sf_dir)
    rows = rows.withColumn("weight", F.lit(1.0 / rows.count()))
    for rule in _RULES:
        wrong = F.expr(rule) != (F.col("Response") == 1)
        rows = rows.withColumn("weight", boosting.reweighted(wrong, boosting.weighted_error(rows, wrong), 0.5))
    return rows.groupBy("l_quantity", "l_linestatus", "Response").agg(
        F.count(F.lit(1)).alias("n"), (F.sum("weight") * 1000).alias("weight")
    )


# --- fits on scores -------------------------------------------------------------------------------


@add(
    "split_statistic_lines",
    "n i, statistic d4, cut d6, cut_statistic d4, cut_n i, cut_goods i",
    f"""
    with c as (select score as x, count(*) as n, sum(Response) as g from ({_LINES}) group by 1),
    t as (select sum(n) as n, sum(g) as g, sum(x * n) as sx, sum(x * x * n) as sxx, sum(x * g) as sxy,
      sum(g)::double / sum(n) as rate from c),
    r as (select x, sum(n) over w as nl, sum(g) over w as gl from c window w as (order by x)),
    cuts as (select x, nl, gl, power(gl - nl * rate, 2) / (rate * (1 - rate) / (n - 1) * nl * (n - nl)) as s
      from r, t where nl >= ceil(0.01 * n) and n - nl >= ceil(0.01 * n))
    select t.n, power(sxy - rate * sx, 2) / (rate * (1 - rate) / (t.n - 1) * (t.n * sxx - sx * sx)) as statistic,
      x as cut, s as cut_statistic, nl as cut_n, gl as cut_goods
    from t, (select * from cuts order by s desc, x limit 1)""",
)
def _(spark, sf_dir):
    ranked = calibration.ranked_scores(separable_lines(spark, sf_dir), "score", RESPONSE)
    total = ranked.agg(F.sum("n").alias("n"), F.sum("goods").alias("g")).first()
    part = calibration.Part(None, 0, 0, total["n"], total["g"])
    least = -(-total["n"] // 100)
    return calibration.split_statistics(ranked, [part], least, 0.0).withColumn("n", F.lit(total["n"]))


def _newton_sql(source: str, steps: int = 15) -> str:
    def sums(k):
        return f"""(select any_value(a) as a, any_value(b) as b, sum(g - n * p) as ga, sum((g - n * p) * x) as gb,
          sum(n * p * (1 - p)) as h, sum(n * p * (1 - p) * x) as hx, sum(n * p * (1 - p) * x * x) as hxx
          from (select *, 1 / (1 + exp(-(a + b * x))) as p from c, s{k}))"""

    out = [
        f"c as materialized (select score as x, count(*) as n, sum(Response) as g from {source} "
        "where score is not null and Response is not null group by 1)",
        "s0 as (select 0.0::double as a, 0.0::double as b)",
    ]
    for k in range(steps):
        out.append(
            f"s{k + 1} as materialized (select a + (hxx * ga - hx * gb) / (h * hxx - hx * hx) as a, "
            f"b + (h * gb - hx * ga) / (h * hxx - hx * hx) as b from {sums(k)})"
        )
    return (
        "with "
        + ", ".join(out)
        + " select a as intercept, b as slope, sqrt(hxx / (h * hxx - hx * hx)) as intercept_error, "
        + f"sqrt(h / (h * hxx - hx * hx)) as slope_error from {sums(steps)}"
    )


def _density_sql(source: str, points: int = 512) -> str:
    return f"""
    with c as materialized (select score as x, count(*) as n from {source} where score is not null group by 1),
    s as materialized (select count(*) as total, min(score) as low, max(score) as high,
      0.9::double * least(stddev_samp(score), (quantile_cont(score, 0.75) - quantile_cont(score, 0.25)) / 1.34)
        * power(count(*), -0.2::double) as h from {source} where score is not null),
    g as materialized (select *, low - 3 * h as start, (high - low + 6 * h) / {points - 1} as step from s),
    p as (select n, (x - start) / step as place, floor((x - start) / step) as i from c, g),
    m as materialized (select i, sum(m) as m from (
      select i, n * (i + 1 - place) as m from p union all select i + 1, n * (place - i) from p) group by 1)
    select any_value(start + j * step) as x, sum(m * exp(-power((j - i) * step / h, 2) / 2))
      / any_value(total * h * sqrt(2 * pi())) as density, any_value(h) as bandwidth
    from range({points}) r(j), m, g group by j"""


for _suffix, _source, _sql in (
    ("", q.scored_accounts, "scored_accounts"),
    ("_lines", separable_lines, f"({_LINES})"),
):

    @add(f"calibration_fit{_suffix}", "intercept d4, slope d4, intercept_error d4, slope_error d4", _newton_sql(_sql))
    def _(spark, sf_dir, source=_source):
        curve = calibration.fit_calibration(source(spark, sf_dir), "score", RESPONSE)
        row = (curve.intercept, curve.slope, curve.intercept_error, curve.slope_error)
        return spark.createDataFrame([row], "intercept double, slope double, intercept_error double, slope_error double")

    @add(f"score_density{_suffix}", "x d6, density d6, bandwidth d6", _density_sql(_sql))
    def _(spark, sf_dir, source=_source):
        return evaluation.score_density(source(spark, sf_dir), "score")


@add("optimal_bins_separable", None)
def _(spark, sf_dir):
    return calibration.optimal_bins(separable_lines(spark, sf_dir), "score", RESPONSE, OPTIONS.optimal_bin_min_share)


# --- prepared frames ------------------------------------------------------------------------------

_CATEGORIES, _NUMBERS = q.CATEGORIES, q.NUMBER_COLUMNS
_MEDIAN = ", ".join(f"coalesce({c}, (select median({c}) from train_rows)) as {c}" for c in _NUMBERS)
_CLEAN = {
    part: f"(select account_id, Response, {', '.join(_CATEGORIES)}, {_MEDIAN} from {part}_rows)" for part in ("train", "test")
}
_ELIGIBLE = (
    f"select r.variable, type from ({q._ROLE_SQL}) r join ({q._missing_sql(q.TEXT_COLUMNS + _NUMBERS, 'train_rows')}) m "
    f"on r.variable = m.variable where type in ('num', 'cat') and missing_share <= {OPTIONS.max_missing_share}"
)
_PREPARED = f"""
    eligible as materialized ({_ELIGIBLE}),
    clean_train as materialized (select * from {_CLEAN['train']}),
    clean_test as materialized (select * from {_CLEAN['test']}),
    values_iv as materialized (select variable, sum(iv) as iv from ({q._woe_sql(_NUMBERS, _CATEGORIES, 'clean_train', 'Response')})
      where variable in (select variable from eligible) group by 1),
    failed as (select variable from values_iv where iv < {OPTIONS.iv_floor})"""


def _known_sql(alias: str, but_failed: bool = False) -> str:
    """Rows of ``alias`` whose levels of eligible categories were seen in training. Scored rows have no role column."""
    return " and ".join(
        f"('{c}' not in (select variable from eligible) "
        + (f"or '{c}' in (select variable from failed) " if but_failed else "")
        + f"or exists (select 1 from clean_train r where r.{c} is not distinct from {alias}.{c}))"
        for c in _CATEGORIES
        if c != "md_sc_f" or not but_failed
    )


def _long_sql(source: str) -> str:
    numbers = [f"select account_id, Response, '{c}' as variable, cast({c} as double) as number, cast(null as varchar) as level from {source}" for c in _NUMBERS]
    texts = [f"select account_id, Response, '{c}', cast(null as double), cast({c} as varchar) from {source}" for c in _CATEGORIES]
    return (
        f"select * from ({q._union(numbers + texts)}) where variable in (select variable from eligible) "
        "and variable not in (select variable from failed)"
    )


def _long(rows: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    values = [
        F.struct(F.lit(n).alias("variable"), F.col(n).cast("double").alias("number"), F.lit(None).cast("string").alias("level"))
        for n in numeric
    ] + [
        F.struct(F.lit(n).alias("variable"), F.lit(None).cast("double").alias("number"), F.col(n).cast("string").alias("level"))
        for n in categorical
    ]
    return rows.select("account_id", RESPONSE, F.inline(F.array(*values)))


@once
def prepared(spark, sf_dir) -> training.Prepared:
    """The frame with later days' activity, which must be kept out, prepared."""
    frame = q.training_frame(spark, sf_dir).withColumns(
        {"usage_units_d8": F.col("contacts") * 2, "pkgs_d14": F.col("keywords_all"), "uu_d9": F.col("churn_90d")}
    )
    return training.prepare(frame, OPTIONS)


_FRAME = "account_id i, Response n, variable s, number d4, level s"


@add("prepared_train", _FRAME, f"with {_PREPARED} {_long_sql('clean_train')}")
def _(spark, sf_dir):
    sets = prepared(spark, sf_dir)
    return _long(sets.train, sets.numeric, sets.categorical)


@add(
    "prepared_test",
    _FRAME,
    f"with {_PREPARED}, kept as materialized (select * from clean_test t where {_known_sql('t')}) {_long_sql('kept')}",
)
def _(spark, sf_dir):
    sets = prepared(spark, sf_dir)
    return _long(sets.test, sets.numeric, sets.categorical)


@add("prepared_iv", "variable s, iv d6", f"with {_PREPARED} select variable, iv from values_iv")
def _(spark, sf_dir):
    return prepared(spark, sf_dir).iv


@add(
    "medians_big",
    "variable s, median s",
    q._union(
        f"""select '{c}' as variable, cast(cast(min(x) + max(x) as decimal(36, 0)) * cast(0.5 as decimal(2, 1)) as varchar) as median
        from (select cast({c} as decimal(36, 0)) as x, row_number() over (order by {c}) as place, count(*) over () as n from ({q._BIG}))
        where place in ((n + 1) // 2, n // 2 + 1)"""
        for c in ("big", "wide")
    ),
)
def _(spark, sf_dir):
    """Medians of whole numbers and decimals that a double can't tell apart."""
    rows = b.table(spark, sf_dir, "lineitem").selectExpr(
        "9007199254740992 + l_orderkey as big",
        "cast(cast(l_orderkey as decimal(17, 0)) * 100000000000000000000 + l_linenumber as decimal(38, 0)) as wide",
    )
    return ranking.exact_medians(rows, ["big", "wide"])


_SCORED_CATEGORIES = [c for c in _CATEGORIES if c != "md_sc_f"]


@add(
    "scoring_losses",
    "variable s, rows i",
    q._union(
        [
            f"select '{c}' as variable, count(*) as rows from scoring_frame s "
            f"where not exists (select 1 from {q._SEEN_CTE} r where r.{c} is not distinct from s.{c})"
            for c in _SCORED_CATEGORIES
        ]
        + [
            "select null, count(*) from scoring_frame s where not ("
            + " and ".join(
                f"exists (select 1 from {q._SEEN_CTE} r where r.{c} is not distinct from s.{c})" for c in _SCORED_CATEGORIES
            )
            + ")"
        ]
    ),
)
def _(spark, sf_dir):
    """Accounts to be scored that drop out for a value unseen in training, counted while the others pass."""
    train = q.train_rows(spark, sf_dir).filter("country <> 'ASIA'")
    known = levels.learn_levels(train, _SCORED_CATEGORIES, OPTIONS.max_levels)
    losses = Observation()
    kept = levels.keep_known(q.scoring_rows(spark, sf_dir), known, losses)
    kept.write.format("noop").mode("overwrite").save()
    return levels.loss_report(losses, spark)


@add(
    "messages_csv",
    "doc_id i, source s, digest s",
    "select doc_id, source, md5(text) as digest from documents",
)
def _(spark, sf_dir):
    """All documents, written with their line breaks and read back in pieces."""
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    b.table(spark, sf_dir, "documents").select("doc_id", "source", "text").write.csv(path, header=True, nullValue="NA", escape='"')
    back = readers.read_quoted_csv(spark, path, "doc_id long, source string, text string", None)
    return back.select("doc_id", "source", F.md5("text").alias("digest"))


# --- scores on their way ----------------------------------------------------------------------------

_SCORED = f"with {_PREPARED} select s.* from scoring_frame s where {_known_sql('s', True)}"
_DAY = f"date '{q.EFFECTIVE.isoformat()}'"


@add(
    "score_rows",
    "account_id i, first_usage_units t, efft_d t, in_range i",
    f"select account_id, first_usage_units, {_DAY} as efft_d, 1 as in_range from ({_SCORED})",
)
def _(spark, sf_dir):
    out = scoring.score_output(q.scoring_rows(spark, sf_dir), q.trained(spark, sf_dir).model, q.EFFECTIVE)
    return out.withColumn("in_range", F.col("churn_90d_score").between(0, 1).cast("int"))


@add(
    "score_sink_rows",
    "account_id i, first_usage_units t, efft_d t, n i, first i",
    f"select account_id, first_usage_units, {_DAY} as efft_d, 1 as n, 1 as first from ({_SCORED})",
)
def _(spark, sf_dir):
    """Two runs, the second a day later and with other scores: each account keeps the first run's row."""
    path = f"{shared_folder(spark)}/sink-{uuid.uuid4().hex}"
    rows = stage(scoring.score_output(q.scoring_rows(spark, sf_dir), q.trained(spark, sf_dir).model, q.EFFECTIVE), "sink-rows")
    sinks.append_scores_path(rows, path)
    later = rows.withColumn("efft_d", F.date_add("efft_d", 1)).withColumn("churn_90d_score", F.lit(2.0))
    table = sinks.append_scores_path(later, path)
    return table.groupBy("account_id", "first_usage_units", "efft_d").agg(
        F.count(F.lit(1)).alias("n"), F.max((F.col("churn_90d_score") <= 1).cast("int")).alias("first")
    )


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """How many rows there are, and how many stand on one side only, repeats counted."""
    both = left.exceptAll(right).unionByName(right.exceptAll(left))
    return left.agg(F.count(F.lit(1)).alias("rows")).join(both.agg(F.count(F.lit(1)).alias("differing")))


@add("export_csv_diff", "rows i, differing i", f"select count(*) as rows, 0 as differing from ({_SCORED})")
def _(spark, sf_dir):
    """The export, read back, against the rows that were exported. In this format the text NA is a missing value."""
    out = stage(scoring.cohort_export(q.scoring_rows(spark, sf_dir), q.trained(spark, sf_dir).model), "export-rows")
    path = f"{shared_folder(spark)}/export-{uuid.uuid4().hex}"
    sinks.export_csv(out, path)
    schema = ", ".join(f"{name} {kind}" for name, kind in out.dtypes)
    out = out.select(*[F.nullif(n, F.lit("NA")).alias(n) if kind == "string" else n for n, kind in out.dtypes])
    return _differing(out, readers.read_csv(spark, path, schema, index_column=None))


@add("model_roundtrip_diff", "rows i, differing i", f"select count(*) as rows, 0 as differing from ({_SCORED})")
def _(spark, sf_dir):
    """Scores of a saved project against those of the project in memory."""
    model = q.trained(spark, sf_dir).model
    path = f"{shared_folder(spark)}/project-{uuid.uuid4().hex}"
    project.save_project(model, path, spark)
    rows = q.scoring_rows(spark, sf_dir)
    return _differing(scoring.score_accounts(rows, model), scoring.score_accounts(rows, project.load_project(spark, path)))
