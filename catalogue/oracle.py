"""DuckDB SQL for the same results, composed from named common table expressions."""

from __future__ import annotations

import re

from ebbtide.functions.text import KEYWORDS
from ebbtide.operators.cohort import LEADING, MIDDLE, TRAILING

from .bindings import OPTIONS

DAY = (
    "(date '1995-01-01' + cast(floor(date_diff('day', date '1995-01-01', cast({c} as date)) / 52.0) as integer))"
)
CREDITS = "case when lang = 'de' then 'NA' when lang = 'es' then null else cast(n_chars as varchar) end"
PROP = "cast(json_extract_string(props, '$.k') as bigint)"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def keyword_case(name: str, message: str = "lower(message)", paid: str = "paid") -> str:
    pattern = quoted("(?s)" + KEYWORDS[name])
    return f"case when regexp_matches({message}, {pattern}) then {paid} else 0.0 end"


SUMMED = [name for name in KEYWORDS if name != "tm_test"]
PAID = "coalesce(try_cast(credits as double), 0.0)"

COHORT_COLUMNS = [
    *LEADING, "usage", *MIDDLE, "start_month", "is_api", "is_api_developer", "first_usage_units_month",
    *TRAILING, "phone_f", "email_f",
]


def _cohort(window: str = "") -> str:
    picked = ", ".join("a." + c for c in LEADING) + ", p.usage, " + ", ".join("a." + c for c in MIDDLE)
    picked += ", month(a.start_date) as start_month, a.is_api, a.is_api_developer"
    picked += ", month(a.first_usage_units) as first_usage_units_month, "
    picked += ", ".join("a." + c for c in TRAILING)
    return f"""
    select distinct {picked},
      case when a.phone is not null then 1 else 0 end as phone_f,
      case when a.email is not null and a.email like '%@%' then 1 else 0 end as email_f
    from accounts a left join profiles p on a.account_id = p.userid
    where lower(a.site) not in ('nation_3', 'nation_7')
      and lower(a.email) not like '%internal.example%'
      and lower(a.email) not like '%partner.example%' {window}"""


def grid_columns(measures: list[str], days: int = 7) -> str:
    prefix = {"usage_units_d": "uu_d", "usage_dollars_d": "ud_d", "pkgs_d": "pkgs_d", "rpct_d": "rpct_d", "capn_d": "capn_d"}
    return ", ".join(
        f"sum(case when days_after = {d} then {m} else 0 end) as {prefix[m]}{d + 1}"
        for m in measures
        for d in range(days)
    )


def usage_by_day(cohort: str, dim: str, fact: str, categories: str) -> str:
    return f"""
    select c.account_key, date_diff('day', c.first_usage_units, f.day) as days_after,
      sum(f.usage_units) as usage_units_d, sum(f.usage_dollars) as usage_dollars_d
    from {cohort} c join {dim} d on lower(d.site) = lower(c.site) and d.account_id = c.account_id
    left join (select *, cast(to_timestamp(processdate_est_key) at time zone 'UTC' as date) as day from {fact}) f
      on f.account_key = d.account_key and lower(f.category) in ({categories})
      and date_diff('day', c.first_usage_units, f.day) between 0 and 6
    group by 1, 2"""


def packages_by_day(cohort: str, log: str) -> str:
    return f"""
    select c.account_key, date_diff('day', c.first_usage_units, cast(u.createdat as date)) as days_after,
      count(distinct u.packageid) as pkgs_d
    from {cohort} c join {log} u on c.account_id = u.userid
      and date_diff('day', c.first_usage_units, cast(u.createdat as date)) between 0 and 6
    group by 1, 2"""


def campaigns_by_day(cohort: str, source: str) -> str:
    return f"""
    select c.account_key, date_diff('day', c.first_usage_units, cast(m.stamp_to_send as date)) as days_after,
      sum(m.recipients_count) as rpct_d, count(m.id) as capn_d
    from {cohort} c join {source} m on c.account_id = m.user_id
      and date_diff('day', c.first_usage_units, cast(m.stamp_to_send as date)) between 0 and 6
    group by 1, 2"""


def first_messages(cohort: str, source: str, extra: str = "") -> str:
    return f"""
    select distinct m.user_id, m.recipients_count, m.message, m.credits, m.stamp_to_send
    from {cohort} c join {source} m on c.account_id = m.user_id
      and date_diff('day', c.first_usage_units, cast(m.stamp_to_send as date)) between 0 and 6 {extra}"""


def keyword_sums(source: str) -> str:
    sums = ", ".join(f"sum({keyword_case(n)}) as {n}" for n in SUMMED)
    return f"select user_id as account_id, {sums} from (select *, {PAID} as paid from {source}) group by 1"


GRIDS = {
    "usage_grid": ["usage_units_d", "usage_dollars_d"],
    "package_grid": ["pkgs_d"],
    "campaign_grid": ["rpct_d", "capn_d"],
}
GRID_NAMES = [
    f"{p}_d{d}" for p in ("uu", "ud", "pkgs", "rpct", "capn") for d in range(1, 8)
]


def assembled(cohort: str, tail: str) -> str:
    base = ", ".join(
        "coalesce(b.industry, 'NA') as industry" if c == "industry" else f"b.{c}" for c in COHORT_COLUMNS
    )
    base += ", b.churn_90d, b.churn_1d" + tail
    return (
        f"select {base}, {', '.join(GRID_NAMES)}, {', '.join('k.' + n for n in SUMMED)} from {cohort} b "
        f"left join usage_grid_{cohort} u on b.account_key = u.account_key "
        f"left join package_grid_{cohort} p on b.account_key = p.account_key "
        f"left join campaign_grid_{cohort} g on b.account_key = g.account_key "
        f"left join keywords_{cohort} k on b.account_id = k.account_id"
    )


# name -> SQL; a name used inside another's SQL is found by its word.
CTE: dict[str, str] = {
    "spans": """
    select o_custkey, min(o_orderdate) as first_ts, max(o_orderdate) as last_ts,
      cast(count(*) as double) as n_orders, cast(count(distinct o_orderpriority) as double) as n_priorities,
      max(o_totalprice) as top_price, min(o_totalprice) as low_price,
      sum(case when o_orderstatus = 'F' then 1.0::double else 0.0 end) as n_filled,
      sum(case when o_orderpriority = '1-URGENT' then 1.0::double else 0.0 end) as n_urgent
    from orders group by 1""",
    "accounts": f"""
    select c_custkey + 1000000 as account_key, n_name as site, c_custkey as account_id,
      {DAY.format(c='first_ts')} as first_usage_units,
      case when last_ts < timestamp '2001-06-01' then {DAY.format(c='last_ts')} end as last_usage_units,
      c_name || ', ' || c_mktsegment || '. ' || n_name as company_name,
      cast(c_nationkey as bigint) as company_id,
      case when c_acctbal >= 500 then '+1-' || c_custkey end as phone,
      case when c_acctbal > 9700 then null
           when c_nationkey = 5 then 'U' || c_custkey || '@INTERNAL.example'
           when c_mktsegment = 'FURNITURE' and c_acctbal < 1000 then 'unknown'
           else 'u' || c_custkey || '@mail.example' end as email,
      r_name as attribution_source,
      case when c_nationkey < 12 then 1 else 0 end as mobile_signup, 'main' as brand_used,
      case when c_acctbal >= 0 then c_mktsegment end as industry,
      c_name as city, n_name as state, r_name as country,
      {DAY.format(c='first_ts')} - 3 as start_date,
      case when c_nationkey < 3 then 1 else 0 end as is_api, 0 as is_api_developer,
      case when c_acctbal >= 0 then c_acctbal end as first_month_revenue,
      n_orders as contacts, n_priorities as number_of_contacts,
      case when c_acctbal < 3000 then 1 else 0 end as is_freemium_at_signup,
      case when c_acctbal > 6000 then floor(c_acctbal / 1000) end as customer_satisfaction_pendo,
      case when c_acctbal > 3000 then floor(c_acctbal / 2500) end as customer_service_survey_rating,
      top_price as keywords_all, low_price as keywords_purchased,
      n_filled as keyword_optins, n_urgent as sms_keyword_in,
      case when n_priorities >= 5 then 'mixed' else 'narrow' end as primary_sms_usecase,
      c_name as example_sms, cast(null as varchar) as google_sms_example,
      lower(c_mktsegment) as google_sms_class, c_acctbal / 10000 as google_sms_class_confidence
    from customer join spans on c_custkey = o_custkey
      join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "profiles": """
    select s_suppkey as userid, case when s_acctbal > 4500 then 'Marketing' else 'Alerts' end as usage
    from supplier""",
    "account_dim": """
    select c_custkey + 1000000 as account_key, lower(n_name) as site, c_custkey as account_id
    from customer join nation on c_nationkey = n_nationkey where c_acctbal >= 500""",
    "order_lines": f"""
    select *, {DAY.format(c='o_orderdate')} as day from lineitem join orders on l_orderkey = o_orderkey""",
    "usage_fact": """
    select o_custkey + 1000000 as account_key,
      date_diff('day', date '1970-01-01', day) * 86400 + l_linenumber * 3600 as processdate_est_key,
      case when l_returnflag = 'A' then 'SMS' when l_returnflag = 'N' then 'mms' else 'voice' end as category,
      l_quantity as usage_units, l_extendedprice * (1 - l_discount) as usage_dollars
    from order_lines""",
    "package_log": """
    select o_custkey as userid, cast(day as timestamp) + to_hours(l_linenumber) as createdat,
      l_suppkey as packageid from order_lines""",
    "messages": f"""
    select l_orderkey * 10 + l_linenumber as id, o_custkey as user_id,
      case when o_orderpriority <> '5-LOW' then cast(floor(o_totalprice / 1000) as bigint) end as recipients_count,
      text as message, {CREDITS} as credits, cast(day as timestamp) as stamp_to_send
    from (select *, o_orderkey % (select max(doc_id) + 1 from documents) as sent from order_lines)
      join documents on sent = doc_id""",
    "newest": "select max(first_usage_units) as as_of from accounts",
    "all_cohort": _cohort(),
    "filled": """
    select * replace (case when last_usage_units is null and first_usage_units is not null
      then as_of else last_usage_units end as last_usage_units) from all_cohort cross join newest""",
    "labelled": """
    select *, case when first_usage_units is not null then
        case when date_diff('day', first_usage_units, last_usage_units) <= 35 then 1 else 0 end end as churn_90d,
      case when first_usage_units is not null then
        case when date_diff('day', first_usage_units, last_usage_units) = 0 then 1 else 0 end end as churn_1d
    from filled""",
    "with_role": """
    select *, case
        when first_usage_units < cast(as_of - interval 1 month as date) and churn_90d is not null then 'md'
        when first_usage_units >= as_of - 35 and first_usage_units <= as_of - 7 then 'sc'
        else 'na' end as md_sc_f
    from labelled""",
    "modelled": """
    select * exclude (as_of) from with_role
    where md_sc_f <> 'na' and not coalesce(first_usage_units < date '1995-01-02', false)""",
    "recent": _cohort(
        "and a.first_usage_units >= (select as_of - 35 from newest) "
        "and a.first_usage_units <= (select as_of - 7 from newest)"
    ),
    "scoring": "select *, cast(null as integer) as churn_90d, cast(null as integer) as churn_1d from recent",
    "training_frame": assembled("modelled", ", b.md_sc_f"),
    "scoring_frame": assembled("scoring", ""),
    # users of the event stream
    "users": """
    select user_id as account_key, 'Main' as site, user_id as account_id,
      cast(min(ts) as date) as first_usage_units, cast(max(ts) as date) as last_usage_units
    from events group by user_id""",
    "user_dim": "select distinct user_id as account_key, 'main' as site, user_id as account_id from events",
    "user_usage": f"""
    select user_id as account_key, cast(floor(epoch(ts)) as bigint) as processdate_est_key,
      upper(event_type) as category, value as usage_units, value * {PROP} as usage_dollars from events""",
    "user_packages": f"select user_id as userid, ts as createdat, {PROP} as packageid from events",
    "user_campaigns": f"""
    select event_id as id, user_id, case when {PROP} >= 20 then {PROP} end as recipients_count,
      ts as stamp_to_send from events where event_type = 'purchase'""",
    "user_messages": f"""
    select event_id as id, user_id, case when {PROP} >= 20 then {PROP} end as recipients_count,
      text as message, {CREDITS} as credits, ts as stamp_to_send
    from (select *, event_id % (select max(doc_id) + 1 from documents) as sent from events)
      join documents on sent = doc_id""",
    # rows with a given score
    "scored_accounts": """
    select account_id, churn_90d as Response, contacts, keywords_all, number_of_contacts, md_sc_f as cohort,
      floor(1000 * (0.5::double * (1 - least(contacts, 20) / 20.0::double)
        + 0.5::double * coalesce(first_month_revenue, 0) / 10000.0::double)) / 1000.0::double as score
    from modelled""",
    "scored_lines": """
    select case when l_returnflag = 'R' then 1 else 0 end as Response,
      least(1.0::double, l_extendedprice / 110000) as score, l_quantity, l_discount, l_tax, l_linestatus as cohort
    from lineitem""",
    "model_rows": "select * rename (churn_90d as Response) from training_frame where md_sc_f = 'md'",
    "split_rows": f"""
    select *, case when row_number() over (partition by Response
        order by md5(cast(account_id as varchar) || '|{OPTIONS.split_seed}'), account_id)
        <= ceil(0.7 * count(*) over (partition by Response)) then 'train' else 'test' end as split
    from model_rows""",
    "train_rows": "select * exclude (split) from split_rows where split = 'train'",
    "test_rows": "select * exclude (split) from split_rows where split = 'test'",
}
for _cohort_name in ("modelled", "scoring"):
    CTE[f"usage_day_{_cohort_name}"] = usage_by_day(_cohort_name, "account_dim", "usage_fact", "'sms', 'mms'")
    CTE[f"package_day_{_cohort_name}"] = packages_by_day(_cohort_name, "package_log")
    CTE[f"campaign_day_{_cohort_name}"] = campaigns_by_day(_cohort_name, "messages")
    CTE[f"first_messages_{_cohort_name}"] = first_messages(_cohort_name, "messages")
    CTE[f"keywords_{_cohort_name}"] = keyword_sums(f"first_messages_{_cohort_name}")
    for _grid, _measures in GRIDS.items():
        _days = _grid.replace("grid", "day")
        CTE[f"{_grid}_{_cohort_name}"] = (
            f"select account_key, {grid_columns(_measures)} from {_days}_{_cohort_name} group by 1"
        )
CTE["usage_day_users"] = usage_by_day("users", "user_dim", "user_usage", "'click', 'view'")
CTE["package_day_users"] = packages_by_day("users", "user_packages")
CTE["campaign_day_users"] = campaigns_by_day("users", "user_campaigns")
CTE["first_messages_users"] = first_messages("users", "user_messages")
CTE["keywords_users"] = keyword_sums("first_messages_users")


def query(sql: str, **extra: str) -> str:
    """``sql`` preceded by the table expressions it needs, in order."""
    local = dict(extra)
    ordered: list[str] = []
    bodies: dict[str, str] = {}

    def visit(text: str) -> None:
        words = set(re.findall(r"[A-Za-z_0-9]+", text))
        for name in [*CTE, *local]:
            if name in words and name not in bodies:
                bodies[name] = local.get(name) or CTE[name]
                visit(bodies[name])
                ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    return "with " + ",\n".join(f"{name} as ({bodies[name]})" for name in ordered) + "\n" + sql
