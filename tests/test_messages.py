import datetime as dt
import random
import re

from pyspark.sql import functions as F

from ebbtide import Options
from ebbtide.functions.text import KEYWORDS, matches
from ebbtide.operators import activity, messages as m

from samples import account, accounts, keyed, messages

OPTIONS = Options()
FIRST = dt.date(2018, 12, 25)
SENT = dt.datetime(2018, 12, 26, 8)
SAMPLES = {
    "tm_test": "a test",
    "tm_stopopt": "reply OPTOUT",
    "tm_dnr": "do-not-reply",
    "tm_percoff": "5% off",
    "tm_dayevnt": "Tonight only",
    "tm_sale": "anything",
    "tm_vote": "the polls",
    "tm_ofyear": "deal of the year",
    "tm_store": "in store",
    "tm_quote": "get a quote",
    "tm_admiss": "free admission",
    "tm_http": "x\ncom",
    "tm_call": "msg us",
    "tm_event": "a party",
    "tm_coupon": "offers expire",
    "tm_hire": "new career",
    "tm_majevnt": "Black Friday",
    "tm_backtsch": "back to school",
    "tm_pushsale": "Don't wait",
    "tm_prize": "bonus",
    "tm_signup": "sign up",
    "tm_taxref": "tax",
    "tm_property": "real estate",
    "tm_refer": "refer",
    "tm_auction": "auction",
    "tm_congrats": "congrats",
    "tm_urgent": "urgent",
    "tm_donate": "donate",
}


def test_every_keyword(spark):
    rows = [(i, 1, 1, text, 2.0, SENT) for i, text in enumerate(SAMPLES.values())]
    rows += [(100, 1, 1, "", 2.0, SENT), (101, 1, 1, None, 2.0, SENT), (102, 1, 1, "com net", 2.0, SENT)]
    got = keyed(m.keyword_flags(messages(spark, *rows)), "id")
    for i, name in enumerate(SAMPLES):
        assert got[i][name] == 2.0, name
        assert got[i]["tm_sale"] == 2.0
    assert got[100]["tm_sale"] == 2.0 and sum(got[100][n] for n in KEYWORDS) == 2.0
    assert sum(got[101][n] for n in KEYWORDS) == 0.0
    assert got[102]["tm_http"] == 2.0  # " net" is any character, then net


def test_patterns_equal_regular_expressions(spark):
    """Byte searches against Python's regular expressions on random texts."""
    rng = random.Random(5)
    words = sorted({w for p in KEYWORDS.values() for w in re.split(r"[|]", p)} - {"$"})
    bits = words + ["com", "net", ".com", "\n", " ", "x", "stor", "é", "saleé", "%", "'", "don", "t wait"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 4))) for _ in range(600)] + ["com", "net", "acom"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    extra = {"custom": "a+b|sto?p", "dotted": ".x|y"}
    patterns = {**KEYWORDS, **extra}
    got = keyed(df.select("i", *[matches(F.col("t"), p).alias(n) for n, p in patterns.items()]), "i")
    for i, text in enumerate(texts):
        for name, pattern in patterns.items():
            assert got[i][name] == bool(re.search(pattern, text, re.S)), (name, text)


def days(spark, *rows):
    return m.message_days(messages(spark, *rows))


def test_copies_count_once_for_keywords_and_each_for_campaigns(spark):
    rows = [
        (1, 1, 10, "Sale", 3.0, SENT),
        (2, 1, 10, "Sale", 3.0, SENT),
        (3, 1, 10, "Sale", 3.0, SENT + dt.timedelta(hours=1)),
        (4, 1, 10, "sale", 3.0, SENT),
    ]
    got = days(spark, *rows).first()
    assert (got["capn_d"], got["rpct_d"], got["tm_sale"]) == (4, 40, 9.0)
    assert m.distinct_messages(messages(spark, *rows)).count() == 3


def test_one_pass_equals_separate_passes(spark):
    rng = random.Random(3)
    rows = [
        (
            i,
            rng.randint(1, 5),
            rng.choice([None, 1, 2]),
            rng.choice(["call now", "free gift", None, ""]),
            rng.choice([1.0, None, 2.5]),
            SENT + dt.timedelta(days=rng.randint(0, 3)),
        )
        for i in range(400)
    ]
    sent = messages(spark, *rows)
    both = keyed(m.message_days(sent), "fact_key", "day")
    campaigns = keyed(activity.campaign_days(sent), "fact_key", "day")
    flags = (
        m.keyword_flags(m.distinct_messages(sent))
        .groupBy("user_id", F.to_date("stamp_to_send").alias("day"))
        .agg(*[F.sum(n).alias(n) for n in m.SUMMED])
    )
    keywords = keyed(flags, "user_id", "day")
    assert both.keys() == campaigns.keys() == keywords.keys()
    for key, row in both.items():
        assert (row["rpct_d"], row["capn_d"]) == (campaigns[key]["rpct_d"], campaigns[key]["capn_d"])
        assert all(row[n] == keywords[key][n] for n in m.SUMMED)


def test_missing_credits_are_zero(spark):
    text = "id long, user_id long, recipients_count long, message string, credits string, stamp_to_send timestamp_ntz"
    rows = [(1, 1, 1, "x", "NA", SENT), (2, 1, 1, "x", None, SENT), (3, 1, 1, "x", "4", SENT)]
    got = m.message_days(spark.createDataFrame(rows, text)).first()
    assert got["tm_sale"] == 4.0


def test_features_per_account_id(spark):
    base = accounts(
        spark,
        account(1, account_id=7, first_usage_units=FIRST),
        account(2, account_id=7, first_usage_units=FIRST + dt.timedelta(days=1)),
        account(3, account_id=8, first_usage_units=FIRST),
    )
    sent = days(
        spark,
        (1, 7, 1, "call", 2.0, SENT),  # inside both windows of id 7
        (2, 7, 1, "call", 4.0, SENT + dt.timedelta(days=6)),  # day 7 of the first, day 6 of the second
        (3, 7, 1, "call", 8.0, SENT + dt.timedelta(days=7)),  # after both
        (4, 8, 1, "call", 1.0, dt.datetime(2018, 12, 24, 23, 59)),
    )
    got = keyed(m.keyword_features(base, sent, OPTIONS), "account_id")
    assert set(got) == {7}
    assert got[7]["tm_call"] == 6.0
    assert "tm_test" not in got[7]


def test_texts_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "messages")
    messages(spark, (1, 7, 1, "call", 2.0, SENT)).write.parquet(path)
    plan = m.message_days(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("message#" in line for line in exchanges)
