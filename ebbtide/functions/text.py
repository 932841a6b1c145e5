"""Case-blind text tests and the message keyword table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keyword feature -> pattern over the lower-cased message. A dot stands for any
# character, line breaks included; "$" is the end of the message and so holds for every one.
KEYWORDS = {
    "tm_test": "test",
    "tm_stopopt": "stop|optout",
    "tm_dnr": "do not reply|do-not-reply",
    "tm_percoff": "%|special",
    "tm_dayevnt": "tonight|today|tomorrow|night",
    "tm_sale": "$|sale",
    "tm_vote": "vote|ballot|polls",
    "tm_ofyear": "of the year",
    "tm_store": "store",
    "tm_quote": "quote",
    "tm_admiss": "admission",
    "tm_http": "http|.com|.net",
    "tm_call": "call|message|msg|text",
    "tm_event": "event|rvsp|party",
    "tm_coupon": "coupon|special|expire",
    "tm_hire": "seeking|hire|employ|hiring|earn|career",
    "tm_majevnt": "christmas|halloween|black friday|labor day|valentine",
    "tm_backtsch": "back to school",
    "tm_pushsale": "still time|last chance|don't miss|days only|deadline|don't wait|dont wait|dont miss",
    "tm_prize": "prize|bonus|gift|free",
    "tm_signup": "sign up",
    "tm_taxref": "tax",
    "tm_property": "property|house agent|real estate",
    "tm_refer": "refer",
    "tm_auction": "auction",
    "tm_congrats": "congrat",
    "tm_urgent": "urgent",
    "tm_donate": "donate",
}

# Fixed value: computed per message but not summed per account.
UNSUMMED = ("tm_test",)

_REGEX_SIGNS = set(".^$*+?{}[]\\()")


def _plain(text: str) -> bool:
    return not _REGEX_SIGNS.intersection(text)


def matches(text: Column, pattern: str) -> Column:
    """True where ``pattern`` (alternatives split by ``|``) occurs in ``text``; NULL stays NULL.

    Plain alternatives become byte searches, about four times as fast as one regular
    expression per feature; anything else is left to ``rlike``.
    """
    tests, regexes = [], []
    parts = pattern.split("|")
    for part in parts:
        if any(other != part and _plain(other) and other in part for other in parts):
            continue  # "night" already finds "tonight"
        if part == "$":
            tests.append(F.length(text) >= 0)
        elif _plain(part):
            tests.append(text.contains(part))
        elif part.startswith(".") and _plain(part[1:]):
            # one character, then the rest: the rest anywhere but at the very start
            tests.append(F.substring(text, 2, 2**31 - 1).contains(part[1:]))
        else:
            regexes.append(part)
    if regexes:
        tests = [text.rlike("(?s)" + pattern)]
    return reduce(lambda left, right: left | right, tests)


def credits_value(column: str) -> Column:
    """Credits as a number; missing, or the text ``NA``, counts as 0."""
    return F.coalesce(F.col(column).cast("string").try_cast("double"), F.lit(0.0))


def contains_any(column: str, terms) -> Column:
    """Case-blind: NULL for a NULL text, as a chain of LIKEs gives."""
    lowered = F.lower(F.col(column))
    return reduce(lambda a, b: a | b, [lowered.contains(term.lower()) for term in terms])


def in_list(column: str, values) -> Column:
    """Case-blind membership."""
    return F.lower(F.col(column)).isin(*[value.lower() for value in values])


def is_missing(column: str, spark_type: str) -> Column:
    """NULL, and for floating columns NaN too."""
    test = F.col(column).isNull()
    if spark_type in ("double", "float"):
        test = test | F.isnan(F.col(column))
    return test
