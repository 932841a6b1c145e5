"""Date arithmetic on columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_date(seconds: Column | str, time_zone: str = "UTC") -> Column:
    """Calendar date of an epoch-seconds column in ``time_zone``, whatever the session zone is."""
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    start = F.lit(dt.date(1970, 1, 1))
    if time_zone == "UTC":
        return F.date_add(start, F.floor(seconds / F.lit(86400)).cast("int"))
    moment = start.cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(time_zone), moment).cast("date")


def day_number(day: dt.date) -> int:
    """Days since 1970-01-01."""
    return (day - dt.date(1970, 1, 1)).days


def weeks_before(day: Column, weeks: int) -> Column:
    return F.date_sub(day, 7 * weeks)


def months_before(day: Column, months: int) -> Column:
    return F.add_months(day, -months)


def as_date(value: dt.date | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("date")
