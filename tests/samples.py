"""Hand-made rows for the logical tables."""

import datetime as dt

from ebbtide.sources import schemas


def account(key, **values):
    base = {name: None for name in schemas.column_names(schemas.ACCOUNTS)}
    base.update(
        account_key=key,
        site="shop",
        account_id=key,
        first_usage_units=dt.date(2018, 6, 1),
        email=f"u{key}@mail.test",
    )
    base.update(values)
    return tuple(base.values())


def accounts(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.ACCOUNTS)


def profiles(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.PROFILES)


def dim(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.ACCOUNT_DIM)


def epoch(*ymd_hms):
    return int(dt.datetime(*ymd_hms, tzinfo=dt.timezone.utc).timestamp())


def usage(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.USAGE_FACT)


def packages(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.PACKAGE_LOG)


def messages(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.MESSAGES)


def keyed(df, *keys):
    """Rows as dicts by key tuple (or single key)."""
    out = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys)
        out[key[0] if len(key) == 1 else key] = row.asDict()
    return out
