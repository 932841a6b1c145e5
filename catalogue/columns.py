"""One description of a result's columns for both engines.

``"account_key i, rate d6"``: ``i`` whole number, ``n`` whole number that may be NULL (compared as
double), ``dK`` double rounded to K places, ``s`` text, ``t`` date as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _parts(spec: str) -> list[tuple[str, str]]:
    return [tuple(part.split()) for part in spec.split(",")]


def shape(df: DataFrame, spec: str) -> DataFrame:
    columns = []
    for name, kind in _parts(spec):
        value = F.col(name)
        if kind == "i":
            value = value.cast("long")
        elif kind == "n":
            value = value.cast("double")
        elif kind[0] == "d":
            value = F.round(value.cast("double").cast("decimal(38,12)"), int(kind[1:])).cast("double")
        else:
            value = value.cast("string")
        columns.append(value.alias(name))
    return df.select(*columns)


def shape_sql(sql: str, spec: str) -> str:
    columns = []
    for name, kind in _parts(spec):
        if kind == "i":
            value = f"cast({name} as bigint)"
        elif kind == "n":
            value = f"cast({name} as double)"
        elif kind[0] == "d":
            value = f"cast(round(cast(cast({name} as double) as decimal(38,12)), {kind[1:]}) as double)"
        else:
            value = f"cast({name} as varchar)"
        columns.append(f"{value} as {name}")
    return f"select {', '.join(columns)} from ({sql})"


def spec(kind: str, *names: str) -> str:
    return ", ".join(f"{name} {kind}" for name in names)
