"""What several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import stage

#: A word is a longest run of characters other than these (Java and RE2 syntax).
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def word_array(text: str | Column) -> Column:
    """The words of a text column; NULL text has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(column, F.lit("")), r"[ \t-\r]+", -1), lambda x: x != "")


def bind(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often it is used, inside lambdas as well.

    A computed column doesn't do: the optimizer may put its expression back into a lambda.
    """
    return F.get(F.transform(F.array(value), use), 0)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def pack(df: DataFrame) -> DataFrame:
    """All columns in one struct, so that added columns can't clash with those of the table."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"))


def unpack(df: DataFrame, **replaced: Column) -> DataFrame:
    """The columns that were packed, those named in ``replaced`` with the values given."""
    names = df.schema["__row"].dataType.names
    return df.select(*[(replaced[n] if n in replaced else F.col("__row")[n]).alias(n) for n in names])




def byte_slices(batches, column: str, most: int = 4 << 20):
    """Arrow batches cut so that a text column holds about ``most`` bytes in each; a longer text stands alone.

    Yields (batch, texts): the rows, and the column's values as ``str`` with None for NULL.
    """
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(first, last - first), texts.slice(first, last - first).to_pylist()
            first = last
