"""Input tables from any format Spark reads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def load_source(
    spark: SparkSession,
    location: str,
    kind: str = "parquet",
    schema: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a path, or with ``kind="table"`` a catalogue table.

    A JDBC source takes its ``dbtable`` from ``location``; give ``partitionColumn``, bounds and
    ``numPartitions`` in ``options`` so that it is read in parallel.
    """
    if kind == "table":
        return spark.table(location)
    reader = spark.read.format(kind).options(**dict(options or {}))
    if kind == "jdbc":
        return reader.option("dbtable", location).load()
    return (reader.schema(schema) if schema else reader).load(location)


def read_csv(
    spark: SparkSession, path: str, schema: str, index_column: str | None = "X", multi_line: bool = True
) -> DataFrame:
    """CSV with a header and ``NA`` for missing; the row-number column is dropped.

    The schema is given, never inferred, so the file is read once. Messages hold line breaks, which
    makes each file one task; without ``multi_line`` large files are split, and ``read_quoted_csv`` splits
    files that have line breaks as well.
    """
    frame = spark.read.csv(path, header=True, schema=schema, nullValue="NA", multiLine=multi_line, escape='"')
    return frame.drop(index_column) if index_column else frame


def read_quoted_csv(spark: SparkSession, path: str, schema: str, index_column: str | None = "X") -> DataFrame:
    """The same as ``read_csv`` of files with line breaks inside quotes, but a large file is many tasks.

    Files are read as lines, split as Spark splits text. A line begins a record if the quotes before it in its file are
    even in number; their parity is summed within each split and run over the splits (a row for each). Records of one
    line are parsed where they are; only the lines of longer records are gathered, by file and record number. The
    first record of a file is its header. Quotes inside a value are doubled.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
    )
    quotes = F.char_length("line") - F.char_length(F.replace("line", F.lit('"'), F.lit("")))
    lines = lines.withColumn("odd", F.pmod(quotes, F.lit(2)).cast("long"))
    inside = Window.partitionBy("file", "split").orderBy("place")
    before = F.coalesce(F.sum("odd").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # Where records begin depends on the parity before the split, so both cases are counted.
    lines = lines.withColumn("even", (F.pmod(before, F.lit(2)) == 0).cast("long"))
    splits = lines.groupBy("file", "split").agg(
        F.sum("odd").alias("odd"), F.sum("even").alias("starts_even"), F.sum(1 - F.col("even")).alias("starts_odd")
    )
    along = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("flip", F.pmod(F.coalesce(F.sum("odd").over(along), F.lit(0)), F.lit(2)))
    starts = F.when(F.col("flip") == 0, F.col("starts_even")).otherwise(F.col("starts_odd"))
    splits = splits.select("file", "split", "flip", F.coalesce(F.sum(starts).over(along), F.lit(0)).alias("records"))
    # one row per split of a file
    placed = lines.join(F.broadcast(splits), ["file", "split"])
    begins = F.col("even") != F.col("flip")
    upto = F.sum(begins.cast("long")).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = placed.select("file", "split", "place", "line", begins.alias("begins"), "odd", (F.col("records") + upto).alias("record"))
    alone = placed.filter(F.col("begins") & (F.col("odd") == 0)).select("file", "record", "line")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "place", "line"))), lambda x: x["line"]), "\n")
    longer = placed.filter(~F.col("begins") | (F.col("odd") == 1)).groupBy("file", "record").agg(text.alias("line"))
    records = alone.unionByName(longer).filter((F.col("record") > 1) & (F.trim("line") != ""))
    parsed = F.from_csv(F.rtrim(F.col("line"), F.lit("\r")), schema, {"nullValue": "NA", "escape": '"', "mode": "PERMISSIVE"})
    frame = records.select(parsed.alias("r")).select("r.*")
    return frame.drop(index_column) if index_column else frame


def append_rows(modelling: DataFrame, scoring: DataFrame) -> DataFrame:
    """Scoring rows under modelling rows, by column name."""
    return modelling.unionByName(scoring)


def preview(df: DataFrame, rows: int, *order: str) -> DataFrame:
    """The first rows of a step; give an order for a repeatable choice."""
    return (df.orderBy(*order) if order else df).limit(rows)
