"""Score table, feature tables and exports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from .schemas import SCORES, column_names


class DuplicateKeys(ValueError):
    """A key that has to be unique occurs more than once."""


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, and NULL keys, with their number of rows."""
    any_null = " or ".join(f"{key} is null" for key in keys)
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(f"rows > 1 or {any_null}")
    )


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame, or :class:`DuplicateKeys` with one offender, as a primary key would refuse it."""
    offender = repeated_keys(df, keys).first()
    if offender is not None:
        raise DuplicateKeys(f"not unique on {', '.join(keys)}: {offender.asDict()}")
    return df


def create_score_table(spark: SparkSession, table: str) -> None:
    """Create the score table with its explicit schema when it does not exist yet."""
    if not spark.catalog.tableExists(table):
        spark.sql(f"create table if not exists {table} ({SCORES}) using parquet partitioned by (efft_d)")


def _score_rows(scores: DataFrame) -> DataFrame:
    return scores.select(*column_names(SCORES))


def unscored(scores: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows whose account has no score yet: the first score stays."""
    return scores.join(existing.select("account_id"), "account_id", "left_anti").select(*scores.columns)


def append_scores(scores: DataFrame, table: str) -> DataFrame:
    """Append the first score of each account to the catalogue table and return the table.

    An account repeated within ``scores`` fails the whole write. Accounts scored before are
    left out, so a job run again after a failure adds only what is missing. The new rows are
    written to the shared folder first: scoring runs once for the check and the write.
    """
    spark = scores.sparkSession
    create_score_table(spark, table)
    rows = assert_unique(stage(_score_rows(scores), "scores"), ["account_id"])
    fresh = unscored(rows, spark.table(table))
    fresh.select(*spark.table(table).columns).write.insertInto(table)
    return spark.table(table)


def append_scores_path(scores: DataFrame, path: str) -> DataFrame:
    """The same for a Parquet folder partitioned by date.

    Both writers assume that one job writes at a time: two at once may both add an account. ``publish_scores`` doesn't.
    """
    spark = scores.sparkSession
    rows = assert_unique(stage(_score_rows(scores), "scores"), ["account_id"])
    existing = _stored_scores(spark, path)
    fresh = rows if existing is None else unscored(rows, existing)
    fresh.write.mode("append").partitionBy("efft_d").parquet(path)
    return spark.read.schema(SCORES).parquet(path)


def _stored_scores(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(SCORES).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def publish_scores(scores: DataFrame, path: str, attempts: int = 20, pause=None) -> DataFrame:
    """First scores into a folder that several jobs may write at once; returns the whole table.

    Rows go to a folder of their own under ``path/rows``, which nobody reads until a commit names it. Commits are files
    ``path/commits/<number>``; each belongs to one writer only, since renaming onto a file fails. A writer
    that loses the race leaves out the accounts which the winner has added, and tries the next number. So the table
    has one row per account whatever the interleaving, a job that dies before its commit leaves nothing
    visible, and a job run again adds what is missing. The file system must rename
    atomically, as HDFS does. ``pause`` is called before each commit (for tests).
    """
    spark = scores.sparkSession
    rows = assert_unique(stage(_score_rows(scores), "scores"), ["account_id"])
    for _ in range(attempts):
        known = commits(spark, path)
        fresh = unscored(rows, published_scores(spark, path, known))
        name = uuid.uuid4().hex
        fresh.write.partitionBy("efft_d").parquet(f"{path}/rows/{name}")
        if pause:
            pause()
        if _create(spark, f"{path}/commits/{len(known):010d}", name):
            return published_scores(spark, path)
    raise RuntimeError(f"other writers were faster {attempts} times")


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _create(spark: SparkSession, path: str, content: str) -> bool:
    """A file with this content under this name, or False if the name is taken.

    The file is written aside and renamed, so a commit is whole or not there; renaming does not replace a file.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    system, place = _files(spark, path)
    system.mkdirs(place.getParent())
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}-{content}")
    stream = system.create(aside, True)
    stream.write(bytearray(content.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
    nothing = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(aside, place, nothing)
    except Exception:
        if not system.exists(place):
            raise
        system.delete(aside, False)
        return False
    return True


def commits(spark: SparkSession, path: str) -> list[str]:
    """The folders that commits name, in their order."""
    system, place = _files(spark, f"{path}/commits")
    if not system.exists(place):
        return []
    found = []
    for status in system.listStatus(place):
        name = status.getPath().getName()
        if name.isdigit():
            stream = system.open(status.getPath())
            found.append((name, bytes(stream.readAllBytes()).decode()))
            stream.close()
    return [content for _, content in sorted(found)]


def published_scores(spark: SparkSession, path: str, known: list[str] | None = None) -> DataFrame:
    """The committed rows of a folder that ``publish_scores`` writes."""
    names = commits(spark, path) if known is None else known
    parts = [spark.read.schema(SCORES).parquet(f"{path}/rows/{name}") for name in names]
    out = spark.createDataFrame([], SCORES)
    for part in parts:
        out = out.unionByName(part)
    return out


def export_csv(df: DataFrame, path: str) -> None:
    """CSV part files with a header. Text is quoted so that it reads back unchanged."""
    df.write.mode("overwrite").csv(path, header=True, nullValue="NA", escape='"')
