"""Train / test split and down-sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..options import Options


def split_hash(id_column: str, seed: int):
    return F.md5(F.concat_ws("|", F.col(id_column).cast("string"), F.lit(str(seed))))


def mark_split(df: DataFrame, response: str, id_column: str, options: Options) -> DataFrame:
    """Add ``split``: exactly ``ceil(share * n)`` rows of each response class are ``train``.

    Within a class rows are taken in the order of a seeded MD5 of the id. Only the last row
    taken has to be known, so no class is ever sorted: rows are counted by the first three
    digits of the digest (4,096 even slices), the slice holding the last row is found from those
    counts, and only that slice is numbered. The split itself is then a comparison with one
    row per class.
    """
    digest = split_hash(id_column, options.split_seed)
    hashed = df.select(F.col(response).alias("_class"), F.col(id_column).alias("_id"), digest.alias("_hash"))
    hashed = hashed.withColumn("_slice", F.substring("_hash", 1, 3))
    sizes = hashed.groupBy("_class", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy("_class").orderBy("_slice")
    before = F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted = F.ceil(F.lit(options.train_share) * F.sum("_n").over(Window.partitionBy("_class")))
    last_slice = (
        sizes.select("_class", "_slice", "_n", before.alias("_before"), wanted.alias("_wanted"))
        .filter((F.col("_before") < F.col("_wanted")) & (F.col("_wanted") <= F.col("_before") + F.col("_n")))
        .select(F.col("_class").alias("_c"), F.col("_slice").alias("_s"), "_before", "_wanted")
    )
    place = F.row_number().over(Window.partitionBy("_class").orderBy("_hash", "_id"))
    last = (
        hashed.join(
            F.broadcast(last_slice), F.col("_class").eqNullSafe(F.col("_c")) & (F.col("_slice") == F.col("_s"))
        )
        .withColumn("_place", place + F.col("_before"))
        .filter(F.col("_place") == F.col("_wanted"))
        .select(F.col("_class"), F.col("_hash").alias("_last_hash"), F.col("_id").alias("_last_id"))
    )
    taken = (digest < F.col("_last_hash")) | (
        (digest == F.col("_last_hash")) & (F.col(id_column) <= F.col("_last_id"))
    )
    # one row per class: two, or three with unlabelled rows
    return (
        df.join(F.broadcast(last), F.col(response).eqNullSafe(F.col("_class")), "left")
        .withColumn("split", F.when(taken, "train").otherwise("test"))
        .select(*df.columns, "split")
    )


def by_role(df: DataFrame, role: str) -> DataFrame:
    return df.filter(F.col("md_sc_f") == role)


def downsample(df: DataFrame, options: Options, response: str = "Response") -> DataFrame:
    """Bernoulli sample of all rows; optionally all positives and a share of the rest.

    A row is kept if the seeded digest of its id, as a number, lies below the share. So the sample is the
    same however the rows are partitioned.
    """
    if not options.downsample:
        return df
    digest = F.md5(F.concat(F.col(options.id_column).cast("string"), F.lit(f"|{options.downsample_seed}")))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    picked = number < F.lit(round(options.downsample_share * 2**32))
    if options.stratified_downsample:
        return df.filter((F.col(response) == 1) | ((F.col(response) == 0) & picked))
    return df.filter(picked)
