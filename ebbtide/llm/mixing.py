"""Mixing sources to target weights (8): Sainte-Laguë apportionment of equal-token blocks.

1. Targets. Sources in code-point order, NULL last, weigh 1, 2, 3, repeating, and share all tokens by
   weight. A target stops at ``max_repeats`` times its source's size; the excess is shared again by
   weight. Sorted by size per weight, the sources that stop are a prefix, so running sums find it.
2. Quotas. N = tokens / block seats are given to sources by the highest quotients target / (2s - 1).
   With S sources the final divisor lies between those of N - S and N + S seats (rounding moves the
   sum by S / 2 at most), so only the seats between these two roundings are listed and ranked, about
   3 S rows, never N. Every source is dealt by hash into shards, and its seats go to them alike.
3. Blocks. A shard's documents stand in seeded order; its tokens are cut into n blocks of equal size.
   A quota of q takes every block q div n times and the first q mod n in seeded order once more.

A source of any size is spread over shards of ``shard_tokens`` (at most ``max_shards`` of them, whose
size then grows); no window holds more than one shard, a source's shards, or the sources. Only ids
and sizes are shuffled, never texts. Orders come from MD5 of seed and content: reruns agree.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bind, pack, stage, word_array

#: Sources up to which their table (a few numbers each) is broadcast.
BROADCAST_SOURCES = 50_000


@dataclasses.dataclass(frozen=True)
class Mix:
    """Settings of the mix."""

    seed: str = "mix-1"
    weights: tuple[int, ...] = (1, 2, 3)
    max_repeats: int = 3
    #: Tokens of a block at most; blocks are smaller while sources have fewer than ``least_blocks`` on average.
    block_tokens: int = 1000
    least_blocks: int = 500
    shard_tokens: int = 200_000
    max_shards: int = 10_000


def token_count(text: str) -> Column:
    """Words of the text, 0 for NULL."""
    return F.size(word_array(text)).cast("long")


def content_key(id_col: Column, text: Column) -> Column:
    return F.md5(F.concat_ws(":", F.coalesce(id_col.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))


def seeded(seed: str, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), *[p.cast("string") for p in parts]))


def source_targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """(source, source_size) gets ``rank``, ``weight``, ``target`` and ``capped``. One row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in mix.weights])
    rows = sources.withColumn("rank", F.row_number().over(order)).withColumn(
        "weight", F.get(weights, (F.col("rank") - 1) % len(mix.weights))
    )
    cap = (F.col("source_size") * mix.max_repeats).alias("cap")
    rows = rows.withColumn("cap", cap)
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    rows = rows.withColumns(
        {
            "capped_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weight_left": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
            "total": F.sum("source_size").over(whole),
        }
    )
    # The level if exactly the sources before this one stop; the first source below its cap sets it.
    rows = rows.withColumn("level", (F.col("total") - F.col("capped_before")) / F.col("weight_left"))
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    rows = rows.withColumn("water", F.min_by("level", F.when(fits, F.struct(F.col("cap") / F.col("weight"), "rank"))).over(whole))
    reached = F.col("water").isNull() | (F.col("water") * F.col("weight") >= F.col("cap"))
    target = F.when(reached, F.col("cap").cast("double")).otherwise(F.col("water") * F.col("weight"))
    return rows.select("source", "source_size", "rank", "total", target.alias("target"), reached.alias("capped"))


def apportion(parties: DataFrame, seats: Column, votes: Column, group: list[str], order: str) -> DataFrame:
    """``parties`` with ``quota``: ``seats`` of each group given by highest quotients votes / (2s - 1).

    Ties go to the smaller ``order``. ``seats`` must be equal within a group; votes 0 get none.
    """
    within = Window.partitionBy(*[F.col(g) for g in group]) if group else Window.partitionBy(F.lit(1))
    rows = parties.withColumns({"__seats": seats.cast("long"), "__votes": votes.cast("double")})
    rows = rows.withColumns({"__all": F.sum("__votes").over(within), "__n": F.count(F.lit(1)).over(within)})
    share = F.when(F.col("__all") > 0, F.col("__votes") / F.col("__all")).otherwise(0.0)
    low = F.greatest(F.lit(0), F.round(share * (F.col("__seats") - F.col("__n"))).cast("long") - 1)
    high = F.when(F.col("__votes") > 0, F.round(share * (F.col("__seats") + F.col("__n"))).cast("long") + 1).otherwise(0)
    rows = rows.withColumns({"__low": low, "__high": F.greatest(high, low)})
    rows = rows.withColumn("__open", F.col("__seats") - F.sum("__low").over(within))
    seat = F.explode(F.sequence(F.col("__low"), F.col("__high"))).alias("__seat")  # seat __low is the base itself
    listed = rows.select("*", seat)
    quotient = F.col("__votes") / (2 * F.col("__seat") - 1)
    extra = F.col("__seat") > F.col("__low")
    place = F.row_number().over(
        (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))).orderBy(
            extra.desc(), F.when(extra, quotient).desc(), F.col(order), "__seat"
        )
    )
    won = listed.withColumn("__won", (extra & (place <= F.col("__open"))).cast("long"))
    keys = parties.columns
    return won.groupBy(*keys).agg((F.max("__low") + F.sum("__won")).alias("quota"))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, size, key, copy): the key names the content; equal rows are told apart by ``copy``."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        token_count(text_col).alias("size"),
        content_key(F.col(id_col), F.col(text_col)).alias("key"),
    )
    return rows.withColumn("copy", F.row_number().over(Window.partitionBy("key").orderBy(F.col("source").asc_nulls_last())))


def mix_plan(
    docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces) of the mix.

    documents: doc_id, key, copy, size, source_size, target, one row per row of ``docs``.
    pieces: key, copy, from, to, times: which words [from, to) of a document are taken, how often.
    NULL and empty texts have size 0 and no piece; sources of size 0 get target 0. Without any
    token, all targets are 0. Equal rows are different documents with content in common.
    """
    rows = stage(sized(docs, id_col, text_col, source_col), "mix-sizes")
    sources = stage(
        source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), mix), "mix-sources"
    )
    n_sources = sources.count()
    small = F.broadcast if n_sources <= BROADCAST_SOURCES else (lambda frame: frame)
    named = sources.withColumnRenamed("source", "src")
    rows = rows.join(small(named), F.col("source").eqNullSafe(F.col("src"))).drop("src")

    block = F.greatest(
        F.lit(1), F.least(F.lit(mix.block_tokens), F.expr(f"total div {max(1, n_sources) * mix.least_blocks}"))
    )
    by_source = apportion(sources.filter("total > 0"), F.expr("total") / block, F.col("target"), [], "rank")
    by_source = by_source.withColumnsRenamed({"quota": "source_quota"})

    n_shards = F.greatest(
        F.lit(1), F.least(F.lit(mix.max_shards), F.ceil(F.col("source_size") / mix.shard_tokens))
    ).cast("long")
    number = F.conv(F.substring(seeded(mix.seed + "-shard", F.col("key"), F.col("copy")), 1, 8), 16, 10).cast("long")
    placed = rows.filter("size > 0").withColumn("shard", number % n_shards)
    in_shard = Window.partitionBy("rank", "shard")
    ahead = in_shard.orderBy(seeded(mix.seed + "-order", F.col("key"), F.col("copy")), "key", "copy")
    line = placed.withColumn("end", F.sum("size").over(ahead.rowsBetween(Window.unboundedPreceding, 0))).select(
        "key", "copy", "rank", "shard", (F.col("end") - F.col("size")).alias("start"), "end"
    )
    shards = placed.groupBy("rank", "shard").agg(F.sum("size").alias("length"))
    shards = shards.join(small(by_source), "rank").withColumn(
        "n_blocks", F.greatest(F.lit(1), F.round(F.col("length") / block)).cast("long")
    )
    shards = apportion(shards, F.col("source_quota"), F.col("length"), ["rank"], "shard")
    shards = shards.withColumn(
        "quota",
        F.when(F.col("capped"), mix.max_repeats * F.col("n_blocks")).otherwise(
            F.least("quota", mix.max_repeats * F.col("n_blocks"))
        ),
    ).select("rank", "shard", "length", "n_blocks", "quota")
    shards = stage(shards, "mix-shards")

    blocks = shards.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block"))
    drawn = in_shard.orderBy(seeded(mix.seed + "-block", F.col("rank"), F.col("shard"), F.col("block")), "block")
    blocks = blocks.withColumn("turn", F.row_number().over(drawn)).select(
        "rank",
        "shard",
        "block",
        F.expr("block * length div n_blocks").alias("block_start"),
        F.expr("(block + 1) * length div n_blocks").alias("block_end"),
        F.expr("quota div n_blocks + if(turn <= quota % n_blocks, 1, 0)").alias("times"),
    )
    covered = F.sequence(
        F.expr("((start + 1) * n_blocks - 1) div length"), F.expr("(end * n_blocks - 1) div length")
    )
    pieces = (
        line.join(shards.select("rank", "shard", "length", "n_blocks"), ["rank", "shard"])
        .select("key", "copy", "rank", "shard", "start", "end", F.explode(covered).alias("block"))
        .join(blocks.filter("times > 0").hint("merge"), ["rank", "shard", "block"])  # blocks grow with the tokens
        .select(
            "key",
            "copy",
            (F.greatest("start", "block_start") - F.col("start")).alias("from"),
            (F.least("end", "block_end") - F.col("start")).alias("to"),
            "times",
        )
    )
    return rows.select("doc_id", "key", "copy", "size", "source_size", "target"), pieces


def mixed_counts(docs: DataFrame, mix: Mix = Mix(), **columns: str) -> DataFrame:
    """doc_id, size, source_size, target, taken for each row of ``docs``: see ``mix_plan``."""
    rows, pieces = mix_plan(docs, mix, **columns)
    taken = pieces.groupBy("key", "copy").agg(F.sum(F.expr("(to - from) * times")).alias("taken"))
    return rows.join(taken, ["key", "copy"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_documents(
    docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The mix itself, packed as ``__row``: a row for each time that words of a document are taken.

    The n-th row of a document holds, in order, its words that are taken n times or more, each with
    the white space before it; a document taken whole keeps its text as it is. Documents of which
    nothing is taken are left out, those without words as well.
    """
    _, pieces = mix_plan(docs, mix, id_col, text_col, source_col)
    per_doc = pieces.groupBy("key", "copy").agg(
        F.array_sort(F.collect_list(F.struct("from", "to", "times"))).alias("__pieces"), F.max("times").alias("__most")
    )
    rows = pack(docs).withColumn("key", content_key(F.col("__row")[id_col], F.col("__row")[text_col]))
    order = F.col("__row")[source_col].cast("string").asc_nulls_last()
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("key").orderBy(order)))
    rows = rows.join(per_doc, ["key", "copy"]).withColumn("__turn", F.explode(F.sequence(F.lit(1), F.col("__most").cast("int"))))
    text = F.col("__row")[text_col]
    chosen = F.filter("__pieces", lambda p: p["times"] >= F.col("__turn"))
    spaced = F.regexp_extract_all(text, F.lit(r"([ \t-\r]*[^ \t-\r]+)"), F.lit(1))
    taken = F.aggregate(chosen, F.lit(0).cast("long"), lambda a, p: a + p["to"] - p["from"])

    def slices(words: Column) -> Column:
        parts = F.transform(
            chosen, lambda p: F.array_join(F.slice(words, (p["from"] + 1).cast("int"), (p["to"] - p["from"]).cast("int")), "")
        )
        whole = taken == F.size(words)
        return F.when(whole, text).otherwise(F.regexp_replace(F.array_join(parts, ""), r"^[ \t-\r]+", ""))

    cut = bind(spaced, slices)
    names = rows.schema["__row"].dataType.names
    packed = F.struct(*[(cut if n == text_col else F.col("__row")[n]).alias(n) for n in names])
    return rows.select(packed.alias("__row"))
