"""A corpus pipeline: quality rules, line dedup, near-dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir), reads all that the stage before it kept, and returns a frame
that is written as Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``; where a stage changes the text, ``n_chars`` follows it.

Nulls, empty and repeated rows, empty tables and further columns: see the operators. A stage adds no
column of its own and keeps those that it is given.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import bpe, lines, minhash, mixing
from ebbtide.llm.common import read
from ebbtide.llm.queries import token_digests, vocabulary_path
from ebbtide.session import shared_folder


def columns_of(rows: DataFrame) -> DataFrame:
    """The packed columns, with ``n_chars`` of the text as it now is."""
    names = rows.schema["__row"].dataType.names
    length = F.char_length(F.col("__row")["text"]).cast(
        rows.schema["__row"].dataType["n_chars"].dataType if "n_chars" in names else "long"
    )
    return rows.select(*[(length if n == "n_chars" else F.col("__row")[n]).alias(n) for n in names])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines too frequent on their host are removed; documents that fail the rules or are depleted go."""
    return columns_of(lines.quality_rules(docs).filter("__kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines above a share of their site's pages are dropped."""
    return columns_of(lines.site_line_dedup(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return columns_of(minhash.without_near_duplicates(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document's words come as often as the mix takes them, a row for each time."""
    return columns_of(mixing.mixed_documents(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, and digests of the ids of the text and of what they decode to."""
    return token_digests(bpe.encode_documents(docs.select("doc_id", "text"), vocabulary_path()))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", mix),
    ("bpe_tokens", tokens),
]

#: The signatures, the bands and the tokenizer have no SQL; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage on ``documents``."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
