"""Lines that many documents of one host share: the quality rules (4) and the line dedup (7).

Both count, for each host and normalised line, the distinct documents that hold it. Documents with
the same whole text count once, in the lines' counts and in the host's total alike: copies of a
document are the near-duplicate stage's matter and say nothing about a site's boilerplate.

A normalised line is lower-cased, trimmed, with white space runs made one space and digits made 0; a
line without a word is never counted, removed or dropped. Lines are compared by the xxhash64 of the
normalised line. Only hashes are shuffled, never texts: the counts need (host, line, document)
triples, combined per task first, and a hot host or line is spread by the document's hash.

The two rules have limits of their own. Line dedup (7) drops what stands in a share of the site's
pages, so its limit grows with the site. The quality rules (4) ask how often a line is written at
all: their limit grows with the square root of the host's documents, as a large host has far more
room for a line that says nothing and is still a small share of its pages.

The lines over a limit are few by construction: where a document of a host of h documents has on
average m lines, at most m / ratio lines reach the ratio, and m * sqrt(h) / scale the root. They are
written, counted, and joined as one array per host: broadcast while they are at most
``BROADCAST_LINES``, else joined by host and salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, pack, stage, unpack, word_array

#: Line hashes (8 bytes each) up to which the table of frequent lines is broadcast.
BROADCAST_LINES = 100_000
#: Shares of a host's documents among which a join by host is spread.
SALTS = 32


def normalised(line: Column) -> Column:
    """Lower case, white space runs as one space, trimmed, digits as 0."""
    return F.trim(F.translate(F.regexp_replace(F.lower(line), r"[ \t-\r]+", " "), "123456789", "000000000"))


def has_word(line: Column) -> Column:
    return F.translate(line, " \t\n\x0b\x0c\r", "") != ""


def line_hashes(text: Column) -> Column:
    r"""The hash of each \n-split line of a text, NULL for lines without a word."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.when(has_word(x), F.xxhash64(normalised(x)))
    )


def with_lines(docs: DataFrame, text_col: str, host_col: str) -> DataFrame:
    """``docs`` packed, with its text, host and line hashes beside."""
    return (
        pack(docs)
        .withColumn("__text", F.col("__row")[text_col])
        .withColumn("__host", F.col("__row")[host_col].cast("string"))
        .withColumn("__hashes", line_hashes(F.col("__text")))
    )


def line_counts(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(host, line, n_docs, host_docs): distinct documents with the line, and of the host."""
    lined = with_lines(docs, text_col, host_col).select(
        F.col("__host").alias("host"),
        F.xxhash64(F.col("__text")).alias("doc"),
        F.array_distinct(F.filter("__hashes", lambda x: x.isNotNull())).alias("lines"),
    )
    # Each document also brings a line of its own kind, so that one pass counts lines and documents.
    held = lined.select("host", "doc", F.explode(F.concat(F.array(F.lit(None).cast("long")), "lines")).alias("line"))
    counts = held.distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs"))
    counts = stage(counts.filter("line is null or n_docs > 1"), "line-counts")
    totals = counts.filter("line is null").select(F.col("host").alias("h"), F.col("n_docs").alias("host_docs"))
    return (
        counts.filter("line is not null")
        .join(totals, F.col("host").eqNullSafe(F.col("h")))
        .drop("h")
    )


def frequent_lines(
    docs: DataFrame, limit: Column, least: int, text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """(host, line, n_docs, host_docs) of lines in more than ``least`` documents and more than ``limit``.

    ``limit`` is an expression of ``host_docs``.
    """
    return line_counts(docs, text_col, host_col).filter((F.col("n_docs") > least) & (F.col("n_docs") > limit))


def marked_lines(docs: DataFrame, frequent: DataFrame, text_col: str, host_col: str) -> DataFrame:
    """Packed ``docs`` with ``__hashes`` and ``__frequent``, the frequent lines of its host (NULL if none)."""
    frequent = stage(frequent.select("host", "line"), "frequent-lines")
    sets = frequent.groupBy("host").agg(F.collect_list("line").alias("__frequent"))
    rows = with_lines(docs, text_col, host_col)
    if frequent.count() <= BROADCAST_LINES:
        joined = rows.join(F.broadcast(sets), F.col("__host").eqNullSafe(F.col("host")), "left")
    else:
        salted = sets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("__salt", F.pmod(F.xxhash64("__text"), F.lit(SALTS)))
        joined = rows.join(
            salted, F.col("__host").eqNullSafe(F.col("host")) & (F.col("__salt") == F.col("salt")), "left"
        ).drop("__salt", "salt")
    return joined.drop("host")


def is_frequent(hash_: Column) -> Column:
    return F.coalesce(F.array_contains("__frequent", hash_), F.lit(False))


def kept_text() -> Column:
    """The text without its frequent lines; NULL stays NULL, a text that loses nothing stays as it is."""
    lines = F.split("__text", "\n", -1)
    pairs = F.filter(F.arrays_zip(lines.alias("l"), F.col("__hashes").alias("h")), lambda p: ~is_frequent(p["h"]))
    return F.when(
        F.exists("__hashes", is_frequent), F.array_join(F.transform(pairs, lambda p: p["l"]), "\n")
    ).otherwise(F.col("__text"))


# --- Line dedup (7) ---------------------------------------------------------------------------


def site_line_dedup(
    docs: DataFrame,
    ratio: float = 0.02,
    least_pages: int = 10,
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """Drop lines that more than ``ratio`` of the pages of their host contain, and more than ``least_pages``.

    Returns the columns of ``docs``, with the text replaced, in the struct ``__row``, and ``__lines``
    and ``__dropped``, the numbers of lines before and of those dropped. NULL texts stay NULL and
    have no line; an empty text is one line without a word, which stays. A NULL host is a host of
    its own. Repeated rows count as one page and each loses the same lines. An empty table gives none.
    """
    frequent = frequent_lines(docs, F.lit(ratio) * F.col("host_docs"), least_pages, text_col, host_col)
    rows = marked_lines(docs, frequent, text_col, host_col)
    rows = rows.withColumns(
        {
            "__kept": kept_text(),
            "__lines": F.when(F.col("__text").isNull(), 0).otherwise(F.size("__hashes")).cast("long"),
            "__dropped": F.size(F.filter("__hashes", is_frequent)).cast("long"),
        }
    )
    packed = F.struct(
        *[
            (F.col("__kept") if n == text_col else F.col("__row")[n]).alias(n)
            for n in rows.schema["__row"].dataType.names
        ]
    )
    return rows.select(packed.alias("__row"), "__lines", "__dropped")


# --- Quality rules (4) ------------------------------------------------------------------------

SYMBOLS = "#*$%&|<>"


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text, the first find included.

    Windows are compared by xxhash64. Only a text with a repeated window sorts its windows; then the
    gaps between the repeated windows' places say how many words they cover.
    """

    def covered(places: Column) -> Column:
        gaps = F.transform(
            F.sequence(F.lit(1), F.size(places) - 1),
            lambda k: F.least(F.lit(3), F.get(places, k) - F.get(places, k - 1)),
        )
        more = F.aggregate(gaps, F.lit(3), lambda a, x: a + x)
        return F.when(F.size(places) == 0, 0).when(F.size(places) == 1, 3).otherwise(more)

    def places(ordered: Column) -> Column:
        def same(k, other):
            return F.coalesce(F.get(ordered, other)["g"] == F.get(ordered, k)["g"], F.lit(False))

        found = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), lambda k: same(k, k - 1) | same(k, k + 1))
        return F.array_sort(F.transform(found, lambda k: F.get(ordered, k)["i"]))

    def count(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(
            bind(ordered, lambda o: bind(places(o), covered))
        )

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        )

    return bind(words, lambda w: F.when(F.size(w) < 3, 0).otherwise(bind(windows(w), count)))


def text_counts(text: Column) -> dict[str, Column]:
    """The base counts of a text, by name; ``words`` is the array of its words."""
    whole = F.coalesce(text, F.lit(""))
    worded = F.filter(F.split(whole, "\n", -1), has_word)
    return {
        "word_chars": F.char_length(F.translate(whole, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.char_length(whole) - F.char_length(F.translate(whole, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(worded) - F.size(F.array_distinct(worded))).cast("long"),
    }


def quality_rules(
    docs: DataFrame,
    scale: float = 2.0,
    least_docs: int = 20,
    keep_share: float = 0.5,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """Cross-document line frequency, and the base rules beside.

    A line in more than ``least_docs`` documents of its host, and more than ``scale`` times the root
    of the number of the host's documents, is removed. A document fails the base rules with fewer than ``min_words`` words, or more than
    ``max_repeat_percent`` per cent of them in repeated 3-word windows. It is kept if it passes them
    and the removal leaves at least ``keep_share`` of its words.

    Returns ``__row`` (the columns of ``docs``, the text without the removed lines) and the counts
    of the whole text, prefixed with ``__``. NULL and empty texts have no words and fail. NULL
    hosts are one host. Repeated rows count once and get the same verdict. No rows give no rows.
    """
    frequent = frequent_lines(docs, F.lit(scale) * F.sqrt("host_docs"), least_docs, text_col, host_col)
    rows = marked_lines(docs, frequent, text_col, host_col)
    removed = F.filter(F.arrays_zip(F.split("__text", "\n", -1).alias("l"), F.col("__hashes").alias("h")), lambda p: is_frequent(p["h"]))
    lost = F.aggregate(removed, F.lit(0), lambda a, p: a + F.size(word_array(p["l"])))
    counts = {f"__{k}": v for k, v in text_counts(F.col("__text")).items()}
    rows = rows.withColumns(counts | {"__words": word_array("__text"), "__kept_text": kept_text()})
    rows = rows.withColumns(
        {
            "__n_words": F.size("__words").cast("long"),
            "__n_repeat_words": repeated_words(F.col("__words")).cast("long"),
            "__n_lines_removed": F.size(F.filter("__hashes", is_frequent)).cast("long"),
            "__n_words_removed": F.when(F.exists("__hashes", is_frequent), lost).otherwise(0).cast("long"),
        }
    ).drop("__words")
    failed = (F.col("__n_words") < min_words) | (
        100 * F.col("__n_repeat_words") > max_repeat_percent * F.col("__n_words")
    )
    enough = F.col("__n_words") - F.col("__n_words_removed") >= F.lit(keep_share) * F.col("__n_words")
    rows = rows.withColumn("__base_failed", failed).withColumn("__kept", ~failed & enough)
    packed = F.struct(
        *[
            (F.col("__kept_text") if n == text_col else F.col("__row")[n]).alias(n)
            for n in rows.schema["__row"].dataType.names
        ]
    )
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines_removed n_words_removed base_failed kept"
    return rows.select(packed.alias("__row"), *[f"__{n}" for n in names.split()])


__all__ = ["frequent_lines", "line_counts", "quality_rules", "site_line_dedup", "unpack"]
