"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blocks, bpe, lines, minhash, mixing, neighbours, rank_bpe, ranked, repeats, secrets, toxicity, whitening
from .common import read


@dataclasses.dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


# Words, hosts and normalised lines in DuckDB.
_NORMAL = "translate(trim(regexp_replace(lower(l), '[\\x20\\x09-\\x0D]+', ' ', 'g')), '123456789', '000000000')"
_LINES = f"""
rows as (select row_number() over () as r, doc_id, source, text, coalesce(text, '') as t from documents),
texts as (select distinct source, text from rows),
hosts as (select source, count(*) as host_docs from texts group by source),
held as (
  select distinct source, text, {_NORMAL} as line
  from (select source, text, unnest(string_split(coalesce(text, ''), chr(10))) as l from texts)
  where regexp_matches(l, '[^\\x20\\x09-\\x0D]')
),
counted as (select source, line, count(*) as n_docs from held group by source, line),
frequent as (
  select c.source, c.line from counted c join hosts h on c.source is not distinct from h.source
  where n_docs > {{least}} and n_docs > {{limit}}
),
split as (
  select r, source, unnest(string_split(t, chr(10))) as l, unnest(range(len(string_split(t, chr(10))))) as i from rows
),
marked as (
  select s.r, s.i, s.l, f.line is not null as bad
  from (select *, regexp_matches(l, '[^\\x20\\x09-\\x0D]') as worded, {_NORMAL} as line from split) s
  left join frequent f on s.worded and s.source is not distinct from f.source and s.line = f.line
)
"""

OP4_SQL = (
    "with "
    + _LINES.format(least=20, limit="2.0::double * sqrt(host_docs)")
    + """,
lost as (
  select r, count(*) filter (bad) as n_lines_removed,
    coalesce(sum(len(regexp_extract_all(l, '[^\\x20\\x09-\\x0D]+'))) filter (bad), 0) as n_words_removed,
    count(*) filter (worded) - count(distinct l) filter (worded) as n_dup_lines
  from (select *, regexp_matches(l, '[^\\x20\\x09-\\x0D]') as worded from marked) group by r
),
worded as (select r, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as w from rows),
windows as (
  select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select r, w, unnest(range(1, len(w) - 1)) as i from worded)
),
repeated as (select r, i from (select r, i, count(*) over (partition by r, g) as n from windows) where n > 1),
covered as (
  select r, count(distinct k) as n from (select r, unnest([i, i + 1, i + 2]) as k from repeated) group by r
),
counts as (
  select x.doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda s: length(s))), 0)::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
    coalesce(c.n, 0)::bigint as n_repeat_words, n_lines_removed::bigint as n_lines_removed,
    n_words_removed::bigint as n_words_removed
  from worded x join lost using (r) left join covered c using (r)
)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and n_words - n_words_removed >= 0.5 * n_words as kept
from counts
"""
)

OP7_SQL = (
    "with "
    + _LINES.format(least=10, limit="0.02::double * host_docs")
    + """
select doc_id, case when rows.text is null then null when n_dropped = 0 then rows.text else coalesce(kept, '') end as text,
  case when rows.text is null then 0 else n_lines end::bigint as n_lines, n_dropped::bigint as n_dropped
from rows join (
  select r, count(*) as n_lines, count(*) filter (bad) as n_dropped,
    string_agg(l, chr(10) order by i) filter (not bad) as kept from marked group by r
) using (r)
"""
)

OP8_SQL = """
with recursive sized as (
  select *, row_number() over (partition by key order by source nulls last) as copy from (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
      md5(coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))) as key from documents)
),
ranked as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as rank,
    [1, 2, 3][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from sized group by source
),
levels as (
  select *, 3 * source_size as cap, sum(source_size) over ()::bigint as total, count(*) over () as n_sources,
    (sum(source_size) over () - coalesce(sum(3 * source_size) over w, 0))::bigint::double
      / (sum(weight) over () - coalesce(sum(weight) over w, 0))::bigint as level
  from ranked window w as (order by (3 * source_size)::double / weight, rank rows between unbounded preceding and 1 preceding)
),
water as (select min_by(level, (cap::double / weight, rank)) as water from levels where level * weight <= cap),
targets as (
  select l.*, water is null or water * weight >= cap as capped,
    case when water is null or water * weight >= cap then cap::double else water * weight end as target,
    greatest(1, least(1000, total // (n_sources * 500))) as block
  from levels l, water
),
source_seats as (
  select *, (total::double / block)::double as seats_raw, floor(total::double / block)::bigint as seats,
    target / sum(target) over () as share from targets where total > 0
),
source_low as (
  select *, greatest(0, round(share * (seats - n_sources))::bigint - 1) as low,
    case when target > 0 then round(share * (seats + n_sources))::bigint + 1 else 0 end as high from source_seats
),
source_quota as (
  select t.*, low + coalesce(won, 0) as quota from source_low t left join (
    select rank, count(*) as won from (
      select rank, open, row_number() over (order by target / (2 * seat - 1) desc, rank, seat) as place from (
        select *, seats - sum(low) over () as open from source_low) s, lateral (select unnest(range(low + 1, greatest(high, low) + 1)) as seat)
    ) where place <= open group by rank
  ) using (rank)
),
placed as (
  select s.*, t.rank, t.source_size, t.target,
    ('0x' || substr(md5('mix-1-shard:' || key || ':' || copy), 1, 8))::bigint
      % greatest(1, least(10000, ceil(source_size / 200000.0)))::bigint as shard
  from sized s join targets t on s.source is not distinct from t.source
),
line as (
  select *, (sum(size) over (partition by rank, shard order by md5('mix-1-order:' || key || ':' || copy), key, copy))::bigint as e
  from placed where size > 0
),
shard_size as (select rank, shard, sum(size)::bigint as length from placed where size > 0 group by rank, shard),
shard_seats as (
  select s.rank, s.shard, length, q.quota as seats, capped, greatest(1, round(length::double / block))::bigint as n_blocks,
    length::double / sum(length) over (partition by s.rank) as share, count(*) over (partition by s.rank) as n
  from shard_size s join source_quota q using (rank)
),
shard_low as (
  select *, greatest(0, round(share * (seats - n))::bigint - 1) as low, round(share * (seats + n))::bigint + 1 as high
  from shard_seats
),
shard_quota as (
  select t.*, case when capped then 3 * n_blocks else least(low + coalesce(won, 0), 3 * n_blocks) end as quota
  from shard_low t left join (
    select rank, shard, count(*) as won from (
      select rank, shard, open,
        row_number() over (partition by rank order by length::double / (2 * seat - 1) desc, shard, seat) as place from (
        select *, seats - sum(low) over (partition by rank) as open from shard_low) s,
        lateral (select unnest(range(low + 1, greatest(high, low) + 1)) as seat)
    ) where place <= open group by rank, shard
  ) using (rank, shard)
),
blocks as (
  select *, block * length // n_blocks as bs, (block + 1) * length // n_blocks as be,
    quota // n_blocks + (turn <= quota % n_blocks)::int as times
  from (select *, row_number() over (partition by rank, shard
      order by md5('mix-1-block:' || rank || ':' || shard || ':' || block), block) as turn
    from (select *, unnest(range(0, n_blocks)) as block from shard_quota))
),
taken as (
  select key, copy, sum((least(e, be) - greatest(e - size, bs)) * times)::bigint as taken
  from line join blocks using (rank, shard) where be > e - size and bs < e group by key, copy
)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken
from placed left join taken using (key, copy)
"""


_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)

OP12_SQL = f"""
with docs as (select row_number() over () as r, doc_id, {_TERMS} as terms from documents),
wanted as (select distinct item_id, term from (select item_id, unnest({_TERMS}) as term from benchmark)),
totals as (select count(*) filter (len(terms) > 0) as n_docs, sum(len(terms))::bigint as n_terms from docs),
held as (
  select r, term, count(*) as tf from (select r, unnest(terms) as term from docs)
  where term in (select term from wanted) group by r, term
),
weights as (
  select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)))::bigint as w
  from (select term, count(*) as df from held group by term), totals
),
sizes as (select r, doc_id, 10 + (90 * len(terms) * n_docs) // n_terms as m from docs, totals where len(terms) > 0),
scores as (
  select item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from wanted join held using (term) join weights using (term) join sizes using (r) group by item_id, r
)
select item_id, rank, doc_id, score from (
  select item_id, doc_id, score,
    row_number() over (partition by item_id order by score desc, doc_id nulls last)::int as rank
  from scores join sizes using (r) where score > 0
) where rank <= 10
"""


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.quality_rules(read(spark, sf_dir, "documents"))
    own = [F.col(c).alias(c[2:]) for c in rows.columns if c != "__row"]
    return rows.select(F.col("__row.doc_id").alias("doc_id"), *own)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.site_line_dedup(read(spark, sf_dir, "documents"))
    return rows.select(
        "__row.doc_id", "__row.text", F.col("__lines").alias("n_lines"), F.col("__dropped").alias("n_dropped")
    )


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_counts(read(spark, sf_dir, "documents"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = blocks.extract_pages(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return rows.select(
        "__row.page_id", "__row.url", F.col("main").alias("text"), F.char_length("main").cast("long").alias("n_chars")
    )


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return repeats.remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_on(docs, read(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select(
        "__row.doc_id",
        toxicity.held_out(F.col("__row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.linked_vectors(read(spark, sf_dir, "embeddings"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.scan_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    numbers = [number(kind) for kind in secrets.KINDS]
    return rows.select(
        "__row.doc_id", *numbers, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def vocabulary_path() -> str:
    """The public vocabulary that the query is about; the file is installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_digests(rows: DataFrame, between: str = ",") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of encoded documents."""
    return rows.select(
        "__row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", between), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_digests(bpe.encode_documents(docs, vocabulary_path()))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors)
    rows = whitening.whiten(vectors, model)
    error = whitening.identity_error(rows, len(model.eigenvalues))
    shares = F.array(*[F.lit(x) for x in model.explained]).cast("array<double>")
    return rows.select(
        F.col("__row.vec_id").alias("vec_id"), "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_digests(rank_bpe.encode_documents(docs, path, public_tokenizers.PATTERN), " ")


QUERIES: dict[str, Query] = {
    "op1_flat_blocks": Query(op1),
    "op2_prefix_intervals": Query(op2),
    "op3_gru_toxicity": Query(op3),
    "op4_line_frequency": Query(op4, OP4_SQL),
    "op5_nn_descent": Query(op5),
    "op6_entropy_secrets": Query(op6),
    "op7_site_lines": Query(op7, OP7_SQL),
    "op8_sainte_lague": Query(op8, OP8_SQL),
    "op9_tree_bpe": Query(op9),
    "op10_bag_minhash": Query(op10),
    "op11_exact_whitening": Query(op11),
    "op12_impact_tiles": Query(op12, OP12_SQL),
    "op13_rank_bpe": Query(op13),
}
