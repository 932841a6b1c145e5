import random

import pytest

from ebbtide.llm import lines

from .plain import CLASHING, frame, frequent, prose, quality, repeat_words, without, words


def documents(seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(160):
        parts = [prose(rng, rng.randrange(1, 40)) for _ in range(rng.randrange(1, 6))]
        if i % 3 == 0:
            parts.insert(rng.randrange(len(parts)), f"  Menu  {i % 10} of the SITE ")
        if i % 5 == 0:
            parts.append("Notice " + " ".join(f"part{k}" for k in range(80)))
        if i % 11 == 0:
            parts += [parts[0], "a b c d a b c d a b c d"]
        rows.append((i, "\n".join(parts), f"s{i % 2}"))
    long = prose(rng, 20_000)
    odd = [(500, None, "s0"), (501, "", "s0"), (502, " \n\t", None), (503, long, None), (504, "Menu 7 of the site", "s0")]
    return rows + odd + [rows[5], rows[5], (None, rows[6][1], "s1")]


@pytest.mark.parametrize("schema", [None, CLASHING])
def test_quality_against_plain(spark, schema):
    rows = documents()
    docs = frame(spark, rows, *([schema] if schema else []))
    got = [
        (r["__row"]["doc_id"], r["__row"]["text"], r["__n_words"], r["__n_repeat_words"], r["__base_failed"], r["__kept"])
        for r in lines.quality_rules(docs, scale=1.5, least_docs=5).collect()
    ]
    found = frequent(rows, lambda h: 1.5 * h**0.5, 5, host=2)
    assert len({line for _, line in found}) == 2  # the menu and the notice
    want = [
        (i, without(t, s, found), len(words(t)), repeat_words(words(t)), *quality(t, s, found)) for i, t, s in rows
    ]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    depleted = [g for g in got if not g[4] and not g[5]]
    assert len(depleted) > 3 and any(g[5] for g in got)


def test_limits_grow_apart(spark):
    """A share of a site is one limit, the root of its size another: neither holds the other's lines."""

    def found(n_docs, n_held):
        rows = [(i, f"own {'x' * (i + 1)}\n" + ("held" if i < n_held else ""), "s") for i in range(n_docs)]
        docs = frame(spark, rows)
        removed = lines.quality_rules(docs).agg({"__n_lines_removed": "sum"}).first()[0]
        return removed, lines.site_line_dedup(docs).agg({"__dropped": "sum"}).first()[0]

    assert found(400, 30) == (0, 30)  # more than 8 pages, not more than 40 documents
    assert found(400, 41) == (41, 41)
    assert found(16_900, 300) == (300, 0)  # more than 260 documents, not more than 338 pages


def test_site_lines_against_plain(spark):
    rows = documents(2)
    got = lines.site_line_dedup(frame(spark, rows), ratio=0.2, least_pages=5).collect()
    found = frequent(rows, lambda h: 0.2 * h, 5, host=2)
    want = [(i, without(t, s, found)) for i, t, s in rows]
    assert sorted(((r["__row"]["doc_id"], r["__row"]["text"]) for r in got), key=repr) == sorted(want, key=repr)
    assert sum(r["__dropped"] for r in got) > 40
    assert {r["__lines"] for r in got if r["__row"]["text"] is None} == {0}


def test_salted_join_gives_the_same(spark, monkeypatch):
    docs = frame(spark, documents(3))
    first = lines.site_line_dedup(docs, 0.2, 5).collect()
    monkeypatch.setattr(lines, "BROADCAST_LINES", 0)
    assert sorted(map(repr, lines.site_line_dedup(docs, 0.2, 5).collect())) == sorted(map(repr, first))


def test_base_counts(spark):
    text = "a#b a#b a#b\n\nx & y\nx & y\n a#b a#b a#b"
    row = lines.quality_rules(frame(spark, [(1, text, "s")])).first()
    assert (row["__n_words"], row["__word_chars"], row["__n_symbols"], row["__n_dup_lines"]) == (12, 24, 8, 1)
    assert row["__n_repeat_words"] == repeat_words(words(text))


def test_empty_table(spark):
    docs = frame(spark, [])
    assert lines.quality_rules(docs).count() == 0 and lines.site_line_dedup(docs).count() == 0
