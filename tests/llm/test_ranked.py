import dataclasses
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ebbtide.llm import ranked

from .plain import CLASHING, frame, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string, doc_id long, score long, rank int, `__text` string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, k=10):
    """(item_id, rank, doc_id, score) of (doc_id, text) and (item_id, text), document by document."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    n_terms = sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, text in items:
        wanted.setdefault(i, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        found = []
        for doc, c in counts:
            if not c:
                continue
            m = 100 - 90 + (90 * c.total() * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in own
                if t in c
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        found.sort(key=lambda x: x[:3])
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(found[:k])]
    return out


def texts(n, seed=1):
    rng = random.Random(seed)
    odd = ["Ünï-CODE é", "ÀB cd", "a_b.c", "日本語 日本語", "x" * 300, "\x7f\x80z", "K k İ", "..."]
    return [" ".join(rng.choice(odd) if rng.random() < 0.1 else prose(rng, 3, 60) for _ in range(rng.randrange(30))) for _ in range(n)]


def documents():
    out = list(enumerate(texts(120)))
    out += [(500 + k, "w1 w2 w3 same") for k in range(25)]  # more ties than places
    out += [(7, "w1 w2 w3 same"), (7, "w1 w2 w3 same"), (None, "w1 w2 w3 same"), (600, None), (601, ""), (602, "-- !!"), (603, prose(random.Random(3), 20000))]
    random.Random(2).shuffle(out)
    return out


def benchmark():
    out = [(k, t) for k, t in enumerate(texts(30, 5))]
    return out + [(100, "w1 SAME"), (101, None), (102, ""), (103, "notfoundanywhere"), (104, "w1"), (104, "w2 w1"), (None, "w5 w6"), (105, prose(random.Random(4), 3000, 60))]


SMALL = ranked.Search(docs=7, terms=5, items=3, group_items=4, buckets=2, piece=16)


@pytest.mark.parametrize("options", [ranked.Search(), SMALL, dataclasses.replace(SMALL, group_bytes=1, group_items=99)])
def test_against_brute_force(spark, options):
    rows = frame(spark, [(i, t, "s") for i, t in documents()], CLASHING).repartition(5)
    items = spark.createDataFrame([(i, t, None, None, None, None) for i, t in benchmark()], ITEMS)
    got = [tuple(r) for r in ranked.search(rows, items, options).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got, key=repr) == sorted(plain_search(documents(), benchmark()), key=repr)
    assert len(got) > 200


def test_no_rows(spark):
    docs, items = frame(spark, [(1, "a b", "s")]), spark.createDataFrame([(1, "a", None, None, None, None)], ITEMS)
    assert ranked.search(frame(spark, []), items).count() == 0
    assert ranked.search(docs, items.limit(0)).count() == 0
    assert ranked.search(frame(spark, [(1, None, "s")]), items).count() == 0
    assert [tuple(r) for r in ranked.search(docs, items).collect()] == plain_search([(1, "a b")], [(1, "a")])


def test_tiles_stay_exact():
    weights = np.array([25_000] * 10 + [10**9, 5, 10**9] + [1] * 50)
    edges = ranked.tile_edges(weights, 20)
    assert edges[0] == 0 and edges[-1] == len(weights) and edges == sorted(set(edges))
    for a, b in zip(edges, edges[1:]):
        assert b - a <= 20
        assert b - a == 1 or sum(weights[a:b].tolist()) * ranked.TOP_IMPACT < ranked.EXACT
    heavy = ranked.tile_edges(np.array([4_000_000_000] * 6), 100)
    assert heavy == [0, 2, 4, 6]
    rng = np.random.default_rng(1)
    w, impact = rng.integers(0, 30_000, 4096), rng.integers(0, ranked.TOP_IMPACT, 4096)
    assert int(w.astype(float) @ impact.astype(float)) == sum(a * b for a, b in zip(w.tolist(), impact.tolist()))


def test_pieces_of_a_text():
    for text in texts(50, 9):
        raw = text.encode()
        assert ranked.term_counts(raw, 5) == ranked.term_counts(raw) == Counter(t.encode() for t in terms(text))
