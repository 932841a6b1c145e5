import random

import numpy as np
import pytest

from ebbtide.llm import repeats

from .plain import CLASHING, frame, prose, spans
from .plain import repeats as plain


def corpus(seed):
    rng = random.Random(seed)
    shared = [prose(rng, rng.randrange(15, 60)) for _ in range(4)]
    line = prose(rng, 12)
    rows = []
    for i in range(70):
        parts = [prose(rng, rng.randrange(1, 40)) for _ in range(rng.randrange(1, 4))]
        if rng.random() < 0.5:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        if rng.random() < 0.5:
            parts.insert(rng.randrange(len(parts) + 1), line)
        if rng.random() < 0.1:
            parts.append("ab " * rng.randrange(30, 200))
        if rng.random() < 0.1:
            parts.append("x" * rng.randrange(90, 900) + parts[0] * 2)
        rows.append((i, "é ".join(parts), "s"))
    long = prose(rng, 20_000)
    odd = [(90, None, "s"), (91, "", None), (92, "y" * 99, "s"), (93, "y" * 100, "s"), (94, "y" * 101, "s"), (95, long, "s"), (96, long[500:90_000], "s")]
    return rows + odd + [(200 + i, rows[i][1], "s") for i in range(8)]


@pytest.mark.parametrize(
    "seed, r", [(1, repeats.Repeats()), (2, repeats.Repeats(crowd=2)), (3, repeats.Repeats(length=40, piece=16)), (4, repeats.Repeats(piece=100))]
)
def test_against_every_window(spark, seed, r):
    rows = corpus(seed)
    docs = frame(spark, rows + [rows[3]], CLASHING).repartition(5)
    got = repeats.remove_repeats(docs, r).collect()
    assert len(got) == len(rows) + 1
    want = plain([(i, t) for i, t, _ in rows], r.length)
    for x in got:
        raw, gone = want[x["doc_id"]]
        assert x["n_bytes"] == len(raw)
        assert [tuple(s) for s in x["spans"]] == spans(gone), x["doc_id"]
        assert bytes(x["kept"]) == bytes(b for b, g in zip(raw, gone) if not g)


def test_intervals_are_the_maximal_repeats():
    rng = random.Random(5)
    text = bytes(rng.choice(b"ab") for _ in range(400))
    array = repeats.SuffixArray([text], np.array([len(text) - 7]), np.array([0]))
    found = set()
    for first, last, size in repeats.maximal_repeats(array, 8):
        at = sorted(int(array.place[k]) for k in array.order[first : last + 1])
        assert len({text[p : p + size] for p in at}) == 1
        found.add((size, tuple(at)))
    want = set()
    for size in range(8, 60):
        places = {}
        for p in range(len(text) - size + 1):
            places.setdefault(text[p : p + size], []).append(p)
        for string, at in places.items():
            rights = {text[p + size : p + size + 1] or p for p in at}
            lefts = {text[p - 1 : p] if p else -1 for p in at}
            if len(at) > 1 and len(rights) > 1 and len(lefts) > 1:
                want.add((size, tuple(at)))
    assert found == want


def test_no_rows_and_no_ids(spark):
    assert repeats.remove_repeats(frame(spark, [])).count() == 0
    text = prose(random.Random(1), 60)
    got = repeats.remove_repeats(frame(spark, [(None, text, "s"), (1, text, "s"), (None, text, "s")])).collect()
    assert sorted((r["doc_id"] or 0, len(r["kept"])) for r in got) == [(0, 0), (0, 0), (1, len(text))]
