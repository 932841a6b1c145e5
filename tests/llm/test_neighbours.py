import random

import numpy as np
import pytest

from ebbtide.llm import neighbours

from .plain import groups


def vectors(seed=1, size=16):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, None):
        for k in range(6):
            centre = rng.standard_normal(size)
            for _ in range((1, 2, 5, 40, 3, 1)[k]):
                rows.append((centre + 0.08 * rng.standard_normal(size), label))
        rows += [(rng.standard_normal(size), label) for _ in range(60)]
    out = [(i, v.astype(np.float32).tolist(), y) for i, (v, y) in enumerate(rows)]
    odd = [None, [], [0.0] * size, [1.0] * (size - 1) + [None], [float("nan")] * size, [float("inf")] + [1.0] * (size - 1), [1.0, 2.0]]
    out += [(1000 + k, v, 0) for k, v in enumerate(odd)]
    return out + [(2000, out[0][1], 0), (2001, out[0][1], 0), (2001, out[0][1], 0), (2002, [10 * x for x in out[0][1]], 0)]


def truth(rows):
    usable = {}
    for k, (i, v, y) in enumerate(rows):
        good = y is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        usable[k] = (y, np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float))) if good else None

    def linked(a, b):
        x, y = usable[a], usable[b]
        return bool(x and y and x[0] == y[0] and len(x[1]) == len(y[1]) and x[1] @ y[1] >= 0.93)

    group = groups(usable, linked)
    least = {}
    for k, g in group.items():
        least[g] = min(least.get(g, 10**9), rows[k][0])
    return [(rows[k][0], sum(linked(k, j) for j in usable if j != k), least[group[k]]) for k in usable]


SCHEMA = "vec_id long, embedding array<float>, label int, node long, size int, component long"


@pytest.mark.parametrize("d", [neighbours.Descent(), neighbours.Descent(trees=2, cell=8, k=2, k_most=4, block=7, audit=60)])
def test_against_brute_force(spark, d):
    rows = vectors()
    random.Random(1).shuffle(rows)
    got = neighbours.linked_vectors(spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA), d).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == sorted(truth(rows))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_no_rows(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert neighbours.linked_vectors(frame).count() == 0
    one = spark.createDataFrame([(5, None, None, 1, 1, 1)], SCHEMA)
    assert [tuple(r) for r in neighbours.linked_vectors(one).collect()] == [(5, 0, 5, True)]


@pytest.mark.parametrize("d", [neighbours.Descent(cell=20), neighbours.Descent(trees=1, share=0.1, cell=10, k=2, iterations=1, audit=100, audit_links=10)])
def test_few_links_in_many_vectors(spark, caplog, d):
    """Pairs that stand alone among many vectors without links, beside one large group: whatever the trees see, 0.99 is found."""
    rng = np.random.default_rng(5)
    singles, pairs = rng.standard_normal((900, 16)), rng.standard_normal((60, 16))
    group = rng.standard_normal(16) + 0.02 * rng.standard_normal((300, 16))
    x = np.concatenate([singles, pairs, pairs + 0.06 * rng.standard_normal(pairs.shape), group])
    rows = [(k, v.astype(np.float32).tolist(), k % 3 if k < 900 else 1) for k, v in enumerate(x)]
    want = {r[0]: r for r in truth(rows)}
    with caplog.at_level("INFO", logger="ebbtide.llm.neighbours"):
        got = neighbours.linked_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), d).collect()
    linked = [i for i, (_, n, _) in want.items() if n]
    equal = sum((r["vec_id"], r["n_links"], r["component_id"]) == want[r["vec_id"]] for r in got if r["vec_id"] in set(linked))
    assert len(linked) > 400 and equal >= 0.99 * len(linked)
    assert "recall" in caplog.text
