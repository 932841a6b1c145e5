import math
from fractions import Fraction

import numpy as np
import pytest

from ebbtide.llm import queries, whitening
from ebbtide.llm.whitening import Roots

SCHEMA = "vec_id long, embedding array<double>, label int, n long, deviation string, whitened int, __row int, __vector int"


def whole(vector):
    return [math.floor(64 * c) + 1_000_000 for c in vector]


def usable(vectors, size):
    return [
        (i, v) for i, v in vectors if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)
    ]


def leverrier(a):
    """Coefficients of det(t I - a), the lowest first, by traces of powers (Faddeev and LeVerrier)."""
    size = len(a)
    a = np.array(a, dtype=object)
    m, out = np.zeros((size, size), dtype=object), [1]
    for k in range(1, size + 1):
        m = a.dot(m) + out[-1] * np.eye(size, dtype=int).astype(object)
        out.append(-sum(a.dot(m)[i, i] for i in range(size)) // k)
    return out[::-1]


def scattered(rows):
    x = np.array([whole(v) for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    return [[int(v) for v in row] for row in (n * x.T.dot(x) - np.outer(sums, sums))]


def random_rows(n, size, seed=1, scale=1.0):
    rng = np.random.default_rng(seed)
    mix = rng.standard_normal((size, size))
    return [(i, (scale * rng.standard_normal(size) @ mix).tolist()) for i in range(n)]


def spoilt(size):
    inf, nan = float("inf"), float("nan")
    bad = [None, [], [None] + [1.0] * (size - 1), [nan] * size, [inf] + [0.0] * (size - 1), [1.0] * (size + 1), [2.0]]
    return [(9000 + k, v) for k, v in enumerate(bad)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 5, "d", 2, 3, 4) for i, v in rows], SCHEMA).repartition(3)


def result(spark, rows, most=32):
    df = frame(spark, rows)
    model = whitening.fit(df, most=most)
    out = whitening.whiten(df, model)
    return model, out, sorted(((r["__row"]["vec_id"], r["deviation"] and int(r["deviation"]), r["whitened"]) for r in out.collect()), key=repr)


@pytest.mark.parametrize(("n", "size", "scale"), [(80, 9, 1.0), (40, 40, 3.0), (25, 5, 1e7), (7, 3, 1e-2)])
def test_against_numpy(spark, n, size, scale):
    rows = random_rows(n, size, n, scale) + [(3, random_rows(n, size, n, scale)[3][1])] + spoilt(size)
    model, out, got = result(spark, rows)
    good = usable(rows, size)
    x = np.array([whole(v) for _, v in good], dtype=object)
    sums = x.sum(axis=0)
    centred = (len(x) * x - sums).astype(float) / len(x)
    values, directions = np.linalg.eigh(centred.T @ centred / len(x))
    values, directions = values[::-1], directions[:, ::-1]
    k = len(model.eigenvalues)
    assert k == min(32, size, len(x) - 1)
    assert np.allclose(model.eigenvalues, values[:k], rtol=1e-9)
    assert np.allclose(model.explained, values[:k] / values.sum(), rtol=1e-9)
    want = centred @ directions[:, :k] / np.sqrt(values[:k])
    found = {}
    for i, _, v in got:
        found.setdefault(i, v)
    own = np.array([found[i] for i, _ in good])
    signs = np.sign((own * want).sum(axis=0))
    assert np.abs(own - want * signs).max() < 1e-6
    assert sorted((i, d) for i, d, _ in got) == sorted(
        (i, sum((len(x) * a - int(s)) ** 2 for a, s in zip(whole(v), sums))) for i, v in good
    )
    error = whitening.identity_error(out, k)
    mean = own.mean(axis=0)
    assert error < 1e-9
    assert abs(error - np.abs((own - mean).T @ (own - mean) / len(own) - np.eye(k)).max()) < 1e-9


def test_scatter_and_polynomial_are_exact(spark):
    for n, size, scale in [(30, 6, 1.0), (30, 6, 1e9), (4000, 3, 1e5)]:
        rows = random_rows(n, size, 4, scale)
        df = frame(spark, rows).selectExpr("embedding as __vector")
        found_n, found_size, sums, matrix = whitening.scatter(df)
        assert (found_n, found_size) == (n, size)
        assert matrix == scattered(rows)
        assert whitening.characteristic_polynomial(spark, matrix) == leverrier(matrix)
    for matrix in ([[0, 0], [0, 0]], [[5]], [[0, 0, 1], [0, 2, 0], [1, 0, 3]], np.diag([3, 3, 0, 7]).tolist()):
        for p in (2147483647, 101):
            want = [c % p for c in leverrier(matrix)]
            assert whitening.polynomial_mod(np.array(matrix), p).tolist() == want


def test_equal_roots_and_lost_dimensions(spark):
    """Corners of a cube (one root three times) beside a constant dimension, and one that repeats another."""
    corners = [[a, b, c, 5.0, a] for a in (-1.0, 1.0) for b in (-1.0, 1.0) for c in (-1.0, 1.0)]
    model, out, got = result(spark, list(enumerate(corners)))
    assert np.allclose(model.eigenvalues, [2 * 64**2, 64**2, 64**2])
    assert np.allclose(model.components.T @ model.components, np.eye(3), atol=1e-14)
    assert whitening.identity_error(out, 3) < 1e-12
    assert result(spark, list(enumerate(corners)))[2] == got
    simplex = [[float(i == j) for j in range(6)] for i in range(6)]
    model, out, _ = result(spark, list(enumerate(simplex)))
    assert len(model.eigenvalues) == 5 and np.ptp(model.eigenvalues) == 0
    assert whitening.identity_error(out, 5) < 1e-12
    assert np.abs(model.components.T @ model.components - np.eye(5)).max() < 1e-14


def test_roots_of_known_polynomials():
    def times(roots):
        out = [1]
        for r in roots:
            out = [(out[k - 1] if k else 0) - r * (out[k] if k < len(out) else 0) for k in range(len(out) + 1)]
        return out

    for roots in ([1, 2, 3], [5, 5, 9], [4, 4, 4], [1, 10**6, 10**6 + 1, 10**6 + 1], [7]):
        p = times(roots)
        single = whitening.without_repeats(p)
        assert single == times(sorted(set(roots)))
        every, once = Roots(p), Roots(single)
        for k, want in enumerate(sorted(roots, reverse=True), 1):
            root = whitening.narrow(once, whitening.isolate(every, once, k, sum(roots)), 80)
            assert Fraction(root.low, 2**root.scale) <= want <= Fraction(root.high, 2**root.scale)
            assert Fraction(root.high - root.low, 2**root.scale) <= Fraction(want, 2**70)
    near = [2**40, 2**40 * 10**30 + 1, 2**40 * 10**30]  # two of them differ in the 43rd digit
    every = Roots(times(near))
    roots = [whitening.narrow(every, whitening.isolate(every, every, k, sum(near)), 200) for k in (1, 2)]
    assert [r.high >> r.scale for r in roots] == [near[1], near[2]] or [r.low >> r.scale for r in roots] == [near[1] - 1, near[2] - 1]


def test_close_roots_need_more_digits():
    matrix = [[10**40, 1, 0], [1, 10**40, 0], [0, 0, 5]]
    p = leverrier(matrix)
    value, vector = whitening.component(matrix, Roots(p), Roots(whitening.without_repeats(p)), 1)
    assert round(value) == 10**40 + 1
    assert np.allclose(vector, [0.5**0.5, 0.5**0.5, 0], atol=1e-15)


def test_small_tables(spark):
    for rows in ([], spoilt(3)[:5], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        model, out, got = result(spark, rows)
        assert model.eigenvalues == [] and whitening.identity_error(out, 0) == 0.0
        assert [(d, w) for _, d, w in got] == [(0, [])] * len(usable(rows, 2))
    model, _, got = result(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0])])
    assert len(model.eigenvalues) == 1 and [abs(w[0]) for _, _, w in got] == [1.0, 1.0]
    model, _, got = result(spark, random_rows(50, 6), most=2)
    assert len(model.eigenvalues) == 2 and {len(w) for _, _, w in got} == {2}


def test_very_large_components(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.5, 2.0])]
    model, out, got = result(spark, rows)
    assert len(model.eigenvalues) == 2 and len(got) == 3
    whole = [[whitening.LIMIT, 0], [-whitening.LIMIT, 64], [32, 128]]  # held at the limit, beyond 38 digits NULL
    exact = [sum((3 * a - b) ** 2 for a, b in zip(row, (32, 192))) for row in whole]
    assert [d for _, d, _ in got] == [d if d < 10**38 else None for d in exact]
    assert all(math.isfinite(x) for _, _, w in got for x in w)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = queries.QUERIES["op11_exact_whitening"].build(spark, folder).collect()
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    assert len(rows) == 32 * len(vectors) and {r["n"] for r in rows} == {len(vectors)}
    assert sorted({r["component"] for r in rows}) == list(range(1, 33))
    x = np.array([whole(v["embedding"]) for v in vectors], dtype=np.int64)
    deviation = dict(zip([v["vec_id"] for v in vectors], ((len(x) * x - x.sum(axis=0)) ** 2).sum(axis=1).tolist()))
    assert all(r["deviation"] == deviation[r["vec_id"]] for r in rows)
    assert max(r["identity_error"] for r in rows) < 1e-10
    values = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    explained = {r["component"]: r["explained"] for r in rows}
    assert np.allclose([explained[k] for k in range(1, 33)], values[:32] / values.sum(), rtol=1e-9)
