"""Calibration by Newton steps, bins by conditional inference, densities: against plain versions."""

import math
import random

import numpy as np
import pytest

from ebbtide.operators import calibration
from ebbtide.operators import evaluation as ev

SCHEMA = "score double, Response int"


def scored(spark, pairs):
    return spark.createDataFrame(pairs, SCHEMA)


def random_pairs(n=3000, seed=2, places=2):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x = round(rng.random(), places)
        out.append((x, int(rng.random() < 1 / (1 + math.exp(-6 * (x - 0.5))))))
    return out + [(None, 1), (0.3, None)]


def plain_newton(pairs):
    x, y = (np.array(v, dtype=float) for v in zip(*[p for p in pairs if None not in p]))
    design, b = np.column_stack([np.ones_like(x), x]), np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-design @ b))
        hessian = (design * (p * (1 - p))[:, None]).T @ design
        b = b + np.linalg.solve(hessian, design.T @ (y - p))
    return b, np.sqrt(np.diag(np.linalg.inv(hessian)))


@pytest.mark.parametrize("shift", [0.0, 1e6, -300.0])
def test_calibration_and_its_errors(spark, shift):
    pairs = random_pairs()
    moved = [(None if x is None else x + shift, y) for x, y in pairs]
    curve = calibration.fit_calibration(scored(spark, moved), "score", "Response")
    b, errors = plain_newton(pairs)
    assert curve.slope == pytest.approx(b[1], rel=1e-7)
    assert curve.slope_error == pytest.approx(errors[1], rel=1e-6)
    assert curve.intercept == pytest.approx(b[0] - b[1] * shift, rel=1e-7)
    if not shift:
        assert curve.intercept_error == pytest.approx(errors[0], rel=1e-6)


def test_calibration_where_there_is_no_maximum(spark):
    def values(pairs, at):
        curve = calibration.fit_calibration(scored(spark, pairs), "score", "Response")
        rows = scored(spark, [(x, 0) for x in at]).select("score", curve.column("score").alias("p")).collect()
        return curve, [r["p"] for r in sorted(rows, key=lambda r: r["score"])]

    curve, got = values([(0.125, 0), (0.25, 0), (0.5, 1), (0.875, 1)], [0.125, 0.37, 0.375, 0.38, 1.0])
    assert got == [0, 0, 0.5, 1, 1] and curve.slope == math.inf
    _, got = values([(0.1, 1), (0.2, 1), (0.2, 0), (0.2, 0), (0.4, 0)], [0.1, 0.2, 0.3])
    assert got == [1, pytest.approx(1 / 3), 0]
    curve, got = values([(0.5, 1), (0.5, 0), (0.5, 0), (0.5, 0)], [0.1, 0.9])
    assert curve.slope == 0 and got == [pytest.approx(0.25)] * 2
    assert values([(0.1, 1), (0.4, 1)], [0.2])[1] == [1.0]
    assert values([(0.1, 0), (0.4, 0)], [0.2])[1] == [0.0]
    with pytest.raises(ValueError, match="needs rows"):
        calibration.fit_calibration(scored(spark, [(None, 1)]), "score", "Response")


def plain_cuts(pairs, share, significance=0.05, min_split=20):
    """Recursion over the rows themselves; p-values by the normal distribution's tails."""
    rows = sorted(p for p in pairs if None not in p)
    least = max(1, math.ceil(round(share * len(rows), 9)))

    def statistic(xs, ys):
        n, rate = len(xs), sum(ys) / len(ys)
        var = rate * (1 - rate) / (n - 1)
        spread = var * (n * sum(x * x for x in xs) - sum(xs) ** 2)
        return (sum(x * y for x, y in zip(xs, ys)) - rate * sum(xs)) ** 2 / spread if spread > 1e-12 else 0.0

    def cut(part):
        xs, ys = [r[0] for r in part], [r[1] for r in part]
        if len(part) < min_split or math.erfc(math.sqrt(statistic(xs, ys) / 2)) >= significance:
            return []
        best = None
        for c in sorted(set(xs))[:-1]:
            left = [1.0 * (x <= c) for x in xs]
            if least <= sum(left) <= len(part) - least:
                value = statistic(left, ys)
                if best is None or value > best[0] * (1 + 1e-12):
                    best = value, c
        if best is None:
            return []
        c = best[1]
        return cut([r for r in part if r[0] <= c]) + [c] + cut([r for r in part if r[0] > c])

    return cut(rows)


@pytest.mark.parametrize(("seed", "n", "share"), [(1, 800, 0.01), (2, 500, 0.1), (3, 60, 0.01), (4, 2000, 0.05)])
def test_bins_by_inference(spark, seed, n, share):
    pairs = random_pairs(n, seed)
    got = calibration.learn_cut_points(scored(spark, pairs), "score", "Response", share)
    assert got == plain_cuts(pairs, share)
    assert n < 500 or len(got) >= 3


def test_bins_without_dependence(spark):
    rng = random.Random(3)
    noise = [(rng.random(), rng.randrange(2)) for _ in range(400)]
    assert calibration.learn_cut_points(scored(spark, noise), "score", "Response", 0.01) == plain_cuts(noise, 0.01)
    for pairs in ([], [(0.5, 1)], [(0.5, 1), (0.5, 0)] * 30, [(k / 9, 1) for k in range(40)]):
        assert calibration.learn_cut_points(scored(spark, pairs), "score", "Response", 0.01) == []
    steps = [(float(k // 20), int(k // 20 in (1, 3))) for k in range(100)]
    assert calibration.learn_cut_points(scored(spark, steps), "score", "Response", 0.01) == plain_cuts(steps, 0.01)


def plain_density(xs, points=512):
    xs = np.sort(np.array(xs, dtype=float))
    n = len(xs)
    sd = xs.std(ddof=1) if n > 1 else float("nan")
    q1, q3 = np.quantile(xs, [0.25, 0.75])
    narrow = min(sd, (q3 - q1) / 1.34)
    h = 0.9 * (narrow if narrow > 0 else sd if sd > 0 else 1.0) * n**-0.2
    grid = np.linspace(xs[0] - 3 * h, xs[-1] + 3 * h, points)
    exact = np.exp(-(((grid[:, None] - xs[None, :]) / h) ** 2) / 2).sum(axis=1) / (n * h * math.sqrt(2 * math.pi))
    return grid, exact, h


@pytest.mark.parametrize("xs", [[x for x, _ in random_pairs(700)[:700]], [0.2] * 90 + [0.9] * 3, [0.4, 0.4], [2.5], [1.5, -2.0, 7.0]])
def test_density(spark, xs):
    rows = sorted(ev.score_density(scored(spark, [(x, 0) for x in xs] + [(None, 1)]), "score").collect())
    grid, exact, h = plain_density(xs)
    assert len(rows) == 512 and rows[0]["bandwidth"] == pytest.approx(h)
    assert [r["x"] for r in rows] == pytest.approx(grid.tolist())
    got = np.array([r["density"] for r in rows])
    assert np.abs(got - exact).max() < 2e-3 * exact.max()  # sharing between grid points
    assert abs(got.sum() * (grid[1] - grid[0]) - 1) < 0.01
    assert ev.score_density(scored(spark, [(None, 1)]), "score").collect() == []
