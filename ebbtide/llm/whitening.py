r"""Embedding whitening (11) by the exact characteristic polynomial.

Vectors become whole numbers ``x = floor(64 c) + 1000000``. With ``n`` vectors and ``y = n x - sum(x)`` the
integer scatter is ``A = sum(y y') / n``, and the covariance is ``A / n**2``.

1. Scatter: tasks add products of whole numbers, by matrix products of parts small enough to be exact in
   float64, and send their sums as digits in base 2**40, which Spark adds. Nothing is rounded.
2. Polynomial: ``det(t I - A)`` modulo many 31-bit primes, each by a reduction to Hessenberg form and the
   recurrence over its leading minors; one Spark row per prime. The Chinese remainder theorem joins the images
   once the primes' product exceeds twice a bound of every coefficient (Maclaurin's inequality).
3. Roots: ``A`` is symmetric, so all roots are real, and the sign changes of the coefficients of ``p(t + a)``
   count the roots above ``a`` exactly. Zero roots are trailing zeros of the polynomial. Equal roots are
   found by the greatest common divisor with the derivative, likewise by modular images; without them every
   root is alone in some interval with dyadic ends, found by bisection on the count and then
   narrowed by exact signs to as many digits as asked for.
4. Components: inverse iteration on ``A - root I`` in decimal arithmetic, with more digits of the root and of the
   arithmetic until the vector stands still to 30 digits. A root that occurs m times has m vectors, each kept
   orthogonal to those before it. One Spark row per component.
5. The whitened vectors are one narrow pass; their covariance is measured in another.

The driver holds what is bounded by the dimension: the scatter, the polynomial and the components.
"""

from __future__ import annotations

import dataclasses
import decimal
import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pack, stage

SCALE = 64
SHIFT = 1_000_000
#: ``floor(64 c)`` is held between these; a component beyond 2**56 counts as 2**56.
LIMIT = 1 << 62
#: Sums are sent as digits of this many bits.
DIGIT = 40
#: Whole numbers are multiplied in parts of this many bits, this many rows at a time: sums stay below 2**53.
PART, ROWS = 20, 2048


@dataclasses.dataclass
class Whitening:
    """``n`` vectors of dimension ``size`` with sums ``sums`` of ``floor(64 c)``; components as columns."""

    n: int
    size: int
    sums: list[int]
    eigenvalues: list[float]
    explained: list[float]
    components: np.ndarray


# Whole numbers of vectors


def matrices(vectors: pa.Array):
    """(rows, matrix of whole numbers) of the usable vectors of each length in a batch."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.fill_null(vectors.flatten(), float("nan")).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for size in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == size)
        matrix = values[starts[rows][:, None] + np.arange(size)]
        good = np.isfinite(matrix).all(axis=1)
        with np.errstate(over="ignore"):
            whole = np.floor(SCALE * matrix[good])
        yield rows[good], np.clip(whole, -float(LIMIT), float(LIMIT)).astype(np.int64)


def exact_products(whole: np.ndarray) -> np.ndarray:
    """``whole' whole`` of at most ``ROWS`` rows, as Python integers or as int64 where they fit."""
    if not len(whole) or np.abs(whole).max() < 1 << PART:
        part = whole.astype(np.float64)
        return (part.T @ part).astype(np.int64)
    parts, rest = [], whole
    while len(parts) < 4:
        last = len(parts) == 3
        parts.append((rest if last else rest & ((1 << PART) - 1)).astype(np.float64))
        rest = rest >> PART
    total = np.zeros((whole.shape[1], whole.shape[1]), dtype=object)
    for i, left in enumerate(parts):
        for j, right in enumerate(parts):
            total += (left.T @ right).astype(np.int64).astype(object) << (PART * (i + j))
    return total


def digits(value: int) -> list[int]:
    """Base 2**40, the lowest first; the last one carries the sign."""
    out = []
    while value not in (0, -1):
        out.append(value & ((1 << DIGIT) - 1))
        value >>= DIGIT
    return out + [-1] if value else out


class Sums:
    """Number, sums and sums of products of the vectors of one length."""

    def __init__(self, size: int):
        self.n = 0
        self.sums = np.zeros(size, dtype=object)
        self.products = np.zeros((size, size), dtype=object)
        self.small, self.waiting = np.zeros((size, size), dtype=np.int64), 0

    def add(self, whole: np.ndarray) -> None:
        for first in range(0, len(whole), ROWS):
            block = whole[first : first + ROWS]
            self.n += len(block)
            high = (block >> 31).sum(axis=0).astype(object)
            self.sums += (high << 31) + (block & ((1 << 31) - 1)).sum(axis=0).astype(object)
            products = exact_products(block)
            if products.dtype == object:
                self.products += products
            else:
                self.small += products
                self.waiting += 1
                if self.waiting == 512:
                    self.flush()

    def flush(self) -> None:
        self.products += self.small.astype(object)
        self.small[:] = 0
        self.waiting = 0

    def cells(self):
        """(cell, digit, value): -1 is the number, then sums, then products on and above the diagonal."""
        self.flush()
        size = len(self.sums)
        numbers = [(-1, self.n)]
        numbers += [(i, v) for i, v in enumerate(self.sums)]
        numbers += [(size + i * size + j, self.products[i, j]) for i in range(size) for j in range(i, size)]
        for cell, number in numbers:
            for place, digit in enumerate(digits(int(number))):
                yield cell, place, digit


def scatter(rows: DataFrame) -> tuple[int, int, list[int], list[list[int]]]:
    """(n, dimension, sums, integer scatter A) of the column ``__vector``, exact.

    The dimension is the commonest length of the usable vectors, the longest of several.
    """

    def run(batches):
        held: dict[int, Sums] = {}
        for batch in batches:
            for _, whole in matrices(batch.column(0)):
                if len(whole):
                    held.setdefault(whole.shape[1], Sums(whole.shape[1])).add(whole)
        for size, sums in held.items():
            cells = list(sums.cells())
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * len(cells), pa.int64()), *(pa.array([c[k] for c in cells], pa.int64()) for k in range(3))],
                names=["size", "cell", "place", "digit"],
            )

    sums = rows.select("__vector").mapInArrow(run, "size long, cell long, place long, digit long")
    table = stage(sums.groupBy("size", "cell", "place").agg(F.sum("digit").alias("digit")), "scatter")
    number = F.sum(F.col("digit").cast("double") * F.pow(F.lit(2.0), F.col("place") * DIGIT))
    first = table.filter("cell = -1").groupBy("size").agg(number.alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if first is None:
        return 0, 0, [], []
    size = first["size"]
    found: dict[int, int] = {}
    for row in table.filter(F.col("size") == size).collect():  # a few rows for each pair of dimensions
        found[row["cell"]] = found.get(row["cell"], 0) + (row["digit"] << (DIGIT * row["place"]))
    n, own = found[-1], [found.get(i, 0) for i in range(size)]
    matrix = [[0] * size for _ in range(size)]
    for i in range(size):
        for j in range(i, size):
            matrix[i][j] = matrix[j][i] = n * found.get(size + i * size + j, 0) - own[i] * own[j]
    return n, size, own, matrix


# The characteristic polynomial


def primes_below(top: int):
    """Primes below ``top`` (at most 2**31), falling."""
    root = math.isqrt(top) + 1
    sieve = np.ones(root + 1, dtype=bool)
    sieve[:2] = False
    for k in range(2, math.isqrt(root) + 1):
        if sieve[k]:
            sieve[k * k :: k] = False
    small = np.flatnonzero(sieve)
    value = top - 1
    while value > root:
        if (value % small).all():
            yield value
        value -= 1


def hessenberg(matrix: np.ndarray, p: int) -> np.ndarray:
    """A similar matrix modulo ``p`` with zeros below the first subdiagonal."""
    h = matrix % p
    size = len(h)
    for k in range(size - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factor = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factor[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factor % p).sum(axis=1)) % p
    return h


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(t I - matrix) modulo ``p``, the lowest first."""
    h = hessenberg(matrix, p)
    size = len(h)
    leading = np.zeros((size + 1, size + 1), dtype=np.int64)  # row m: the polynomial of the first m rows
    leading[0, 0] = 1
    for m in range(1, size + 1):
        share = np.zeros(m, dtype=np.int64)  # of the polynomials before it
        run = 1
        for i in range(m - 1, -1, -1):
            share[i] = h[i, m - 1] * run % p
            run = run * int(h[i, i - 1]) % p if i else 0
        lower = (share[:, None] * leading[:m] % p).sum(axis=0)
        leading[m, 1:] = leading[m - 1, :-1]
        leading[m] = (leading[m] - lower) % p
    return leading[size]


def coefficient_bound(trace: int, size: int) -> int:
    """No coefficient of a matrix with roots >= 0 of this sum is larger."""
    return max(-(-math.comb(size, k) * trace**k // size**k) for k in range(size + 1))


def remainders_to_integers(images: list[list[int]], primes: list[int]) -> list[int]:
    """The integers nearest to 0 with these remainders, coefficient by coefficient."""
    product = math.prod(primes)
    parts = [product // p for p in primes]
    parts = [part * pow(part % p, -1, p) for part, p in zip(parts, primes)]
    out = []
    for remainders in zip(*images):
        value = sum(int(r) * part for r, part in zip(remainders, parts)) % product
        out.append(value - product if 2 * value > product else value)
    return out


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients of det(t I - matrix), the lowest first; its images are Spark rows."""
    size = len(matrix)
    bound = 2 * coefficient_bound(sum(matrix[i][i] for i in range(size)), size) + 1
    primes, product = [], 1
    for p in primes_below(1 << 31):
        primes.append(p)
        product *= p
        if product > bound:
            break
    sent = spark.sparkContext.broadcast((matrix, primes))

    def run(batches):
        whole, moduli = sent.value
        whole = np.array(whole, dtype=object)
        for batch in batches:
            for k in batch.column(0).to_pylist():
                p = moduli[k]
                image = polynomial_mod((whole % p).astype(np.int64), p)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int64()), pa.array([image.tolist()], pa.list_(pa.int64()))], names=["k", "image"]
                )

    tasks = min(len(primes), spark.sparkContext.defaultParallelism)
    rows = spark.range(0, len(primes), 1, tasks).mapInArrow(run, "k long, image array<long>").collect()
    images = [row["image"] for row in sorted(rows, key=lambda r: r["k"])]
    return remainders_to_integers(images, primes)


# Roots


def divide(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Quotient and remainder by a polynomial with leading coefficient 1."""
    rest, out = list(a), [0] * max(0, len(a) - len(b) + 1)
    for k in range(len(out) - 1, -1, -1):
        out[k] = rest[k + len(b) - 1]
        if out[k]:
            for i, value in enumerate(b):
                rest[k + i] -= out[k] * value
    return out, rest[: len(b) - 1]


def derivative(a: list[int]) -> list[int]:
    return [k * value for k, value in enumerate(a)][1:]


def divisor_mod(a: list[int], b: list[int], p: int) -> list[int]:
    """The greatest common divisor modulo ``p``, with leading coefficient 1."""

    def trimmed(values):
        values = [v % p for v in values]
        while values and not values[-1]:
            values.pop()
        return values

    def monic(values):
        inverse = pow(values[-1], -1, p)
        return [v * inverse % p for v in values]

    a, b = trimmed(a), trimmed(b)
    while b:
        b = monic(b)
        for k in range(len(a) - len(b), -1, -1):
            factor = a[k + len(b) - 1]
            if factor:
                a[k : k + len(b)] = [(x - factor * y) % p for x, y in zip(a[k:], b)]
        a, b = b, trimmed(a)
    return monic(a)


def without_repeats(polynomial: list[int]) -> list[int]:
    """The polynomial with leading coefficient 1 that has each root once."""
    if len(polynomial) < 3:
        return polynomial
    slope = derivative(polynomial)
    images, moduli, length = [], [], len(polynomial) + 1
    for p in primes_below(1 << 31):
        image = divisor_mod(polynomial, slope, p)
        if len(image) == 1:
            return polynomial  # no common root modulo one prime: none at all
        if len(image) < length:
            images, moduli, length = [], [], len(image)
        if len(image) == length:
            images.append(image)
            moduli.append(p)
            common = remainders_to_integers(images, moduli)
            if not any(divide(polynomial, common)[1]) and not any(divide(slope, common)[1]):
                return divide(polynomial, common)[0]
    raise ArithmeticError("no common divisor found")


class Roots:
    """Counts and signs of a polynomial with real roots only, at ``place / 2**scale``."""

    def __init__(self, polynomial: list[int]):
        self.own = polynomial
        self.scaled: dict[int, list[int]] = {}

    def at(self, scale: int) -> list[int]:
        if scale not in self.scaled:
            top = len(self.own) - 1
            self.scaled[scale] = [value << (scale * (top - k)) for k, value in enumerate(self.own)]
        return self.scaled[scale]

    def above(self, place: int, scale: int) -> int:
        """How many roots lie above: the sign changes of the coefficients around the place."""
        shifted = list(self.at(scale))
        for first in range(len(shifted) - 1):
            for k in range(len(shifted) - 2, first - 1, -1):
                shifted[k] += place * shifted[k + 1]
        signs = [value > 0 for value in shifted if value]
        return sum(a != b for a, b in zip(signs, signs[1:]))

    def sign(self, place: int, scale: int) -> int:
        value = 0
        for coefficient in reversed(self.at(scale)):
            value = value * place + coefficient
        return (value > 0) - (value < 0)


@dataclasses.dataclass
class Root:
    """The only one in (low, high] / 2**scale; ``above`` single roots are larger, ``first`` counted as often as they occur."""

    low: int
    high: int
    scale: int
    above: int
    first: int


def isolate(every: Roots, single: Roots, number: int, top: int) -> Root:
    """The root that is ``number``-th from above, each counted as often as it occurs."""
    low, high, scale = 0, top, 0
    while single.above(low, scale) - single.above(high, scale) > 1:
        if high - low == 1:
            low, high, scale = low << 16, high << 16, scale + 16
        middle = (low + high) // 2
        if every.above(middle, scale) >= number:
            low = middle
        else:
            high = middle
    return Root(low, high, scale, single.above(high, scale), every.above(high, scale))


def narrow(single: Roots, root: Root, bits: int) -> Root:
    """The same root with an interval that is 2**-bits of it or less."""
    low, high, scale = root.low, root.high, root.scale
    beyond = -1 if root.above % 2 else 1  # the sign between this root and the next larger one
    while not low or (high - low) << bits > low:
        if high - low == 1:
            low, high, scale = low << 64, high << 64, scale + 64
        middle = (low + high) // 2
        sign = single.sign(middle, scale)
        if sign == 0:
            low, high, scale = (middle << bits) - 1, middle << bits, scale + bits
            break
        low, high = (low, middle) if sign == beyond else (middle, high)
    return dataclasses.replace(root, low=low, high=high, scale=scale)


# Components


class Solver:
    """Solves (A - root I) v = b in the current decimal precision, by elimination with row exchanges."""

    def __init__(self, matrix: list[list[int]], root: Decimal, least: Decimal):
        size = len(matrix)
        work = np.array([[Decimal(v) for v in row] for row in matrix], dtype=object)
        for i in range(size):
            work[i, i] -= root
        self.order = list(range(size))
        for k in range(size):
            pivot = max(range(k, size), key=lambda i: abs(work[i, k]))
            if pivot != k:
                work[[k, pivot]] = work[[pivot, k]]
                self.order[k], self.order[pivot] = self.order[pivot], self.order[k]
            if abs(work[k, k]) < least:
                work[k, k] = least  # a root: what remains is rounding
            if k + 1 < size:
                work[k + 1 :, k] = work[k + 1 :, k] / work[k, k]
                work[k + 1 :, k + 1 :] -= np.outer(work[k + 1 :, k], work[k, k + 1 :])
        self.work = work

    def solve(self, values: np.ndarray) -> np.ndarray:
        size, work = len(self.order), self.work
        out = values[self.order].copy()
        for k in range(1, size):
            out[k] -= np.dot(work[k, :k], out[:k])
        for k in range(size - 1, -1, -1):
            if k + 1 < size:
                out[k] -= np.dot(work[k, k + 1 :], out[k + 1 :])
            out[k] = out[k] / work[k, k]
        return out


def unit(values: np.ndarray) -> np.ndarray:
    largest = max(abs(v) for v in values)
    values = values / largest
    return values / np.dot(values, values).sqrt()


def apart(values: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for other in others:
            values = values - np.dot(values, other) * other
    return values


def start(size: int, number: int) -> np.ndarray:
    """A fixed start vector without any pattern that a matrix would share."""
    return np.array([Decimal((i + 1) * (i + 3 + number) * 7919 % 10007 - 5003) for i in range(size)], dtype=object)


def component(matrix: list[list[int]], every: Roots, single: Roots, number: int) -> tuple[Decimal, np.ndarray]:
    """The ``number``-th root from above, and its unit vector (its largest entry is positive)."""
    size, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    root = isolate(every, single, number, trace)
    wanted = 60
    while True:
        root = narrow(single, root, int(wanted * 3.33) + 1)
        with decimal.localcontext() as context:
            context.prec = wanted + 30 + len(str(trace)) - len(str(max(1, root.high >> root.scale)))
            context.Emax, context.Emin = decimal.MAX_EMAX, decimal.MIN_EMIN
            value = (Decimal(root.low) + Decimal(root.high)) / 2 / Decimal(2) ** root.scale
            solver = Solver(matrix, value, Decimal(trace).scaleb(-context.prec))
            found: list[np.ndarray] = []
            still = True
            for k in range(number - root.first):
                vector = unit(apart(start(size, k), found))
                for _ in range(6):
                    before, vector = vector, unit(apart(solver.solve(vector), found))
                    moved = min(max(abs(a - s * b) for a, b in zip(vector, before)) for s in (1, -1))
                    if moved < Decimal(10) ** -30:
                        break
                else:
                    still = False
                    break
                found.append(vector)
            if still:
                vector = found[-1]
                largest = max(range(size), key=lambda i: abs(vector[i]))
                return value, np.array([float(v) for v in (vector if vector[largest] > 0 else -vector)])
        wanted *= 2


def fit(df: DataFrame, vector: str = "embedding", most: int = 32) -> Whitening:
    """The whitening of all usable vectors of ``df``: up to ``most`` components with a root above 0.

    NULL vectors, those with NULL or non-finite entries, empty ones, and those of another length than the commonest (the
    longest of several) are left out. Repeated rows count as often as they occur. Equal roots have any
    orthonormal vectors of their space, always the same. Fewer components than ``most`` if the vectors span less: one
    vector, or equal ones, have none, and neither has an empty table. Further columns aren't read.
    """
    spark = df.sparkSession
    rows = df.select(F.col(f"`{vector}`").cast("array<double>").alias("__vector"))
    n, size, sums, matrix = scatter(rows)
    if not n or not any(matrix[i][i] for i in range(size)):
        return Whitening(n, size, sums, [], [], np.zeros((size, 0)))
    polynomial = characteristic_polynomial(spark, matrix)
    while polynomial[0] == 0:
        polynomial = polynomial[1:]
    single = without_repeats(polynomial)
    number = min(most, len(polynomial) - 1)
    sent = spark.sparkContext.broadcast((matrix, polynomial, single))

    def run(batches):
        whole, every, once = sent.value
        every, once = Roots(every), Roots(once)
        for batch in batches:
            for k in batch.column(0).to_pylist():
                value, direction = component(whole, every, once, k + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int64()), pa.array([str(value)]), pa.array([direction.tolist()], pa.list_(pa.float64()))],
                    names=["k", "root", "direction"],
                )

    found = spark.range(0, number, 1, number).mapInArrow(run, "k long, root string, direction array<double>").collect()
    found = sorted(found, key=lambda row: row["k"])
    trace = sum(matrix[i][i] for i in range(size))
    with decimal.localcontext() as context:
        context.prec = 40
        values = [float(Decimal(row["root"]) / n / n) for row in found]
        shares = [float(Decimal(row["root"]) / trace) for row in found]
    return Whitening(n, size, sums, values, shares, np.array([row["direction"] for row in found]).T)


def deviations(whole: np.ndarray, model: Whitening) -> pa.Array:
    """sum((n x - sum(x))**2) of each row, exact; NULL where it has more than 38 digits."""
    largest = max(int(np.abs(whole).max(initial=0)), 1) * model.n + max(map(abs, model.sums), default=0)
    if largest < 1 << 31 and largest**2 * max(model.size, 1) < 1 << 62:
        centred = whole * model.n - np.array(model.sums, dtype=np.int64)
        return pa.array((centred * centred).sum(axis=1)).cast(pa.decimal128(38, 0))
    centred = whole.astype(object) * model.n - np.array(model.sums, dtype=object)
    values = (centred * centred).sum(axis=1) if len(whole) else []
    return pa.array([Decimal(v) if v < 10**38 else None for v in map(int, values)], pa.decimal128(38, 0))


def whiten(df: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """``__row`` (the columns of ``df``), ``deviation`` decimal(38,0), ``whitened`` array<double>.

    One row per usable vector of the fitted length, see ``fit``; the others have none. ``deviation`` is the
    exact sum over dimensions of (n x - sum(x))**2, NULL beyond 38 digits. ``whitened`` has a number for each
    component: the centred vector along it, over the root of its variance. Repeated rows give repeated results.
    """
    rows = pack(df).selectExpr("__row", f"cast(__row.`{vector}` as array<double>) as __vector")
    scaled = model.components / np.sqrt(np.array(model.eigenvalues)) if model.eigenvalues else model.components
    centre = np.array([s / model.n for s in model.sums]) if model.n else np.zeros(0)

    def run(batches):
        for batch in batches:
            own = batch.column(batch.schema.get_field_index("__row"))
            for at, whole in matrices(batch.column(batch.schema.get_field_index("__vector"))):
                if not len(at) or whole.shape[1] != model.size:
                    continue
                values = (whole - centre) @ scaled
                ends = np.arange(len(at) + 1) * values.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.ravel(), pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [own.take(pa.array(at)), deviations(whole, model), lists], names=["__row", "deviation", "whitened"]
                )

    schema = rows.select("__row").schema.add("deviation", T.DecimalType(38, 0)).add("whitened", T.ArrayType(T.DoubleType()))
    return rows.mapInArrow(run, schema)


def identity_error(whitened: DataFrame, components: int) -> float:
    """The largest entry of the covariance of ``whitened`` minus the identity, measured over all its rows.

    0 if there are no components or no rows.
    """
    if not components:
        return 0.0

    def run(batches):
        n, sums, products = 0, np.zeros(components), np.zeros((components, components))
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, components)
            n += len(values)
            sums += values.sum(axis=0)
            products += values.T @ values
        cells = np.concatenate([[n], sums, products.ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(cells)), pa.int64()), pa.array(cells, pa.float64())], names=["cell", "value"]
        )

    totals = whitened.select("whitened").mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("v"))
    found = np.array([row["v"] for row in totals.orderBy("cell").collect()])  # one row per pair of components
    if not len(found) or not found[0]:
        return 0.0
    n, mean = found[0], found[1 : components + 1] / found[0]
    covariance = found[components + 1 :].reshape(components, components) / n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(components)).max())
