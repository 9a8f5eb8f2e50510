"""Whiten embeddings by their exact spectrum.

Vectors become whole numbers.  The scatter of the distinct ones, n * sum(x x') - S S', is a matrix of integers, summed exactly in
Spark.  Its characteristic polynomial is worked out modulo many primes, a few per task, by reduction to Hessenberg form; Chinese
remaindering puts the integer coefficients together, from enough primes to exceed a proven bound on them.  All roots are
real, so the sign changes of the shifted polynomial count the roots above any number exactly, with multiplicity: bisection isolates
them, and bisection on the sign alone narrows each to ``PRECISION`` bits.  Components come from inverse iteration in fixed-point
integers of that precision; equal eigenvalues share one factorisation and are made orthogonal.

What reaches the driver is one number per pair of dimensions and per prime and coefficient, whatever the number of vectors.

Defined results: vectors that are null or hold null or non-finite entries are dropped, and so are vectors of another length than the
most frequent one (ties: the longest).  Entries beyond 2^62 in size are set to it.  ``deviation`` is null where it does not fit a long;
``deviation_digits`` then has it.  Eigenvalues of zero, found exactly, have components (any orthonormal
basis) but null ``whitened``, and ``explained`` is null where all are zero.  Repeated rows are rows of their own that count once in the fit; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledger.llm.common import cut, named

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
LIMIT = 1 << 62
#: Bits to which roots are known: far beyond the 53 of a double, so that close eigenvalues keep clean components.
PRECISION = 192
#: Sums cross the exchange as two decimals of 38 digits: value = high * 2^64 + low.
HALF = 1 << 64


def whole(embedding: Column) -> Column:
    """The vector as whole numbers without the offset, which shifts all alike: floor(64 * c)."""
    def entry(c: Column) -> Column:
        wide = c.cast("double") * SCALE
        return F.floor(F.least(F.greatest(wide, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))).cast("long")
    return F.transform(embedding, entry)


def usable(embedding: Column) -> Column:
    def odd(c: Column) -> Column:
        wide = c.cast("double")
        return c.isNull() | F.isnan(wide) | (F.abs(wide) == F.lit(math.inf))
    return embedding.isNotNull() & ~F.exists(embedding, odd)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _products(rows: np.ndarray) -> np.ndarray:
    """Exact sums of products of all pairs of columns, as Python integers."""
    total = np.zeros((rows.shape[1],) * 2, object)
    largest = int(max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0)))))
    if largest >= 1 << 26:
        wide = rows.astype(object)
        return total + wide.T @ wide
    # Doubles hold all whole numbers below 2^53, so sums of so many products are exact.
    step = max(1, (1 << 53) // max(1, largest * largest) - 1)
    for at in range(0, len(rows), min(step, 1 << 16)):
        part = rows[at:at + min(step, 1 << 16)].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def moments(fit: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """Number of rows, sums and sums of products of ``fit.x``, exact."""
    exact = pa.decimal128(38, 0)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(width, object), np.zeros((width, width), object)
        for batch in batches:
            rows = _matrix(batch.column(0), width)
            n += len(rows)
            sums += rows.astype(object).sum(axis=0) if len(rows) else 0
            products += _products(rows)
        if n:
            cells = [(-1, -1, n), *((-1, j, int(v)) for j, v in enumerate(sums))]
            cells += [(i, j, int(products[i, j])) for i in range(width) for j in range(i, width)]
            i, j, value = zip(*cells, strict=True)
            high = [v >> 64 for v in value]
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(h) for h in high], exact),
                 pa.array([Decimal(v - (h << 64)) for v, h in zip(value, high, strict=True)], exact)], ["i", "j", "high", "low"])

    parts = fit.select("x").mapInArrow(partial, "i int, j int, high decimal(38,0), low decimal(38,0)")
    cells = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    found = {(r.i, r.j): int(r.high) * HALF + int(r.low) for r in cells}
    square = [[found[min(i, j), max(i, j)] for j in range(width)] for i in range(width)]
    return found[-1, -1], [found[-1, j] for j in range(width)], square


def _is_prime(n: int) -> bool:
    """Miller and Rabin; these bases decide every number below 2^32."""
    if n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 7, 61):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2^31, the largest first, whose product exceeds ``bound``."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def polynomial_modulo(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Characteristic polynomial of ``matrix`` modulo each of ``primes``: a row per prime, the constant coefficient first."""
    d, m = len(matrix), np.array(primes, np.int64)
    h = np.array([[[v % p for v in row] for row in matrix] for p in primes], np.int64)
    col, cube, each = m[:, None], m[:, None, None], np.arange(len(primes))
    for k in range(1, d - 1):
        # A row with an entry in column k - 1 comes to row k, its column along with it.
        pivot = k + (h[:, k:, k - 1] != 0).argmax(axis=1)
        for by_row in (True, False):
            view = h if by_row else h.transpose(0, 2, 1)
            moved = view[each, pivot].copy()
            view[each, pivot] = view[:, k]
            view[:, k] = moved
        inverse = np.array([pow(int(v), -1, int(p)) if v else 0 for v, p in zip(h[:, k, k - 1], m, strict=True)], np.int64)
        factor = h[:, k + 1:, k - 1] * inverse[:, None] % col
        h[:, k + 1:] = (h[:, k + 1:] - factor[:, :, None] * h[:, k, None, :] % cube) % cube
        h[:, :, k] = (h[:, :, k] + (h[:, :, k + 1:] * factor[:, None, :] % cube).sum(axis=2)) % col
    # The polynomials of the leading blocks, each from all before it.
    p = np.zeros((len(primes), d + 1, d + 1), np.int64)
    p[:, 0, 0] = 1
    for k in range(1, d + 1):
        p[:, k, 1:] = p[:, k - 1, :-1]
        weight, chain = np.zeros((len(primes), k), np.int64), np.ones(len(primes), np.int64)
        for i in range(k):
            if i:
                chain = chain * h[:, k - i, k - i - 1] % m
            weight[:, k - 1 - i] = chain * h[:, k - 1 - i, k - 1] % m
        p[:, k] = (p[:, k] - (weight[:, :, None] * p[:, :k] % cube).sum(axis=1)) % col
    return p[:, d]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients of det(t - matrix), the constant one first; ``matrix`` has no negative eigenvalue."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    # With roots of at least 0, the coefficients are largest where all roots are equal.
    bound = max(math.comb(d, k) * trace ** k // d ** k + 1 for k in range(d + 1))
    primes = primes_beyond(2 * bound + 1)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [primes[k] for k in batch.column(0).to_pylist()]
            if own:
                rows = polynomial_modulo(matrix, own).tolist()
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(rows, pa.list_(pa.int64()))], ["prime", "c"])

    tasks = min(len(primes), max(1, spark.sparkContext.defaultParallelism))
    found = spark.range(0, len(primes), 1, tasks).mapInArrow(residues, "prime bigint, c array<bigint>").collect()
    value, modulus = [0] * (d + 1), 1
    for row in found:
        p = row["prime"]
        inverse = pow(modulus, -1, p)
        value = [v + modulus * ((c - v) * inverse % p) for v, c in zip(value, row["c"], strict=True)]
        modulus *= p
    return [v - modulus if v > modulus // 2 else v for v in value]


def _roots_above(coefficients: list[int], a: int) -> int:
    """Roots above ``a``, with multiplicity: the sign changes of the polynomial moved there, as all roots are real."""
    b = coefficients[:]
    for i in range(len(b) - 1):
        for k in range(len(b) - 2, i - 1, -1):
            b[k] += a * b[k + 1]
    signs = [v > 0 for v in b if v]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def _narrow(coefficients: list[int], low: int, high: int) -> tuple[int, int]:
    """Bisect (low, high], which holds one simple root, to width 1."""
    def sign(a: int) -> int:
        value = reduce(lambda v, c: v * a + c, reversed(coefficients))
        return (value > 0) - (value < 0)
    above = sign(high)
    if above == 0:
        return high - 1, high
    while high - low > 1:
        middle = (low + high) // 2
        s = sign(middle)
        if s == 0:
            return middle - 1, middle
        low, high = (low, middle) if s == above else (middle, high)
    return low, high


def largest_roots(coefficients: list[int], count: int) -> tuple[list[tuple[int, int]], int]:
    """The ``count`` largest roots of a polynomial with real roots of at least 0: (root * 2^bits, multiplicity) falling, and ``bits``."""
    d = len(coefficients) - 1
    zeros = next(k for k, c in enumerate(coefficients) if c)
    count = min(count, d - zeros)
    if not count:
        return [], 0
    bits = PRECISION
    while True:
        scaled = [c << (bits * (d - k)) for k, c in enumerate(coefficients)][zeros:]
        top = 1 << (abs(coefficients[d - 1]).bit_length() + 1 + bits)
        found, waiting = [], [(0, top, d - zeros)]
        while waiting and sum(m for _, m in found) < count:
            low, high, inside = waiting.pop()
            if inside == 1:
                found.append((_narrow(scaled, low, high)[1], 1))
            elif high - low == 1:
                found.append((high, inside))
            else:
                middle = (low + high) // 2
                above = _roots_above(scaled, middle) - sum(m for v, m in found) - sum(m for a, _, m in waiting if a >= high)
                # The upper half is looked at first.
                waiting += [(a, b, m) for a, b, m in ((low, middle, inside - above), (middle, high, above)) if m]
        # Roots so small that too few bits of them are known ask for more bits.
        known = found[-1][0].bit_length()
        if known >= PRECISION // 2:
            return found, bits
        bits += PRECISION


class _Shifted:
    """Factorised ``matrix - root`` in fixed-point integers of ``bits`` binary places."""

    def __init__(self, matrix: list[list[int]], root: int, bits: int):
        self.bits, d = bits, len(matrix)
        a = [[(v << bits) - (root if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(matrix)]
        self.swaps = []
        for k in range(d):
            r = max(range(k, d), key=lambda i: abs(a[i][k]))
            self.swaps.append(r)
            a[k], a[r] = a[r], a[k]
            # A pivot that vanishes stands for one in the last place.
            pivot = a[k][k] = a[k][k] or 1
            upper = a[k]
            for i in range(k + 1, d):
                row = a[i]
                if row[k]:
                    f = row[k] = (row[k] << bits) // pivot
                    for j in range(k + 1, d):
                        row[j] -= f * upper[j] >> bits
        self.a = a

    def solve(self, b: list[int]) -> list[int]:
        """The solution, scaled to one with largest entry near 1."""
        a, bits, b, d = self.a, self.bits, b[:], len(b)
        for k, r in enumerate(self.swaps):
            b[k], b[r] = b[r], b[k]
            for i in range(k + 1, d):
                b[i] -= a[i][k] * b[k] >> bits
        for k in reversed(range(d)):
            b[k] = ((b[k] - (sum(a[k][j] * b[j] for j in range(k + 1, d)) >> bits)) << bits) // a[k][k]
        return _scaled(b, bits)


def _scaled(v: list[int], bits: int) -> list[int]:
    largest = max(abs(x) for x in v) or 1
    return [(x << bits) // largest for x in v]


def null_space(matrix: list[list[int]], root: int, bits: int, size: int) -> list[list[float]]:
    """``size`` orthonormal vectors that ``matrix`` stretches by ``root / 2^bits``: inverse iteration from fixed starting vectors."""
    shifted, draw, found = _Shifted(matrix, root, bits), Random(7), []
    for _ in range(size):
        v = [draw.randrange(-1 << bits, 1 << bits) for _ in matrix]
        for _ in range(3):
            v = shifted.solve(v)
            for u in found:
                share = (sum(x * y for x, y in zip(u, v, strict=True)) << bits) // sum(x * x for x in u)
                v = [y - (share * x >> bits) for x, y in zip(u, v, strict=True)]
            v = _scaled(v, bits)
        found.append(v)
    out = []
    for v in found:
        length = math.isqrt(sum(x * x for x in v))
        out.append([x / length for x in v])
    return out


@dataclass
class Whitening:
    """The fitted map: row -> (n * x - sums) @ columns."""
    n: int
    sums: list[int]
    columns: np.ndarray
    explained: list[float | None]
    positive: int


def fit_whitening(spark: SparkSession, fit: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """Exact fit on the rows of ``fit.x`` (at least one row of ``width`` numbers)."""
    n, sums, square = moments(fit, width)
    scatter = [[n * square[i][j] - sums[i] * sums[j] for j in range(width)] for i in range(width)]
    trace, common = sum(scatter[i][i] for i in range(width)), math.gcd(*(v for row in scatter for v in row))
    count = min(components, width)
    if not trace:
        return Whitening(n, sums, np.zeros((width, 0)), [None] * count, 0)
    reduced = [[v // common for v in row] for row in scatter]
    roots, bits = largest_roots(characteristic_polynomial(spark, reduced), count)
    columns, explained = [], []
    for root, multiplicity in roots:
        stretch = math.sqrt(root * common / (1 << bits)) if root.bit_length() < 900 else math.isqrt(root * common >> bits)
        for v in null_space(reduced, root, bits, multiplicity):
            columns.append([x / stretch for x in v])
            explained.append(float(root * common / (trace << bits)))
    positive = min(count, len(columns))
    explained = explained[:positive] + [0.0] * (count - positive)
    return Whitening(n, sums, np.array(columns[:positive]).T.reshape(width, positive), explained, positive)


def _apply(model: Whitening, rows: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Whitened rows and their exact deviations."""
    far = max((abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0))))) * model.n + max(map(abs, model.sums))
    kind = np.int64 if far < 1 << 62 else object
    centred = rows.astype(kind) * model.n - np.array(model.sums, kind)
    wide = centred if far * far * rows.shape[1] < 1 << 63 else centred.astype(object)
    return centred.astype(np.float64) @ model.columns, (wide * wide).sum(axis=1).tolist()


def _covariance_error(fit: DataFrame, model: Whitening, width: int) -> float | None:
    """Largest entry of (covariance of the whitened fit list - identity), centred by the measured means first."""
    k = model.positive
    if not k:
        return None

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            if batch.num_rows:
                yield _apply(model, _matrix(batch.column(0), width))[0]

    def cells(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], ["at", "value"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from cells(sum((w.sum(axis=0) for w in whitened(batches)), np.zeros(k)))

    def collected(job) -> np.ndarray:
        rows = fit.select("x").mapInArrow(job, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
        return np.array([r["value"] for r in sorted(rows)])

    means = collected(sums) / model.n

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from cells(sum(((w - means).T @ (w - means) for w in whitened(batches)), np.zeros((k, k))))

    return float(np.abs(collected(products).reshape(k, k) / model.n - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error, deviation_digits."""
    spark = vectors.sparkSession
    rows = vectors.select(named("vec_id").alias("vec_id"), named("embedding").alias("_e")).filter(usable(F.col("_e")))
    rows = rows.select("vec_id", whole(F.col("_e")).alias("x")).filter(F.size("x") > 0)
    kind = rows.schema["vec_id"].dataType.simpleString()
    out = (f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
           "identity_error double, deviation_digits string")
    lengths = rows.groupBy(F.size("x").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    if lengths is None:
        return spark.createDataFrame([], out)
    width = lengths["w"]
    rows = rows.filter(F.size("x") == width)
    fit = cut(rows.select("x").distinct(), "whitening-fit")
    model = fit_whitening(spark, fit, width, components)
    error = _covariance_error(fit, model, width)
    count = len(model.explained)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values, deviations = _apply(model, _matrix(batch.column(1), width))
            filled = [[*row, *[None] * (count - model.positive)] for row in values.tolist()]
            fits = [v if v < 1 << 63 else None for v in deviations]
            digits = [None if v < 1 << 63 else str(v) for v in deviations]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fits, pa.int64()), pa.array(digits, pa.string()), pa.array(filled, pa.list_(pa.float64()))],
                ["vec_id", "deviation", "deviation_digits", "values"])

    made = rows.mapInArrow(apply, f"vec_id {kind}, deviation bigint, deviation_digits string, values array<double>")
    shares = F.array(*[F.lit(v).cast("double") for v in model.explained])
    return made.select("vec_id", "deviation", "deviation_digits", F.posexplode("values").alias("_at", "whitened")).select(
        "vec_id", (F.col("_at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("_at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"), "deviation_digits")
