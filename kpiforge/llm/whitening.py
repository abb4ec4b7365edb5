"""Embedding whitening from the exact characteristic polynomial of the scatter.

1. Entries become integers, x = floor(1024 c) + 100000. Tasks sum x and the
   products of every two dimensions exactly (digits of 20 bits, whose float64
   matrix products are exact); Spark adds the partial sums digit by digit. They
   give the integer scatter C = n sum(x x') - S S', that is n^2 times the
   covariance.
2. C's characteristic polynomial is found modulo many 31-bit primes, by Spark
   tasks: each reduces C to Hessenberg form modulo its primes. Chinese
   remaindering gives the integer coefficients; enough primes are taken for a
   proven bound on them.
3. All roots are real and none is negative, so the sign changes in the
   coefficients of f(x + a) are exactly the number of roots above a. Bisection
   with that count isolates the greatest roots to 2^-ROOT_BITS of their size.
4. A root's component is the null space of C - root: inverse iteration in
   DIGITS decimal digits. Roots that agree to that precision share a space, of
   which an orthonormal basis is taken.
5. Rows are centred exactly (n x - S is an integer), projected and divided by
   the root of the eigenvalue.

What the driver holds has a fixed size: the scatter (dimensions squared),
residues and roots. Cost of steps 2 to 4 grows with the fourth power of the
dimensions and not with the rows.

Defined cases: a row is left out if its vector is null, empty, holds a null, NaN
or infinite entry, or has another length than most (of equally common lengths
the greatest counts). |floor(1024 c)| is held at 2^62. Components with
eigenvalue zero are none, so equal rows, or one row, give no components and no
result rows; so does an empty table. Null ids are kept; repeated rows count each
time; other columns are ignored. A deviation of more than 38 digits is null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiforge.llm.common import column, pick
from kpiforge.llm.textvec import mix

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
ROOT_BITS = 100   # a root is known to 2^-ROOT_BITS of its size
DIGITS = 90       # of the inverse iteration
_CLIP = 2.0**62
_DIGIT = 20       # bits of a digit in the exact products
_ROWS = 8192      # rows of one exact product: 2^13 products of 2^38 stay below 2^53
_LIMB = 40        # bits of the numbers that Spark adds
PRIMES_PER_TASK = 16


# --- 1. exact sums ------------------------------------------------------------

def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows whose vector holds finite numbers only."""
    d = pick(df, vec_id=id_col, vector=vector_col)

    def bad(v):
        return v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))

    return d.filter(F.col("vector").isNotNull() & (F.size("vector") > 0) & ~F.exists("vector", bad))


def dimensions(vectors: DataFrame) -> int:
    """The commonest length of a vector, of equals the greatest; 0 without rows."""
    sizes = vectors.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("rows"))
    first = sizes.orderBy(F.desc("rows"), F.desc("size")).first()
    return first["size"] if first else 0


def integers(vectors: pa.Array, size: int) -> np.ndarray:
    """floor(1024 c) of every entry, one row for each vector of ``size``."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(flat * SCALE), -_CLIP, _CLIP).astype(np.int64)


def moments(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, sums of products) of the columns of ``y``, exact (object arrays)."""
    size = y.shape[1]
    sums, products = np.zeros(size, object), np.zeros((size, size), object)
    for a in range(0, len(y), _ROWS):
        rest, digits = y[a:a + _ROWS], []
        while not digits or rest.any():
            low = ((rest + (1 << _DIGIT - 1)) & ((1 << _DIGIT) - 1)) - (1 << _DIGIT - 1)  # signed digit
            digits.append(low.astype(np.float64))
            rest = (rest - low) >> _DIGIT
        for i, p in enumerate(digits):
            sums += p.sum(axis=0).astype(np.int64).astype(object) << _DIGIT * i
            for j, q in enumerate(digits):
                products += (p.T @ q).astype(np.int64).astype(object) << _DIGIT * (i + j)
    return sums, products


def limbs(value: int) -> list[int]:
    """``value`` as digits of 40 bits, the last one signed; few enough bits for
    Spark to add eight million of each."""
    out = []
    while not -(1 << _LIMB) < value < 1 << _LIMB:
        out.append(value & ((1 << _LIMB) - 1))
        value >>= _LIMB
    return [*out, value]


def scatter(vectors: DataFrame, size: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, sums of products) of floor(1024 c) over the vectors of ``size``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(size, object), np.zeros((size, size), object)
        for batch in batches:
            y = integers(column(batch, "vector"), size)
            s, p = moments(y)
            n, sums, products = n + len(y), sums + s, products + p
        if not n:
            return
        rows = [(-1, -1, k, v) for k, v in enumerate(limbs(n))]
        rows += [(i, -1, k, v) for i in range(size) for k, v in enumerate(limbs(sums[i]))]
        rows += [(i, j, k, v) for i in range(size) for j in range(i, size) for k, v in enumerate(limbs(products[i, j]))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
            ["i", "j", "limb", "value"])

    rows = vectors.filter(F.size("vector") == size).select("vector")
    total = rows.mapInArrow(run, "i int, j int, limb int, value bigint").groupBy("i", "j", "limb").agg(
        F.sum("value").alias("value"))
    n, sums, products = 0, [0] * size, [[0] * size for _ in range(size)]
    for r in total.collect():  # at most size^2 / 2 numbers of a few limbs
        part = r["value"] << _LIMB * r["limb"]
        if r["i"] < 0:
            n += part
        elif r["j"] < 0:
            sums[r["i"]] += part
        else:
            products[r["i"]][r["j"]] += part
            if r["i"] != r["j"]:
                products[r["j"]][r["i"]] += part
    return n, sums, products


# --- 2. characteristic polynomial ----------------------------------------------

def primes_below(bound: int, count: int) -> list[int]:
    """The ``count`` greatest primes below ``bound`` (at most 2^32)."""
    def is_prime(m: int) -> bool:
        odd, twos = m - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):  # decides all m < 3,215,031,751
            x = pow(base, odd, m)
            if x in (1, m - 1):
                continue
            for _ in range(twos - 1):
                x = x * x % m
                if x == m - 1:
                    break
            else:
                return False
        return True

    out, m = [], bound - 1 - bound % 2
    while len(out) < count:
        if is_prime(m):
            out.append(m)
        m -= 2
    return out


def residues(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Coefficients of x^size, x^(size-1), ..., 1 of det(x - matrix) modulo each
    prime: one row for each. All primes take their steps together."""
    size, p = len(matrix), np.array(primes, np.int64)
    h = np.array([[[v % q for v in row] for row in matrix] for q in primes], np.int64)
    every, q1, q2 = np.arange(len(p)), p[:, None], p[:, None, None]
    for k in range(size - 2):  # Hessenberg form: column k is cleared below row k + 1
        pivot = k + 1 + (h[:, k + 1:, k] != 0).argmax(axis=1)
        swap = h[every, pivot].copy()
        h[every, pivot] = h[:, k + 1]
        h[:, k + 1] = swap
        swap = h[every, :, pivot].copy()
        h[every, :, pivot] = h[:, :, k + 1]
        h[:, :, k + 1] = swap
        inverse = np.array([pow(int(v), -1, int(m)) if v else 0 for v, m in zip(h[:, k + 1, k], p)], np.int64)
        times = h[:, k + 2:, k] * inverse[:, None] % q1
        h[:, k + 2:] = (h[:, k + 2:] - times[:, :, None] * h[:, k + 1, None, :] % q2) % q2
        h[:, :, k + 1] = (h[:, :, k + 1] + (h[:, :, k + 2:] * times[:, None, :] % q2).sum(axis=2)) % q1
    # f_k: polynomial of the leading k rows, lowest power first
    f = np.zeros((size + 1, len(p), size + 1), np.int64)
    f[0, :, 0] = 1
    for k in range(1, size + 1):
        g = -(h[:, k - 1, k - 1, None] * f[k - 1] % q1)
        g[:, 1:] += f[k - 1, :, :-1]
        below = np.ones(len(p), np.int64)
        for i in range(k - 1, 0, -1):
            below = below * h[:, i, i - 1] % p
            g -= (h[:, i - 1, k - 1] * below % p)[:, None] * f[i - 1] % q1
        f[k] = g % q1
    return f[size, :, ::-1]


def remainder(values: list[int], primes: list[int]) -> tuple[int, int]:
    """(x, product of the primes) with x = values modulo the primes (Chinese
    remaindering, by halves)."""
    if len(primes) == 1:
        return values[0] % primes[0], primes[0]
    half = len(primes) // 2
    a, m = remainder(values[:half], primes[:half])
    b, k = remainder(values[half:], primes[half:])
    return a + m * ((b - a) * pow(m, -1, k) % k), m * k


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients, highest power first, of det(x - matrix) of a
    positive semidefinite integer matrix. The absolute value of a coefficient is
    a sum of principal minors, all at most (1 + trace / size)^size."""
    size = len(matrix)
    trace = sum(matrix[i][i] for i in range(size))
    bits = size * (1 + trace // size + 1).bit_length()
    primes = primes_below(1 << 31, bits // 30 + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in column(batch, "id").to_pylist():
                part = primes[at * PRIMES_PER_TASK:(at + 1) * PRIMES_PER_TASK]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int64()), pa.array(residues(matrix, part).tolist(), pa.list_(pa.int64()))],
                    ["prime", "coefficients"])

    tasks = -(-len(primes) // PRIMES_PER_TASK)
    found = spark.range(0, tasks, 1, tasks).mapInArrow(run, "prime bigint, coefficients array<bigint>").collect()
    modulo = [r["prime"] for r in found]
    out = []
    for k in range(size + 1):  # the sign of the k-th coefficient is that of (-1)^k
        sign = -1 if k % 2 else 1
        out.append(sign * remainder([sign * r["coefficients"][k] for r in found], modulo)[0])
    return out


# --- 3. roots ---------------------------------------------------------------------

def roots_above(poly: list[int], a: Fraction) -> int:
    """Number of roots greater than ``a`` (multiple ones counted so) of a
    polynomial with real roots only: sign changes of the coefficients of f(x + a)."""
    m, d = a.numerator, a.denominator
    c, scale = [], 1
    for v in poly:  # d^size f(x / d), whose shift by m is one of integers
        c.append(v * scale)
        scale *= d
    for end in range(len(c), 1, -1):
        for i in range(1, end):
            c[i] += m * c[i - 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def greatest_roots(poly: list[int], most: int, bits: int = ROOT_BITS) -> list[tuple[Fraction, int]]:
    """(root, multiplicity) of the ``most`` greatest positive roots (with a root
    that several share, all of it), falling, each known to 2^-``bits`` of its
    size. All roots must be real and none negative."""
    positive = len(poly) - 1
    while positive and poly[-1] == 0:
        poly, positive = poly[:-1], positive - 1
    if not positive:
        return []
    top = Fraction(1 << abs(poly[1]).bit_length())  # the sum of all roots lies below
    out: list[tuple[Fraction, int]] = []
    todo = [(Fraction(0), top, positive, 0)]  # (low, high, roots above low, roots above high)
    while todo and sum(m for _, m in out) < most:
        low, high, n_low, n_high = todo.pop()
        if n_low == n_high:
            continue
        if high - low <= low / (1 << bits):
            out.append(((low + high) / 2, n_low - n_high))
            continue
        middle = (low + high) / 2
        n = roots_above(poly, middle)
        todo += [(low, middle, n_low, n), (middle, high, n, n_high)]  # the upper half first
    return out


# --- 4. components -----------------------------------------------------------------

def null_space(matrix: list[list[int]], root: Fraction, multiplicity: int) -> list[list[Decimal]]:
    """Orthonormal basis of the null space of ``matrix`` - ``root``, by inverse
    iteration with an LU factorisation."""
    size = len(matrix)
    with localcontext() as context:
        context.prec = DIGITS
        shift = Decimal(root.numerator) / Decimal(root.denominator)
        tiny = shift.scaleb(-DIGITS // 2)
        a = np.array([[Decimal(v) for v in row] for row in matrix], object)
        a[np.diag_indices(size)] -= shift
        order = np.arange(size)
        for k in range(size):
            pivot = k + int(np.abs(a[k:, k]).argmax())
            a[[k, pivot]] = a[[pivot, k]]
            order[[k, pivot]] = order[[pivot, k]]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            a[k + 1:, k] /= a[k, k]
            a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:])
        # fixed starting vectors without structure
        start = mix(np.arange(1, size * multiplicity + 1, dtype=np.uint64)) >> np.uint64(40)
        basis = np.array([Decimal(int(v) - (1 << 23)) for v in start], object).reshape(multiplicity, size)
        for _ in range(40):
            before, basis = basis, basis[:, order].copy()
            for k in range(1, size):
                basis[:, k] -= basis[:, :k] @ a[k, :k]
            for k in range(size - 1, -1, -1):
                if k + 1 < size:
                    basis[:, k] -= basis[:, k + 1:] @ a[k, k + 1:]
                basis[:, k] /= a[k, k]
            for k in range(multiplicity):
                for _ in range(2):  # the second turn takes away what the first left
                    for j in range(k):
                        basis[k] -= (basis[k] @ basis[j]) * basis[j]
                    basis[k] /= (basis[k] @ basis[k]).sqrt()
            # the same space as before: the old basis projected on it is whole
            inside = before - (before @ basis.T) @ basis
            if max(abs(v) for v in inside.ravel()) < Decimal(10) ** -30:
                break
        return basis.tolist()


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: ``size`` dimensions, ``n`` rows, ``sums`` of floor(1024 c),
    and per component, by falling eigenvalue: unit vector, eigenvalue of the
    covariance, share of the trace, and the vector over the eigenvalue's root."""
    size: int
    n: int
    sums: list[int]
    vectors: list[list[float]]
    eigenvalues: list[float]
    explained: list[float]
    scaled: list[list[float]]


def fit(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """The whitening of all usable vectors of ``df``."""
    vectors = usable(df.select(vector_col).withColumn("vec_id", F.lit(0)), "vec_id", vector_col)
    size = dimensions(vectors)
    if not size:
        return Whitening(0, 0, [], [], [], [], [])
    n, sums, products = scatter(vectors, size)
    matrix = [[n * products[i][j] - sums[i] * sums[j] for j in range(size)] for i in range(size)]
    trace = sum(matrix[i][i] for i in range(size))
    poly = characteristic_polynomial(df.sparkSession, matrix)
    unit, values, shares, scaled = [], [], [], []
    for root, multiplicity in greatest_roots(poly, components):
        with localcontext() as context:
            context.prec = DIGITS
            deviation = (Decimal(root.numerator) / Decimal(root.denominator)).sqrt() / n
            for v in null_space(matrix, root, multiplicity)[:components - len(unit)]:
                lead = max(range(size), key=lambda i: (abs(v[i]), -i))
                sign = 1 if v[lead] > 0 else -1
                unit.append([float(sign * x) for x in v])
                scaled.append([float(sign * x / deviation) for x in v])
                values.append(float(root / n**2))
                shares.append(float(root / trace))
    return Whitening(size, n, sums, unit, values, shares, scaled)


# --- 5. rows ------------------------------------------------------------------------

def centred(y: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S for every row, exact: int64 where that holds it, else objects."""
    if n * int(np.abs(y).max(initial=0)) + max(map(abs, sums)) < 1 << 62:
        return y * n - np.array(sums, np.int64)
    return y.astype(object) * n - np.array(sums, object)


def squares(t: np.ndarray) -> np.ndarray:
    """Sum of the squares of every row, exact."""
    if t.dtype != object and t.shape[1] * int(np.abs(t).max(initial=0)) ** 2 >= 1 << 63:
        t = t.astype(object)
    return (t * t).sum(axis=1)


def apply(df: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, deviation decimal, whitened array<double>) of every usable vector
    of the fitted size; ``deviation`` is the sum over dimensions of (n x - S)^2."""
    vectors = usable(df, id_col, vector_col).filter(F.size("vector") == model.size)
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    size, n, sums, k = model.size, model.n, model.sums, len(model.scaled)
    project = np.array(model.scaled, np.float64).reshape(k, size).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = centred(integers(column(batch, "vector"), size), n, sums)
            total = squares(t)
            if total.dtype == object:
                total = pa.array([Decimal(v) if v < 10**38 else None for v in total], pa.decimal128(38, 0))
            else:
                total = pa.array(total).cast(pa.decimal128(38, 0))
            white = (t / n).astype(np.float64) @ project
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(t) + 1) * k, pa.int32()), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([column(batch, "vec_id"), total, lists],
                                             ["vec_id", "deviation", "whitened"])

    return vectors.mapInArrow(run, f"vec_id {id_type}, deviation decimal(38,0), whitened array<double>")


def identity_error(white: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity
    (0 without components)."""
    if not components:
        return 0.0
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    got = white.agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(math.fabs(got[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
