"""Whitening: every exact step against plain rational arithmetic, the whole
against numpy's eigenvectors, and odd rows."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from kpiforge.llm import whitening
from kpiforge.llm.queries import op13_whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def polynomial(matrix):
    """Characteristic polynomial by Faddeev and LeVerrier, in fractions."""
    size = len(matrix)
    m, out = [[Fraction(0)] * size for _ in range(size)], [Fraction(1)]
    for k in range(1, size + 1):
        for i in range(size):
            m[i][i] += out[-1]
        m = [[sum(matrix[i][t] * m[t][j] for t in range(size)) for j in range(size)] for i in range(size)]
        out.append(-sum(m[i][i] for i in range(size)) / k)
    return [int(c) for c in out]


def gram(rng, size, rank, top):
    rows = [[rng.randint(-top, top) for _ in range(size)] for _ in range(rank)]
    return [[sum(r[i] * r[j] for r in rows) for j in range(size)] for i in range(size)]


@pytest.mark.parametrize("size,rank,top", [(1, 1, 9), (2, 2, 5), (3, 1, 50), (5, 5, 1000), (6, 3, 1), (9, 12, 10**9), (4, 0, 1)])
def test_characteristic_polynomial_is_exact(spark, size, rank, top):
    rng = random.Random(size * 100 + rank)
    for _ in range(3 if size > 1 else 1):
        matrix = gram(rng, size, rank, top)
        assert whitening.characteristic_polynomial(spark, matrix) == polynomial(matrix)
    diagonal = [[(i + 2) * (i == j) for j in range(size)] for i in range(size)]
    assert whitening.characteristic_polynomial(spark, diagonal) == polynomial(diagonal)


def test_hessenberg_needs_pivots_and_meets_zero_columns():
    primes = whitening.primes_below(1 << 31, 5)
    assert primes[0] == 2147483647 and all(p % d for p in primes for d in range(2, 3000))
    rng = random.Random(2)
    for _ in range(30):
        size = rng.randint(1, 6)
        matrix = [[rng.choice([0, 0, 0, 1, -7, 10**20]) for _ in range(size)] for _ in range(size)]
        got = whitening.residues(matrix, primes)
        assert got.tolist() == [[c % p for c in polynomial(matrix)] for p in primes]


def test_remainders_give_the_number_back():
    primes = whitening.primes_below(1 << 31, 40)
    for x in (0, 1, 12345678901234567890 ** 18):
        got, product = whitening.remainder([x % p for p in primes], primes)
        assert got == x and product == math.prod(primes)


def test_roots_with_multiplicity_and_tiny_gaps():
    def expand(roots):
        poly = [1]
        for r in roots:
            poly = [a - r * b for a, b in zip(poly + [0], [0] + poly)]
        return poly
    roots = [0, 0, 1, 3, 3, 10**12, 10**12 + 1, 10**12 + 1, 10**30]
    poly = expand(roots)
    for a in (0, 1, 2, 3, Fraction(7, 2), 10**12, 10**12 + 1, 10**31):
        assert whitening.roots_above(poly, Fraction(a)) == sum(r > a for r in roots)
    got = whitening.greatest_roots(poly, 8)
    assert [m for _, m in got] == [1, 2, 1, 2, 1]
    for (x, _), want in zip(got, (10**30, 10**12 + 1, 10**12, 3, 1)):
        assert abs(x - want) <= Fraction(want, 2**99)
    assert whitening.greatest_roots([1, 0, 0], 8) == []
    assert len(whitening.greatest_roots(poly, 2)) == 2


def test_null_space_of_multiple_roots_is_orthonormal():
    # 5 I + 7 v v' with v = (1, 1, 1, 1): root 33 once, root 5 three times
    matrix = [[5 * (i == j) + 7 for j in range(4)] for i in range(4)]
    (a, one), (b, three) = whitening.greatest_roots(polynomial(matrix), 4)
    assert (one, three) == (1, 3)
    basis = np.array(whitening.null_space(matrix, a, one) + whitening.null_space(matrix, b, three)).astype(float)
    assert np.abs(basis @ basis.T - np.eye(4)).max() < 1e-15
    assert np.abs(np.array(matrix) @ basis[0] - 33 * basis[0]).max() < 1e-13
    # two roots that differ in the 13th digit still have their own vectors
    near = [[10**13, 0, 1], [0, 10**13, 0], [1, 0, 10**13 - 5]]
    for root, m in whitening.greatest_roots(polynomial(near), 3):
        v = np.array(whitening.null_space(near, root, m)[0])
        left = [sum(int(near[i][j]) * Fraction(v[j]) for j in range(3)) - root * Fraction(v[i]) for i in range(3)]
        assert max(abs(x) for x in left) < 1e-13


def test_exact_moments_of_great_numbers():
    rng = np.random.default_rng(1)
    y = np.concatenate([rng.integers(-2**62, 2**62, (50, 3)), rng.integers(-9, 9, (9000, 3)), [[-2**62, 2**62, 0]]])
    sums, products = whitening.moments(y)
    rows = [[int(v) for v in r] for r in y]
    assert sums.tolist() == [sum(r[i] for r in rows) for i in range(3)]
    assert products.tolist() == [[sum(r[i] * r[j] for r in rows) for j in range(3)] for i in range(3)]
    for v in (0, -1, 2**40, -2**200 + 3, 10**50):
        assert sum(x << 40 * k for k, x in enumerate(whitening.limbs(v))) == v
        assert all(abs(x) <= 2**40 for x in whitening.limbs(v))


def expected(rows, most=8):
    """{vec_id: (deviation, whitened up to sign)} and the eigenvalue shares, by numpy."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in rows]
    n, size = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(size)]
    t = [[n * r[i] - s[i] for i in range(size)] for r in x]
    centred = np.array(t, float) / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    return n, [sum(v * v for v in r) for r in t], centred @ u / np.sqrt(e), e / np.trace(centred.T @ centred / n)


def by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r.vec_id, {})[r.component] = r
    return out


def test_query_equals_numpy_on_the_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    n, deviation, white, shares = expected(rows)
    got = op13_whitening(spark, SF).collect()
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-12
    found = by_id(got)
    table = np.array([[found[i][k].whitened for k in range(1, 9)] for i, _ in rows])
    assert [found[i][1].deviation for i, _ in rows] == deviation
    sign = np.sign((table * white).sum(axis=0))
    assert np.abs(table - white * sign).max() < 1e-9
    assert np.allclose([found[rows[0][0]][k].explained for k in range(1, 9)], shares, rtol=1e-10)
    assert np.abs(table.T @ table / n - np.eye(8)).max() < 1e-12


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_odd_rows(spark, tmp_path):
    rng = random.Random(9)
    good = [(i, [rng.uniform(-2, 2) for _ in range(3)], 0) for i in range(30)]
    good += [(7, good[7][1], 1), (None, [0.5, 0.25, -1.0], None), (31, [1e3, -3e2, 0.0], 0)]
    nan, inf = float("nan"), float("inf")
    bad = [(100, None, 0), (101, [], 0), (102, [1.0, None, 2.0], 0), (103, [1.0, nan, 2.0], 0),
           (104, [inf, 0.0, 0.0], 0), (105, [-inf, 0.0, 0.0], 0), (106, [1.0, 2.0], 0), (107, [1.0] * 4, 0)]
    d = frame(spark, good + bad)
    for c in ("vector", "n", "whitened", "deviation", "component", "at"):
        d = d.withColumn(c, d.label)
    d.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op13_whitening(spark, str(tmp_path)).collect()
    n, deviation, white, _ = expected([r[:2] for r in good])
    assert n == 33 and len(got) == 33 * 3 and got[0].identity_error < 1e-9
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(deviation)
    assert sum(r.vec_id is None for r in got) == 3 and sum(r.vec_id == 7 for r in got) == 6
    for k in (1, 2, 3):
        mine = np.sort([abs(r.whitened) for r in got if r.component == k])
        assert np.allclose(mine, np.sort(np.abs(white[:, k - 1])), atol=1e-8)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0)] * 5, [(1, None, 0)], [(1, [], 0)]])
def test_no_spread_gives_no_rows(spark, tmp_path, rows):
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op13_whitening(spark, str(tmp_path))
    assert got.collect() == []
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_fewer_components_than_dimensions_and_repeated_eigenvalues(spark):
    # a line in three dimensions: one component
    line = frame(spark, [(i, [float(i), 2.0 * i, 0.0], 0) for i in range(6)])
    model = whitening.fit(line)
    assert len(model.vectors) == 1 and abs(model.explained[0] - 1) < 1e-15
    assert np.allclose(np.abs(model.vectors[0]), np.array([1, 2, 0]) / 5**0.5, atol=1e-15)
    # ten dimensions of equal spread: any eight orthonormal directions
    cross = frame(spark, [(i, [(1.0 if k % 2 else -1.0) if i // 2 == j else 0.0 for j in range(10)], 0)
                          for i, k in ((i, i) for i in range(20))])
    model = whitening.fit(cross)
    v = np.array(model.vectors)
    assert v.shape == (8, 10) and np.abs(v @ v.T - np.eye(8)).max() < 1e-15
    assert whitening.identity_error(whitening.apply(cross, model), 8) < 1e-14


def test_entries_of_any_size(spark):
    rows = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0]), (4, [3.0, -2.0])],
                                 "vec_id long, embedding array<double>")
    model = whitening.fit(rows)
    got = whitening.apply(rows, model).collect()
    assert len(model.vectors) == 2 and whitening.identity_error(whitening.apply(rows, model), 2) < 1e-9
    y = [[2**62, 0], [-2**62, 1024], [0, 5120], [3072, -2048]]
    s = [sum(r[i] for r in y) for i in range(2)]
    for r, v in zip(sorted(got, key=lambda r: r.vec_id), y):
        want = sum((4 * v[i] - s[i]) ** 2 for i in range(2))
        assert r.deviation is None if want >= 10**38 else int(r.deviation) == want
