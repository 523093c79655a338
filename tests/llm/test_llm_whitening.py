"""Whitening against numpy, and its exact parts against plain integer arithmetic."""

from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest

from meterfold.llm import whitening as w


def test_gram_is_exact():
    rng = np.random.default_rng(1)
    for size in (5, 1 << 21, 1 << 45, (1 << 62) - 1):
        rows = rng.integers(-size, size + 1, (50, 4))
        plain = rows.astype(object)
        assert (w.exact_gram(rows) == plain.T @ plain).all()


def test_integers():
    assert w.integers(np.array([[0.5, -0.0001, -1.0]])).tolist() == [[512, -1, -1024]]
    with pytest.raises(ValueError):
        w.integers(np.array([[1e300]]))


def plain_polynomial(matrix):
    """``det(x - matrix)`` by the sum over permutations."""
    n = len(matrix)
    total = [0] * (n + 1)
    for perm in permutations(range(n)):
        sign = 1
        for i in range(n):
            for j in range(i):
                sign = -sign if perm[j] > perm[i] else sign
        poly = [sign]
        for i, j in enumerate(perm):
            factor = [-matrix[i][j], int(i == j)]
            poly = [sum(poly[a] * factor[k - a] for a in range(len(poly)) if 0 <= k - a < 2) for k in range(len(poly) + 1)]
        total = [a + b for a, b in zip(total, poly)]
    return total


@pytest.mark.parametrize("seed", range(4))
def test_polynomial(spark, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-9, 10, (7, 4)).astype(object)
    x[:, 2] = 0 if seed == 1 else x[:, 2]
    matrix = [[int(v) for v in row] for row in x.T @ x]
    primes = w.primes_beyond(2 * w.largest_coefficient(matrix))
    residues = [(p, w.polynomial_modulo(np.array(matrix, dtype=object), p)) for p in primes]
    assert w.remaindered(residues) == plain_polynomial(matrix)
    assert w.characteristic_polynomial(spark, matrix) == plain_polynomial(matrix)


def test_primes():
    assert [n for n in range(2, 60) if w.is_prime(n)] == [2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59]
    assert w.primes_beyond(1)[0] == (1 << 31) - 1 and not any(map(w.is_prime, (2047, 1373653, 25326001)))


def test_roots():
    # (x - 9)^2 (x - 4)^3 (x - 1) x
    poly = [1]
    for root in (9, 9, 4, 4, 4, 1, 0):
        poly = [a - root * b for a, b in zip([0, *poly], [*poly, 0])]
    found = w.largest_roots(poly, 8)
    assert [m for _, m in found] == [2, 3, 1]
    assert all(abs(r - e) < Fraction(1, 1 << 200) for (r, _), e in zip(found, (9, 4, 1)))
    assert [w.roots_above(poly, Fraction(b)) for b in (-1, 0, 1, 3, 4, 8, 9)] == [7, 6, 5, 5, 2, 2, 0]
    assert len(w.largest_roots(poly, 2)) == 1


def expected(rows):
    x = np.floor(np.array(rows, dtype=np.float64) * 1024) + 100_000
    centred = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    return x, centred, values[::-1], vectors[:, ::-1]


def test_whitening(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((300, 12)) * np.linspace(0.05, 0.4, 12)
    base[200:] = base[0]  # one vector very often
    rows = [(i, v.tolist(), "x", 0.5) for i, v in enumerate(base)]
    usable = dict((r[0], r[1]) for r in rows)
    rows += [(1000, None, "n", 1.0), (1001, [float("nan")] + [0.1] * 11, "w", None), (1002, [None] + [0.1] * 11, "c", None)]
    rows += [(1003, [float("inf")] * 12, "e", 0.0), (1004, [], "f", 0.0), (None, base[5].tolist(), "f", 0.0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, component string, n double")
    got = w.whiten(df).collect()
    x, centred, values, vectors = expected([*usable.values(), base[5].tolist()])
    ids = [*usable, None]
    n = len(ids)
    assert len(got) == 8 * n and {r["n"] for r in got} == {n}
    place = {}
    for i, v in enumerate(ids):
        place.setdefault(v, i)
    exact = x.astype(int).astype(object)
    sums = exact.sum(axis=0)
    signs = {}
    for r in got:
        row, c = place[r["vec_id"]], r["component"] - 1
        assert r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(exact[row], sums))
        want = centred[row] @ vectors[:, c] / np.sqrt(values[c])
        assert abs(abs(r["whitened"]) - abs(want)) < 1e-9
        if abs(want) > 1e-6:
            signs.setdefault(c, set()).add(np.sign(want * r["whitened"]))
        assert abs(r["explained"] - values[c] / values.sum()) < 1e-12
        assert r["identity_error"] < 1e-9
    assert all(len(s) == 1 for s in signs.values())


def test_equal_eigenvalues_and_low_rank(spark):
    # plus and minus each axis: equal eigenvalues along four axes, none along the fifth
    rows = [(2 * a + s, [float((1 - 2 * s) * (a == d)) for d in range(4)] + [1.0]) for a in range(4) for s in range(2)]
    got = w.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()
    assert {r["component"] for r in got} == {1, 2, 3, 4}
    assert all(abs(r["explained"] - 0.25) < 1e-12 and r["identity_error"] < 1e-9 for r in got)
    norm = {}
    for r in got:
        norm[r["vec_id"]] = norm.get(r["vec_id"], 0) + r["whitened"] ** 2
    assert all(abs(v - 4) < 1e-9 for v in norm.values())


def test_without_spread(spark):
    schema = "vec_id bigint, embedding array<float>"
    for rows in ([], [(1, [0.5, 1.0])], [(i, [0.5, 1.0]) for i in range(9)], [(1, None)]):
        assert w.whiten(spark.createDataFrame(rows, schema)).collect() == []
    with pytest.raises(Exception, match="different lengths"):
        w.whiten(spark.createDataFrame([(1, [0.5]), (2, [0.5, 1.0])], schema)).collect()


def test_deviation_beyond_a_long(spark):
    rows = [(i, [float(i * 10**9), float(i % 2)]) for i in range(4)]
    got = w.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert len(got) == 8 and all(r["identity_error"] < 1e-6 for r in got)
    assert {r["deviation"] for r in got} == {None}
