"""Whitening of embeddings by components from the exact characteristic polynomial of their scatter.

Entries are made integers, so the scatter matrix is a matrix of integers and is summed without any
rounding. Its characteristic polynomial has integer coefficients: it is computed modulo many primes,
each by a Hessenberg reduction in a task of its own, and put together by Chinese remaindering. All
roots of a symmetric matrix are real; for such a polynomial the sign changes of its coefficients
after a shift by a count exactly the roots above a (Descartes), so roots are isolated by bisection
on integers. A component spans the null space of the matrix less a root, and inverse iteration in
decimal arithmetic with more digits than the root needs finds it.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Context, Decimal, localcontext
from fractions import Fraction
from math import comb, isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterfold.session import materialise

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
# Bits to which roots are known relative to the largest one; roots nearer to each other count as one.
ROOT_BITS = 256
_DIGITS = 200
# Products of two limbs, summed over a block of rows, stay below 2^53, where doubles are exact.
_LIMB_BITS = 20
_BLOCK = 4_096
_LARGEST = 1 << 62


def integers(vectors: np.ndarray) -> np.ndarray:
    """``floor(1024 c)`` of each entry; it and the shifted value must fit a long."""
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    if scaled.size and not (np.abs(scaled) < _LARGEST).all():
        raise ValueError("an entry times 1024 does not fit a long")
    return scaled.astype(np.int64)


def exact_gram(rows: np.ndarray) -> np.ndarray:
    """``rows.T @ rows`` in Python integers: limb by limb in doubles, none of whose sums is rounded."""
    dims = rows.shape[1]
    total = np.zeros((dims, dims), dtype=object)
    for first in range(0, len(rows), _BLOCK):
        rest, limbs = rows[first : first + _BLOCK], []
        while not limbs or rest.any():
            # signed limbs: what is left moves towards zero
            low = np.fmod(rest, 1 << _LIMB_BITS)
            limbs.append(low.astype(np.float64))
            rest = (rest - low) // (1 << _LIMB_BITS)
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << (_LIMB_BITS * (i + j))
    return total


# --- the polynomial


def is_prime(n: int) -> bool:
    """Miller and Rabin's test with bases that decide every ``n`` below 2^31."""
    if n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        if n % base == 0:
            return n == base
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


def primes_beyond(product: int) -> list[int]:
    """The largest primes below 2^31 whose product exceeds ``product``."""
    found, reached, n = [], 1, (1 << 31) - 1
    while reached <= product:
        if is_prime(n):
            found.append(n)
            reached *= n
        n -= 2
    return found


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of ``det(x - matrix)`` modulo a prime below 2^31, from that of 1 up.

    Similarity transforms bring the matrix to Hessenberg form, column by column; the polynomial of
    each leading block follows from those of the smaller ones.
    """
    h = (matrix % p).astype(np.int64)
    n = len(h)
    for m in range(1, n - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        pivot = m + int(below[0])
        if pivot != m:
            h[[m, pivot]] = h[[pivot, m]]
            h[:, [m, pivot]] = h[:, [pivot, m]]
        factor = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - factor[:, None] * h[m] % p) % p
        # a column takes many products, each below 2^62: reduced before they are summed
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * factor % p).sum(axis=1)) % p
    leading = np.zeros((n + 1, n + 1), dtype=np.int64)
    leading[0, 0] = 1
    for k in range(1, n + 1):
        poly = np.zeros(n + 1, dtype=np.int64)
        poly[1:] = leading[k - 1, :-1]
        poly = (poly - h[k - 1, k - 1] * leading[k - 1] % p) % p
        below = 1
        for i in range(1, k):
            below = below * int(h[k - i, k - i - 1]) % p
            if not below:
                break
            poly = (poly - h[k - i - 1, k - 1] * below % p * leading[k - i - 1] % p) % p
        leading[k] = poly
    return [int(c) for c in leading[n]]


def remaindered(residues: list[tuple[int, list[int]]]) -> list[int]:
    """Integers of either sign from their residues modulo primes, which are put together in pairs."""
    parts = [(p, list(r)) for p, r in residues]
    while len(parts) > 1:
        joined = []
        for (p, a), (q, b) in zip(parts[::2], parts[1::2]):
            inverse = pow(p, -1, q)
            joined.append((p * q, [x + p * ((y - x) * inverse % q) for x, y in zip(a, b)]))
        parts = joined + (parts[-1:] if len(parts) % 2 else [])
    [(modulus, values)] = parts
    return [v - modulus if 2 * v > modulus else v for v in values]


def largest_coefficient(matrix: list[list[int]]) -> int:
    """A bound on the coefficients of a positive semidefinite matrix' polynomial: C(n, k) (trace / n)^k (Maclaurin)."""
    n = len(matrix)
    trace = sum(matrix[i][i] for i in range(n))
    return max(comb(n, k) * (trace**k // n**k + 1) for k in range(n + 1))


# --- its roots


def shifted(poly: list[int], by: int) -> list[int]:
    """The coefficients of ``poly(x + by)``, from that of 1 up."""
    out = list(poly)
    for i in range(len(out) - 1):
        for j in range(len(out) - 2, i - 1, -1):
            out[j] += by * out[j + 1]
    return out


def roots_above(poly: list[int], bound: Fraction) -> int:
    """How many roots exceed ``bound``, counted as often as they occur; all must be real."""
    top, denominator = bound.numerator, bound.denominator
    degree = len(poly) - 1
    # the roots of the scaled polynomial are those of the first times the denominator
    scaled = [c * denominator ** (degree - k) for k, c in enumerate(poly)]
    signs = [c > 0 for c in shifted(scaled, top) if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign_at(poly: list[int], x: int, bits: int) -> int:
    """The sign of ``poly(x / 2^bits)``."""
    value = 0
    for power, c in enumerate(reversed(poly)):
        value = value * x + (c << (bits * power))
    return (value > 0) - (value < 0)


def derivative(poly: list[int], times: int) -> list[int]:
    for _ in range(times):
        poly = [k * c for k, c in enumerate(poly)][1:]
    return poly


def largest_roots(poly: list[int], most: int, root_bits: int = ROOT_BITS) -> list[tuple[Fraction, int]]:
    """The largest positive roots with their multiplicities, until ``most`` roots are counted; all must be real.

    Intervals are halved until each holds one root, simple or multiple. A root of multiplicity m is
    a simple root of the derivative m - 1, whose sign then halves the interval down to ``root_bits``
    below the largest root. Roots that are nearer than that to each other are taken as one.
    """
    degree = len(poly) - 1
    bound = 1
    while roots_above(poly, Fraction(bound)):
        bound *= 2
    step = Fraction(bound, 1 << root_bits)
    found: list[tuple[Fraction, int]] = []

    def search(low: Fraction, above_low: int, high: Fraction, above_high: int) -> None:
        """Roots in (low, high], the larger ones first."""
        inside = above_low - above_high
        if not inside or sum(m for _, m in found) >= most:
            return
        # sign changes tell roots apart only if they are: a cluster is cut until it is one root or too narrow
        if inside == 1 or high - low <= step:
            found.append((_refined(poly, inside, low, high, step), inside))
            return
        middle = (low + high) / 2
        above = roots_above(poly, middle)
        search(middle, above, high, above_high)
        search(low, above_low, middle, above)

    search(Fraction(0), roots_above(poly, Fraction(0)), Fraction(bound), 0)
    assert sum(m for _, m in found) <= degree
    return found


def _refined(poly: list[int], multiplicity: int, low: Fraction, high: Fraction, step: Fraction) -> Fraction:
    if high - low <= step:
        return (low + high) / 2
    poly = derivative(poly, multiplicity - 1)
    bits = max(low.denominator, high.denominator, step.denominator).bit_length()
    a, b, width = int(low * (1 << bits)), int(high * (1 << bits)), max(1, int(step * (1 << bits)))
    at_high = _sign_at(poly, b, bits)
    while at_high and b - a > width:
        middle = (a + b) // 2
        sign = _sign_at(poly, middle, bits)
        if sign == 0:
            return Fraction(middle, 1 << bits)
        a, b = (a, middle) if sign == at_high else (middle, b)
    return Fraction(b, 1 << bits) if not at_high else Fraction(a + b, 2 << bits)


# --- its vectors


def null_space(matrix: list[list[int]], root: Fraction, count: int, digits: int = _DIGITS, seed: int = 5) -> np.ndarray:
    """``count`` orthonormal columns that the matrix maps to ``root`` times themselves, as doubles.

    One elimination of the matrix less the root, then inverse iteration from random vectors. The
    root is known to far more digits than a double, so two steps leave nothing of other components.
    """
    n = len(matrix)
    with localcontext(Context(prec=digits)):
        value = Decimal(root.numerator) / Decimal(root.denominator)
        rows = np.array([[Decimal(int(x)) for x in row] for row in matrix], dtype=object)
        rows[np.arange(n), np.arange(n)] -= value
        order = np.arange(n)
        size = max(abs(value), Decimal(1))
        for k in range(n):
            pivot = k + max(range(n - k), key=lambda i: abs(rows[k + i, k]))
            rows[[k, pivot]], order[[k, pivot]] = rows[[pivot, k]], order[[pivot, k]]
            if not rows[k, k]:
                # the null space itself: as small as the arithmetic allows, not zero
                rows[k, k] = size.scaleb(-digits)
            rows[k + 1 :, k] = rows[k + 1 :, k] / rows[k, k]
            rows[k + 1 :, k + 1 :] -= np.multiply.outer(rows[k + 1 :, k], rows[k, k + 1 :])

        def solve(b: np.ndarray) -> np.ndarray:
            x = b[order].copy()
            for k in range(n):
                x[k + 1 :] -= rows[k + 1 :, k] * x[k]
            for k in range(n - 1, -1, -1):
                x[k] = x[k] / rows[k, k]
                x[:k] -= rows[:k, k] * x[k]
            return x

        rng, found = np.random.default_rng(seed), []
        for _ in range(count):
            x = np.array([Decimal(int(v)) for v in rng.integers(-1_000_000, 1_000_000, n)], dtype=object)
            for _ in range(3):
                for v in found:
                    x = x - v * (v @ x)
                x = x / max(abs(v) for v in x)
                x = solve(x)
                x = x / max(abs(v) for v in x)
            for v in found:
                x = x - v * (v @ x)
            found.append(x / (x @ x).sqrt())
    return np.array([[float(v) for v in x] for x in found]).T


# --- over a table


def _entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a vector without NULL, NaN or infinity, and their integers as a matrix."""
    numbers = column.flatten()
    if not column.null_count and not numbers.null_count and len(column) and len(numbers):
        lengths = np.diff(column.offsets.to_numpy())
        if (lengths == lengths[0]).all():
            whole = numbers.to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)
            good = np.isfinite(whole).all(axis=1)
            return good, integers(whole[good])
    good = np.zeros(len(column), dtype=bool)
    out = []
    for row, numbers in enumerate(column):
        if not numbers.is_valid or numbers.values.null_count or not len(numbers.values):
            continue
        v = numbers.values.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(v).all():
            good[row] = True
            out.append(v)
    if len({len(v) for v in out}) > 1:
        raise ValueError("vectors of different lengths have no common covariance")
    return good, integers(np.array(out)) if out else np.zeros((0, 0), np.int64)


def scatter(vectors: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """``n``, the sums of the integers less 100,000, and ``n`` times the scatter matrix, all exact.

    Each task sends the sums and products of its rows; Spark adds them up as decimals. The driver
    gets one number for each pair of dimensions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, gram = 0, None, None
        for batch in batches:
            good, rows = _entries(batch.column("embedding"))
            if not good.any():
                continue
            if gram is not None and len(gram) != rows.shape[1]:
                raise ValueError("vectors of different lengths have no common covariance")
            n += len(rows)
            total = np.array([int(v) for v in rows.astype(object).sum(axis=0)], dtype=object)
            product = exact_gram(rows)
            sums, gram = (total, product) if gram is None else (sums + total, gram + product)
        if n:
            i, j = np.triu_indices(len(gram))
            # row -1 holds the sums, and before them the number of rows
            left = np.r_[np.full(len(sums) + 1, -1), i].astype(np.int32)
            right = np.r_[-1, np.arange(len(sums)), j].astype(np.int32)
            values = [Decimal(int(v)) for v in [n, *sums, *gram[i, j]]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(left), pa.array(right), pa.array(values, pa.decimal128(38, 0))], names=["i", "j", "v"]
            )

    parts = vectors.select("embedding").mapInArrow(run, "i int, j int, v decimal(38, 0)")
    added = parts.groupBy("i", "j").agg(F.sum("v").alias("v"), F.count("*").alias("tasks")).collect()
    cells = {(r["i"], r["j"]): int(r["v"]) for r in added}
    if not cells:
        return 0, [], []
    if len({r["tasks"] for r in added}) > 1:
        raise ValueError("vectors of different lengths have no common covariance")
    n = cells[-1, -1]
    dims = max(j for i, j in cells) + 1
    sums = [cells[-1, d] for d in range(dims)]
    matrix = [[n * cells[min(i, j), max(i, j)] - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]
    return n, sums, matrix


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Of a positive semidefinite matrix of integers, from the coefficient of 1 up; one task per few primes."""
    primes = primes_beyond(2 * largest_coefficient(matrix) + 1)
    whole = np.array(matrix, dtype=object)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(int(p), k, c) for p in batch["p"] for k, c in enumerate(polynomial_modulo(whole, int(p)))]
            yield pd.DataFrame(rows, columns=["p", "k", "c"])

    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    dealt = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(tasks)
    residues: dict[int, dict[int, int]] = {}
    for r in dealt.mapInPandas(run, "p bigint, k int, c bigint").collect():
        residues.setdefault(r["p"], {})[r["k"]] = r["c"]
    return remaindered([(p, [residues[p][k] for k in range(len(matrix) + 1)]) for p in primes])


def components(spark, matrix: list[list[int]], most: int = COMPONENTS) -> tuple[np.ndarray, list[Fraction]]:
    """Unit columns and the roots they belong to, by falling root; only positive roots."""
    roots = largest_roots(characteristic_polynomial(spark, matrix), most) if matrix else []
    if not roots:
        return np.zeros((len(matrix), 0)), []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for number, times, top, bottom in zip(batch["number"], batch["times"], batch["top"], batch["bottom"]):
                found = null_space(matrix, Fraction(int(top), int(bottom)), int(times))
                rows += [(number, c, column.tolist()) for c, column in enumerate(found.T)]
            yield pd.DataFrame(rows, columns=["number", "c", "v"])

    rows = [(number, m, str(r.numerator), str(r.denominator)) for number, (r, m) in enumerate(roots)]
    dealt = spark.createDataFrame(rows, "number int, times int, top string, bottom string").repartition(len(rows), "number")
    found = sorted((r["number"], r["c"], r["v"]) for r in dealt.mapInPandas(run, "number int, c int, v array<double>").collect())
    chosen = found[:most]
    return np.array([v for _, _, v in chosen]).T, [roots[number][0] for number, _, _ in chosen]


def _sqrt(x: Fraction) -> float:
    """Correct to a double also where ``x`` is beyond one."""
    places = max(0, 128 - x.numerator.bit_length() + x.denominator.bit_length())
    places += places % 2
    return float(Fraction(isqrt((x.numerator << places) // x.denominator), 1 << (places // 2)))


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per usable vector and component.

    A usable vector of ``vectors(vec_id, embedding)`` has entries and no NULL, NaN or infinite one.
    An entry c becomes ``x = floor(1024 c) + 100000``. ``n`` counts the usable vectors,
    ``deviation`` is the sum of ``(n x - S)^2`` over the dimensions, ``whitened`` the centred vector
    along the component over the root of its eigenvalue, ``explained`` that eigenvalue's share of
    the trace, and ``identity_error`` the largest entry of the whitened covariance less the identity.

    Edge cases: rows without id and repeated rows take part like any other; equal eigenvalues share
    a space, of which some orthonormal components are given; a table of rank r has only r
    components, so equal vectors, a single one and an empty table give no rows; vectors of different
    lengths, or an entry whose x does not fit a long, raise; ``deviation`` is NULL where it does not
    fit a long; other columns are not read.

    Vectors are read twice and never shuffled. What the driver gets depends on the dimensions only.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    chosen = vectors.select("vec_id", "embedding")
    n, sums, matrix = scatter(chosen)
    axes, roots = components(spark, matrix, most)
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    # a root is n^2 times an eigenvalue, and n x - S is n times a centred vector
    lengths = np.array([_sqrt(r) for r in roots])
    shares = [float(r / trace) for r in roots]
    total = np.array(sums, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, rows = _entries(batch.column("embedding"))
            if not good.any() or not len(lengths):
                continue
            reach = n * int(np.abs(rows).max()) + max(map(abs, sums))
            if reach * reach * rows.shape[1] < 1 << 63:
                centred = rows * n - np.array(sums, dtype=np.int64)
                deviation = pa.array((centred * centred).sum(axis=1))
            else:
                centred = rows.astype(object) * n - total
                exact = (centred * centred).sum(axis=1)
                deviation = pa.array([int(v) if v < 1 << 63 else None for v in exact], pa.int64())
            whitened = centred.astype(np.float64) @ axes / lengths
            flat = pa.array(np.ascontiguousarray(whitened).reshape(-1))
            places = pa.array(np.arange(len(whitened) + 1, dtype=np.int32) * whitened.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").filter(pa.array(good)), deviation, pa.ListArray.from_arrays(places, flat)],
                names=["vec_id", "deviation", "w"],
            )

    rows = materialise(chosen.mapInArrow(run, f"vec_id {kind}, deviation bigint, w array<double>"), "whitened")
    width = range(len(lengths))
    pairs = [F.covar_pop(F.col("w")[i], F.col("w")[j]) - float(i == j) for i in width for j in width if i <= j]
    error = rows.agg(F.greatest(*[F.abs(p) for p in pairs], F.lit(0.0)).alias("e")).first()["e"] if pairs else None
    share = F.array(*[F.lit(s) for s in shares]) if shares else F.array().cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        share[F.col("at")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
