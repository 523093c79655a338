"""Near-duplicate embeddings by counting collisions on one-dimensional projections.

Vectors of one direction are close on every axis; others are close on few. So each vector is
projected onto many fixed random axes, a query's collisions with another vector are the axes on
which that one lies in the window around the query, and only pairs with enough collisions are
verified with the cosine. Window and count follow from pairs at the very threshold, for which the
share that is found is known.

The count is taken for blocks of vectors against blocks: on each axis one block is sorted, a
query's window is a run of it, and the runs of all axes are added up as bit sets, 64 pairs at a
time. Blocks are cut along the first axis, and blocks further apart than its window never meet.
A pair that passes is a number inside a task; what leaves it is a row per linked vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterfold.llm.common import components_of, connected_components
from meterfold.session import materialise

LEAST_COSINE = 0.95
AXES = 48
BLOCK = 4_096
# Windows along the first axis: so many cells make up one.
CELLS = 3
_PLANES = 6


class Calibration(NamedTuple):
    """The axes (unit rows), the window on each, the collisions asked for, and the first axis' own window."""

    axes: np.ndarray
    window: float
    collisions: int
    first_window: float


@lru_cache(maxsize=16)
def calibrated(dims: int, least_cosine: float = LEAST_COSINE, axes: int = AXES, seed: int = 7) -> Calibration:
    """Axes for vectors of ``dims`` numbers, and window and count for pairs at the threshold.

    Random pairs of exactly the threshold's cosine are projected. The window holds four fifths of
    their differences, the count is reached by 99.8 % of them and the first axis' window holds
    99.9 %; closer pairs collide more often.
    """
    rng = np.random.default_rng([seed, dims])
    stack = []
    while sum(len(s) for s in stack) < axes:
        stack.append(np.linalg.qr(rng.standard_normal((dims, dims)))[0].T)
    rows = np.concatenate(stack)[:axes]
    x = rng.standard_normal((20_000, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal(x.shape)
    side -= (side * x).sum(1, keepdims=True) * x
    length = np.linalg.norm(side, axis=1, keepdims=True)
    side = np.divide(side, length, out=np.zeros_like(side), where=length > 1e-9)
    y = least_cosine * x + np.sqrt(1 - least_cosine**2) * side
    apart = np.abs((x - y) @ rows.T)
    window = float(np.quantile(apart, 0.8)) + 1e-12
    count = int(np.quantile((apart <= window).sum(axis=1), 0.002))
    return Calibration(rows, window, max(1, count), float(np.quantile(apart[:, 0], 0.999)) + 1e-12)


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    vectors = np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1).astype(np.float64)
    # scaled first, so that the norm of very large or small vectors stays finite
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _prefix_sets(order: np.ndarray) -> np.ndarray:
    """Row k is the bit set of the first k members in sorted order."""
    n = len(order)
    single = np.zeros((n + 1, -(-n // 64)), dtype=np.uint64)
    single[np.arange(1, n + 1), order >> 6] = np.uint64(1) << (order & 63).astype(np.uint64)
    return np.bitwise_or.accumulate(single, axis=0)


def colliding_pairs(queries: np.ndarray, others: np.ndarray, window: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that lie within the window on ``least`` columns or more.

    Each column of ``others`` is sorted once, a query's window is the run between two positions,
    and its members are one prefix set less another. The sets are added in bit-sliced counters
    that start at 2^planes - least, so that a pair has passed when its counter overflows.
    """
    words = -(-len(others) // 64)
    start = (1 << _PLANES) - least
    full, none = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0)
    planes = [np.full((len(queries), words), full if start >> k & 1 else none) for k in range(_PLANES)]
    passed = np.zeros((len(queries), words), dtype=np.uint64)
    for axis in range(queries.shape[1]):
        order = np.argsort(others[:, axis], kind="stable")
        values, sets = others[order, axis], _prefix_sets(order)
        low = np.searchsorted(values, queries[:, axis] - window, side="left")
        high = np.searchsorted(values, queries[:, axis] + window, side="right")
        carry = sets[high] ^ sets[low]
        for plane in planes:
            over = plane & carry
            plane ^= carry
            carry = over
        passed |= carry
    bits = np.unpackbits(passed.view(np.uint8), axis=1, bitorder="little")[:, : len(others)]
    return np.nonzero(bits)


def _linked(left: list, right: list | None, kind: str, least_cosine: float, axes: int) -> pa.RecordBatch:
    """Links of one block pair: per linked vector the copies it is linked with, and the smallest id it reaches."""
    rows = left + (right or [])
    unit = _unit([r[2] for r in rows], kind)
    cal = calibrated(unit.shape[1], least_cosine, axes)
    projected = unit @ cal.axes.T
    n = len(left)
    others = projected if right is None else projected[n:]
    i, j = colliding_pairs(projected[:n], others, cal.window, cal.collisions)
    j = j if right is None else j + n
    i, j = (i[i < j], j[i < j])
    close = np.zeros(len(i), dtype=bool)
    for first in range(0, len(i), 1 << 17):
        part = slice(first, first + (1 << 17))
        close[part] = np.einsum("ij,ij->i", unit[i[part]], unit[j[part]]) >= least_cosine
    i, j = i[close], j[close]
    size = np.array([r[3] for r in rows], dtype=np.int64)
    ids = np.array([r[1] for r in rows], dtype=np.int64)
    links = np.bincount(i, size[j], len(rows)) + np.bincount(j, size[i], len(rows))
    root = components_of(len(rows), i, j)
    smallest = np.full(len(rows), np.iinfo(np.int64).max)
    np.minimum.at(smallest, root, ids)
    hit = np.nonzero(links)[0]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[k][0] for k in hit], pa.binary()),
            pa.array(ids[hit]),
            pa.array(links[hit].astype(np.int64)),
            pa.array(smallest[root[hit]]),
        ],
        names=["key", "vec_id", "links", "root"],
    )


def _valid(vectors: DataFrame, least_cosine: float, axes: int) -> DataFrame:
    """Rows with an id and a finite vector that is not zero, as packed numbers with their first projection."""
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raw, dims, cells = [], [], [], []
            for vec_id, numbers in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
                if vec_id is None or not numbers.is_valid or numbers.values.null_count or not len(numbers.values):
                    continue
                v = numbers.values.to_numpy(zero_copy_only=False).astype(kind)
                if not np.isfinite(v).all() or not v.any():
                    continue
                v = v + v.dtype.type(0)  # a negative zero becomes zero
                ids.append(vec_id)
                raw.append(v.tobytes())
                dims.append(len(v))
                cal = calibrated(len(v), least_cosine, axes)
                cells.append(int(np.floor(float((_unit([raw[-1]], kind) @ cal.axes[0])[0]) * CELLS / cal.first_window)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(raw, pa.binary()), pa.array(dims, pa.int32()), pa.array(cells, pa.int32())],
                names=["vec_id", "raw", "dims", "cell"],
            )

    chosen = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    packed = chosen.mapInArrow(run, "vec_id bigint, raw binary, dims int, cell int")
    return packed.withColumn("key", F.unhex(F.md5("raw")))


def near_duplicates(vectors: DataFrame, least_cosine: float = LEAST_COSINE, axes: int = AXES) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, embedding)``.

    ``n_links`` counts the other vectors with a cosine of at least ``least_cosine`` in double
    precision, ``component_id`` is the smallest id reachable over links and ``kept`` marks it.

    Edge cases: a vector that is NULL, zero, or holds a NULL or a number that is not finite links
    with nothing, nor does one without id; vectors of different lengths never link; equal vectors
    are linked and count each; rows of one id are vectors of their own that share a component; an
    empty table gives no rows; other columns are not read.

    Equal vectors are combined before the first shuffle, so a vector of very many copies is one
    member of one block. The driver gets the number of vectors in each cell of the first axis,
    which the window bounds.
    """
    if axes >= 1 << _PLANES:
        raise ValueError(f"fewer than {1 << _PLANES} axes, got {axes}")
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"
    valid = materialise(_valid(vectors, least_cosine, axes), "vectors")
    copies = valid.groupBy("key", "raw", "dims", "cell").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"))
    copies = materialise(copies, "vector-copies")
    counts = {(r["dims"], r["cell"]): -(-r["n"] // BLOCK) for r in copies.groupBy("dims", "cell").agg(F.count("*").alias("n")).collect()}

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["dims", "low", "i", "high", "j", "second", "key", "rep", "raw", "size"]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for key, raw, dims, cell, rep, size in zip(*[c.to_pylist() for c in batch.columns]):
                own = counts[dims, cell]
                block = int.from_bytes(key[:6], "little") % own
                pairs = [(cell, min(block, b), cell, max(block, b), b < block) for b in range(own)]
                for shift in range(1, CELLS + 1):
                    pairs += [(cell, block, cell + shift, b, False) for b in range(counts.get((dims, cell + shift), 0))]
                    pairs += [(cell - shift, b, cell, block, True) for b in range(counts.get((dims, cell - shift), 0))]
                for pair in pairs:
                    for column, value in zip(out, (dims, *pair, key, rep, raw, size)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, _MEET_TYPES)], names=names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = ([], []), None
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if at is not None and row[:5] != at:
                    yield from _block_links(at, held, kind, least_cosine, axes)
                    held = ([], [])
                at = row[:5]
                held[row[5]].append(row[6:7] + row[7:8] + row[8:])
        if at is not None:
            yield from _block_links(at, held, kind, least_cosine, axes)

    pair = ["dims", "low", "i", "high", "j"]
    schema = "dims int, low int, i int, high int, j int, second boolean, key binary, rep bigint, raw binary, size bigint"
    met = copies.select("key", "raw", "dims", "cell", "rep", "size").mapInArrow(meet, schema)
    found = met.repartition(*pair).sortWithinPartitions(*pair).mapInArrow(count, "key binary, vec_id bigint, links bigint, root bigint")
    found = materialise(found, "vector-links")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    joined = valid.select("vec_id", "key").join(copies.select("key", "rep", "size"), "key").join(links, "key", "left")
    edges = found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")).filter("a <> b")
    edges = edges.unionByName(joined.filter("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b")))
    reached = connected_components(edges.distinct(), "vectors").withColumnRenamed("node", "vec_id")
    counted = joined.select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    invalid = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").filter(
        F.col("vec_id").isNull() | F.col("embedding").isNull() | _unusable(F.col("embedding"))
    )
    rows = counted.unionByName(invalid.select("vec_id", F.lit(0).cast("bigint").alias("n_links")))
    component = F.coalesce("component", "vec_id")
    return rows.join(reached, "vec_id", "left").select(
        "vec_id", "n_links", component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept")
    )


_MEET_TYPES = [pa.int32()] * 5 + [pa.bool_(), pa.binary(), pa.int64(), pa.binary(), pa.int64()]


def _block_links(at: tuple, held: tuple[list, list], kind: str, least_cosine: float, axes: int) -> Iterator[pa.RecordBatch]:
    left, right = held
    same = at[1:3] == at[3:5]
    if left and (same and len(left) > 1 or right):
        yield _linked(left, None if same else right, kind, least_cosine, axes)


def _unusable(embedding):
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return bad | ~F.coalesce(F.exists(embedding, lambda x: x != 0), F.lit(False))
