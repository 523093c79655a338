"""What several text operators share: words, hashes, Arrow batches and connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold.session import materialise

SLICE_ROWS = 1_000
SLICE_BYTES = 8 << 20
BATCH_ROWS = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def or_empty(text: Column) -> Column:
    """The text, an absent one as the empty string."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: bytes) -> list[bytes]:
    """Maximal runs without ASCII white space (space, tab to carriage return), A-Z lower-cased.

    On bytes both ``lower`` and ``split`` know ASCII alone, which is the wanted rule.
    """
    return text.lower().split()


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with Arrow batches of at most ``BATCH_ROWS`` rows in its session from now on.

    Spark's default of 10,000 rows is made for numbers: of whole texts a batch would be tens of
    megabytes, several times over in the JVM and in each Python worker.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Each text as UTF-8; an absent one is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), dtype=np.uint64, count=len(tokens))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_hashes(tokens: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the n-grams of hashed words, one per starting word."""
    if len(tokens) < n:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(len(tokens) - n + 1, dtype=np.uint64)
    for i in range(n):
        total = mixed(total + tokens[i : len(tokens) - n + 1 + i] + np.uint64(0x9E3779B97F4A7C15))
    return total


def binary(array: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(array, dtype=kind).tobytes()


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that what a step makes of whole texts stays small; none is empty.

    A slice holds at most ``rows`` rows and ``SLICE_BYTES`` bytes, or a single row beyond that.
    """
    for batch in batches:
        first = 0
        while first < batch.num_rows:
            part = batch.slice(first, rows)
            while part.num_rows > 1 and part.nbytes > SLICE_BYTES:
                part = part.slice(0, part.num_rows // 2)
            yield part
            first += part.num_rows


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int]:
    """The C library's call to give free memory back, where there is one."""
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return lambda pad: 0


def give_back() -> None:
    """Free memory back to the system, which the allocators would keep for later."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, and at the end of the task its memory back to the system.

    Python workers serve one task after the other, of other operators too, and would hold on to it.
    """
    try:
        yield from batches
    finally:
        give_back()


def map_batches(df: DataFrame, step: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``mapInArrow`` with a function from one batch to one table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield from step(pa.Table.from_batches([batch])).to_batches()

    return small_batches(df).mapInArrow(run, schema)


def components_of(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` nodes reaches over the given links."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if np.array_equal(label, before):
            return label


def connected_components(edges: DataFrame, label: str, rounds: int = 60) -> DataFrame:
    """``node, component`` of all nodes of ``edges(a, b)``: the smallest node each one reaches.

    Large-star and small-star steps in turn (Kiveris and others, 2014): every step points the
    neighbours of a node at the smallest of them, so the links become stars in a number of
    rounds that grows with the logarithm of the longest chain. Minima are combined before the
    shuffle and a node with very many links is a skewed join key that AQE splits. Each round is
    written to the shared folder. Links with an absent end are ignored.
    """
    spark = edges.sparkSession
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = materialise(edges.filter("u is not null and v is not null").distinct(), f"{label}-links")
    links = edges.filter("u <> v")
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        star = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = star.distinct()
        low = star.groupBy("u").agg(F.min("v").alias("m"))
        joined = star.join(low, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        following = materialise(small, f"{label}-stars")
        changed = (
            following.groupBy().agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        )
        same = links.groupBy().agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        links = following
        if changed == same:
            break
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    roots = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    stars = links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return roots.join(stars, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
