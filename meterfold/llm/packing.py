"""Best-fit packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterfold.llm.common import released, slices, small_batches
from meterfold.llm.tokens import VOCABULARY, encoded
from meterfold.session import materialise

SEQUENCE = 2048


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """``start, length`` of a document's pieces: whole sequences, and before them the shorter rest."""
    rest = n % capacity
    bounds = [(0, rest)] if rest else []
    return bounds + [(s, capacity) for s in range(rest, n, capacity)]


def cut_documents(docs: DataFrame, capacity: int = SEQUENCE, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of the encoded documents, each with its end id."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, pieces = [], []
            for row, raw in enumerate(encoded(batch.column("text").to_pylist(), vocabulary)):
                for piece, (start, length) in enumerate(piece_bounds(len(raw) // 4, capacity)):
                    rows.append(row)
                    pieces.append((piece, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)])))
            columns = list(zip(*pieces)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(columns[0], pa.int32()),
                    *[pa.array(c, pa.int64()) for c in columns[1:]],
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return released(cut(batches))

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = small_batches(docs).select("doc_id", F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


@dataclass(frozen=True)
class Placement:
    """Pieces of one length, by rank, in runs of neighbouring sequences at one offset.

    The piece of rank ``r`` in the run that begins at rank ``rank`` goes to sequence
    ``sequence + (r - rank)``. ``key`` orders the runs: length first, then rank.
    """

    key: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    @staticmethod
    def keys(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return (length.astype(np.int64) << 48) + rank

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = self.keys(length, rank)
        run = np.searchsorted(self.key, wanted, side="right") - 1
        return self.sequence[run] + (wanted - self.key[run]), self.offset[run]


class _Gaps:
    """Open sequences as runs ``first, count`` of equal gap, found by the smallest gap that is large enough."""

    def __init__(self):
        self.sizes: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, gap: int, first: int, count: int) -> None:
        if gap <= 0 or count <= 0:
            return
        if gap not in self.runs:
            insort(self.sizes, gap)
            self.runs[gap] = []
        heapq.heappush(self.runs[gap], (first, count))

    def successor(self, length: int) -> int | None:
        at = bisect_left(self.sizes, length)
        return self.sizes[at] if at < len(self.sizes) else None

    def take(self, gap: int, most: int) -> tuple[int, int]:
        """Up to ``most`` sequences of one run, lowest first."""
        first, count = heapq.heappop(self.runs[gap])
        used = min(count, most)
        if count > used:
            heapq.heappush(self.runs[gap], (first + used, count - used))
        elif not self.runs[gap]:
            del self.runs[gap]
            self.sizes.remove(gap)
        return first, used


def plan_packing(counts: dict[int, int], capacity: int = SEQUENCE) -> Placement:
    """Best fit, longest first, in supersteps of all pieces of one length.

    A superstep sweeps the sorted gaps upward from the length: the pieces, in the order of their
    rank, take the sequences of the smallest gap that fits, then those of the next one; the gaps
    are updated in bulk, and the next sweep sees them. Where no gap is left, new sequences are
    opened and filled with as many pieces of the length as they hold. All pieces or sequences of
    equal size move together, so the work depends on the capacity and not on their number.
    """
    gaps, opened, runs = _Gaps(), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left and (gap := gaps.successor(length)) is not None:
            first, used = gaps.take(gap, left)
            runs.append((length, rank, first, capacity - gap))
            gaps.add(gap - length, first, used)
            rank, left = rank + used, left - used
        per = capacity // length
        whole, extra = divmod(left, per)
        for place in range(per if whole else 0):
            runs.append((length, rank, opened, place * length))
            rank += whole
        gaps.add(capacity - per * length, opened, whole)
        opened += whole
        for place in range(extra):
            runs.append((length, rank, opened, place * length))
            rank += 1
        gaps.add(capacity - extra * length, opened, 1 if extra else 0)
        opened += bool(extra)
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 4)
    return Placement(Placement.keys(table[:, 0], table[:, 1]), table[:, 2], table[:, 3])


def _ranked(pieces: DataFrame) -> DataFrame:
    """Add ``rank``, gapless from 0 within a length, in the order of ``doc_id, piece``.

    Pieces are sorted in ranges of the length and then of the id, so a length of very many pieces
    spreads over several ranges; one count per range and length joins them up.
    """
    order = ["length", "doc_id", "piece", "ids_crc32"]
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, last = TaskContext.get().partitionId(), 0, -1
        for batch in batches:
            length = batch.column("length").to_numpy()
            begins = np.r_[True, length[1:] != length[:-1]]
            inside = np.arange(len(length)) - np.maximum.accumulate(np.where(begins, np.arange(len(length)), 0))
            if len(length) and length[0] == last:
                inside[: len(length) if begins[1:].sum() == 0 else int(np.argmax(begins[1:])) + 1] += seen
            if len(length):
                last, seen = int(length[-1]), int(inside[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(length), part, np.int32)), pa.array(inside.astype(np.int64))],
                names=[*batch.schema.names, "part", "inside"],
            )

    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, inside bigint"
    sorted_ = pieces.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = materialise(sorted_.mapInArrow(number, schema), "pack-ranges")
    counts = ranged.groupBy("length", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return ranged.join(offsets, ["length", "part"]).withColumn("rank", F.col("before") + F.col("inside"))


def pack(docs: DataFrame, capacity: int = SEQUENCE, vocabulary: str = VOCABULARY) -> DataFrame:
    """Pack ``docs(doc_id, text)`` into sequences of at most ``capacity`` tokens, few of them.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for each piece. A
    document is its token ids and the end id; only one that is longer than a sequence is cut, into
    whole sequences with the shorter rest first.

    Edge cases: an absent text is empty and takes one token; rows without id and repeated rows are
    packed each; an empty table gives no rows; other columns are not read.

    Only piece rows are shuffled, never texts or ids. The driver gets the number of pieces of each
    length, at most ``capacity`` numbers, and sends back the runs of the plan.
    """
    pieces = materialise(cut_documents(docs, capacity, vocabulary), "pack-pieces")
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_packing(counts, capacity)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = plan.of(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"],
            )

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return _ranked(pieces).select(*columns, "rank").mapInArrow(place, schema)
