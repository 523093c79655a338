"""Exact deduplication against a historical corpus that a minimal perfect hash indexes."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from meterfold.llm.common import binary, mixed, small_batches
from meterfold.session import materialise

DIGEST = 32
# Digests in one part of the index; parts are built and searched independently.
PART_DIGESTS = 50_000
# Bits per digest in each level of the hash, and the most levels before digests are listed one by one.
BITS_PER_DIGEST = 2
MAX_LEVELS = 40

GROUP = "digest binary, keep_id bigint, group_size bigint"
INDEX = "part int, levels array<int>, bits binary, listed binary, digests binary, keep_ids binary, sizes binary"


@pandas_udf(T.BinaryType())
def text_digest(texts: pd.Series) -> pd.Series:
    """SHA-256 of the text's UTF-8 with A-Z lower-cased; an absent text counts as empty.

    Spark's ``translate`` looks each character up and took about twice the time of this.
    """
    return pd.Series([hashlib.sha256((t or "").encode().lower()).digest() for t in texts])


def _keys(digests: np.ndarray) -> np.ndarray:
    """A 64-bit number for each digest, from bytes that did not choose its part."""
    halves = np.frombuffer(digests.tobytes(), dtype="<u8").reshape(-1, 4)
    return halves[:, 1] ^ mixed(halves[:, 2])


def _seated(keys: np.ndarray, level: int, seats: int) -> np.ndarray:
    return (mixed(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) % np.uint64(seats)).astype(np.int64)


class MinimalPerfectHash:
    """n distinct keys onto 0..n-1, in levels: a key alone in its seat stays, the others move on.

    Keys that no level could seat come last in a sorted list, so the hash is total for any keys.
    """

    def __init__(self, levels: list[int], bits: np.ndarray, listed: np.ndarray):
        self.levels, self.bits, self.listed = levels, bits, listed
        self.ranks = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalPerfectHash:
        levels, bits, rest = [], [], keys
        while len(rest) and len(levels) < MAX_LEVELS:
            seats = BITS_PER_DIGEST * len(rest)
            at = _seated(rest, len(levels), seats)
            alone = np.bincount(at, minlength=seats) == 1
            levels.append(seats)
            bits.append(alone)
            rest = rest[~alone[at]]
        return cls(levels, np.concatenate(bits) if bits else np.zeros(0, bool), np.sort(rest))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; for a key that was never added any slot, or -1."""
        found = np.full(len(keys), -1, dtype=np.int64)
        open_, start = np.arange(len(keys)), 0
        for level, seats in enumerate(self.levels):
            at = start + _seated(keys[open_], level, seats)
            hit = self.bits[at]
            found[open_[hit]] = self.ranks[at[hit]]
            open_, start = open_[~hit], start + seats
        if len(self.listed) and len(open_):
            place = np.minimum(np.searchsorted(self.listed, keys[open_]), len(self.listed) - 1)
            hit = self.listed[place] == keys[open_]
            found[open_[hit]] = self.ranks[-1] + place[hit]
        return found


def _matrix(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype=np.uint8).reshape(-1, DIGEST)


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    """Locators as numbers; the lowest number stands for an absent one."""
    return np.array([np.iinfo(np.int64).min if x is None else x for x in column.to_pylist()], dtype=np.int64)


def _part_of(digest: Column, parts: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring(digest, 1, 6)), 16, 10).cast("bigint"), F.lit(parts)).cast("int")


def grouped(digests: DataFrame) -> DataFrame:
    """One row per distinct digest: the largest ``doc_id`` and the number of rows, combined before the shuffle."""
    return digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))


def _build_part(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    digests = _matrix(rows["digest"].to_pylist())
    keys = _keys(digests)
    perfect = MinimalPerfectHash.build(keys)
    order = np.empty(len(keys), dtype=np.int64)
    slots = perfect.slots(keys)
    # equal keys of different digests would share a listed slot: each takes one of their run
    by_slot = np.argsort(slots, kind="stable")
    order[:] = by_slot
    return pa.table(
        {
            "part": pa.array([key[0].as_py()], pa.int32()),
            "levels": pa.array([perfect.levels], pa.list_(pa.int32())),
            "bits": [np.packbits(perfect.bits).tobytes()],
            "listed": [binary(perfect.listed, "<u8")],
            "digests": [digests[order].tobytes()],
            "keep_ids": [binary(_ids(rows["keep_id"])[order], "<i8")],
            "sizes": [binary(np.array(rows["group_size"].to_pylist())[order], "<i8")],
        }
    )


def build_index(groups: DataFrame, parts: int) -> DataFrame:
    """The historical index: per part a minimal perfect hash whose slots hold full digests and winners."""
    parted = groups.select(_part_of(F.col("digest"), parts).alias("part"), "digest", "keep_id", "group_size")
    return parted.groupBy("part").applyInArrow(_build_part, INDEX)


def _look_up_part(history: pa.Table, arrivals: pa.Table) -> pa.Table:
    """Groups of one part after the arrivals: members join their slot, the others are groups of their own."""
    new = arrivals["digest"].to_pylist()
    new_ids, new_sizes = _ids(arrivals["keep_id"]), np.array(arrivals["group_size"].to_pylist(), dtype=np.int64)
    if history.num_rows:
        row = history.to_pylist()[0]
        seats = int(sum(row["levels"]))
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=seats).astype(bool)
        perfect = MinimalPerfectHash(row["levels"], bits, np.frombuffer(row["listed"], "<u8"))
        stored = np.frombuffer(row["digests"], np.uint8).reshape(-1, DIGEST)
        ids, sizes = np.frombuffer(row["keep_ids"], "<i8").copy(), np.frombuffer(row["sizes"], "<i8").copy()
    else:
        perfect = MinimalPerfectHash.build(np.zeros(0, np.uint64))
        stored, ids, sizes = np.zeros((0, DIGEST), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    member = np.zeros(len(new), dtype=bool)
    if len(new) and len(stored):
        digests = _matrix(new)
        slot = perfect.slots(_keys(digests))
        member = (slot >= 0) & (stored[np.maximum(slot, 0)] == digests).all(axis=1)
        # a listed key may stand for several digests: look through its neighbours byte by byte
        for i in np.nonzero(~member & (slot >= perfect.ranks[-1]))[0]:
            same = np.nonzero((stored[perfect.ranks[-1] :] == digests[i]).all(axis=1))[0]
            if len(same):
                slot[i], member[i] = perfect.ranks[-1] + same[0], True
        np.maximum.at(ids, slot[member], new_ids[member])
        np.add.at(sizes, slot[member], new_sizes[member])
    rest = ~member
    all_ids = np.concatenate([ids, new_ids[rest]])
    none = all_ids == np.iinfo(np.int64).min
    digests = [stored[i].tobytes() for i in range(len(stored))] + [d for d, r in zip(new, rest) if r]
    return pa.table(
        {
            "digest": pa.array(digests, pa.binary()),
            "keep_id": pa.array(all_ids, pa.int64(), mask=none),
            "group_size": pa.array(np.concatenate([sizes, new_sizes[rest]]), pa.int64()),
        }
    )


def look_up(index: DataFrame, arrivals: DataFrame, parts: int) -> DataFrame:
    """All groups, historical and new, after the arriving ones were searched in the index."""
    parted = arrivals.select(_part_of(F.col("digest"), parts).alias("part"), "digest", "keep_id", "group_size")
    return index.groupBy("part").cogroup(parted.groupBy("part")).applyInArrow(_look_up_part, GROUP)


def copy_groups(digests: DataFrame, history: Column, part_digests: int = PART_DIGESTS) -> DataFrame:
    """``digest, keep_id, group_size`` of all of ``digests(doc_id, digest)``.

    Rows where ``history`` holds are the corpus that the index is built from, the others arrive
    later and are looked up in it.
    """
    old = F.coalesce(history, F.lit(True))
    past = materialise(grouped(digests.filter(old)), "exact-history")
    new = materialise(grouped(digests.filter(~old)), "exact-arrivals")
    # a part holds digests of both: neither a short history nor few arrivals make it large
    parts = max(1, -(-max(past.count(), new.count()) // part_digests))
    index = materialise(build_index(past, parts), "exact-index")
    return look_up(index, new, parts)


def deduplicate(docs: DataFrame, history: Column | None = None, part_digests: int = PART_DIGESTS) -> DataFrame:
    """Which rows of ``docs(doc_id, text)`` stay when equal texts are kept once.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256`` for every row. Texts are equal when
    they are so after lower-casing A-Z; the row with the largest ``doc_id`` stays. ``history``
    says which rows are the corpus already indexed (default: the lower half of the ids).

    Edge cases: an absent text is the empty one; an absent id is lower than every id, and
    ``keep_id`` is NULL where a group has no id; of repeated rows one stays; an empty table gives
    no rows; other columns are not read.

    Copies of one text are combined before any shuffle, so the index and its search see each text
    once however often it occurs; the last join has the rows on its streamed side, where AQE
    splits a digest with very many of them.
    """
    digests = materialise(small_batches(docs).select("doc_id", text_digest(F.col("text")).alias("digest")), "exact-digests")
    if history is None:
        middle = digests.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
        history = F.col("doc_id") <= F.lit(middle)
    groups = copy_groups(digests, history, part_digests)
    copies = Window.partitionBy("digest", "doc_id").orderBy("doc_id")
    return (
        digests.withColumn("copy", F.row_number().over(copies))
        .join(groups, "digest", "left")
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def drop_copies(docs: DataFrame, history: Column | None = None) -> DataFrame:
    """The rows that :func:`deduplicate` keeps, with all their columns.

    Edge cases: as there; of a group without any id one row stays, of rows with the same id and text
    one stays, and an empty table gives no rows. Columns may have any names, those used here too.
    """
    kept = deduplicate(docs, history).filter("kept").select(F.col("doc_id").alias("_id"), "text_sha256")
    rows = docs.select(F.struct("*").alias("row"), F.lower(F.hex(text_digest(F.col("text")))).alias("sha"))
    first = Window.partitionBy("row.doc_id", "sha").orderBy("row.doc_id")
    chosen = rows.join(kept, F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("text_sha256")), "left_semi")
    return chosen.withColumn("copy", F.row_number().over(first)).filter("copy = 1").select("row.*")
