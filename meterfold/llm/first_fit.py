"""Packing by first fit, longest first, over a tournament tree of bin capacities, in random groups.

Documents are dealt into groups by a hash, each group is packed on its own, and the groups are
packed at the same time. Inside a group the tree finds the first bin that still holds a piece in a
logarithm of the bins. What is left open is closed by cutting: the emptiest bins are taken apart to
fill up the others, and the rest of the group, shorter than a sequence, is laid out in sequences
whose lengths are powers of two, which take no padding either. So a group loses no place at all and
cuts about one document for each sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from meterfold.llm.bpe import encoded
from meterfold.llm.common import released, slices, small_batches

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
SEQUENCE = 4096
# Documents that are packed together, and their ids in bytes; a group beyond either is packed in parts.
GROUP_DOCS = 8_192
GROUP_BYTES = 32 << 20


class CapacityTree:
    """Bins with what they still hold, as the leaves of a tree whose nodes hold the larger of two children.

    ``first`` walks from the root to the leftmost leaf that holds a size: at each match the left
    child wins if it is large enough.
    """

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.most = [capacity] * (2 * self.leaves)

    def first(self, size: int) -> int:
        """The leftmost bin that holds ``size``; there must be one."""
        most, node, leaves = self.most, 1, self.leaves
        while node < leaves:
            node *= 2
            if most[node] < size:
                node += 1
        return node - leaves

    def take(self, bin_: int, size: int) -> int:
        """Lower a bin's capacity; gives what was left before."""
        most, node = self.most, bin_ + self.leaves
        before = most[node]
        most[node] = before - size
        while node > 1:
            node >>= 1
            larger = max(most[2 * node], most[2 * node + 1])
            if most[node] == larger:
                break
            most[node] = larger
        return before


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of places in ``lengths``, which must not rise and not exceed ``capacity``."""
    tree, bins = CapacityTree(max(1, len(lengths)), capacity), []
    for place, length in enumerate(lengths):
        chosen = tree.first(length)
        tree.take(chosen, length)
        if chosen == len(bins):
            bins.append([])
        bins[chosen].append(place)
    return bins


def powers_of_two(n: int) -> list[int]:
    """``n`` as a sum of distinct powers of two, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack_group(lengths: list[int], capacity: int = SEQUENCE) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(place in lengths, first, length)``, in the order in which they are laid out.

    All sequences but the last ones are full; those are powers of two. ``lengths`` must not rise.
    """
    bins = first_fit_decreasing(lengths, capacity)
    used = [sum(lengths[p] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda b: (-used[b], b))
    full, rest = divmod(sum(used), capacity)
    kept, apart = order[:full], order[full:]
    # what the emptiest bins hold, shortest last, so that small gaps cut short documents
    queue = [(p, 0, lengths[p]) for b in apart for p in bins[b]]
    queue.sort(key=lambda part: -part[2])
    sequences = []
    for goal, places in [*((capacity, bins[b]) for b in kept), *((size, []) for size in powers_of_two(rest))]:
        sequence = [(p, 0, lengths[p]) for p in places]
        gap = goal - sum(n for _, _, n in sequence)
        while gap:
            place, first, length = queue.pop()
            taken = min(gap, length)
            sequence.append((place, first, taken))
            if taken < length:
                queue.append((place, first + taken, length - taken))
            gap -= taken
        sequences.append(sequence)
    return sequences


def _pieces(docs: DataFrame, capacity: int, vocabulary: str, end_id: int) -> DataFrame:
    """Whole sequences of long documents with their checksum, and the rest of each document with its ids.

    ``ids`` are two bytes each where the vocabulary allows; whole sequences bring none.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, out = [], []
            for row, raw in enumerate(encoded(batch.column("text").to_pylist(), vocabulary, end_id)):
                total = len(raw) // 4
                whole = total - total % capacity
                for start in range(0, whole, capacity):
                    rows.append(row)
                    out.append((total, start, capacity, zlib.crc32(raw[4 * start : 4 * (start + capacity)]), None))
                if whole < total:
                    ids = np.frombuffer(raw, "<u4")[whole:]
                    narrow = ids.astype("<u2") if ids.max() < 1 << 16 else ids
                    rows.append(row)
                    out.append((total, whole, total - whole, None, narrow.tobytes()))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(pa.array(rows, pa.int64())) for c in ("doc_id", "deal")],
                    *[pa.array(c, k) for c, k in zip(columns, kinds)],
                ],
                names=["doc_id", "deal", "doc_tokens", "start", "length", "ids_crc32", "ids"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string").alias("text")
    deal = F.xxhash64(F.lit("groups"), F.col("doc_id"), F.col("text").cast("string")).alias("deal")
    schema = f"doc_id {kind}, deal bigint, doc_tokens bigint, start bigint, length bigint, ids_crc32 bigint, ids binary"
    chosen = small_batches(docs).select("doc_id", text, deal)
    return chosen.mapInArrow(lambda batches: released(encode(batches)), schema)


def pack(
    docs: DataFrame,
    capacity: int = SEQUENCE,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    group_docs: int = GROUP_DOCS,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """Pack ``docs(doc_id, text)`` into sequences of ``capacity`` tokens (a power of two) without padding.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` for each piece. A
    document is its token ids and the end id. One longer than a sequence gives whole sequences from
    its beginning, and its rest is packed like a shorter document.

    Edge cases: an absent text is empty and takes one token; rows without id and repeated rows are
    packed each; equal texts and ties in length are dealt and ordered by id and checksum, so the
    result is the same in every run; a text may be longer than a group; an empty table gives no
    rows; other columns are not read.

    The rests travel once, with their ids, to the group that a hash of id and text names. A group
    is about ``group_docs`` documents whatever their number; rows that are all the same fall into
    one group, which is packed in parts of at most ``group_docs`` documents and ``group_bytes``.
    Nothing comes to the driver but the number of rows.
    """
    if capacity & (capacity - 1):
        raise ValueError(f"a sequence's length must be a power of two, got {capacity}")
    # the number of rows is in the files' footers
    groups = max(1, -(-docs.count() // group_docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)

    def laid_out(rows: list[list], number: int, group: int) -> tuple[pa.RecordBatch, int]:
        """The pieces of one group or a part of it, its sequences numbered from ``number`` on, and the next number."""
        whole = [r for r in rows if r[5] is None]
        rests = [r for r in rows if r[5] is not None]
        out = []
        for doc_id, total, start, length, crc, _ in whole:
            out.append((doc_id, start, length, crc, total, (group << 32) + number, 0))
            number += 1
        for sequence in pack_group([r[3] for r in rests], capacity):
            offset = 0
            for place, first, length in sequence:
                doc_id, total, start, whole_length, _, ids = rests[place]
                width = len(ids) // whole_length
                wide = np.frombuffer(ids, f"<u{width}", length, first * width).astype("<u4").tobytes()
                out.append((doc_id, start + first, length, zlib.crc32(wide), total, (group << 32) + number, offset))
                offset += length
            number += 1
        arrays = [pa.array(c, t) for c, t in zip(zip(*out), [id_type, *[pa.int64()] * 6])]
        return pa.RecordBatch.from_arrays(arrays, names=names), number

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, at, done = [], 0, None, 0
        for batch in batches:
            for group, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and (group != at or len(held) >= group_docs * 2 or size > group_bytes):
                    packed, done = laid_out(held, done, at)
                    yield packed
                    held, size = [], 0
                if group != at:
                    at, done = group, 0
                held.append(row)
                size += len(row[5] or b"")
        if held:
            yield laid_out(held, done, at)[0]

    group = F.pmod("deal", F.lit(groups)).alias("group")
    rows = _pieces(docs, capacity, vocabulary, end_id).select(group, "doc_id", "doc_tokens", "start", "length", "ids_crc32", "ids")
    rows = rows.repartition(groups, "group").sortWithinPartitions("group", F.desc("length"), "doc_id", "start", "ids_crc32", "ids")
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return rows.mapInArrow(place, schema)
