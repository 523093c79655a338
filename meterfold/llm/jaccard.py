"""Near-duplicate documents: an exact Jaccard join of word shingles as a blocked sparse product.

Documents are the rows and hashed shingles the columns of a sparse 0/1 matrix A; the overlaps of
all pairs are A times its transpose. Most of it never has to be formed:

1. Blocks of columns count in how many documents each shingle occurs. A shingle of one document
   adds to no overlap, so a document of which less than the threshold's share of shingles occurs
   elsewhere is similar to none.
2. What is left is reduced to distinct sets and counted once more. Two similar sets share one of
   the few rarest shingles of each (the prefix), which ties the sets into clusters.
3. Within a cluster the product is formed by blocks of documents whose sizes allow the
   threshold. Overlaps accumulate over blocks of columns, and pairs below the bound
   100 |x and y| >= 80 |x or y| are dropped. A block pair returns a spanning forest of its links,
   not the pairs.

Shingles are 64-bit hashes of 64-bit word hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterfold.llm.common import (
    binary,
    components_of,
    connected_components,
    give_back,
    ngram_hashes,
    released,
    small_batches,
    text_bytes,
    word_hashes,
    words,
)
from meterfold.session import materialise

SHINGLE = 5
LEAST_PERCENT = 80

# Documents packed together, text bytes behind one block of columns, shingles in one block of rows.
BATCH_DOCS = 1_000
BLOCK_BYTES = 8 << 20
BLOCK_SHINGLES = 1 << 21
BLOCK_DOCS = 768
PRODUCT_COLUMNS = 4_096

_PACKED = "batch bigint, block int, roster boolean, ids binary, sizes binary, hashes binary, dfs binary"
_COUNTED = "doc_id bigint, n_shingles bigint, hashes binary"


def shingle_set(text: bytes, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes; the whole sequence is one shingle if it is shorter."""
    tokens = words(text)
    if not tokens:
        return np.empty(0, dtype=np.uint64)
    if len(tokens) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(tokens), seed=n)], dtype=np.uint64)
    return np.unique(ngram_hashes(word_hashes(tokens), n))


def needed_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of a set of size ``n`` with any similar one: ceil(percent / 100 * n)."""
    return -(-percent * n // 100)


def _rows(columns: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    names = ["batch", "block", "roster", "ids", "sizes", "hashes", "dfs"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _pack(rows: DataFrame, sets: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, list[np.ndarray]]], blocks: int) -> DataFrame:
    """Incidence by batch of documents and block of columns, one row of packed numbers for each.

    ``sets`` gives ids, set sizes and the shingles that take part. A batch also has a roster row
    with its ids and sizes; rosters are spread over the blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            for first in range(0, whole.num_rows, BATCH_DOCS):
                ids, sizes, parts = sets(whole.slice(first, BATCH_DOCS))
                hashes = np.concatenate(parts) if parts else np.empty(0, np.uint64)
                doc = np.repeat(np.arange(len(parts), dtype=np.uint32), [len(p) for p in parts])
                block = (hashes % np.uint64(blocks)).astype(np.int64)
                order = np.argsort(block, kind="stable")
                hashes, doc, block = hashes[order], doc[order], block[order]
                bounds = np.searchsorted(block, np.arange(blocks + 1))
                out = [[number], [number % blocks], [True], [binary(ids, "<i8")], [binary(sizes, "<i8")], [b""], [b""]]
                for b in np.nonzero(np.diff(bounds))[0]:
                    inside = slice(bounds[b], bounds[b + 1])
                    row = (number, int(b), False, binary(doc[inside], "<u4"), b"", binary(hashes[inside], "<u8"), b"")
                    for column, value in zip(out, row):
                        column.append(value)
                yield _rows(out)
                number += 1

    return rows.mapInArrow(lambda batches: released(run(batches)), _PACKED)


def occurrences(values: np.ndarray) -> np.ndarray:
    """How often each value occurs among all, in their order; takes three arrays of their length."""
    order = np.argsort(values).astype(np.uint32)
    ordered = values[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(values) else np.empty(0, np.int64)
    counts = np.diff(np.r_[starts, len(values)]).astype(np.uint32)
    found = np.empty(len(values), np.uint32)
    found[order] = np.repeat(counts, counts)
    return found


def _whole(column: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column as numbers, without a copy, and where each row ends among them."""
    column = column.combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    size = np.dtype(kind).itemsize
    raw = column.buffers()[2]
    if raw is None or ends[0] == ends[-1]:
        return np.empty(0, kind), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]].view(kind), (ends - ends[0]) // size


def _count_block(rows: pa.Table) -> pa.Table:
    """Of one block of columns the incidences of those in two documents or more, with the column's count."""
    packed = rows.filter(pa.compute.invert(rows["roster"]))
    hashes, ends = _whole(packed["hashes"], "<u8")
    docs, _ = _whole(packed["ids"], "<u4")
    df = occurrences(hashes)
    rosters = rows.filter(rows["roster"])
    out = [rosters[c].to_pylist() for c in ("batch", "block", "roster", "ids", "sizes", "hashes", "dfs")]
    for batch, block, first, last in zip(packed["batch"].to_pylist(), packed["block"].to_pylist(), ends[:-1], ends[1:]):
        shared = df[first:last] >= 2
        if shared.any():
            ids, own, times = (a[first:last][shared].tobytes() for a in (docs, hashes, df))
            row = (batch, block, False, ids, b"", own, times)
            for column, value in zip(out, row):
                column.append(value)
    found = pa.Table.from_batches([_rows(out)])
    del packed, hashes, docs, df, out
    give_back()
    return found


def _gather(percent: int, rare_first: bool) -> Callable[[pa.Table], pa.Table]:
    """A function from one batch's counted rows to one row per document.

    ``hashes`` holds the shared shingles of a document that may have a similar one, else NULL.
    """

    def gather(rows: pa.Table) -> pa.Table:
        data = rows.to_pylist()
        [roster] = [r for r in data if r["roster"]]
        ids, sizes = np.frombuffer(roster["ids"], "<i8"), np.frombuffer(roster["sizes"], "<i8")
        packed = [r for r in data if not r["roster"]]
        doc = np.frombuffer(b"".join(r["ids"] for r in packed), "<u4").astype(np.int64)
        hashes = np.frombuffer(b"".join(r["hashes"] for r in packed), "<u8")
        dfs = np.frombuffer(b"".join(r["dfs"] for r in packed), "<u4")
        shared = np.bincount(doc, minlength=len(ids))
        candidate = (sizes > 0) & (shared >= needed_overlap(sizes, percent))
        order = np.lexsort((hashes, dfs, doc)) if rare_first else np.lexsort((hashes, doc))
        hashes, ends = hashes[order], np.cumsum(shared)
        sets = [hashes[e - s : e].tobytes() if c else None for c, s, e in zip(candidate, shared, ends)]
        absent = ids == _NO_ID
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64(), mask=absent),
                "n_shingles": pa.array(sizes, pa.int64()),
                "hashes": pa.array(sets, pa.binary()),
            }
        )

    return gather


_NO_ID = np.iinfo(np.int64).min


def _counted(packed: DataFrame, percent: int, rare_first: bool) -> DataFrame:
    counted = packed.groupBy("block").applyInArrow(_count_block, _PACKED)
    return counted.groupBy("batch").applyInArrow(_gather(percent, rare_first), _COUNTED)


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(_NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def shingle_counts(docs: DataFrame, n: int = SHINGLE, percent: int = LEAST_PERCENT) -> DataFrame:
    """``doc_id, n_shingles, hashes`` of all documents: sizes, and the shared shingles of candidates."""

    def sets(batch: pa.RecordBatch):
        parts = [shingle_set(t, n) for t in text_bytes(batch.column("text"))]
        return _ids(batch.column("doc_id")), np.array([len(p) for p in parts], dtype=np.int64), parts

    rows = small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return _counted(_pack(rows, sets, max(1, -(-size // BLOCK_BYTES))), percent, rare_first=False)


def _recounted(reps: DataFrame, percent: int) -> DataFrame:
    """The same over distinct sets alone, their shingles in the order of rarity."""

    def sets(batch: pa.RecordBatch):
        parts = [np.frombuffer(h, "<u8") for h in batch.column("hashes").to_pylist()]
        return _ids(batch.column("doc_id")), batch.column("n_shingles").to_numpy(), parts

    size = reps.agg(F.sum(F.octet_length("hashes"))).first()[0] or 0
    return _counted(_pack(reps, sets, max(1, -(-size // BLOCK_BYTES))), percent, rare_first=True)


def _prefixes(reps: DataFrame, percent: int) -> DataFrame:
    """``doc_id, shingle`` of each set's prefix: any similar set has one of these in its own.

    The prefix has n - needed + 1 of the rarest shingles, of which those without a second
    document come first and tie nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("n_shingles").to_numpy()
            parts = [np.frombuffer(h, "<i8") for h in batch.column("hashes").to_pylist()]
            alone = sizes - np.array([len(p) for p in parts], dtype=np.int64)
            length = sizes - needed_overlap(sizes, percent) + 1 - alone
            kept = [p[: max(0, k)] for p, k in zip(parts, length)]
            docs = np.repeat(batch.column("doc_id").to_numpy(), [len(k) for k in kept])
            flat = np.concatenate(kept) if kept else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(flat)], names=["doc_id", "shingle"])

    return reps.mapInArrow(run, "doc_id bigint, shingle bigint")


def _clusters(reps: DataFrame, percent: int) -> DataFrame:
    """``node, component``: sets tied by prefix shingles, each shingle as a star around its smallest document."""
    tied = materialise(_prefixes(reps, percent), "jaccard-prefixes")
    centres = tied.groupBy("shingle").agg(F.min("doc_id").alias("centre"), F.count("*").alias("n")).filter("n > 1")
    edges = tied.join(centres, "shingle").filter("doc_id <> centre").select(F.col("doc_id").alias("a"), F.col("centre").alias("b"))
    return connected_components(edges.distinct(), "jaccard-clusters")


def similar_forest(ids: np.ndarray, sizes: np.ndarray, parts: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join the similar sets of one block product, each set with the smallest it reaches.

    The overlaps accumulate over blocks of columns. Columns of a single set are left out first.
    """
    n = len(ids)
    flat = np.concatenate(parts)
    doc = np.repeat(np.arange(n, dtype=np.int32), [len(p) for p in parts])
    keep = occurrences(flat) >= 2
    flat, doc = flat[keep], doc[keep]
    order = np.argsort(flat, kind="stable").astype(np.uint32)
    flat, doc = flat[order], doc[order]
    column = np.cumsum(np.r_[False, flat[1:] != flat[:-1]], dtype=np.int32) if len(flat) else np.empty(0, np.int32)
    # a document of 2^24 shingles or more would need wider numbers than float32 to count them exactly
    exact = np.float32 if max(map(len, parts), default=0) < 1 << 24 else np.float64
    overlap = np.zeros((n, n), dtype=exact)
    width = int(column[-1]) + 1 if len(column) else 0
    for first in range(0, width, PRODUCT_COLUMNS):
        low, high = np.searchsorted(column, [first, first + PRODUCT_COLUMNS])
        rows, local = np.unique(doc[low:high], return_inverse=True)
        block = np.zeros((len(rows), min(PRODUCT_COLUMNS, width - first)), dtype=exact)
        block[local, column[low:high] - first] = 1
        overlap[np.ix_(rows, rows)] += block @ block.T
    shared = overlap.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - shared
    left, right = np.nonzero(np.triu(100 * shared >= percent * union, 1))
    root = components_of(n, left, right)
    smallest = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(smallest, root, ids)
    return [(int(i), int(m)) for i, m in zip(ids, smallest[root]) if i != m]


def _products(reps: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links between similar sets, by blocks of documents of one cluster.

    Similar sets differ in size by the threshold at most, so with size classes of that ratio
    partners are in the same or in a neighbouring class. A class of many sets is split into blocks
    by a hash; a block meets each block of its own and of the neighbouring classes once.
    """
    ratio = 100 / percent
    placed = reps.join(clusters.withColumnRenamed("node", "doc_id"), "doc_id").withColumn(
        "class", F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(ratio)) + F.lit(1e-9)).cast("int")
    )
    most = F.greatest(F.lit(16), F.least(F.lit(BLOCK_DOCS), F.floor(F.lit(float(BLOCK_SHINGLES)) / F.pow(F.lit(ratio), F.col("class") + 1))))
    counts = placed.groupBy("component", "class").agg(F.count("*").alias("n"))
    counts = materialise(counts.withColumn("blocks", F.ceil(F.col("n") / most).cast("int")), "jaccard-classes")

    def of_class(shift: int, name: str) -> DataFrame:
        return counts.select("component", (F.col("class") + shift).alias("class"), F.col("blocks").alias(name))

    sized = (
        placed.join(of_class(0, "own"), ["component", "class"])
        .join(of_class(1, "smaller"), ["component", "class"], "left")
        .join(of_class(-1, "larger"), ["component", "class"], "left")
        .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("own")).cast("int"))
    )
    here, blk = F.col("class"), F.col("block")

    def meets(count, cell):
        return F.transform(F.sequence(F.lit(0), F.coalesce(F.col(count), F.lit(0)) - 1), cell)

    def none_if_empty(count, cells):
        empty = F.array().cast("array<struct<class:int,i:int,up:int,j:int>>")
        return F.when(F.coalesce(F.col(count), F.lit(0)) > 0, cells).otherwise(empty)

    def cell(c, i, up, j):
        return F.struct(c.cast("int").alias("class"), i.cast("int").alias("i"), up.cast("int").alias("up"), j.cast("int").alias("j"))

    own = meets("own", lambda j: cell(here, F.least(blk, j), F.lit(0), F.greatest(blk, j)))
    larger = none_if_empty("larger", meets("larger", lambda j: cell(here, blk, F.lit(1), j)))
    smaller = none_if_empty("smaller", meets("smaller", lambda j: cell(here - 1, j, F.lit(1), blk)))
    cells = sized.select("component", "doc_id", "n_shingles", "hashes", F.explode(F.concat(own, larger, smaller)).alias("cell"))
    keys = ["component", "cell"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def links() -> pa.RecordBatch:
            ids = np.array([r[0] for r in held], dtype=np.int64)
            sizes = np.array([r[1] for r in held], dtype=np.int64)
            found = similar_forest(ids, sizes, [np.frombuffer(r[2], "<u8") for r in held], percent) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"]
            )

        for batch in batches:
            for component, cell_, *row in zip(*[batch.column(c).to_pylist() for c in (*keys, "doc_id", "n_shingles", "hashes")]):
                own_key = (component, *cell_.values())
                if key is not None and own_key != key:
                    yield links()
                    held = []
                key = own_key
                held.append(row)
        if held:
            yield links()

    linked = cells.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda batches: released(run(batches)), "a bigint, b bigint")
    return linked.distinct()


def jaccard_classes(docs: DataFrame, n: int = SHINGLE, percent: int = LEAST_PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs(doc_id, text)``.

    Two documents are linked when the Jaccard similarity of their sets of distinct n-word shingles
    is at least ``percent``; ``component_id`` is the smallest id reachable over links. Words are
    runs without ASCII white space, with A-Z lower-cased; a text of fewer words is one shingle.

    Edge cases: a text without words, or an absent one, has no shingles and links with nothing; a
    row without id keeps its size, links with nothing and has no component; rows of one id are one
    document with the links of all its rows; an empty table gives no rows; other columns are not
    read.
    """
    counted = materialise(shingle_counts(docs, n, percent), "jaccard-counts")
    candidates = counted.filter("hashes is not null and doc_id is not null")
    whole = F.octet_length("hashes") == 8 * F.col("n_shingles")
    own = F.concat_ws("#", F.lit("id"), F.col("doc_id").cast("string"), F.md5("hashes"))
    keyed = candidates.withColumn("set", F.when(whole, F.md5("hashes")).otherwise(own))
    reps = keyed.groupBy("set", "n_shingles").agg(F.min("doc_id").alias("doc_id"), F.min_by("hashes", "doc_id").alias("hashes"))
    reps = materialise(reps, "jaccard-sets")
    pruned = _recounted(reps.select("doc_id", "n_shingles", "hashes"), percent).filter("hashes is not null")
    pruned = materialise(pruned, "jaccard-shared")
    links = _products(pruned, _clusters(pruned, percent), percent)
    copies = (
        keyed.select("set", "n_shingles", F.col("doc_id").alias("a"))
        .join(reps.select("set", "n_shingles", F.col("doc_id").alias("b")), ["set", "n_shingles"])
        .filter("a <> b")
        .select("a", "b")
    )
    linked = connected_components(links.unionByName(copies), "jaccard-links").withColumnRenamed("node", "doc_id")
    return (
        counted.select("doc_id", "n_shingles")
        .join(linked, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )


def drop_near_copies(docs: DataFrame, n: int = SHINGLE, percent: int = LEAST_PERCENT) -> DataFrame:
    """The rows of ``docs`` with one document of each class left, that of the smallest id; all columns stay.

    Edge cases: as in :func:`jaccard_classes`; rows without id stay, as they have no class, texts
    without words stay, of rows with the same id and text one stays, and rows of one id with
    different texts stay together; an empty table gives no rows. Columns may have any names, those
    used here too.
    """
    classes = jaccard_classes(docs, n, percent)
    others = classes.filter("component_id < doc_id").select(F.col("doc_id").alias("_other")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("text_hash"))
    same = Window.partitionBy("row.doc_id", "text_hash").orderBy("text_hash")
    kept = rows.join(others, F.col("row.doc_id") == F.col("_other"), "left_anti").withColumn("copy", F.row_number().over(same))
    return kept.filter("copy = 1 or row.doc_id is null").select("row.*")
