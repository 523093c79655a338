"""Token ids of whole texts, and the Parquet files that hold them."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterfold.llm import bpe
from meterfold.llm.common import map_batches, released, slices, small_batches
from meterfold.session import fresh_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
ID = "<u4"
# Bytes that the words of one worker may take while token files are written. Most of the work is rare words
# that come back after many others; no other operator runs in between, so they can be kept for longer.
MEMO_BYTES = 320 << 20


def encoded(texts: list[str | None], vocabulary: str = VOCABULARY, memo_bytes: int = bpe.MEMO_BYTES) -> list[bytes]:
    """Ids of each text followed by the end id; an absent text counts as empty."""
    return bpe.encoded(texts, vocabulary, END_ID, memo_bytes)


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows in ranges of ``doc_id``, sorted inside; rows of one id are ordered by a hash of their text."""
    rows = small_batches(docs).select("doc_id", F.col("text").cast("string").alias("text")).withColumn("tie", F.xxhash64("text"))
    return rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").drop("tie")


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str = VOCABULARY,
    row_group_bytes: int = 16 << 20,
    page_bytes: int = 256 << 10,
    page_rows: int = 2_000,
    memo_bytes: int = MEMO_BYTES,
) -> None:
    """Encode ``docs(doc_id, text)`` and write the ids in ascending ``doc_id`` order.

    Each file holds a range of ids, sorted: ``doc_id, n_tokens, part, first, ids`` with the file's
    number, the tokens before the document inside the file, and the ids as a list. Ids are
    dictionary-encoded, the numbers of the other columns delta-encoded; row groups and pages are
    bounded in bytes and rows, and the page index lets a reader fetch single documents or only the
    metadata.

    Edge cases: an absent text is empty and has the end id alone; rows without id come first;
    repeated rows are written each; an empty table gives an empty folder that can be read; other
    columns are not read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            ids = encoded(batch.column("text").to_pylist(), vocabulary, memo_bytes)
            counts = np.array([len(i) // 4 for i in ids], dtype=np.int64)
            ends = np.cumsum(counts)
            values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), values)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts.astype(np.int32)),
                    pa.array(np.full(len(counts), part, dtype=np.int32)),
                    pa.array(before + ends - counts),
                    lists,
                ],
                names=["doc_id", "n_tokens", "part", "first", "ids"],
            )
            before += int(counts.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return released(encode(batches))

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens int, part int, first bigint, ids array<int>"
    writer = _in_order(docs).mapInArrow(run, schema).write.mode("errorifexists")
    for column in ("doc_id", "n_tokens", "part", "first"):
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    (
        writer.option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(page_bytes))
        .option("parquet.page.row.count.limit", str(page_rows))
        .option("compression", "zstd")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Token files with ``start``, the tokens of all documents before; columns that a query drops are not read.

    A file's total is summed from its counts alone: one row per file, whatever the documents.
    """
    files = spark.read.parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # the window spans one row per file
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))
    # one small row per file may be broadcast; the lists must not be shuffled to meet it
    return files.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("offset") + F.col("first")).cast("bigint").alias("start"), F.col("n_tokens").cast("bigint"), "ids"
    )


def with_checksums(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: the checksum of the ids as little-endian 32-bit numbers."""

    def sums(rows: pa.Table) -> pa.Table:
        found = []
        for chunk in rows["ids"].chunks:
            cuts = chunk.offsets.to_numpy()
            raw = memoryview(chunk.values[cuts[0] : cuts[-1]].to_numpy(zero_copy_only=False).astype("<i4", copy=False)).cast("B")
            found += [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cuts[:-1] - cuts[0], cuts[1:] - cuts[0])]
        return rows.drop_columns(["ids"]).append_column("ids_crc32", pa.array(found, pa.int64()))

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return map_batches(tokens, sums, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Write the tokens of ``docs`` to the shared folder and read them back, as digests."""
    spark = docs.sparkSession
    path = fresh_path(spark, "tokens")
    write_tokens(docs, path, vocabulary)
    return with_checksums(read_tokens(spark, path))
