"""Weighted rendezvous sharding: a record goes to the shard that wins its hash lottery."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterfold.llm.common import or_empty
from meterfold.session import materialise

SHARDS = 16
HASH_BITS = 52


def _lottery(key: Column, shard: int, weight: float) -> Column:
    """The record's cost in a shard, -ln(u)/weight with u uniform in (0, 1) by MD5; the lowest wins."""
    digits = F.substring(F.md5(F.concat_ws("#", key, F.lit(str(shard))).cast("binary")), 1, HASH_BITS // 4)
    u = (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(2**HASH_BITS))
    return F.struct((-F.log(u) / F.lit(float(weight))).alias("cost"), F.lit(shard).alias("shard"))


def rendezvous_shard(key: Column, weights: dict[int, float]) -> Column:
    """The shard of each key by weighted rendezvous hashing.

    A shard's share of the keys is its share of the weights. The lottery of one shard knows
    nothing of the others, so a new shard only takes keys and a removed one only gives them.
    """
    if not weights or any(not (math.isfinite(w) and w > 0) for w in weights.values()):
        raise ValueError(f"weights must be positive numbers, got {weights}")
    tickets = [_lottery(key, s, w) for s, w in sorted(weights.items())]
    return (F.least(*tickets) if len(tickets) > 1 else tickets[0])["shard"]


def assign_shards(
    docs: DataFrame, weights: dict[int, float] | None = None, new_shard: tuple[int, float] | None = (SHARDS, 1.0)
) -> DataFrame:
    """Place each row of ``docs(doc_id, text)`` in a shard, with a gapless slot inside it.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``. The law is ``key``: the
    id and the weights decide, whatever the text. ``grown_shard`` is the shard once ``new_shard``
    joins (NULL if none is asked for). Slots follow ``doc_id``.

    Edge cases: an absent id is the key ``null`` and all such rows share a shard; an absent text
    has the size and checksum of the empty one; repeated rows get the same shard and slots of
    their own; an empty table gives no rows; other columns are not read.

    Texts are read once and reduced to a number each; only these small rows are shuffled. Slots
    need no shard in one task: rows are dealt out by ranges of the id, counted per shard and
    range, and numbered inside a range.
    """
    weights = weights or {s: 1.0 for s in range(SHARDS)}
    text = or_empty(F.col("text"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    grown = rendezvous_shard(key, {**weights, new_shard[0]: new_shard[1]}) if new_shard else F.lit(None).cast("int")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        rendezvous_shard(key, weights).alias("shard"),
        grown.alias("grown_shard"),
    )
    order = ["doc_id", "size", "text_crc32"]
    ranged = materialise(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "shards")
    counts = ranged.groupBy("shard", "part").agg(F.count("*").alias("n"))
    # one row per shard and range here, whatever the number of records
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "part").orderBy(*order)
    return (
        ranged.withColumn("place", F.row_number().over(inside) - 1)
        .join(offsets, ["shard", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("first") + F.col("place")).cast("bigint").alias("slot"),
            "grown_shard",
        )
    )
