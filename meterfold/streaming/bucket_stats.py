"""Statistics of instantaneous values over a stream of readings."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterfold.functions.timebucket import DAY_START, grain_name, instant_wall_clock, stat_type, wall_clock_instant
from meterfold.operators.series import Series
from meterfold.sources.store import StatStore


def stream_bucket_stats(
    readings: DataFrame,
    grain: str,
    s: Series = Series(),
    delay: str = "1 day",
    day_start: timedelta | None = DAY_START,
) -> DataFrame:
    """Average, extremes and count per series and bucket; readings later than ``delay`` are dropped.

    Readings are aggregated on the map side before they meet the state, so a busy series
    reaches its state as one row per task and bucket.
    """
    lengths = {"minute": "1 minute", "hour": "1 hour", "day": "1 day"}
    shift = day_start if grain_name(grain) == "day" and day_start is not None else timedelta(0)
    event_time = wall_clock_instant(F.col(s.ts))
    buckets = F.window("_at", lengths[grain_name(grain)], startTime=f"{int(shift.total_seconds())} seconds")
    return (
        readings.withColumn("_at", event_time)
        .withWatermark("_at", delay)
        .groupBy(*s.keys, buckets.alias("_window"))
        .agg(
            F.avg(s.value).alias("dbl_stats"),
            F.min(s.value).alias("dbl_min"),
            F.max(s.value).alias("dbl_max"),
            F.count(F.lit(1)).alias("readings"),
        )
        .withColumn("stat_time", instant_wall_clock(F.col("_window.start")) - F.lit(shift))
        .drop("_window")
    )


def upsert_stream(
    stats: DataFrame,
    devices: DataFrame,
    store: StatStore,
    table: str,
    grain: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep a fact table up to date with every bucket a micro-batch changed.

    Devices are joined to buckets, not to readings. A replayed batch overwrites its own rows.
    ``trigger`` is Spark's, by default one pass over what is available.
    """
    columns = ["dbl_stats", "dbl_min", "dbl_max"]

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        facts = batch.join(devices.select("entity_id", "device_id", "device_type"), "entity_id")
        store.upsert(table, facts.withColumn("stat_type", stat_type(grain)), columns)

    return (
        stats.writeStream.outputMode("update")
        .foreachBatch(store_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
