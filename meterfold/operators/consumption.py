"""Consumption from cumulative meter counters.

Buckets are aggregated before anything is ordered: the window that looks at the next bucket
sees one row per observed bucket, however many readings fell into it.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterfold.functions.timebucket import (
    DAY_START,
    calendar_bucket,
    check_range,
    grain_bucket,
    half_open,
    log_day,
    lookahead_end,
    timestamp_literal,
)
from meterfold.operators.ordered import with_previous
from meterfold.operators.series import Series


def _delta(value: Column, previous: Column) -> Column:
    """Step between two readings: a decrease is a counter reset and counts 0.

    A missing reading counts as 0, a missing predecessor as no step at all.
    """
    current = F.coalesce(value, F.lit(0))
    before = F.coalesce(previous, current)
    return F.when(current < before, F.lit(0)).otherwise(current - before)


def reading_delta(
    readings: DataFrame, s: Series = Series(), skip_nulls: bool = False, slice_grain: str = "hour"
) -> DataFrame:
    """Each reading's step from the one before it; the first of a series has none and is dropped."""
    if skip_nulls:
        readings = readings.filter(F.col(s.value).isNotNull())
    return (
        with_previous(readings, s, slice_grain)
        .filter("has_prev")
        .withColumn("delta", _delta(F.col(s.value), F.col("prev_value")))
        .drop("prev_value", "has_prev")
    )


def delta_per_bucket(
    readings: DataFrame, s: Series = Series(), grain: str = "minute", skip_nulls: bool = False
) -> DataFrame:
    """Sum of the reading steps per bucket, as ``bucket, delta``.

    The same steps as :func:`reading_delta`, summed where they arise: readings are shuffled
    once, on series and bucket, and only bucket rows travel on to meet their predecessor.
    """
    if skip_nulls:
        readings = readings.filter(F.col(s.value).isNotNull())
    sliced = readings.withColumn("bucket", calendar_bucket(F.col(s.ts), grain))
    within = Window.partitionBy(*s.keys, "bucket").orderBy(*s.ordering)
    across = Window.partitionBy(*s.keys).orderBy("bucket")
    stepped = (
        sliced.withColumn("_pos", F.row_number().over(within))
        .withColumn("_lag", F.lag(s.value).over(within))
        .withColumn("_step", F.when(F.col("_pos") > 1, _delta(F.col(s.value), F.col("_lag"))))
    )
    buckets = stepped.groupBy(*s.keys, "bucket").agg(
        F.sum("_step").alias("_inner"),
        F.max(F.when(F.col("_pos") == 1, F.col(s.value))).alias("_head"),
        F.max_by(s.value, "_pos").alias("_tail"),
    )
    return (
        buckets.withColumn("_carry", F.lag("_tail").over(across))
        .withColumn("_follows", F.row_number().over(across) > 1)
        .filter(F.col("_follows") | F.col("_inner").isNotNull())
        .withColumn(
            "delta",
            F.coalesce("_inner", F.lit(0))
            + F.when(F.col("_follows"), _delta(F.col("_head"), F.col("_carry"))).otherwise(F.lit(0)),
        )
        .select(*s.keys, "bucket", "delta")
    )


def bucket_consumption_min(
    readings: DataFrame,
    grain: str,
    s: Series = Series(),
    start: datetime | None = None,
    end: datetime | None = None,
    day_start: timedelta | None = None,
) -> DataFrame:
    """Consumption as the next observed bucket's minimum less this one's.

    The newest bucket has no next one and uses its own maximum. The scan reaches beyond
    ``end`` so that an outage does not cut the last requested bucket short.
    """
    check_range(start, end, grain)
    if start is not None:
        readings = readings.filter(F.col(s.ts) >= timestamp_literal(start))
    if end is not None:
        readings = readings.filter(F.col(s.ts) <= timestamp_literal(lookahead_end(end, grain)))
    buckets = (
        readings.groupBy(*s.keys, grain_bucket(F.col(s.ts), grain, day_start).alias("bucket"))
        .agg(F.min(s.value).alias("min_value"), F.max(s.value).alias("_max"))
        .filter(F.col("min_value").isNotNull())
    )
    following = Window.partitionBy(*s.keys).orderBy("bucket")
    consumed = buckets.select(
        *s.keys,
        "bucket",
        "min_value",
        F.coalesce(F.lead("min_value").over(following), F.col("_max")).alias("next_min_value"),
    ).withColumn("energy_consumption", F.col("next_min_value") - F.col("min_value"))
    return half_open(consumed, "bucket", end=end)


def open_bucket(
    readings: DataFrame, grain: str, s: Series = Series(), day_start: timedelta | None = DAY_START
) -> DataFrame:
    """The newest bucket of each series, the one that may still receive readings."""
    return (
        readings.filter(F.col(s.value).isNotNull())
        .groupBy(*s.keys)
        .agg(grain_bucket(F.max(s.ts), grain, day_start).alias("max_bucket"))
    )


def _first_readings(readings: DataFrame, bucket: Column, s: Series) -> DataFrame:
    """Per bucket its first and last reading, and the first of the next observed bucket."""
    following = Window.partitionBy(*s.keys).orderBy("period_start")
    return (
        readings.filter(F.col(s.value).isNotNull())
        .groupBy(*s.keys, bucket.alias("period_start"))
        .agg(s.first().alias("energy_start"), s.last().alias("_last"))
        .withColumn("_next", F.lead("energy_start").over(following))
    )


def bucket_consumption_first(
    readings: DataFrame,
    grain: str = "day",
    s: Series = Series(),
    start: datetime | None = None,
    end: datetime | None = None,
    key_config: DataFrame | None = None,
    day_start: timedelta | None = DAY_START,
) -> DataFrame:
    """Consumption as the next observed bucket's first reading less this one's first.

    The newest bucket is measured to its own last reading. With ``key_config`` the counter
    key is translated to ``consumption_key_id``: by device type and key if the series has the
    type, else by the key alone, which must then mean the same for every type.
    """
    if start is not None:
        readings = readings.filter(F.col(s.ts) >= timestamp_literal(start))
    firsts = _first_readings(readings, grain_bucket(F.col(s.ts), grain, day_start), s)
    spans = half_open(
        firsts.withColumn("energy_end", F.coalesce("_next", "_last"))
        .withColumn("consumption", F.col("energy_end") - F.col("energy_start"))
        .drop("_next", "_last"),
        "period_start",
        start,
        end,
    )
    if key_config is None:
        return spans
    keys = key_config.select("device_type", F.col("accumulation_key_id").alias("key_id"), "consumption_key_id")
    if "device_type" in s.keys:
        return spans.join(keys, ["device_type", "key_id"])
    keys = keys.drop("device_type").distinct()
    shared = keys.groupBy("key_id").count().filter("count > 1").limit(1).collect()
    if shared:
        raise ValueError(f"counter key {shared[0]['key_id']} means several things; give the series its device_type")
    return spans.join(keys, "key_id")


def daily_consumption(
    readings: DataFrame,
    as_of: date,
    s: Series = Series(),
    start_day: date | None = None,
    end_day: date | None = None,
) -> DataFrame:
    """Consumption per calendar day; a day without a later one counts only if it is today."""
    firsts = _first_readings(readings, log_day(F.col(s.ts)), s)
    days = (
        firsts.filter(F.col("_next").isNotNull() | (F.col("period_start") == F.lit(as_of)))
        .withColumn("energy_end", F.coalesce("_next", "_last"))
        .withColumn("daily_energy", F.col("energy_end") - F.col("energy_start"))
        .withColumnRenamed("period_start", "result_day")
        .select(*s.keys, "result_day", "energy_start", "energy_end", "daily_energy")
    )
    if start_day is not None:
        days = days.filter(F.col("result_day") >= F.lit(start_day))
    if end_day is not None:
        days = days.filter(F.col("result_day") < F.lit(end_day))
    return days


def fleet_consumption(
    readings: DataFrame,
    devices: DataFrame,
    key_config: DataFrame,
    grain: str,
    latest: DataFrame | None = None,
    s: Series = Series(),
    day_start: timedelta | None = DAY_START,
) -> DataFrame:
    """Bucket consumption of every device, each from the bucket its watermark lies in.

    ``latest`` holds ``device_id, device_type, key_id, latest_stat_time`` under the
    consumption key; a device without a row is computed from its first reading.

    The watermark is applied to buckets and not to readings. A start is always a bucket's
    first instant, so both keep the same rows, and buckets are far fewer than readings.
    """
    counters = key_config.select(F.col("accumulation_key_id").alias("key_id"))
    consumed = bucket_consumption_min(readings.join(counters, "key_id", "left_semi"), grain, s, day_start=day_start)
    roles = key_config.select(
        "device_type", F.col("accumulation_key_id").alias("_counter"), F.col("consumption_key_id").alias("key_id")
    )
    wanted = with_restart(
        devices.select("device_id", "device_type", "factory_id", "entity_id").join(roles, "device_type"), latest, grain
    ).withColumnsRenamed({"key_id": "_consumption", "_counter": "key_id"})
    return (
        consumed.join(wanted, ["entity_id", "key_id"])
        .filter(F.col("_restart").isNull() | (F.col("bucket") >= F.col("_restart")))
        .select(
            "device_id",
            "device_type",
            "factory_id",
            F.col("_consumption").alias("key_id"),
            F.col("bucket").alias("stat_time"),
            F.col("energy_consumption").alias("consumption"),
        )
    )


def with_restart(series: DataFrame, latest: DataFrame | None, grain: str) -> DataFrame:
    """Add ``_restart``, the first bucket to redo, to rows ``device_id, device_type, key_id``.

    One row per device and key, so the join is small whatever the telemetry.
    """
    if latest is None:
        return series.withColumn("_restart", F.lit(None).cast("timestamp_ntz"))
    known = latest.select(
        "device_id", "device_type", "key_id", restart_bucket(F.col("latest_stat_time"), grain).alias("_restart")
    )
    return series.join(known, ["device_id", "device_type", "key_id"], "left")


def restart_bucket(since: Column, grain: str) -> Column:
    """The bucket a stored watermark asks to redo.

    A day watermark is midnight plus 07:59:59 of the production day it closes, so its plain
    calendar day names that production day.
    """
    return calendar_bucket(since, grain)
