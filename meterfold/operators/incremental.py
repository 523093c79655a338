"""Incremental processing: watermarks, merges into stored facts, run metrics."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from meterfold.functions.timebucket import BEGINNING, DAY_START, calendar_bucket, grain_name, timestamp_literal, ts_to_epoch_ms

SERIES_KEY = ["device_id", "device_type", "key_id"]

# What is added to the newest bucket to make the stored watermark.
WATERMARK_OFFSET = {
    "minute_electricity": timedelta(seconds=57),
    "minute": timedelta(seconds=59),
    "hour": timedelta(minutes=59, seconds=59),
    "day": timedelta(hours=7, minutes=59, seconds=59),
    "calendar_day": timedelta(minutes=59, seconds=59),
}


class DuplicateKeyError(ValueError):
    """Rows to insert whose key is already taken."""


def since_watermark(
    df: DataFrame,
    latest: DataFrame,
    column: str,
    strict: bool = False,
    restart: Callable[[Column], Column] | None = None,
    default: datetime = BEGINNING,
) -> DataFrame:
    """Rows of each series from its watermark on.

    ``strict`` excludes the watermark itself, ``restart`` maps it to another lower bound (the
    start of its bucket). A series without watermark starts at ``default``.
    """
    known = latest.select(*SERIES_KEY, F.col("latest_stat_time").alias("_since"))
    bound = F.col("_since") if restart is None else restart(F.col("_since"))
    bound = F.coalesce(bound, timestamp_literal(default))
    reached = F.col(column) > bound if strict else F.col(column) >= bound
    return df.join(known, SERIES_KEY, "left").filter(reached).drop("_since")


def advance_watermark(facts: DataFrame, offset: timedelta) -> DataFrame:
    """The watermark of each series after ``facts`` are stored."""
    return (
        facts.groupBy(*SERIES_KEY)
        .agg((F.max("stat_time") + F.lit(offset)).alias("latest_stat_time"))
        .withColumn("latest_epoch", ts_to_epoch_ms(F.col("latest_stat_time")))
    )


def marks_of(facts: DataFrame, offset: timedelta) -> DataFrame:
    """:func:`advance_watermark` with where the facts begin; nothing is left to be redone then."""
    return (
        facts.groupBy(*SERIES_KEY)
        .agg((F.max("stat_time") + F.lit(offset)).alias("latest_stat_time"), F.min("stat_time").alias("first_stat_time"))
        .withColumn("latest_epoch", ts_to_epoch_ms(F.col("latest_stat_time")))
        .withColumn("redo_until", F.lit(None).cast("timestamp_ntz"))
    )


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Insert new rows; of rows already there overwrite only ``columns``.

    Both sides are unique on ``keys``, so the outer join has no hot key.
    """
    old = target.withColumn("_old", F.lit(True)).alias("t")
    new = updates.withColumn("_new", F.lit(True)).alias("u")
    on = [F.col(f"t.{k}") == F.col(f"u.{k}") for k in keys]
    inserted = F.col("t._old").isNull()

    def merged(name: str) -> Column:
        if name in keys:
            return F.coalesce(f"t.{name}", f"u.{name}").alias(name)
        if name not in updates.columns:
            return F.col(f"t.{name}").alias(name)
        takes_new = F.col("u._new").isNotNull() if name in columns else inserted
        return F.when(takes_new, F.col(f"u.{name}")).otherwise(F.col(f"t.{name}")).alias(name)

    return old.join(new, on, "full_outer").select(*[merged(c) for c in target.columns])


def update_only(target: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Overwrite ``columns`` of the rows ``updates`` match; never insert."""
    new = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = target.join(new, keys, "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )


def insert_only(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Append; a key that exists already, or twice among the new rows, is an error."""
    taken = new.select(*keys).join(target.select(*keys), keys, "left_semi")
    twice = new.groupBy(*keys).count().filter("count > 1").select(*keys)
    offending = taken.unionByName(twice).limit(1).collect()
    if offending:
        raise DuplicateKeyError(f"key already present: {offending[0].asDict()}")
    missing = [c for c in target.columns if c not in new.columns]
    return target.unionByName(new.withColumns({c: F.lit(None) for c in missing}) if missing else new)


def target_high_water(target: DataFrame, grain: str, keys: list[str] = SERIES_KEY) -> DataFrame:
    """The last second of the newest period stored for each series."""
    unit = F.expr(f"INTERVAL 1 {grain_name(grain).upper()}")
    return target.groupBy(*keys).agg(
        (F.max("stat_time") + unit - F.expr("INTERVAL 1 SECOND")).alias("high_water")
    )


def beyond_high_water(
    facts: DataFrame,
    target: DataFrame,
    grain: str,
    refresh_open: bool = False,
    keys: list[str] = SERIES_KEY,
    rewound: DataFrame | None = None,
) -> DataFrame:
    """Facts of the periods after the newest one stored; ``refresh_open`` redoes that one too.

    A series in ``rewound`` is redone from the period named there on.
    """
    stored = target_high_water(target, grain, keys)
    bound = F.col("high_water")
    if refresh_open:
        bound = calendar_bucket(bound, grain) - F.expr("INTERVAL 1 SECOND")
    facts = facts.join(stored, keys, "left")
    if rewound is not None:
        back = rewound.select(*keys, (F.col("latest_stat_time") - F.expr("INTERVAL 1 SECOND")).alias("_back"))
        facts, bound = facts.join(back, keys, "left"), F.least(bound, F.col("_back"))
        return facts.filter(bound.isNull() | F.col("high_water").isNull() | (F.col("stat_time") > bound)).drop("high_water", "_back")
    return facts.filter(F.col("high_water").isNull() | (F.col("stat_time") > bound)).drop("high_water")


def run_metrics(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows and series a write passes through, without a job of its own."""
    observation = Observation(name)
    return (
        df.observe(
            observation,
            F.count(F.lit(1)).alias("rows"),
            F.min("stat_time").alias("first_stat_time"),
            F.max("stat_time").alias("last_stat_time"),
        ),
        observation,
    )


def rewind_watermark(latest: DataFrame, late: DataFrame, grain: str = "minute", day_start: timedelta = DAY_START) -> DataFrame:
    """Watermarks set back to the oldest late reading's bucket, so that the next run redoes all of it.

    ``late`` holds ``device_id, device_type, key_id, ts``. ``grain`` names the watermark's bucket as
    in ``WATERMARK_OFFSET``: the new mark is that bucket's own, the start of the minute, hour,
    production day (``day``) or calendar day plus the grain's offset. A mark in the middle of a
    bucket would let a job redo it from a part of its readings.
    """
    unit = {"minute_electricity": "minute", "calendar_day": "day"}.get(grain, grain)
    at = F.col("ts") - F.lit(day_start) if grain == "day" else F.col("ts")
    bucket = calendar_bucket(at, unit) + F.lit(WATERMARK_OFFSET[grain])
    oldest = late.groupBy(*SERIES_KEY).agg(F.min(bucket).alias("_late"))
    moved = F.least("latest_stat_time", "_late")
    return (
        latest.join(oldest, SERIES_KEY, "left")
        .withColumn("latest_stat_time", moved)
        .withColumn("latest_epoch", ts_to_epoch_ms(F.col("latest_stat_time")))
        .drop("_late")
    )
