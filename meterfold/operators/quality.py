"""Checks on telemetry, facts and watermarks."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterfold.functions.period import period_type
from meterfold.functions.timebucket import (
    MINIMUM_RANGE,
    calendar_bucket,
    check_range,
    half_open,
    lookahead_end,
    timestamp_literal,
)
from meterfold.operators.consumption import bucket_consumption_min
from meterfold.operators.incremental import SERIES_KEY
from meterfold.operators.series import Series

# The label of each check, by coarse grain, and the fine grain it is summed from.
ROLLUP_CHECKS = (
    ("時統計", "hour", "minute"),
    ("日統計", "day", "hour"),
    ("月統計", "month", "day"),
    ("年統計", "year", "month"),
)


def rollup_mismatches(
    readings: DataFrame,
    coarse: str,
    fine: str,
    s: Series = Series(),
    start: datetime | None = None,
    end: datetime | None = None,
    tolerance: float = 0,
) -> DataFrame:
    """Coarse buckets next to the sum of their fine ones, as ``consumption, fine_sum, matches``."""
    wide = bucket_consumption_min(readings, coarse, s, start, end)
    narrow = bucket_consumption_min(readings, fine, s, start, end)
    sums = narrow.groupBy(*s.keys, calendar_bucket(F.col("bucket"), coarse).alias("bucket")).agg(
        F.sum("energy_consumption").alias("fine_sum")
    )
    gap = F.abs(F.col("consumption") - F.col("fine_sum"))
    return (
        wide.select(*s.keys, "bucket", F.col("energy_consumption").alias("consumption"))
        .join(sums, [*s.keys, "bucket"])
        .withColumn("matches", gap <= tolerance)
    )


def _consumption_of_all_grains(
    readings: DataFrame, s: Series, start: datetime | None, end: datetime | None
) -> DataFrame:
    """``grain, bucket, consumption`` for every grain, from one scan.

    Each minute's extremes are handed to the buckets of all grains. With an ``end`` the year
    looks further ahead than the other grains, so the readings beyond their horizon go to it
    alone.
    """
    near = F.lit(True)
    if start is not None:
        readings = readings.filter(F.col(s.ts) >= timestamp_literal(start))
    if end is not None:
        readings = readings.filter(F.col(s.ts) <= timestamp_literal(lookahead_end(end, "year")))
        near = F.col(s.ts) <= timestamp_literal(lookahead_end(end, "month"))
    minutes = readings.groupBy(
        *s.keys, near.alias("_near"), calendar_bucket(F.col(s.ts), "minute").alias("_minute")
    ).agg(F.min(s.value).alias("_low"), F.max(s.value).alias("_high"))

    def bucket_of(grain: str) -> Column:
        return F.struct(F.lit(grain).alias("grain"), calendar_bucket(F.col("_minute"), grain).alias("bucket"))

    every = F.array(*[bucket_of(g) for g in MINIMUM_RANGE])
    buckets = (
        minutes.select(*s.keys, "_low", "_high", F.explode(F.when(F.col("_near"), every).otherwise(F.array(bucket_of("year")))))
        .groupBy(*s.keys, F.col("col.grain").alias("grain"), F.col("col.bucket").alias("bucket"))
        .agg(F.min("_low").alias("_low"), F.max("_high").alias("_high"))
        .filter(F.col("_low").isNotNull())
    )
    following = Window.partitionBy(*s.keys, "grain").orderBy("bucket")
    next_low = F.coalesce(F.lead("_low").over(following), F.col("_high"))
    consumed = buckets.select(*s.keys, "grain", "bucket", (next_low - F.col("_low")).alias("consumption"))
    return half_open(consumed, "bucket", end=end)


def verify_rollup(
    readings: DataFrame,
    s: Series = Series(),
    start: datetime | None = None,
    end: datetime | None = None,
    tolerance: float = 0,
) -> DataFrame:
    """One row per grain: ``OK`` if every coarse bucket equals the sum of its fine ones.

    Every bucket meets its parts in one aggregation: it goes there once as itself and once as
    a part of the bucket it belongs to.
    """
    for grain in MINIMUM_RANGE:
        check_range(start, end, grain)
    grain, bucket = F.col("grain"), F.col("bucket")
    parent = parent_bucket = None
    for _, coarse, fine in ROLLUP_CHECKS:
        is_fine, above = grain == fine, calendar_bucket(bucket, coarse)
        parent = F.when(is_fine, coarse) if parent is None else parent.when(is_fine, coarse)
        parent_bucket = F.when(is_fine, above) if parent_bucket is None else parent_bucket.when(is_fine, above)
    consumption = F.col("consumption")
    nothing = F.when(F.lit(False), consumption)
    roles = F.array(
        F.struct(grain.alias("coarse"), bucket.alias("at"), consumption.alias("own"), nothing.alias("part")),
        F.struct(parent.alias("coarse"), parent_bucket.alias("at"), nothing.alias("own"), consumption.alias("part")),
    )
    pairs = (
        _consumption_of_all_grains(readings, s, start, end)
        .select(*s.keys, F.explode(roles).alias("r"))
        .groupBy(*s.keys, "r.coarse", "r.at")
        .agg(F.max("r.own").alias("own"), F.sum("r.part").alias("parts"))
    )
    wrong = F.abs(F.col("own") - F.col("parts")) > tolerance
    counts = pairs.agg(*[F.count_if(wrong & (F.col("coarse") == c)).alias(c) for _, c, _ in ROLLUP_CHECKS])
    verdicts = [
        F.struct(F.lit(label).alias("stat_type"), F.when(F.col(c) > 0, "NG").otherwise("OK").alias("check_result"))
        for label, c, _ in ROLLUP_CHECKS
    ]
    return counts.select(F.explode(F.array(*verdicts)).alias("v")).select("v.*")


def watermark_drift(latest: DataFrame, facts: DataFrame, offset: timedelta | None = None) -> DataFrame:
    """Watermarks that differ from the newest fact stored.

    Watermarks are written with an offset; give it to compare like with like, leave it out to
    compare the raw values.
    """
    newest = facts.groupBy(*SERIES_KEY).agg(F.max("stat_time").alias("max_stat_time"))
    mark = F.col("latest_stat_time")
    if offset is not None:
        mark = mark - F.lit(offset)
    return (
        latest.select(*SERIES_KEY, "latest_stat_time")
        .join(newest, SERIES_KEY)
        .filter(mark != F.col("max_stat_time"))
    )


def duplicate_keys(facts: DataFrame, keys: list[str]) -> DataFrame:
    return facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def assert_unique_key(facts: DataFrame, keys: list[str]) -> None:
    offending = duplicate_keys(facts, keys).limit(1).collect()
    if offending:
        raise ValueError(f"key not unique: {offending[0].asDict()}")


def period_truth_table(cases: DataFrame, computed: Column | None = None) -> DataFrame:
    """Cases ``ts, expected`` with the computed period and whether it agrees (``Y``/``N``)."""
    output = computed if computed is not None else period_type(F.col("ts"))
    return cases.withColumn("fn_output", output).withColumn(
        "verify", F.when(F.col("fn_output") == F.col("expected"), "Y").otherwise("N")
    )


def drop_column(facts: DataFrame, column: str = "entity_id") -> DataFrame:
    return facts.drop(column)
