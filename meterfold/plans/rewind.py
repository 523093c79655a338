"""Late readings: set the watermarks that they concern back, so that the next runs redo the facts.

A reading concerns every grain above it. Consumption is the step to the next bucket, so a late
reading changes the bucket it falls into and the one observed before it; an average changes in its
own bucket alone. Each watermark goes back to the first bucket that changes and remembers how far it
had come, so that a job rereads the span between and no more. Months and years have no watermark;
the first period to redo is noted for them.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterfold.functions.timebucket import DAY_START, calendar_bucket, epoch_ms_to_ts, ts_to_epoch_ms
from meterfold.operators.incremental import SERIES_KEY, WATERMARK_OFFSET
from meterfold.operators.statistics import ENERGY_KEY
from meterfold.plans.jobs import GRAIN_JOBS, Estate, Run, run_grain
from meterfold.session import materialise
from meterfold.sources.store import StatStore

# How far back the bucket before a late reading is looked for at first; beyond, all older facts are.
NEAR = {"minutely": timedelta(days=2), "hourly": timedelta(days=7), "daily": timedelta(days=62)}


@dataclass(frozen=True)
class Concern:
    """A watermark that a reading concerns: its table, the grain's name in ``WATERMARK_OFFSET``, and its facts.

    ``role`` says which key of the reading's device type the watermark has; ``step`` whether the
    bucket before changes as well.
    """

    table: str
    grain: str
    facts: str
    role: str
    step: bool
    electricity: bool | None = None

    @property
    def unit(self) -> str:
        return {"minute_electricity": "minute", "calendar_day": "day"}.get(self.grain, self.grain)

    def bucket(self, ts: Column) -> Column:
        return calendar_bucket(ts - F.lit(DAY_START) if self.grain == "day" else ts, self.unit)


CONCERNS = (
    Concern("minute_latest", "minute_electricity", "minutely", "counter", False, electricity=True),
    Concern("minute_latest", "minute", "minutely", "consumption", True, electricity=False),
    Concern("hour_latest", "hour", "hourly", "consumption", True),
    Concern("hour_latest", "hour", "hourly", "rate", False, electricity=False),
    Concern("day_latest", "day", "daily", "consumption", True),
    Concern("day_latest", "calendar_day", "daily", "rate", False, electricity=False),
    Concern("day_latest", "day", "daily", "average", False),
    Concern("tou_latest", "day", "daily", "consumption", True, electricity=True),
)


def _keys(estate: Estate, concern: Concern) -> DataFrame:
    """``device_type, reading_key, key_id`` of a role; an average is the same for every type."""
    config = estate.key_config
    if concern.role == "average":
        keys = estate.avg_key_config.select(F.col("rate_key_id").alias("reading_key"), F.col("avg_key_id").alias("key_id"))
        return keys
    reading = "rate_key_id" if concern.role == "rate" else "accumulation_key_id"
    key = {"rate": "rate_key_id", "consumption": "consumption_key_id", "counter": "accumulation_key_id"}[concern.role]
    keys = config.select("device_type", F.col(reading).alias("reading_key"), F.col(key).alias("key_id"))
    if concern.role == "counter":
        keys = keys.filter(F.col("key_id") == ENERGY_KEY)
    if concern.electricity is not None:
        kind = F.col("device_type") == "E"
        keys = keys.filter(kind if concern.electricity else ~kind)
    return keys


def _late_series(estate: Estate, late: DataFrame, concern: Concern) -> DataFrame:
    """The oldest late bucket of each series that a concern is about."""
    keys = _keys(estate, concern)
    devices = estate.device.select("device_id", "device_type", "entity_id")
    rows = late.join(devices, "entity_id").withColumnRenamed("key_id", "reading_key")
    rows = rows.join(keys, [c for c in ("device_type", "reading_key") if c in keys.columns])
    return rows.groupBy(*SERIES_KEY).agg(F.min(concern.bucket(F.col("ts"))).alias("_late"))


def _first_changed(store: StatStore, series: DataFrame, concern: Concern) -> DataFrame:
    """Replace ``_late`` by the bucket observed before it, where there is one."""
    bounds = series.agg(F.min("_late").alias("low"), F.max("_late").alias("high")).first()
    if not concern.step or bounds["low"] is None:
        return series

    def before(since: datetime | None) -> DataFrame:
        facts = store.read(concern.facts, since).filter(F.col("stat_time") < F.lit(bounds["high"]).cast("timestamp_ntz"))
        facts = facts.select(*SERIES_KEY, "stat_time").join(series, SERIES_KEY).filter(F.col("stat_time") < F.col("_late"))
        return facts.groupBy(*SERIES_KEY).agg(F.max("stat_time").alias("_before"))

    near = materialise(series.join(before(bounds["low"] - NEAR[concern.facts]), SERIES_KEY, "left"), "rewind-near")
    if near.filter("_before is null").limit(1).collect():
        near = near.drop("_before").join(before(None), SERIES_KEY, "left")
    return near.select(*SERIES_KEY, F.coalesce("_before", "_late").alias("_late"))


def rewind(estate: Estate, store: StatStore, late: DataFrame) -> int:
    """Set back what ``late(entity_id, key_id, ts)`` concerns; gives the number of watermarks that moved.

    Repeating it changes nothing. It must not run while a job runs.
    """
    late = materialise(late.select("entity_id", "key_id", "ts"), "rewind-late")
    if not late.limit(1).collect():
        return 0
    moved = 0
    for concern in CONCERNS:
        if concern.role == "average" and estate.avg_key_config is None:
            continue
        marks = store.read(concern.table)
        series = materialise(_late_series(estate, late, concern).join(marks.select(*SERIES_KEY), SERIES_KEY, "left_semi"), "rewind-series")
        series = _first_changed(store, series, concern)
        back = F.col("_late") + F.lit(WATERMARK_OFFSET[concern.grain])
        rows = (
            marks.join(series, SERIES_KEY)
            .filter(back < F.col("latest_stat_time"))
            .select(
                *SERIES_KEY,
                back.alias("latest_stat_time"),
                ts_to_epoch_ms(back).alias("latest_epoch"),
                F.least("first_stat_time", "_late").alias("first_stat_time"),
                F.greatest("redo_until", "latest_stat_time").alias("redo_until"),
                F.lit(None).cast("bigint").alias("carry_ms"),
                F.lit(None).cast("double").alias("carry_value"),
                "_late",
            )
        )
        rows = materialise(rows, "rewind-marks")
        n = rows.count()
        if not n:
            continue
        moved += n
        columns = [c for c in rows.columns if c not in (*SERIES_KEY, "_late")]
        store.upsert(concern.table, rows.drop("_late"), columns)
        if concern.table == "day_latest":
            _note_periods(store, rows)
    return moved


def _note_periods(store: StatStore, days: DataFrame) -> None:
    """The first month and year to redo of the series whose days go back."""
    for grain, table in (("month", "month_rewound"), ("year", "year_rewound")):
        period = calendar_bucket(F.col("_late"), grain)
        noted = store.read(table).select(*SERIES_KEY, F.col("latest_stat_time").alias("_noted"))
        rows = days.join(noted, SERIES_KEY, "left").select(*SERIES_KEY, F.least(period, "_noted").alias("latest_stat_time"))
        store.advance(table, materialise(rows.withColumn("latest_epoch", ts_to_epoch_ms(F.col("latest_stat_time"))), f"rewind-{grain}s"))


def late_arrivals(estate: Estate, store: StatStore) -> DataFrame | None:
    """``entity_id, key_id, ts``: per series the oldest reading in new loads that is behind a watermark.

    The loads' summaries tell; no telemetry is read. New are the loads that some job has not worked
    on; nothing is late where there are none, or no job has run. The rows are stored, as a rewind
    replaces the files of the watermarks that they are found by.
    """
    log = estate.arrivals
    newest, done = log.newest(), store.read("progress").agg(F.min("arrival")).first()[0]
    if newest is None or done is None or done >= newest:
        return None
    came = log.arrived(done, newest).select("entity_id", "key_id", epoch_ms_to_ts(F.col("first_ms")).alias("ts"))
    found = None
    for concern in CONCERNS:
        if concern.role == "average" and estate.avg_key_config is None:
            continue
        keys = _keys(estate, concern)
        devices = estate.device.select("device_id", "device_type", "entity_id")
        rows = came.join(devices, "entity_id").withColumnRenamed("key_id", "reading_key")
        rows = rows.join(keys, [c for c in ("device_type", "reading_key") if c in keys.columns])
        marks = store.read(concern.table).select(*SERIES_KEY, "latest_stat_time")
        behind = rows.join(marks, SERIES_KEY).filter(
            concern.bucket(F.col("ts")) < calendar_bucket(F.col("latest_stat_time"), concern.unit)
        )
        behind = behind.select("entity_id", F.col("reading_key").alias("key_id"), "ts")
        found = behind if found is None else found.unionByName(behind)
    return materialise(found.distinct(), "late-arrivals")


def run_arrived(estate: Estate, store: StatStore, as_of: datetime, schedule: list[tuple[str, str, dict]] | None = None) -> list[Run]:
    """Redo what new loads bring too late, and run the scheduled statistics over what they bring."""
    late = late_arrivals(estate, store)
    if late is not None:
        rewind(estate, store, late)
    runs = []
    for grain, measure, options in schedule if schedule is not None else [(g, m, {}) for g, m in GRAIN_JOBS]:
        runs += run_grain(estate, store, grain, measure, as_of, **options)
    return runs
