"""The statistics jobs: choose devices, compute from the watermark on, store, advance.

Each job computes all devices in one plan. Facts are stored before the watermark moves, so a
job that dies is simply run again.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterfold.functions.timebucket import (
    DAY_START,
    add_months,
    calendar_bucket,
    epoch_ms_to_ts,
    production_day,
    timestamp_literal,
    ts_to_epoch_ms,
)
from meterfold.operators import incremental, statistics
from meterfold.operators.incremental import WATERMARK_OFFSET
from meterfold.operators.series import TELEMETRY
from meterfold.operators.statistics import CONSUMED_ENERGY_KEY, ENERGY_KEY, TOU_COLUMNS
from meterfold.operators.tariff import tou_split
from meterfold.plans.due import LAGGING_SHARE, Due, due_facts, due_readings
from meterfold.session import materialise
from meterfold.sources.arrivals import ArrivalLog
from meterfold.sources.store import SEARCHED, StatStore
from meterfold.sources.telemetry import (
    ELECTRICITY,
    EXCLUDED_FACTORIES,
    OTHER_UTILITIES,
    STALE_AFTER,
    eligible_devices,
    stale_devices,
    telemetry_values,
)


@dataclass
class Estate:
    """Telemetry and the dimensions that describe it.

    With ``arrivals`` the jobs read telemetry from that log, by what has arrived since their last
    run; without it they read ``ts_kv``, by time alone.
    """

    ts_kv: DataFrame | None
    device: DataFrame
    key_config: DataFrame
    param: DataFrame
    key_dictionary: DataFrame | None = None
    avg_key_config: DataFrame | None = None
    device_keys: DataFrame | None = None
    electricity_rate: DataFrame | None = None
    energy_charge: DataFrame | None = None
    date_column: str | None = None
    arrivals: ArrivalLog | None = None
    exclude_factories: tuple[str, ...] = EXCLUDED_FACTORIES


@dataclass
class Run:
    """What a job stored, and how long it took."""

    job: str
    rows: int
    first_stat_time: datetime | None
    last_stat_time: datetime | None
    seconds: float


def _keys(estate: Estate, role: str) -> DataFrame:
    return estate.key_config.select("device_type", F.col(f"{role}_key_id").alias("key_id"))


def _floor(moment: datetime, grain: str) -> datetime:
    """Start of the bucket a watermark lies in; a production day's watermark is its midnight's."""
    start = moment.replace(second=0, microsecond=0)
    if grain == "minute":
        return start
    start = start.replace(minute=0)
    if grain == "hour":
        return start
    start = start.replace(hour=0)
    return {"day": start, "month": start.replace(day=1), "year": start.replace(month=1, day=1)}[grain]


def _values(estate: Estate, start: datetime | None, end: datetime | None = None) -> DataFrame:
    return telemetry_values(estate.ts_kv, start, end, estate.date_column)


def _only(df: DataFrame, column: str, chosen: DataFrame) -> DataFrame:
    """Rows of the chosen ids. The ids are few next to the rows; Spark sees their size and picks the join."""
    return df.join(chosen, column, "left_semi")


def _from_watermarks(
    series: DataFrame,
    latest: DataFrame,
    searched: DataFrame | None,
    grain: str,
    load: Callable[[datetime | None, datetime | None], DataFrame],
    id_column: str,
    shift: timedelta = timedelta(0),
    unseen_since: datetime | None = None,
) -> DataFrame:
    """What ``load`` gives from the watermarks of ``series`` on, in bands, so that few files are opened.

    The fleet is read from the watermark that all but a few series have passed. Older files are
    read for the series behind it alone, from the oldest of those on, and for a series without a
    watermark from its beginning (or ``unseen_since``) or from where ``searched`` says that there is
    nothing of it before. So a dead or a silent meter costs its own readings, not a scan
    of everybody's. ``series`` holds ``device_id, device_type, key_id`` and ``id_column``.
    """
    marks = latest.select(*incremental.SERIES_KEY, F.col("latest_stat_time").alias("_mark"))
    if searched is not None:
        looked = searched.select(*incremental.SERIES_KEY, F.col("latest_stat_time").alias("_looked"))
        marks = marks.join(looked, incremental.SERIES_KEY, "full_outer").select(
            *incremental.SERIES_KEY, F.coalesce("_mark", "_looked").alias("_mark")
        )
    known = materialise(series.join(marks, incremental.SERIES_KEY, "left"), "job-series")
    row = known.agg(
        F.percentile_approx("_mark", LAGGING_SHARE).alias("fleet"),
        F.min("_mark").alias("oldest"),
        F.count_if(F.col("_mark").isNull()).alias("unseen"),
    ).first()
    if row["fleet"] is None:
        return load(unseen_since, None)
    start, oldest = _floor(row["fleet"], grain) + shift, _floor(row["oldest"], grain) + shift
    found = load(start, None)
    if oldest < start:
        behind = known.filter(F.col("_mark") < timestamp_literal(start - shift)).select(id_column).distinct()
        found = found.unionByName(_only(load(oldest, start), id_column, behind))
    if row["unseen"] and (unseen_since is None or unseen_since < start):
        # the band of those behind may hold some of their rows already: take the others only
        seen = known.groupBy(id_column).agg(F.min("_mark").alias("_mark"), F.count_if(F.col("_mark").isNull()).alias("_new"))
        fresh = seen.filter("_new > 0")
        before = F.col("_mark").isNull() | (F.col("_mark") >= timestamp_literal(start - shift)) if oldest < start else F.lit(True)
        whole = fresh.filter(before).select(id_column)
        found = found.unionByName(_only(load(unseen_since, start), id_column, whole))
        if oldest < start and (unseen_since is None or unseen_since < oldest):
            rest = fresh.filter(~before).select(id_column)
            found = found.unionByName(_only(load(unseen_since, oldest), id_column, rest))
    return found


def _series(devices: DataFrame, keys: DataFrame) -> DataFrame:
    return devices.select("device_id", "device_type", "entity_id").join(keys, "device_type")


def _read_series(estate: Estate, devices: DataFrame, role: str) -> DataFrame:
    """The devices' watermark keys in a role, and under ``reading_key`` the key their readings carry."""
    reading = "accumulation" if role == "consumption" else role
    keys = estate.key_config.select(
        "device_type", F.col(f"{role}_key_id").alias("key_id"), F.col(f"{reading}_key_id").alias("reading_key")
    )
    return _series(devices, keys)


def _telemetry(
    estate: Estate, store: StatStore, job: str, devices: DataFrame, role: str, table: str, grain: str, shift=timedelta(0)
) -> Due:
    """Readings from the watermarks on."""
    series = _read_series(estate, devices, role)
    if estate.arrivals is not None:
        return due_readings(estate.arrivals, store, job, table, series, grain, shift)
    latest = store.read(table)
    values = _from_watermarks(
        series.drop("reading_key"),
        latest,
        _still_silent(estate, series, latest, store.read(SEARCHED[table]), grain, shift),
        grain,
        lambda a, b: _values(estate, a, b),
        "entity_id",
        shift,
    )
    return Due(values, None, [lambda: _mark_searched(store, table, series, values)])


def _moved(devices: DataFrame, due: Due) -> DataFrame:
    """The devices whose facts are there from their watermark on."""
    return devices.join(due.series.select("device_id"), "device_id", "left_semi")


def _due(devices: DataFrame, due: Due) -> DataFrame:
    """The devices whose readings are there from their watermark on; others must not be derived from a part."""
    return devices if due.series is None else devices.join(due.series.select("entity_id"), "entity_id", "left_semi")


def _still_silent(
    estate: Estate, series: DataFrame, latest: DataFrame, searched: DataFrame, grain: str, shift: timedelta
) -> DataFrame:
    """The marks of ``searched`` before which their series have no reading even now.

    A meter may report for the first time with a backlog, which is older than how far it was searched
    for. Its mark is left out then, so that it is read from its beginning. Telemetry does not tell when
    a reading arrived, so the first reading of each key before the marks is looked up; nothing is read
    where no series of this job has only such a mark.
    """
    begin = (calendar_bucket(F.col("latest_stat_time"), grain) + F.lit(shift)).alias("_begin")
    marks = searched.join(latest.select(*incremental.SERIES_KEY), incremental.SERIES_KEY, "left_anti")
    marks = materialise(marks.select(*incremental.SERIES_KEY, begin).join(series, incremental.SERIES_KEY), "job-searched")
    until = marks.agg(F.max("_begin").alias("t")).first()["t"]
    if until is None:
        return searched
    values = _values(estate, None, until).join(marks.select("entity_id"), "entity_id", "left_semi")
    begins = values.groupBy("entity_id", F.col("key_id").alias("reading_key")).agg(F.min("ts").alias("_first"))
    back = marks.join(begins, ["entity_id", "reading_key"]).filter(F.col("_first") < F.col("_begin"))
    return searched.join(back.select(*incremental.SERIES_KEY), incremental.SERIES_KEY, "left_anti")


def _mark_searched(store: StatStore, table: str, series: DataFrame, values: DataFrame) -> None:
    """Note for the series without a watermark and without any reading how far the telemetry was searched.

    ``series`` has the counter's or rate's key as ``reading_key``. Nothing is read where every
    series has a watermark.
    """
    marks = store.read(table).select(*incremental.SERIES_KEY)
    unseen = materialise(series.join(marks, incremental.SERIES_KEY, "left_anti").distinct(), "job-unseen")
    if not unseen.limit(1).collect():
        return
    present = materialise(values.groupBy("entity_id", "key_id").agg(F.max("ts").alias("t")), "job-present")
    until = present.agg(F.max("t").alias("t")).first()["t"]
    if until is None:
        return
    found = present.select("entity_id", F.col("key_id").alias("reading_key"))
    silent = unseen.join(found, ["entity_id", "reading_key"], "left_anti").select(*incremental.SERIES_KEY)
    # a day earlier, as the newest buckets are still open
    mark = timestamp_literal(until.replace(minute=0, second=0, microsecond=0) - timedelta(days=1))
    rows = silent.withColumn("latest_stat_time", mark).withColumn("latest_epoch", ts_to_epoch_ms(F.col("latest_stat_time")))
    store.advance(SEARCHED[table], rows)


def _facts(
    store: StatStore, job: str, source: str, source_marks: str, estate: Estate, devices: DataFrame, table: str, grain: str, shift=timedelta(0)
) -> Due:
    series = _series(devices, _keys(estate, "consumption"))
    return due_facts(store, job, source, source_marks, table, series, grain, shift)


def _counter_since_marks(estate: Estate, store: StatStore, devices: DataFrame, waiting: DataFrame | None) -> Due:
    """Electricity counters of the due meters from the watermarks on, each with the reading before.

    That reading is kept with the watermark. Of a meter whose watermark was rewound it is looked up
    on the date of the last fact before, which is where it lies; of one whose watermark was set from
    outside, and has no facts, on the dates since its first reading.
    """
    log, begin = estate.arrivals, F.col("begin")

    def meters(chosen: DataFrame) -> DataFrame:
        keys = {"key_id": F.lit(ENERGY_KEY), "reading_key": F.lit(ENERGY_KEY)}
        return chosen.select("device_id", "device_type", "entity_id").withColumns(keys)

    held = None if waiting is None else meters(waiting)
    found = due_readings(log, store, "minute_electricity", "minute_latest", meters(devices), "minute", held=held)
    found.rows = found.rows.filter(F.col("key_id") == ENERGY_KEY)
    if found.series is None:
        return found
    marks = store.read("minute_latest").filter(F.col("key_id") == ENERGY_KEY).drop("key_id")
    due = found.series.filter(~F.col("new")).join(devices.select("device_id", "device_type", "entity_id"), "entity_id")
    due = materialise(due.join(marks, ["device_id", "device_type"]), "job-meters")
    at = epoch_ms_to_ts(F.col("carry_ms"))
    carried = due.filter((F.col("carry_ms") >= 0) & (at < begin)).select(
        "entity_id", F.lit(ENERGY_KEY).alias("key_id"), F.col("carry_ms").alias("ts_ms"), at.alias("ts"), F.col("carry_value").alias("value")
    )
    needy = due.filter(F.col("carry_ms").isNull()).select("entity_id", "device_id", "device_type", "begin")
    latest = needy.agg(F.max("begin")).first()[0]
    if latest is not None:
        facts = store.read("minutely", before=latest + timedelta(days=1)).filter(F.col("key_id") == CONSUMED_ENERGY_KEY)
        facts = facts.join(needy, ["device_id", "device_type"]).filter(F.col("stat_time") < begin)
        last = facts.groupBy("entity_id").agg(F.max("stat_time").alias("t"))
        newest = log.newest()
        first = log.seen(newest).filter(F.col("key_id") == ENERGY_KEY).select("entity_id", epoch_ms_to_ts(F.col("first_ms")).alias("f"))
        # without a fact before, nothing says where in between it is
        days = F.when(F.col("t").isNotNull(), F.array(F.to_date("t"))).otherwise(F.sequence(F.to_date("f"), F.to_date("begin")))
        spans = needy.join(last, "entity_id", "left").join(first, "entity_id").filter("f < begin").select(F.explode(days).alias("d"))
        dates = sorted(r["d"] for r in spans.distinct().collect())
        older = log.values(newest, end=latest, dates=dates).filter(F.col("key_id") == ENERGY_KEY)
        older = older.join(needy.select("entity_id", "begin"), "entity_id").filter(F.col("ts") < begin)
        before = older.groupBy("entity_id", "key_id").agg(
            F.max("ts_ms").alias("ts_ms"), F.max("ts").alias("ts"), F.max_by("value", "ts_ms").alias("value")
        )
        carried = carried.unionByName(before)
    found.rows = found.rows.unionByName(carried.select(*found.rows.columns))
    return found


def _carried(values: DataFrame, devices: DataFrame, marks: DataFrame) -> DataFrame:
    """Add to ``marks`` each meter's last reading before the minute its watermark lies in."""
    minute = F.date_trunc("minute", "latest_stat_time").cast("timestamp_ntz")
    bounds = marks.join(devices.select("device_id", "device_type", "entity_id"), ["device_id", "device_type"])
    earlier = values.join(bounds.select("entity_id", "device_id", "device_type", minute.alias("_bound")), "entity_id")
    last = (
        earlier.filter(F.col("ts") < F.col("_bound"))
        .groupBy("device_id", "device_type")
        .agg(F.max("ts_ms").alias("carry_ms"), F.max_by("value", "ts_ms").alias("carry_value"))
    )
    return marks.join(last, ["device_id", "device_type"], "left").withColumn("carry_ms", F.coalesce("carry_ms", F.lit(-1)))


def _counter_with_baseline(estate: Estate, devices: DataFrame, latest: DataFrame) -> DataFrame:
    """Electricity counters from the watermarks on, and each one's last reading before its own.

    Most meters have that reading within the month before the fleet's watermark. Older files are
    searched only for those that were silent longer, that lag behind, or that have no watermark.
    """

    def load(start: datetime | None, end: datetime | None) -> DataFrame:
        return _values(estate, start, end).filter(F.col("key_id") == ENERGY_KEY)

    marked = materialise(
        devices.select("device_id", "device_type", "entity_id")
        .join(latest.filter(F.col("key_id") == ENERGY_KEY), ["device_id", "device_type"], "left")
        .groupBy("entity_id")
        .agg(F.min(F.date_trunc("minute", "latest_stat_time").cast("timestamp_ntz")).alias("bound")),
        "job-meters",
    )
    fleet = marked.agg(F.percentile_approx("bound", LAGGING_SHARE).alias("m")).first()["m"]
    if fleet is None:
        return load(None, None)
    horizon = add_months(fleet, -1)
    recent = load(horizon, None)
    begins = recent.groupBy("entity_id").agg(F.min("ts").alias("first_ts"))
    # without a reading before its own bound among the recent ones
    needy = materialise(
        marked.join(begins, "entity_id", "left")
        .filter(F.col("bound").isNull() | F.col("first_ts").isNull() | (F.col("first_ts") >= F.col("bound")))
        .select("entity_id", "bound"),
        "job-baselines",
    )
    older = load(None, horizon).join(needy, "entity_id")
    after = F.col("bound").isNull() | (F.col("ts") >= F.col("bound"))
    last = (
        older.filter(~after)
        .groupBy("entity_id", "key_id")
        .agg(F.max("ts_ms").alias("ts_ms"), F.max("ts").alias("ts"), F.max_by("value", "ts_ms").alias("value"))
    )
    return recent.unionByName(last.select(recent.columns)).unionByName(older.filter(after).select(recent.columns))


def _finish(job: str, began: float, metrics: dict) -> Run:
    return Run(
        job,
        metrics.get("rows", 0),
        metrics.get("first_stat_time"),
        metrics.get("last_stat_time"),
        time.monotonic() - began,
    )


def _eligible(estate: Estate, **choice) -> DataFrame:
    return eligible_devices(estate.device, exclude_factories=estate.exclude_factories, **choice)


def minute_electricity(
    estate: Estate,
    store: StatStore,
    as_of: datetime,
    stale_after: timedelta | None = STALE_AFTER,
    param_name: str = statistics.ELECTRICITY_COEFFICIENT,
) -> Run:
    """Minute electricity of the devices whose watermark is older than ``stale_after``.

    A device without a watermark is not due. ``stale_after=None`` takes every device.
    """
    began, store = time.monotonic(), store.owned_by("electricity")
    meters, waiting = _eligible(estate, types=ELECTRICITY), None
    devices, latest = meters, store.read("minute_latest")
    if stale_after is not None:
        devices = stale_devices(meters, latest, ENERGY_KEY, as_of, stale_after).drop("latest_stat_time")
        if estate.arrivals is not None:
            # who is due is settled before the watermarks move
            devices = materialise(devices, "job-due")
            waiting = meters.join(devices.select("device_id"), "device_id", "left_anti")
    if estate.arrivals is not None:
        due = _counter_since_marks(estate, store, devices, waiting)
    else:
        due = Due(_counter_with_baseline(estate, devices, latest))
    facts = statistics.minute_electricity(due.rows, _due(devices, due), estate.param, latest, TELEMETRY, param_name)
    stored, metrics = store.upsert("minutely", facts, ["dbl_stats", "kgco2e"])
    offset = WATERMARK_OFFSET["minute_electricity"]
    marks = incremental.marks_of(stored.withColumn("key_id", F.lit(ENERGY_KEY)), offset)
    if estate.arrivals is not None:
        marks = materialise(_carried(due.rows, devices, marks), "job-marks")
    store.advance("minute_latest", marks)
    due.done()
    return _finish("minute_electricity", began, metrics)


def _run(
    job: str,
    store: StatStore,
    table: str,
    facts: DataFrame,
    columns: list[str],
    latest_table: str | None,
    offset: timedelta | None,
    write: Callable | None = None,
    due: Due | None = None,
) -> Run:
    """Store facts, then the watermarks, then what the job has looked at."""
    began = time.monotonic()
    stored, metrics = (write or store.upsert)(table, facts, columns)
    if latest_table is not None:
        store.advance(latest_table, incremental.marks_of(stored, offset))
    if due is not None:
        due.done()
    return _finish(job, began, metrics)


def minute_other(estate: Estate, store: StatStore, as_of: datetime) -> Run:
    store = store.owned_by("other")
    devices, latest = _eligible(estate, exclude_types=ELECTRICITY), store.read("minute_latest")
    due = _telemetry(estate, store, "minute_other", devices, "consumption", "minute_latest", "minute")
    facts = statistics.minute_other(due.rows, _due(devices, due), estate.key_config, estate.param, latest, TELEMETRY)
    columns = ["dbl_stats", "kgco2e"]
    return _run("minute_other", store, "minutely", facts, columns, "minute_latest", WATERMARK_OFFSET["minute"], None, due)


def hour_electricity(estate: Estate, store: StatStore, as_of: datetime) -> Run:
    store = store.owned_by("electricity")
    devices, latest = _eligible(estate, types=ELECTRICITY), store.read("hour_latest")
    due = _telemetry(estate, store, "hour_electricity", devices, "consumption", "hour_latest", "hour")
    facts = statistics.hour_electricity(
        due.rows,
        _due(devices, due),
        estate.key_config,
        estate.param,
        estate.electricity_rate,
        estate.energy_charge,
        latest,
        TELEMETRY,
    )
    columns = ["dbl_stats", "charge", "period_type", "kgco2e"]
    return _run("hour_electricity", store, "hourly", facts, columns, "hour_latest", WATERMARK_OFFSET["hour"], None, due)


def hour_other(estate: Estate, store: StatStore, as_of: datetime) -> Run:
    store = store.owned_by("other")
    devices, latest = _eligible(estate, exclude_types=ELECTRICITY), store.read("hour_latest")
    due = _facts(store, "hour_other", "minutely", "minute_latest", estate, devices, "hour_latest", "hour")
    facts = statistics.hour_other(due.rows, _moved(devices, due), estate.key_config, latest)
    columns = ["dbl_stats", "dbl_avg", "dbl_min", "dbl_max", "kgco2e"]
    return _run("hour_other", store, "hourly", facts, columns, "hour_latest", WATERMARK_OFFSET["hour"], None, due)


def hour_rate_other(estate: Estate, store: StatStore, as_of: datetime) -> Run:
    store = store.owned_by("other_rate")
    devices, latest = _eligible(estate, exclude_types=ELECTRICITY), store.read("hour_latest")
    due = _telemetry(estate, store, "hour_rate_other", devices, "rate", "hour_latest", "hour")
    facts = statistics.hour_rate_other(due.rows, _due(devices, due), estate.key_config, latest, TELEMETRY)
    return _run("hour_rate_other", store, "hourly", facts, ["dbl_stats"], "hour_latest", WATERMARK_OFFSET["hour"], None, due)


def day_profile(estate: Estate, store: StatStore, as_of: datetime) -> Run:
    """The day's average and extremes; its watermark is advanced by :func:`day_consumption`."""
    store = store.owned_by("consumption")
    devices, latest = _eligible(estate), store.read("day_latest")
    due = _facts(store, "day_profile", "hourly", "hour_latest", estate, devices, "day_latest", "day", DAY_START)
    facts = statistics.day_profile(due.rows, _moved(devices, due), estate.key_config, latest)
    columns = ["dbl_avg", "dbl_min", "dbl_max", "long_stats", "long_avg", "long_min", "long_max"]
    return _run("day_profile", store, "daily", facts, columns, None, None, None, due)


def day_consumption(estate: Estate, store: StatStore, as_of: datetime) -> Run:
    store = store.owned_by("consumption")
    devices, latest = _eligible(estate), store.read("day_latest")
    due = _telemetry(estate, store, "day_consumption", devices, "consumption", "day_latest", "day", DAY_START)
    facts = statistics.day_consumption(
        due.rows, _due(devices, due), estate.key_config, estate.param, latest, TELEMETRY
    )
    columns, offset = ["dbl_stats", "kgco2e"], WATERMARK_OFFSET["day"]
    return _run("day_consumption", store, "daily", facts, columns, "day_latest", offset, store.update_only, due)


def day_tou(estate: Estate, store: StatStore, as_of: datetime, since: datetime | None = None) -> Run:
    """Peak, partial and off-peak shares of the production days since the last run, or from ``since`` on.

    The job has watermarks of its own, as it may run at other times than the day's consumption.
    """
    store = store.owned_by("consumption")
    latest, due = store.read("tou_latest"), None
    if since is not None:
        hours = store.read("hourly", since).filter(F.col("key_id") == CONSUMED_ENERGY_KEY)
        hours = hours.filter(production_day(F.col("stat_time")) >= timestamp_literal(since))
    else:
        meters = _series(_eligible(estate, types=ELECTRICITY), _keys(estate, "consumption"))
        meters = meters.filter(F.col("key_id") == CONSUMED_ENERGY_KEY)
        due = due_facts(store, "day_tou", "hourly", "hour_latest", "tou_latest", meters, "day", DAY_START)
        hours = due.rows.filter(F.col("key_id") == CONSUMED_ENERGY_KEY)
        hours = hours.join(due.series.select(*incremental.SERIES_KEY), incremental.SERIES_KEY, "left_semi")
        hours = incremental.since_watermark(hours, latest, "stat_time", strict=True)
    shares, offset = tou_split(hours), WATERMARK_OFFSET["day"]
    return _run("day_tou", store, "daily", shares, TOU_COLUMNS, "tou_latest", offset, store.update_only, due)


def day_rate(
    estate: Estate, store: StatStore, as_of: datetime, default_start: datetime = statistics.MEASURES_SINCE
) -> Run:
    store = store.owned_by("measures")
    devices, latest = _eligible(estate), store.read("day_latest")
    due = _measures(estate, store, devices, latest, default_start)
    facts = statistics.day_rate(
        due.rows,
        _due(devices, due),
        estate.avg_key_config,
        estate.key_dictionary,
        latest,
        TELEMETRY,
        default_start=default_start,
    )
    columns = ["dbl_stats", "dbl_min", "dbl_max"]
    return _run("day_rate", store, "daily", facts, columns, "day_latest", WATERMARK_OFFSET["day"], None, due)


def _measures(estate: Estate, store: StatStore, devices: DataFrame, latest: DataFrame, default_start: datetime) -> Due:
    """Instantaneous values from each average's watermark on; from the default for one that has none."""
    names = statistics.ELECTRICITY_MEASURES + statistics.FLOW_RATES
    if estate.arrivals is not None:
        named = estate.key_dictionary.filter(F.col("key").isin(*names)).select(F.col("key_id").alias("rate_key_id"))
        # a configuration table: a handful of rows
        keys = estate.avg_key_config.join(named, "rate_key_id").select("avg_key_id", "rate_key_id").collect()
        pairs = F.array(*[F.struct(F.lit(k["avg_key_id"]).alias("key_id"), F.lit(k["rate_key_id"]).alias("reading_key")) for k in keys])
        series = devices.select("device_id", "device_type", "entity_id", F.explode(pairs).alias("_keys")).select(
            "device_id", "device_type", "entity_id", "_keys.*"
        )
        due = due_readings(
            estate.arrivals, store, "day_rate", "day_latest", series, "day", DAY_START, unseen_since=default_start
        )
        if due.series is not None:
            # a device may have one average due and another not: only due ones are derived
            due.rows = due.rows.join(due.series.select("entity_id", "key_id"), ["entity_id", "key_id"], "left_semi")
        return due
    averages = latest.join(estate.avg_key_config.select(F.col("avg_key_id").alias("key_id")), "key_id", "left_semi")
    oldest = averages.groupBy("device_id", "device_type").agg(F.min("latest_stat_time").alias("latest_stat_time"))
    every = F.lit(0).alias("key_id")
    values = _from_watermarks(
        devices.select("device_id", "device_type", "entity_id", every),
        oldest.select("device_id", "device_type", every, "latest_stat_time"),
        None,
        "day",
        lambda a, b: _values(estate, a, b),
        "entity_id",
        DAY_START,
        unseen_since=default_start,
    )
    return Due(values)


def day_rate_other(estate: Estate, store: StatStore, as_of: datetime) -> Run:
    store = store.owned_by("other_rate")
    devices, latest = _eligible(estate, exclude_types=ELECTRICITY), store.read("day_latest")
    due = _telemetry(estate, store, "day_rate_other", devices, "rate", "day_latest", "day")
    facts = statistics.day_rate_other(due.rows, _due(devices, due), estate.key_config, latest, TELEMETRY)
    offset = WATERMARK_OFFSET["calendar_day"]
    return _run("day_rate_other", store, "daily", facts, ["dbl_stats"], "day_latest", offset, None, due)


def _of_devices(facts: DataFrame, devices: DataFrame) -> DataFrame:
    return facts.join(devices.select("device_id"), "device_id", "left_semi")


def _rolled_keys(estate: Estate) -> DataFrame:
    names = (*statistics.FLOW_RATES, *statistics.CONSUMED_VOLUMES)
    return estate.key_dictionary.filter(F.col("key").isin(*names)).select("key_id")


REWOUND = {"monthly": "month_rewound", "yearly": "year_rewound"}


def _rewound(store: StatStore, target: str, devices: DataFrame) -> DataFrame:
    """From which stored period on the devices' series have to be redone."""
    back = store.read(REWOUND[target]).filter("latest_stat_time is not null")
    return materialise(back.join(devices.select("device_id"), "device_id", "left_semi"), f"job-{REWOUND[target]}")


def _redone(store: StatStore, target: str, rewound: DataFrame) -> None:
    """Take back what :func:`_rewound` gave, once it is stored."""
    if rewound.limit(1).collect():
        none = {"latest_stat_time": F.lit(None).cast("timestamp_ntz"), "latest_epoch": F.lit(None).cast("bigint")}
        store.advance(REWOUND[target], rewound.withColumns(none))


def _open_periods(
    store: StatStore, source: str, target: str, devices: DataFrame, keys: DataFrame, rewound: DataFrame
) -> DataFrame:
    """Facts of the periods that may still be missing or open, or are to be redone, by device.

    The fleet is read from its newest stored period on; devices behind it, or with one of ``keys``
    that is not stored yet, from the beginning.
    """
    stored = store.read(target).select(*incremental.SERIES_KEY, "stat_time")
    stored = stored.groupBy(*incremental.SERIES_KEY).agg(F.max("stat_time").alias("latest_stat_time"))
    back = rewound.select(*incremental.SERIES_KEY, F.col("latest_stat_time").alias("_back"))
    stored = stored.join(back, incremental.SERIES_KEY, "left").withColumn("latest_stat_time", F.least("latest_stat_time", "_back")).drop("_back")
    rolled = store.read("day_latest").select(*incremental.SERIES_KEY).join(keys.select("key_id"), "key_id", "left_semi")
    series = rolled.distinct().join(devices.select("device_id"), "device_id", "left_semi")
    grain = {"monthly": "month", "yearly": "year"}[target]
    return _from_watermarks(series, stored, None, grain, lambda a, b: store.read(source, a, b), "device_id")


def month_electricity(estate: Estate, store: StatStore, as_of: datetime, refresh_open: bool = False) -> Run:
    """Months after the newest one stored; ``refresh_open`` redoes that one as well."""
    store = store.owned_by("electricity")
    devices = _eligible(estate, types=ELECTRICITY)
    rewound = _rewound(store, "monthly", devices)
    daily = _of_devices(_open_periods(store, "daily", "monthly", devices, estate.device_keys, rewound), devices)
    months = statistics.period_electricity(daily, estate.device_keys, "month").drop("long_stats")
    facts = incremental.beyond_high_water(months, store.read("monthly"), "month", refresh_open, rewound=rewound)
    redo = Due(facts, None, [lambda: _redone(store, "monthly", rewound)])
    if refresh_open or rewound.limit(1).collect():
        return _run("month_electricity", store, "monthly", facts, ["dbl_stats", *TOU_COLUMNS, "kgco2e"], None, None, None, redo)

    def insert(table: str, rows: DataFrame, columns: list[str]):
        return store.insert_only(table, rows)

    return _run("month_electricity", store, "monthly", facts, [], None, None, insert)


def month_other(estate: Estate, store: StatStore, as_of: datetime, refresh_open: bool = False) -> Run:
    devices = eligible_devices(estate.device, types=OTHER_UTILITIES, exclude_factories=())
    store = store.owned_by("other")
    rewound = _rewound(store, "monthly", devices)
    daily = _of_devices(_open_periods(store, "daily", "monthly", devices, _rolled_keys(estate), rewound), devices)
    months = statistics.period_other(daily, estate.key_dictionary, "month")
    facts = incremental.beyond_high_water(months, store.read("monthly"), "month", refresh_open, rewound=rewound)
    redo = Due(facts, None, [lambda: _redone(store, "monthly", rewound)])
    return _run("month_other", store, "monthly", facts, ["long_stats", "dbl_stats", "kgco2e"], None, None, None, redo)


def year_electricity(estate: Estate, store: StatStore, as_of: datetime, refresh_open: bool = False) -> Run:
    devices = eligible_devices(estate.device, types=ELECTRICITY, exclude_factories=())
    store = store.owned_by("electricity")
    rewound = _rewound(store, "yearly", devices)
    monthly = _of_devices(_open_periods(store, "monthly", "yearly", devices, estate.device_keys, rewound), devices)
    years = statistics.period_electricity(monthly, estate.device_keys, "year")
    facts = incremental.beyond_high_water(years, store.read("yearly"), "year", refresh_open, rewound=rewound)
    columns = ["long_stats", "dbl_stats", *TOU_COLUMNS, "kgco2e"]
    redo = Due(facts, None, [lambda: _redone(store, "yearly", rewound)])
    return _run("year_electricity", store, "yearly", facts, columns, None, None, None, redo)


def year_other(estate: Estate, store: StatStore, as_of: datetime, refresh_open: bool = False) -> Run:
    devices = eligible_devices(estate.device, types=OTHER_UTILITIES, exclude_factories=())
    store = store.owned_by("other")
    rewound = _rewound(store, "yearly", devices)
    monthly = _of_devices(_open_periods(store, "monthly", "yearly", devices, _rolled_keys(estate), rewound), devices)
    years = statistics.period_other(monthly, estate.key_dictionary, "year")
    facts = incremental.beyond_high_water(years, store.read("yearly"), "year", refresh_open, rewound=rewound)
    redo = Due(facts, None, [lambda: _redone(store, "yearly", rewound)])
    return _run("year_other", store, "yearly", facts, ["long_stats", "dbl_stats", "kgco2e"], None, None, None, redo)


# The jobs of each scheduled run, in order: a day's profile comes before its consumption.
GRAIN_JOBS: dict[tuple[str, str], tuple[Callable[..., Run], ...]] = {
    ("minute", "electricity"): (minute_electricity,),
    ("minute", "other"): (minute_other,),
    ("hour", "electricity"): (hour_electricity,),
    ("hour", "other"): (hour_other,),
    ("hour", "other_rate"): (hour_rate_other,),
    ("day", "consumption"): (day_profile, day_consumption),
    ("day", "tou"): (day_tou,),
    ("day", "rate"): (day_rate,),
    ("day", "other_rate"): (day_rate_other,),
    ("month", "electricity"): (month_electricity,),
    ("month", "other"): (month_other,),
    ("year", "electricity"): (year_electricity,),
    ("year", "other"): (year_other,),
}


def run_grain(estate: Estate, store: StatStore, grain: str, measure: str, as_of: datetime, **options) -> list[Run]:
    """Run one scheduled statistic for all its devices."""
    return [job(estate, store, as_of, **options) for job in GRAIN_JOBS[grain, measure]]
