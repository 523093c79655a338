"""What a job has to read: the series with anything new, and the files that hold it.

A series is due if a load since the job's last run brought readings of it, if its watermark was
rewound, or if the job never looked at it. Others, dead or silent, are not read at all. The due
ones are read in bands: the fleet from the watermark that all but a few have passed, a series behind
it from the dates of its own open or rewound buckets and from the new loads, and a series without
watermark from its first reading and its first load.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterfold.functions.timebucket import calendar_bucket, epoch_ms_to_ts, timestamp_literal
from meterfold.operators.incremental import SERIES_KEY
from meterfold.session import materialise
from meterfold.sources.arrivals import ArrivalLog
from meterfold.sources.store import StatStore

# Scans for the fleet start at the watermark that this share of the series has not reached.
LAGGING_SHARE = 0.05

# Up to so many series their ids are part of the scan's filter, which skips row groups; more are joined.
LISTED_SERIES = 200

READING = ["entity_id", "key_id"]

_FOREVER = datetime(9000, 1, 1)


@dataclass
class Due:
    """The readings or facts a job works on, and what it notes once they are stored."""

    rows: DataFrame
    series: DataFrame | None = None
    notes: list[Callable[[], None]] = field(default_factory=list)

    def done(self) -> None:
        for note in self.notes:
            note()


def _bucket(mark: Column, grain: str, shift: timedelta) -> Column:
    return calendar_bucket(mark, grain) + F.lit(shift)


def _dates(spans: DataFrame, first: str, last: str) -> list[date]:
    """The distinct dates that spans of time touch: as many as the calendar has, whatever the series."""
    days = spans.select(F.explode(F.sequence(F.to_date(first), F.to_date(last))).alias("d")).distinct()
    return sorted(r["d"] for r in days.collect())


def of_series(rows: DataFrame, series: DataFrame, columns: list[str], few: list[tuple] | None) -> DataFrame:
    """Rows of some series: the ids of a few are also pushed into the scan."""
    if few is not None:
        rows = rows.filter(F.col(columns[0]).isin([f[0] for f in few]))
    return rows.join(series, columns)


def _few(series: DataFrame, column: str) -> list[tuple] | None:
    ids = series.select(column).distinct().limit(LISTED_SERIES + 1).collect()
    return [tuple(r) for r in ids] if len(ids) <= LISTED_SERIES else None


def due_readings(
    log: ArrivalLog,
    store: StatStore,
    job: str,
    table: str,
    series: DataFrame,
    grain: str,
    shift: timedelta = timedelta(0),
    unseen_since: datetime | None = None,
    held: DataFrame | None = None,
) -> Due:
    """Readings that a job needs of ``series(device_id, device_type, key_id, entity_id, reading_key)``.

    ``table`` holds the watermarks under ``key_id``; the readings come under ``reading_key``. Series
    in ``held`` sit this run out: what has come for them is left for the next one. The result's
    ``series`` are ``entity_id, key_id, begin, until, new``; without it every series is due.
    """
    newest, before = log.newest(), store.progress(job)
    if newest is None:
        return Due(log.values(-1))

    def of_job() -> DataFrame:
        return store.read("sources").filter(F.col("job") == job).select(*SERIES_KEY)

    def note_looked_at() -> None:
        looked = series.select(*SERIES_KEY).distinct().join(of_job(), SERIES_KEY, "left_anti")
        if looked.limit(1).collect():
            store.merge_small("sources", looked.withColumns({"job": F.lit(job), "latest_epoch": F.lit(newest)}), ["latest_epoch"])

    def note_held() -> None:
        came = log.arrived(-1 if before is None else before, newest).withColumnRenamed("key_id", "reading_key")
        marks = store.read(table).select(*SERIES_KEY, "latest_stat_time", "redo_until")
        rows = held.join(marks, SERIES_KEY).join(came, ["entity_id", "reading_key"])
        until = F.greatest("latest_stat_time", "redo_until", epoch_ms_to_ts(F.col("last_ms")))
        store.advance(table, rows.groupBy(*SERIES_KEY).agg(F.max(until).alias("redo_until")))

    notes = [note_looked_at, *([note_held] if held is not None else []), lambda: store.set_progress(job, newest)]
    if before is None:
        return Due(log.values(newest, unseen_since), None, notes)
    marks = store.read(table).select(*SERIES_KEY, F.col("latest_stat_time").alias("_mark"), "redo_until")
    length = F.expr(f"INTERVAL 1 {grain.upper()}")
    fresh = log.arrived(before, newest).select("entity_id", F.col("key_id").alias("reading_key"), F.lit(True).alias("_fresh"))
    looked = of_job().withColumn("_looked", F.lit(True))
    known = series.join(marks, SERIES_KEY, "left")
    judged = known.join(fresh, ["entity_id", "reading_key"], "left").join(looked, SERIES_KEY, "left")
    new, unknown = F.col("_mark").isNull(), F.col("_looked").isNull()
    begin = _bucket(F.col("_mark"), grain, shift)
    # one that was never looked at may have readings anywhere after its mark
    until = F.when(unknown, timestamp_literal(_FOREVER)).otherwise(F.coalesce(_bucket(F.col("redo_until"), grain, shift), begin) + length)
    due = materialise(
        judged.filter(F.col("_fresh").isNotNull() | F.col("redo_until").isNotNull() | unknown)
        .groupBy("entity_id", F.col("reading_key").alias("key_id"))
        .agg(F.min(begin).alias("begin"), F.max(until).alias("until"), F.max(new).alias("new")),
        "due-series",
    )
    row = due.agg(
        F.percentile_approx(F.when(~F.col("new"), F.col("begin")), LAGGING_SHARE).alias("fleet"),
        F.min(F.when(~F.col("new"), F.col("begin"))).alias("oldest"),
        F.count_if("new").alias("new"),
        F.count("*").alias("n"),
    ).first()
    if not row["n"]:
        return Due(log.values(-1), due, notes)
    start = row["fleet"]
    parts = [log.values(newest, start)] if start is not None else []
    if start is not None and row["oldest"] < start:
        behind = due.filter(~F.col("new") & (F.col("begin") < timestamp_literal(start))).drop("new")
        few = _few(behind, "entity_id")
        # older loads hold their open bucket, or all that a rewind goes back over; new loads what has come
        open_dates = _dates(behind.withColumn("_last", F.least("until", timestamp_literal(start))), "begin", "_last")
        stored = of_series(log.values(before, end=start, dates=open_dates), behind, READING, few)
        stored = stored.filter((F.col("ts") >= F.col("begin")) & (F.col("ts") < F.col("until")))
        came = of_series(log.values(newest, row["oldest"], start, after=before), behind, READING, few)
        came = came.filter(F.col("ts") >= F.col("begin"))
        parts += [p.drop("begin", "until") for p in (stored, came)]
    if row["new"]:
        firsts = materialise(due.filter("new").select(*READING).join(log.seen(newest), READING), "due-firsts")
        first = firsts.agg(F.min(epoch_ms_to_ts(F.col("first_ms"))).alias("t"), F.min("first_arrival").alias("a")).first()
        if first["t"] is not None:
            since = first["t"] if unseen_since is None else max(first["t"], unseen_since)
            if start is None or since < start:
                rows = log.values(newest, since, start, after=first["a"] - 1)
                parts.append(of_series(rows, firsts.select(*READING), READING, _few(firsts, "entity_id")))
    if not parts:
        return Due(log.values(-1), due, notes)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part.select(*found.columns))
    return Due(found, due, notes)


def due_facts(
    store: StatStore, job: str, source: str, source_marks: str, table: str, series: DataFrame, grain: str, shift: timedelta = timedelta(0)
) -> Due:
    """Stored facts of ``source`` that a job needs of ``series(device_id, device_type, key_id)``.

    The watermarks of the source say which series moved since the job's last run, and where the
    facts of a new one begin. What is behind the fleet is read from the dates it moved over.
    """
    moved = store.read(source_marks).select(*SERIES_KEY, F.col("latest_stat_time").alias("_source"), "first_stat_time")
    before = store.read("sources").filter(F.col("job") == job)
    before = before.select(*SERIES_KEY, F.col("latest_stat_time").alias("_before"))
    marks = store.read(table).select(*SERIES_KEY, F.col("latest_stat_time").alias("_mark"), "redo_until")
    # a series that the source has no watermark of has no facts there; one that was rewound and redone has moved too
    known = series.select(*SERIES_KEY).distinct().join(moved, SERIES_KEY).join(before, SERIES_KEY, "left").join(marks, SERIES_KEY, "left")
    new = F.col("_mark").isNull()
    wanted = F.col("_before").isNull() | (F.col("_source") != F.col("_before")) | F.col("redo_until").isNotNull()
    begin = F.when(new, F.col("first_stat_time")).otherwise(_bucket(F.col("_mark"), grain, shift))
    due = materialise(known.filter(wanted).withColumns({"begin": begin, "new": new}), "due-facts")

    def note_sources() -> None:
        rows = due.select(
            F.lit(job).alias("job"), *SERIES_KEY, F.col("_source").alias("latest_stat_time"), F.lit(0).alias("latest_epoch")
        )
        store.merge_small("sources", rows, ["latest_stat_time", "latest_epoch"])

    row = due.agg(
        F.percentile_approx(F.when(~F.col("new"), F.col("begin")), LAGGING_SHARE).alias("fleet"),
        F.min("begin").alias("oldest"),
        F.count_if(F.col("begin").isNull()).alias("unbounded"),
        F.count("*").alias("n"),
    ).first()
    if not row["n"]:
        return Due(store.read(source).limit(0), due)
    start = row["fleet"]
    if start is None or row["unbounded"]:
        # all are new, or of some it is not known where they begin
        since = None if row["unbounded"] else row["oldest"]
        return Due(store.read(source, since), due, [note_sources])
    found = store.read(source, start)
    if row["oldest"] < start:
        behind = due.filter(F.col("begin") < timestamp_literal(start))
        last = F.least(F.greatest("_source", "begin", F.coalesce("redo_until", "begin")), timestamp_literal(start))
        dates = _dates(behind.withColumn("_last", last), "begin", "_last")
        # the start's own period is read for everybody already
        rows = store.read(source, before=start, dates=dates)
        found = found.unionByName(rows.join(behind.select(*SERIES_KEY), SERIES_KEY, "left_semi"))
    return Due(found, due, [note_sources])
