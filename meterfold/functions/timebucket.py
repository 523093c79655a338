"""Time bucketing: calendar buckets, production days, range checks and look-ahead."""

from __future__ import annotations

import calendar
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The statistic code stored with every fact.
STAT_TYPE = {"minute": 1, "hour": 2, "day": 3, "month": 4, "year": 5}

# Fixed value: a production day runs from 08:00 to 08:00.
DAY_START = timedelta(hours=8)

# Fixed value: the lower bound of a series that has no watermark yet.
BEGINNING = datetime(1911, 1, 1)

# A checked range must be longer than one unit. A month counts as 30 days and a
# year as 360, the rule by which databases compare intervals of months and days.
MINIMUM_RANGE = {
    "minute": timedelta(minutes=1),
    "hour": timedelta(hours=1),
    "day": timedelta(days=1),
    "month": timedelta(days=30),
    "year": timedelta(days=360),
}

# Months the scan reaches beyond the requested end, so that the bucket after an
# outage is still found.
LOOKAHEAD_MONTHS = {"minute": 1, "hour": 1, "day": 1, "month": 1, "year": 12}

_TRUNCATABLE = {"second", "minute", "hour", "day", "week", "month", "quarter", "year"}


def grain_name(grain: str) -> str:
    """Lower-case the grain; Spark would turn an unknown one into NULL buckets silently."""
    name = grain.lower()
    if name not in _TRUNCATABLE:
        raise ValueError(f"unknown grain {grain!r}; expected one of {sorted(_TRUNCATABLE)}")
    return name


def timestamp_literal(moment: datetime | date) -> Column:
    return F.lit(moment.isoformat()).cast("timestamp_ntz")


def epoch_ms(moment: datetime) -> int:
    """Epoch milliseconds of a UTC wall-clock time."""
    return calendar.timegm(moment.timetuple()) * 1000 + moment.microsecond // 1000


def instant_ms(moment: datetime) -> Column:
    """Epoch milliseconds of a wall-clock time of the session's zone, as a constant that reaches file scans."""
    return ts_to_epoch_ms(timestamp_literal(moment))


def wall_clock_instant(ts: Column) -> Column:
    """The instant that reads in UTC what ``ts`` reads in the session's zone.

    Fixed windows over instants begin at UTC midnight; over these they begin at local midnight.
    """
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts).cast("timestamp")


def instant_wall_clock(instant: Column) -> Column:
    """The opposite of :func:`wall_clock_instant`."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def epoch_ms_to_ts(ms: Column) -> Column:
    """Epoch milliseconds to a wall-clock time of whole seconds (truncated toward zero)."""
    seconds = F.call_function("div", ms, F.lit(1000))
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def ts_to_epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def calendar_bucket(ts: Column, grain: str) -> Column:
    """Start of the calendar unit; from a day up by way of the date, which is the cheaper truncation."""
    name = grain_name(grain)
    if name in ("second", "minute", "hour"):
        return F.date_trunc(name, ts).cast("timestamp_ntz")
    day = F.to_date(ts)
    return (day if name == "day" else F.trunc(day, name)).cast("timestamp_ntz")


def production_day(ts: Column, day_start: timedelta = DAY_START) -> Column:
    """Midnight of the production day: 07:59:59 still belongs to the day before."""
    return calendar_bucket(ts - F.lit(day_start), "day")


def grain_bucket(ts: Column, grain: str, day_start: timedelta | None = DAY_START) -> Column:
    """Production day at the day grain, calendar bucket at every other.

    ``day_start=None`` asks for calendar days.
    """
    if grain_name(grain) == "day" and day_start is not None:
        return production_day(ts, day_start)
    return calendar_bucket(ts, grain)


def log_day(ts: Column) -> Column:
    return F.to_date(ts)


def check_range(start: datetime | None, end: datetime | None, grain: str) -> None:
    """Reject a range that is not longer than one unit of the grain."""
    unit = MINIMUM_RANGE.get(grain_name(grain))
    if unit is None or start is None or end is None:
        return
    if end - start <= unit:
        raise ValueError(
            f"at grain {grain!r} the range must be longer than one {grain_name(grain)}, "
            f"got {end - start}; move the end later or the start earlier"
        )


def add_months(moment: datetime, months: int) -> datetime:
    """Calendar month arithmetic; a day past the month's end becomes its last day."""
    years, month0 = divmod(moment.year * 12 + moment.month - 1 + months, 12)
    last = calendar.monthrange(years, month0 + 1)[1]
    return moment.replace(year=years, month=month0 + 1, day=min(moment.day, last))


def lookahead_end(end: datetime | None, grain: str) -> datetime | None:
    if end is None:
        return None
    return add_months(end, LOOKAHEAD_MONTHS.get(grain_name(grain), 0))


def half_open(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """``start <= column < end``; a missing bound leaves that side open."""
    if start is not None:
        df = df.filter(F.col(column) >= timestamp_literal(start))
    if end is not None:
        df = df.filter(F.col(column) < timestamp_literal(end))
    return df


def stat_type(grain: str) -> Column:
    return F.lit(STAT_TYPE[grain_name(grain)])
