from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meterfold.functions import timebucket as tb


def test_epoch_ms_truncates_toward_zero(frame):
    df = frame([(1704067207999,), (0,), (-1,), (-1500,)], "ms bigint")
    got = [r[0] for r in df.select(tb.epoch_ms_to_ts(F.col("ms"))).collect()]
    assert got == [
        datetime(2024, 1, 1, 0, 0, 7),
        datetime(1970, 1, 1),
        datetime(1970, 1, 1),
        datetime(1969, 12, 31, 23, 59, 59),
    ]


def test_production_day_starts_at_eight(frame):
    df = frame([("2024-12-10 07:59:59.999",), ("2024-12-10 08:00:00",), ("2024-12-11 07:59:59",)], "ts timestamp_ntz")
    got = [r[0] for r in df.select(tb.production_day(F.col("ts"))).collect()]
    assert got == [datetime(2024, 12, 9), datetime(2024, 12, 10), datetime(2024, 12, 10)]


def test_buckets_of_every_grain(frame):
    df = frame([("2024-05-17 06:45:31.5",)], "ts timestamp_ntz")
    at = F.col("ts")
    row = df.select(*[tb.grain_bucket(at, g).alias(g) for g in tb.STAT_TYPE], tb.log_day(at).alias("log")).first()
    assert row.asDict() == {
        "minute": datetime(2024, 5, 17, 6, 45),
        "hour": datetime(2024, 5, 17, 6),
        "day": datetime(2024, 5, 16),
        "month": datetime(2024, 5, 1),
        "year": datetime(2024, 1, 1),
        "log": date(2024, 5, 17),
    }
    assert df.select(tb.grain_bucket(at, "DAY", None)).first()[0] == datetime(2024, 5, 17)


def test_unknown_grain_is_an_error():
    with pytest.raises(ValueError):
        tb.calendar_bucket(F.lit(None), "fortnight")


@pytest.mark.parametrize(
    "grain, end, fine",
    [
        ("minute", datetime(2024, 1, 1, 0, 1), False),
        ("MINUTE", datetime(2024, 1, 1, 0, 1, 1), True),
        ("hour", datetime(2024, 1, 1, 1), False),
        ("day", datetime(2024, 1, 2), False),
        ("day", datetime(2024, 1, 2, 0, 0, 1), True),
        ("month", datetime(2024, 1, 31), False),
        ("month", datetime(2024, 2, 1), True),
        ("year", datetime(2024, 12, 26), False),
        ("year", datetime(2024, 12, 27), True),
        ("week", datetime(2024, 1, 1), True),
    ],
)
def test_range_must_exceed_one_unit(grain, end, fine):
    if fine:
        tb.check_range(datetime(2024, 1, 1), end, grain)
    else:
        with pytest.raises(ValueError):
            tb.check_range(datetime(2024, 1, 1), end, grain)


def test_open_range_passes():
    tb.check_range(None, datetime(2024, 1, 1), "year")
    tb.check_range(datetime(2024, 1, 1), None, "year")


def test_lookahead_clamps_to_the_months_end():
    assert tb.lookahead_end(datetime(2024, 1, 31, 5), "hour") == datetime(2024, 2, 29, 5)
    assert tb.lookahead_end(datetime(2024, 2, 29), "year") == datetime(2025, 2, 28)
    assert tb.lookahead_end(datetime(2024, 12, 15), "day") == datetime(2025, 1, 15)
    assert tb.lookahead_end(datetime(2024, 12, 15), "week") == datetime(2024, 12, 15)
    assert tb.lookahead_end(None, "day") is None


def test_half_open(frame):
    df = frame([("2024-01-01",), ("2024-01-02",), ("2024-01-03",)], "bucket timestamp_ntz")
    kept = tb.half_open(df, "bucket", datetime(2024, 1, 1), datetime(2024, 1, 3)).count()
    assert (kept, tb.half_open(df, "bucket").count()) == (2, 3)


def test_calendar_buckets_agree_with_the_general_truncation(frame):
    """Before and after the epoch, leap days and week starts included."""
    df = frame([("1911-02-28 23:59:59.999999",), ("1969-12-31 23:59:59.5",), ("2024-02-29 00:00:00",), ("2024-12-30 12:00:00",), (None,)], "ts timestamp_ntz")
    for grain in ("second", "minute", "hour", "day", "week", "month", "quarter", "year"):
        general = F.date_trunc(grain, "ts").cast("timestamp_ntz")
        assert df.filter(~tb.calendar_bucket(F.col("ts"), grain).eqNullSafe(general)).count() == 0
