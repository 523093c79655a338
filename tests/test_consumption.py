"""Consumption operators against plain loops over the readings."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterfold.operators import consumption as c
from meterfold.operators.ordered import running_total
from meterfold.operators.quality import verify_rollup
from meterfold.operators.series import Series

SCHEMA = "entity_id string, key_id int, ts timestamp_ntz, value bigint"
T0 = datetime(2024, 1, 1)


def random_readings(seed, nulls=True, resets=True):
    """Three meters with gaps of very different length; one holds most readings."""
    rng = random.Random(seed)
    rows = []
    for meter, n in [("hot", 150), ("b", 25), ("single", 1)]:
        ts, value = T0, 0
        for _ in range(n):
            ts += timedelta(seconds=rng.choice([1, 7, 45, 600, 4000, 90000]))
            value = 0 if resets and rng.random() < 0.1 else value + rng.randrange(50)
            rows.append((meter, 142, ts, None if nulls and rng.random() < 0.15 else value))
    rng.shuffle(rows)
    return rows


def as_text(rows):
    return [(e, k, t.isoformat(sep=" "), v) for e, k, t, v in rows]


def by_series(rows):
    series = {}
    for e, k, t, v in sorted(rows, key=lambda r: r[2]):
        series.setdefault((e, k), []).append((t, v))
    return series


def expected_deltas(rows):
    for (e, k), readings in by_series(rows).items():
        for (_, before), (t, v) in zip(readings, readings[1:]):
            current = v or 0
            previous = current if before is None else before
            yield e, k, t, max(0, current - previous)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("slice_grain", ["minute", "hour", "month"])
def test_reading_delta(frame, seed, slice_grain):
    rows = random_readings(seed)
    got = c.reading_delta(frame(as_text(rows), SCHEMA), slice_grain=slice_grain)
    assert sorted(map(tuple, got.select("entity_id", "key_id", "ts", "delta").collect())) == sorted(expected_deltas(rows))


@pytest.mark.parametrize("seed", [4, 5])
@pytest.mark.parametrize("grain", ["minute", "hour", "day"])
def test_delta_per_bucket_sums_the_deltas(frame, seed, grain):
    rows = random_readings(seed)
    df = frame(as_text(rows), SCHEMA)
    floor = {
        "minute": lambda t: t.replace(second=0),
        "hour": lambda t: t.replace(minute=0, second=0),
        "day": lambda t: t.replace(hour=0, minute=0, second=0),
    }[grain]
    want = {}
    for e, k, t, delta in expected_deltas(rows):
        want[e, k, floor(t)] = want.get((e, k, floor(t)), 0) + delta
    got = {(r["entity_id"], r["key_id"], r["bucket"]): r["delta"] for r in c.delta_per_bucket(df, grain=grain).collect()}
    assert got == want


def test_skip_nulls_keeps_the_energy(frame):
    rows = [("m", 1, "2024-01-01 00:00:00", 10), ("m", 1, "2024-01-01 00:01:00", None), ("m", 1, "2024-01-01 00:02:00", 15)]
    df = frame(rows, SCHEMA)
    assert [r["delta"] for r in c.reading_delta(df).orderBy("ts").collect()] == [0, 0]
    assert [r["delta"] for r in c.reading_delta(df, skip_nulls=True).collect()] == [5]


def test_counter_reset_counts_zero(frame):
    rows = [("m", 1, "2024-01-01 00:00:00", 90), ("m", 1, "2024-01-01 02:00:00", 4), ("m", 1, "2024-01-01 02:00:30", 9)]
    assert [r["delta"] for r in c.reading_delta(frame(rows, SCHEMA)).orderBy("ts").collect()] == [0, 5]


def test_running_total(frame):
    rows = [r for r in random_readings(6, nulls=False) if True]
    got = running_total(frame(as_text(rows), SCHEMA), Series(), "total").collect()
    want = []
    for (e, k), readings in by_series(rows).items():
        total = 0
        for t, v in readings:
            total += v
            want.append((e, k, t, total))
    assert sorted((r["entity_id"], r["key_id"], r["ts"], r["total"]) for r in got) == sorted(want)


@pytest.mark.parametrize("seed", [7, 8])
def test_bucket_consumption_min(frame, seed):
    rows = random_readings(seed)
    got = c.bucket_consumption_min(frame(as_text(rows), SCHEMA), "hour")
    want = []
    for (e, k), readings in by_series(rows).items():
        buckets = {}
        for t, v in readings:
            if v is not None:
                buckets.setdefault(t.replace(minute=0, second=0), []).append(v)
        order = sorted(buckets)
        for b, following in zip(order, order[1:] + [None]):
            end = max(buckets[b]) if following is None else min(buckets[following])
            want.append((e, k, b, min(buckets[b]), end, end - min(buckets[b])))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_lookahead_bridges_an_outage(frame):
    """The next bucket lies beyond the end, but within the look-ahead; one too far is not seen."""
    rows = [("m", 1, "2024-01-01 10:10:00", 5), ("m", 1, "2024-01-01 10:50:00", 7), ("m", 1, "2024-01-20 03:00:00", 30)]
    df = frame(rows, SCHEMA)
    near = c.bucket_consumption_min(df, "hour", start=datetime(2024, 1, 1), end=datetime(2024, 1, 2))
    assert [tuple(r)[2:] for r in near.collect()] == [(datetime(2024, 1, 1, 10), 5, 30, 25)]
    late = frame(rows[:2] + [("m", 1, "2024-02-03 03:00:00", 30)], SCHEMA)
    far = c.bucket_consumption_min(late, "hour", start=datetime(2024, 1, 1), end=datetime(2024, 1, 2))
    assert [tuple(r)[2:] for r in far.collect()] == [(datetime(2024, 1, 1, 10), 5, 7, 2)]


def test_range_is_checked(frame):
    with pytest.raises(ValueError):
        c.bucket_consumption_min(frame([], SCHEMA), "day", start=T0, end=T0 + timedelta(days=1))


@pytest.mark.parametrize("seed", [9, 10])
def test_bucket_consumption_first(frame, seed):
    rows = random_readings(seed)
    got = c.bucket_consumption_first(frame(as_text(rows), SCHEMA), "day")
    want = []
    for (e, k), readings in by_series(rows).items():
        buckets = {}
        for t, v in readings:
            if v is not None:
                shifted = t - timedelta(hours=8)
                buckets.setdefault(datetime(shifted.year, shifted.month, shifted.day), []).append(v)
        order = sorted(buckets)
        for b, following in zip(order, order[1:] + [None]):
            end = buckets[b][-1] if following is None else buckets[following][0]
            want.append((e, k, b, buckets[b][0], end, end - buckets[b][0]))
    columns = ["entity_id", "key_id", "period_start", "energy_start", "energy_end", "consumption"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want)


def test_tie_column_decides_between_readings_of_one_instant(frame):
    rows = [("m", 1, "2024-01-01 10:00:00", 5, 2), ("m", 1, "2024-01-01 10:00:00", 3, 1), ("m", 1, "2024-01-01 10:00:00", 9, 3)]
    df = frame(rows, SCHEMA + ", id int")
    row = c.bucket_consumption_first(df, "hour", Series(tie="id")).first()
    assert (row["energy_start"], row["energy_end"]) == (3, 9)
    steps = c.reading_delta(df, Series(tie="id")).orderBy("id").collect()
    assert [r["delta"] for r in steps] == [2, 4]


def test_daily_consumption_open_day(frame):
    rows = [("m", 142, "2024-01-01 01:00:00", 1), ("m", 142, "2024-01-02 02:00:00", 4), ("m", 142, "2024-01-02 23:00:00", 9)]
    df = frame(rows, SCHEMA)
    today = c.daily_consumption(df, date(2024, 1, 2)).orderBy("result_day").collect()
    assert [(r["result_day"], r["daily_energy"]) for r in today] == [(date(2024, 1, 1), 3), (date(2024, 1, 2), 5)]
    later = c.daily_consumption(df, date(2024, 1, 5)).collect()
    assert [(r["result_day"], r["daily_energy"]) for r in later] == [(date(2024, 1, 1), 3)]


def test_open_bucket(frame):
    rows = [("m", 142, "2024-01-02 09:00:00", 1), ("m", 142, "2024-01-03 07:00:00", 4), ("m", 142, "2024-01-05 23:00:00", None)]
    assert c.open_bucket(frame(rows, SCHEMA), "day").first()["max_bucket"] == datetime(2024, 1, 2)


def test_all_grains_conserve_energy(frame):
    """Monotone counters: the total per series is the same at every grain, and so says the check."""
    df = frame(as_text(random_readings(11, nulls=False, resets=False)), SCHEMA)
    totals = [
        {r["entity_id"]: r["t"] for r in c.bucket_consumption_min(df, g).groupBy("entity_id").agg(F.sum("energy_consumption").alias("t")).collect()}
        for g in ("minute", "hour", "day", "month")
    ]
    assert all(t == totals[0] for t in totals)
    assert {r["check_result"] for r in verify_rollup(df).collect()} == {"OK"}
    assert verify_rollup(df).count() == 4
    assert {r["check_result"] for r in verify_rollup(df.filter("false")).collect()} == {"OK"}


def test_check_finds_lost_energy(frame):
    """Within one hour the counter falls, so the minutes do not add up to the hour's span."""
    rows = [("m", 1, "2024-01-01 00:00:00", 50), ("m", 1, "2024-01-01 00:05:00", 10), ("m", 1, "2024-01-01 01:00:00", 60)]
    verdicts = {r["stat_type"]: r["check_result"] for r in verify_rollup(frame(rows, SCHEMA)).collect()}
    assert verdicts == {"時統計": "NG", "日統計": "OK", "月統計": "OK", "年統計": "OK"}


def test_fleet_starts_at_each_watermark(frame):
    readings = frame(
        [(e, 142, f"2024-01-0{d} {h:02d}:30:00", d * 100 + h) for e in ("x", "y") for d in (1, 2) for h in (7, 9)], SCHEMA
    )
    devices = frame([("dx", "x", "F", "E"), ("dy", "y", "F", "E")], "device_id string, entity_id string, factory_id string, device_type string")
    keys = frame([("E", 142, 554, 1)], "device_type string, accumulation_key_id int, consumption_key_id int, rate_key_id int")
    latest = frame([("dx", "E", 554, "2024-01-01 07:59:59")], "device_id string, device_type string, key_id int, latest_stat_time timestamp_ntz")
    got = c.fleet_consumption(readings, devices, keys, "day", latest).orderBy("device_id", "stat_time").collect()
    assert [(r["device_id"], r["stat_time"].day, r["consumption"]) for r in got] == [
        ("dx", 1, 100),
        ("dx", 2, 0),
        ("dy", 31, 2),
        ("dy", 1, 100),
        ("dy", 2, 0),
    ]


@pytest.mark.parametrize("end", [None, datetime(2025, 6, 2)])
def test_check_from_minutes_equals_check_from_readings(frame, end):
    """The four verdicts come out as from the readings themselves, with resets and with a range."""
    from meterfold.operators.quality import ROLLUP_CHECKS, rollup_mismatches

    df = frame(as_text(random_readings(12)), SCHEMA)
    start = None if end is None else datetime(2024, 1, 1, 0, 0, 30)
    verdicts = {r["stat_type"]: r["check_result"] for r in verify_rollup(df, start=start, end=end).collect()}
    for label, coarse, fine in ROLLUP_CHECKS:
        wrong = rollup_mismatches(df, coarse, fine, start=start, end=end).filter("NOT matches").count()
        assert verdicts[label] == ("NG" if wrong else "OK")
