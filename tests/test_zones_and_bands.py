"""Jobs in several time zones, and scans that a lagging or silent meter does not widen."""

import random
import subprocess
import sys
import tempfile
from datetime import datetime, timedelta
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from meterfold.functions.timebucket import instant_ms, timestamp_literal, ts_to_epoch_ms
from meterfold.operators import incremental
from meterfold.operators.carbon import carbon_by_device_type, carbon_by_param_name
from meterfold.plans import jobs
from meterfold.session import shared_dir
from meterfold.sources import schemas
from meterfold.sources.store import StatStore
from meterfold.streaming.bucket_stats import stream_bucket_stats

AS_OF = datetime(2025, 5, 1)


@pytest.fixture(params=["UTC", "Asia/Taipei", "America/New_York"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def estate(spark, rows, devices):
    """Readings ``entity, key, wall-clock time, value`` as telemetry of the session's zone."""
    readings = spark.createDataFrame(rows, "entity_id string, key int, at timestamp_ntz, dbl_v double")
    return jobs.Estate(
        ts_kv=readings.select("entity_id", "key", ts_to_epoch_ms(F.col("at")).alias("ts"), "dbl_v"),
        device=spark.createDataFrame(devices, schemas.DEVICE),
        key_config=spark.createDataFrame([("W", 569, 626, 700, None)], schemas.KEY_CONFIG),
        param=spark.createDataFrame([], schemas.CONFIG_PARAM),
    )


def test_two_halves_in_each_zone(spark, zone):
    """96 hours over a change to daylight saving: a run split anywhere gives what one run gives."""
    rng, at, counter, rows = random.Random(1), datetime(2025, 3, 8, 5), 0.0, []
    while at < datetime(2025, 3, 12):
        rows.append(("w", 569, at, counter))
        at, counter = at + timedelta(minutes=rng.choice([20, 55, 200])), counter + rng.randrange(9)
    rows = [r for r in rows if not (r[2].date() == datetime(2025, 3, 9).date() and r[2].hour == 2)]
    devices = [("W1", "w", "P1", "W", None)]
    results = []
    for cuts in ([None], [datetime(2025, 3, 10, 10, 20), None]):
        store = StatStore(spark, tempfile.mkdtemp(prefix="meterfold-test-"))
        for cut in cuts:
            part = estate(spark, [r for r in rows if cut is None or r[2] < cut], devices)
            for job in (jobs.minute_other, jobs.hour_other, jobs.day_profile, jobs.day_consumption):
                job(part, store, AS_OF)
        results.append({t: sorted(map(tuple, store.read(t).collect()), key=str) for t in ("minutely", "hourly", "daily")})
        total = store.read("daily").agg(F.sum("dbl_stats")).first()[0]
        assert total == rows[-1][3] - rows[0][3]
    assert results[0] == results[1]


def test_bounds_are_those_of_the_zone(spark, zone):
    moment = datetime(2025, 1, 2, 3, 4, 5)
    back = spark.range(1).select(F.timestamp_millis(instant_ms(moment)).cast("timestamp_ntz").alias("t")).first()["t"]
    assert back == moment


def test_stream_days_begin_at_eight_in_the_zone(spark, zone):
    folder = tempfile.mkdtemp(prefix="meterfold-stream-")
    schema = "entity_id string, key_id int, ts timestamp_ntz, value bigint"
    times = [datetime(2025, 1, 2, 7, 59), datetime(2025, 1, 2, 8), datetime(2025, 1, 3, 7, 59, 59)]
    spark.createDataFrame([("a", 1, t, 5) for t in times], schema).write.mode("append").parquet(folder)
    stats = stream_bucket_stats(spark.readStream.schema(schema).parquet(folder), "day")
    name = f"days_{zone.replace('/', '_')}"
    stats.writeStream.format("memory").queryName(name).outputMode("update").trigger(availableNow=True).start().awaitTermination()
    got = {r["stat_time"]: r["readings"] for r in spark.table(name).collect()}
    assert got == {datetime(2025, 1, 1): 1, datetime(2025, 1, 2): 2}


def test_a_dead_and_a_silent_meter_cost_only_themselves(spark):
    """The scan of the fleet starts at the fleet's watermark, whatever single meters do."""
    names = [f"w{i}" for i in range(60)]
    series = spark.createDataFrame([(n.upper(), "W", n, 626) for n in names], "device_id string, device_type string, entity_id string, key_id int")
    fleet, dead = datetime(2025, 4, 1, 10, 0, 59), datetime(2024, 1, 1, 0, 0, 59)
    marks = [(n.upper(), "W", 626, dead if n == "w0" else fleet, 0) for n in names if n != "w1"]
    latest = spark.createDataFrame(marks, schemas.LATEST)
    rows = [(n, t) for n in names for t in (datetime(2023, 6, 1), datetime(2024, 6, 1), datetime(2025, 4, 2))]
    facts = spark.createDataFrame(rows, "entity_id string, t timestamp_ntz")
    asked = []

    def load(start, end):
        asked.append((start, end))
        found = facts
        for bound, keep in ((start, lambda x: F.col("t") >= x), (end, lambda x: F.col("t") < x)):
            found = found if bound is None else found.filter(keep(timestamp_literal(bound)))
        return found

    got = jobs._from_watermarks(series, latest, None, "minute", load, "entity_id").collect()
    assert asked[0] == (datetime(2025, 4, 1, 10), None)
    per = {n: sorted(r["t"].year for r in got if r["entity_id"] == n) for n in names}
    assert per["w0"] == [2024, 2025] and per["w1"] == [2023, 2024, 2025] and per["w5"] == [2025]
    searched = spark.createDataFrame([("W1", "W", 626, datetime(2025, 3, 30), 0)], schemas.LATEST)
    asked.clear()
    jobs._from_watermarks(series, latest, searched, "minute", load, "entity_id")
    assert all(start is not None for start, _ in asked)


def test_a_meter_that_never_reported_is_remembered(spark):
    devices = [("W1", "w", "P1", "W", None), ("W2", "none", "P1", "W", None)]
    part = estate(spark, [("w", 569, datetime(2025, 3, 1, h), float(h)) for h in range(5)], devices)
    store = StatStore(spark, tempfile.mkdtemp(prefix="meterfold-test-"))
    jobs.minute_other(part, store, AS_OF)
    assert [(r["device_id"], r["key_id"]) for r in store.read("minute_searched").collect()] == [("W2", 626)]
    rows = [("w", 569, datetime(2025, 3, 1, h), float(h)) for h in range(5)] + [("none", 569, datetime(2025, 3, 2, h), 2.0 * h) for h in range(3)]
    jobs.minute_other(estate(spark, rows, devices), store, AS_OF)
    assert {r["device_id"] for r in store.read("minute_latest").collect()} == {"W1", "W2"}


def test_the_backlog_of_a_silent_meter_is_read_from_its_beginning(spark):
    """A meter that first reports long after it was searched for, with readings from before that."""
    start, devices = datetime(2025, 3, 1, 5), [("W1", "w", "P1", "W", None), ("W2", "late", "P1", "W", None)]
    steady = [("w", k, start + timedelta(hours=5 * n), 3.0 * n) for n in range(50) for k in (569, 700)]
    backlog = [("late", k, datetime(2025, 2, 20, 7) + timedelta(hours=9 * n), 2.0 * n) for n in range(30) for k in (569, 700)]
    results = []
    for runs in ([steady + backlog], [steady, steady + backlog]):
        store = StatStore(spark, tempfile.mkdtemp(prefix="meterfold-test-"))
        for rows in runs:
            part = estate(spark, rows, devices)
            for job in (
                jobs.minute_other, jobs.hour_other, jobs.hour_rate_other, jobs.day_profile, jobs.day_consumption, jobs.day_rate_other,
            ):
                job(part, store, AS_OF)
        results.append({t: sorted(map(tuple, store.read(t).collect()), key=str) for t in ("minutely", "hourly", "daily")})
    assert all(any("W2" in r for r in results[0][t]) for t in results[0])
    assert results[0] == results[1]


def test_readings_between_the_mark_and_the_start_of_the_day_are_read(spark):
    """A production day's scan starts at 08:00, which may be behind the mark."""
    devices = [("W1", "w", "P1", "W", None), ("W2", "late", "P1", "W", None)]
    steady = [("w", 569, datetime(2025, 3, 1) + timedelta(hours=n), 1.0 * n) for n in range(30)]
    store = StatStore(spark, tempfile.mkdtemp(prefix="meterfold-test-"))
    first = estate(spark, steady, devices)
    jobs._mark_searched(store, "day_latest", jobs._read_series(first, first.device.filter("device_id = 'W2'"), "consumption"), jobs._values(first, None))
    assert [r["latest_stat_time"] for r in store.read("day_searched").collect()] == [datetime(2025, 3, 1, 5)]
    both = estate(spark, steady + [("late", 569, datetime(2025, 3, 1, 6), 1.0), ("late", 569, datetime(2025, 3, 1, 9), 4.0)], devices)
    due = jobs._telemetry(both, store, "day_consumption", both.device, "consumption", "day_latest", "day", jobs.DAY_START)
    assert sorted(r["ts"].hour for r in due.rows.filter("entity_id = 'late'").collect()) == [6, 9]


def test_jobs_of_different_owners_keep_each_others_rows(spark):
    """Both read the table before either writes, as two jobs at the same time would."""
    root = tempfile.mkdtemp(prefix="meterfold-test-")
    day = datetime(2025, 3, 1)
    row = "device_type string, device_id string, key_id int, stat_time timestamp_ntz, stat_type int, dbl_stats double"
    one, two = (StatStore(spark, root, owner) for owner in ("one", "two"))
    for store, key in ((one, 1), (two, 2)):
        store.upsert("daily", spark.createDataFrame([("W", "w", key, day, 3, 1.0)], row), ["dbl_stats"])
    staged = {k: spark.createDataFrame([("W", "w", k, day, 3, 9.0)], row) for k in (1, 2)}
    rows, _ = one._stage("daily", staged[1])
    before = one._touched("daily", rows)
    two.upsert("daily", staged[2], ["dbl_stats"])
    one._replace("daily", incremental.upsert(before, rows, ["device_type", "device_id", "key_id", "stat_time"], ["dbl_stats"]))
    assert sorted((r["key_id"], r["dbl_stats"]) for r in one.read("daily").collect()) == [(1, 9.0), (2, 9.0)]


def test_duplicate_facts_are_refused(spark):
    store = StatStore(spark, tempfile.mkdtemp(prefix="meterfold-test-"))
    row = "device_type string, device_id string, key_id int, stat_time timestamp_ntz, dbl_stats double"
    twice = spark.createDataFrame([("W", "w", 1, datetime(2025, 3, 1), 1.0)] * 2, row)
    with pytest.raises(ValueError, match="key not unique"):
        store.upsert("daily", twice, ["dbl_stats"])


def test_one_coefficient_per_plant(spark):
    param = spark.createDataFrame(
        [(2, "b", 9.0, "P", "W"), (1, "b", 2.0, "P", "W"), (3, "b", 7.0, "P", "E")], schemas.CONFIG_PARAM
    )
    facts = spark.createDataFrame([("P", "W", 10.0), ("Q", "W", 1.0)], "factory_id string, device_type string, consumption double")
    assert sorted((r["factory_id"], r["kgco2e"]) for r in carbon_by_device_type(facts, param).collect()) == [("P", 20.0), ("Q", None)]
    assert [r["kgco2e"] for r in carbon_by_param_name(facts, param, "b").collect()] == [20.0]


@pytest.mark.parametrize("grain, mark", [
    ("minute", datetime(2025, 3, 2, 3, 5, 59)), ("hour", datetime(2025, 3, 2, 3, 59, 59)),
    ("day", datetime(2025, 3, 1, 7, 59, 59)), ("calendar_day", datetime(2025, 3, 2, 0, 59, 59)),
])
def test_rewound_marks_are_the_buckets_own(spark, grain, mark):
    latest = spark.createDataFrame([("w", "W", 1, datetime(2025, 4, 1), 0)], schemas.LATEST)
    late = spark.createDataFrame([("w", "W", 1, datetime(2025, 3, 2, 3, 5, 7))], "device_id string, device_type string, key_id int, ts timestamp_ntz")
    assert incremental.rewind_watermark(latest, late, grain).first()["latest_stat_time"] == mark


def test_a_session_needs_a_shared_folder():
    """No folder of one machine stands in for it, whatever the master."""
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(bare)


def test_a_local_session_without_the_setting_gets_a_folder():
    script = """
from pyspark import SparkConf
SparkConf.get = lambda self, key, default=None: default
from meterfold.session import local_session, materialise
spark = local_session(1, 1, "1g")
assert materialise(spark.range(3), "x").count() == 3
print("stored")
"""
    root = str(Path(__file__).resolve().parent.parent)
    ran = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True, timeout=300)
    assert "stored" in ran.stdout, ran.stderr[-2000:]
