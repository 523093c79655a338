from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterfold.operators import incremental as inc
from meterfold.operators.quality import assert_unique_key, drop_column, watermark_drift

FACT = "device_id string, k int, a int, b int"
SERIES = "device_id string, device_type string, key_id int, stat_time timestamp_ntz"
LATEST = "device_id string, device_type string, key_id int, latest_stat_time timestamp_ntz"
KEYS = ["device_id", "k"]


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_upsert_overwrites_only_the_listed_columns(frame):
    target = frame([("x", 1, 10, 11), ("y", 1, 20, 21)], FACT)
    new = frame([("x", 1, 99, 98), ("z", 1, 30, 31)], FACT)
    assert rows(inc.upsert(target, new, KEYS, ["a"])) == [("x", 1, 99, 11), ("y", 1, 20, 21), ("z", 1, 30, 31)]


def test_upsert_may_set_null_and_keeps_columns_the_update_lacks(frame):
    target = frame([("x", 1, 10, 11)], FACT)
    new = frame([("x", 1, None), ("z", 1, 5)], "device_id string, k int, a int")
    merged = inc.upsert(target, new, KEYS, ["a"]).collect()
    assert {tuple(r) for r in merged} == {("x", 1, None, 11), ("z", 1, 5, None)}


def test_update_only_never_inserts(frame):
    target = frame([("x", 1, 10, 11), ("y", 1, 20, 21)], FACT)
    new = frame([("x", 1, 99, 98), ("z", 1, 30, 31)], FACT)
    assert rows(inc.update_only(target, new, KEYS, ["b"])) == [("x", 1, 10, 98), ("y", 1, 20, 21)]


def test_insert_only_rejects_duplicates(frame):
    target = frame([("x", 1, 10, 11)], FACT)
    assert inc.insert_only(target, frame([("y", 1, 1, 1)], FACT), KEYS).count() == 2
    with pytest.raises(inc.DuplicateKeyError):
        inc.insert_only(target, frame([("x", 1, 1, 1)], FACT), KEYS)
    with pytest.raises(inc.DuplicateKeyError):
        inc.insert_only(target, frame([("y", 1, 1, 1), ("y", 1, 2, 2)], FACT), KEYS)


def test_since_watermark(frame):
    facts = frame([("x", "E", 1, f"2024-01-0{d}") for d in (1, 2, 3)] + [("y", "E", 1, "2024-01-01"), ("y", "E", 1, "1900-01-01")], SERIES)
    latest = frame([("x", "E", 1, "2024-01-02"), ("y", "W", 1, "2024-01-09")], LATEST)
    assert inc.since_watermark(facts, latest, "stat_time").count() == 3
    assert inc.since_watermark(facts, latest, "stat_time", strict=True).count() == 2
    late_default = inc.since_watermark(facts, latest, "stat_time", default=datetime(2024, 6, 1))
    assert {r["device_id"] for r in late_default.collect()} == {"x"}


def test_advance_and_rewind(frame):
    facts = frame([("x", "E", 1, "2024-01-02 10:00:00"), ("x", "E", 1, "2024-01-02 11:00:00"), ("x", "E", 2, "2024-01-01")], SERIES)
    marks = inc.advance_watermark(facts, inc.WATERMARK_OFFSET["hour"])
    got = {r["key_id"]: (r["latest_stat_time"], r["latest_epoch"]) for r in marks.collect()}
    assert got[1] == (datetime(2024, 1, 2, 11, 59, 59), 1704196799000)
    assert got[2][0] == datetime(2024, 1, 1, 0, 59, 59)
    late = frame([("x", "E", 1, "2023-12-31 05:00:00"), ("x", "E", 2, "2024-03-01")], "device_id string, device_type string, key_id int, ts timestamp_ntz")
    back = {r["key_id"]: r["latest_stat_time"] for r in inc.rewind_watermark(marks, late, "hour").collect()}
    assert back == {1: datetime(2023, 12, 31, 5, 59, 59), 2: datetime(2024, 1, 1, 0, 59, 59)}


def test_high_water_is_kept_per_key(frame):
    stored = frame([("x", "E", 1, "2024-01-01"), ("x", "E", 2, "2024-03-01")], SERIES)
    assert {r["key_id"]: r["high_water"] for r in inc.target_high_water(stored, "month").collect()} == {
        1: datetime(2024, 1, 31, 23, 59, 59),
        2: datetime(2024, 3, 31, 23, 59, 59),
    }
    months = frame([("x", "E", k, f"2024-0{m}-01") for k in (1, 2, 3) for m in (1, 2, 3, 4)], SERIES)
    kept = inc.beyond_high_water(months, stored, "month").groupBy("key_id").count().collect()
    assert {r["key_id"]: r["count"] for r in kept} == {1: 3, 2: 1, 3: 4}
    refreshed = inc.beyond_high_water(months, stored, "month", refresh_open=True).groupBy("key_id").count().collect()
    assert {r["key_id"]: r["count"] for r in refreshed} == {1: 4, 2: 2, 3: 4}


def test_run_metrics(frame):
    observed, metrics = inc.run_metrics(frame([("x", "E", 1, "2024-01-01"), ("x", "E", 1, "2024-01-03")], SERIES), "m")
    observed.collect()
    assert metrics.get == {"rows": 2, "first_stat_time": datetime(2024, 1, 1), "last_stat_time": datetime(2024, 1, 3)}


def test_drift_raw_and_corrected(frame):
    facts = frame([("x", "E", 1, "2024-01-01"), ("y", "E", 1, "2024-01-05")], SERIES)
    latest = frame([("x", "E", 1, "2024-01-01 07:59:59"), ("y", "E", 1, "2024-01-02 07:59:59"), ("z", "E", 1, "2024-01-01")], LATEST)
    assert watermark_drift(latest, facts).count() == 2
    drifted = watermark_drift(latest, facts, timedelta(hours=7, minutes=59, seconds=59)).collect()
    assert [(r["device_id"], r["max_stat_time"]) for r in drifted] == [("y", datetime(2024, 1, 5))]


def test_unique_key_and_dropped_column(frame):
    facts = frame([("x", 1, 1, 1), ("x", 2, 1, 1)], FACT)
    assert_unique_key(facts, KEYS)
    with pytest.raises(ValueError):
        assert_unique_key(facts, ["device_id"])
    assert drop_column(facts.withColumn("entity_id", F.lit(1))).columns == facts.columns
