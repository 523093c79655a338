from datetime import datetime

from meterfold.functions.timebucket import epoch_ms
from meterfold.sources import telemetry
from meterfold.sources.node_mapping import node_mapping

DEVICE = "device_id string, entity_id string, factory_id string, device_type string"
DEVICES = [
    ("d1", "e1", "A", "E"),
    ("d2", "e2", "KC", "E"),
    ("d3", None, "A", "E"),
    ("d4", "e4", None, "W"),
    ("d5", "e5", "KT", "G"),
    ("d6", "e6", "B", "W"),
]


def ids(df):
    return sorted(r["device_id"] for r in df.collect())


def test_eligible_devices(frame):
    devices = frame(DEVICES, DEVICE)
    assert ids(telemetry.eligible_devices(devices)) == ["d1", "d6"]
    assert ids(telemetry.eligible_devices(devices, types=telemetry.ELECTRICITY)) == ["d1"]
    assert ids(telemetry.eligible_devices(devices, exclude_types=telemetry.ELECTRICITY)) == ["d6"]
    every = telemetry.eligible_devices(devices, types=telemetry.OTHER_UTILITIES, exclude_factories=())
    assert ids(every) == ["d4", "d5", "d6"]


def test_stale_devices_need_a_watermark(frame):
    latest = frame(
        [("d1", "E", 142, "2024-01-01 10:59:59"), ("d2", "E", 142, "2024-01-01 11:00:00"), ("d6", "W", 569, "2020-01-01")],
        "device_id string, device_type string, key_id int, latest_stat_time timestamp_ntz",
    )
    due = telemetry.stale_devices(frame(DEVICES, DEVICE), latest, 142, datetime(2024, 1, 1, 12))
    assert ids(due) == ["d1"]


def test_readings_by_role_and_name(frame):
    values = frame(
        [("e1", 142, 5), ("e1", 630, 6), ("e6", 569, 7), ("e6", 142, 8), ("zz", 142, 9)],
        "entity_id string, key_id int, value int",
    )
    devices = frame(DEVICES, DEVICE)
    keys = frame(
        [("E", 142, 554, 630), ("W", 569, 626, 700)],
        "device_type string, accumulation_key_id int, consumption_key_id int, rate_key_id int",
    )
    names = frame([(142, "Energy"), (630, "Active_Power")], "key_id int, key string")
    counters = telemetry.readings(values, devices, keys, "accumulation").collect()
    assert sorted((r["device_id"], r["value"], r["consumption_key_id"]) for r in counters) == [("d1", 5, 554), ("d6", 7, 626)]
    assert [r["value"] for r in telemetry.readings(values, devices, keys, "rate").collect()] == [6]
    named = telemetry.readings(values, devices, keys, "named", names, ("Energy",)).collect()
    assert sorted((r["device_id"], r["value"]) for r in named) == [("d1", 5), ("d6", 8)]


def test_measure_keys_are_renamed(frame):
    df = frame([(566, 1), (630, 2), (142, 3)], "key_id int, value int")
    config = frame([(566, 627), (630, 627)], "rate_key_id int, avg_key_id int")
    assert sorted((r["key_id"], r["value"]) for r in telemetry.map_measure_keys(df, config).collect()) == [(627, 1), (627, 2)]


def test_node_mapping(spark, frame):
    mapping = node_mapping(spark)
    assert mapping.count() == 142 and mapping.select("device_id").distinct().count() == 142
    devices = frame([("1-8L", "old"), ("6-8L,6-9L", None), ("other", "keep")], "device_id string, node_id string")
    got = {r["device_id"]: r["node_id"] for r in telemetry.apply_node_mapping(devices, mapping).collect()}
    assert got == {"1-8L": "10041000000", "6-8L,6-9L": "10051000003", "other": "keep"}


def test_retention_and_log_rows(frame):
    now = datetime(2024, 1, 1, 12)
    edge = epoch_ms(datetime(2024, 1, 1, 4))
    hot = frame(
        [(edge - 1, "x"), (edge, None), (edge + 1, "a|ERROR|b"), (edge + 1, "|DEBUG|"), (edge + 1, "INFO"), (edge + 2, "|INFO|")],
        "ts bigint, str_v string",
    )
    kept = telemetry.retain_recent(hot, now)
    assert kept.count() == 5
    assert [r["str_v"] for r in telemetry.drop_log_rows(kept).collect()] == [None, "INFO"]


def test_bounds_reach_the_scan(spark, tmp_path):
    """The time bound is compared with the stored column, so Parquet can skip row groups."""
    path = str(tmp_path / "kv")
    spark.sql("SELECT 'e' AS entity_id, 1 AS `key`, id AS ts, 1.0D AS dbl_v FROM range(10)").write.parquet(path)
    bounded = telemetry.telemetry_values(spark.read.parquet(path), datetime(2024, 1, 1))
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,1704067200000)" in plan
