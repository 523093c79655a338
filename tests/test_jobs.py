"""The jobs end to end: one full run, the same in two halves, and a run repeated."""

import os
import random
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterfold.functions.timebucket import epoch_ms
from meterfold.operators.incremental import DuplicateKeyError
from meterfold.operators.quality import assert_unique_key, watermark_drift
from meterfold.operators.statistics import CONSUMED_VOLUMES, ELECTRICITY_COEFFICIENT, FACT_KEY, FLOW_RATES
from meterfold.plans import jobs
from meterfold.sources import schemas
from meterfold.sources.store import StatStore

AS_OF = datetime(2025, 5, 1)
HALF = datetime(2025, 3, 3, 10, 20, 30)
DEVICES = [
    ("E1", "e1", "P1", "E", None),
    ("E2", "e2", "P2", "E", None),
    ("W1", "w1", "P1", "W", None),
    ("G1", "g1", "P2", "G", None),
    ("EX", "ex", "KC", "E", None),
    ("EN", None, "P1", "E", None),
]
KEYS = {
    142: "Energy",
    554: "ConsumedEnergy",
    630: "Active_Power",
    566: "HZ",
    627: "AVG_Active_Power",
    569: "water_total_accumulated_volume",
    626: "water_consumed_volume",
    700: "water_flow_rate",
    612: "gas_total_accumulated_volume",
    635: "gas_consumed_volume",
    701: "gas_flow_rate",
}
COUNTER = {"E": 142, "W": 569, "G": 612}
RATE = {"E": 630, "W": 700, "G": 701}


def telemetry():
    """Four days around a month's end, with outages; every meter has a counter and a rate."""
    rng = random.Random(5)
    rows = []
    for _, entity, _, kind, _ in DEVICES:
        if entity is None:
            continue
        ts, counter = datetime(2025, 2, 27, 5), 100.0
        while ts < datetime(2025, 3, 5):
            rows.append((entity, COUNTER[kind], epoch_ms(ts), counter))
            rows.append((entity, RATE[kind], epoch_ms(ts) + 250, float(rng.randrange(40))))
            ts += timedelta(seconds=rng.choice([20, 50, 600, 3000, 20000]))
            counter += rng.randrange(8)
    return rows


@pytest.fixture(scope="module")
def estate(spark):
    root = tempfile.mkdtemp(prefix="meterfold-estate-")

    def table(rows, schema):
        """The rows as a Parquet table, as a cluster would have them."""
        path = f"{root}/{len(os.listdir(root))}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    prices = [
        (1, d, s, p, 2.0 + i, 1.0 + i)
        for i, (d, s, p) in enumerate(
            [("O", "S", "PE"), ("O", "S", "PP"), ("O", "S", "OP"), ("O", "N", "PP"), ("O", "N", "OP"),
             ("T", "N", "SPP"), ("T", "N", "OP"), ("S", "A", "OP")]
        )
    ]
    return jobs.Estate(
        ts_kv=table(telemetry(), schemas.TS_KV),
        device=table(DEVICES, schemas.DEVICE),
        key_config=table(
            [("E", 142, 554, 630, None), ("W", 569, 626, 700, None), ("G", 612, 635, 701, None)], schemas.KEY_CONFIG
        ),
        param=table(
            [(1, ELECTRICITY_COEFFICIENT, 0.5, "P1", "E"), (2, ELECTRICITY_COEFFICIENT, 0.25, "P2", "E"),
             (3, "水碳排係數", 0.125, "P1", "W")],
            schemas.CONFIG_PARAM,
        ),
        key_dictionary=table(list(KEYS.items()), schemas.KEY_DICTIONARY),
        avg_key_config=table([(630, 627), (700, 800), (701, 801)], schemas.AVG_KEY_CONFIG),
        device_keys=table([("E", 554, "C"), ("E", 627, "A")], schemas.DEVICE_KEYS),
        electricity_rate=table([(1, datetime(2020, 1, 1))], schemas.ELECTRICITY_RATE),
        energy_charge=table(prices, schemas.ENERGY_CHARGE),
    )


SCHEDULE = [
    ("minute", "electricity"), ("minute", "other"), ("hour", "electricity"), ("hour", "other"), ("hour", "other_rate"),
    ("day", "consumption"), ("day", "tou"), ("day", "rate"), ("day", "other_rate"),
]
CALENDAR = [("month", "electricity"), ("month", "other"), ("year", "electricity"), ("year", "other")]


def run_all(estate, store, schedule):
    runs = []
    for grain, measure in schedule:
        options = {"stale_after": None} if (grain, measure) == ("minute", "electricity") else {}
        runs += jobs.run_grain(estate, store, grain, measure, AS_OF, **options)
    return runs


def until(estate, moment):
    return jobs.Estate(**{**estate.__dict__, "ts_kv": estate.ts_kv.filter(F.col("ts") < epoch_ms(moment))})


def contents(store, table):
    order = ["device_id", "key_id"] + (["stat_time"] if "latest" not in table else [])
    return [tuple(r) for r in store.read(table).orderBy("device_type", *order).collect()]


@pytest.fixture(scope="module")
def full(spark, estate):
    store = StatStore(spark, tempfile.mkdtemp(prefix="meterfold-test-"))
    store.runs = run_all(estate, store, SCHEDULE + CALENDAR)
    return store


def test_facts_have_unique_keys(full):
    for table in ("minutely", "hourly", "daily", "monthly", "yearly"):
        facts = full.read(table)
        assert facts.count() > 0
        assert_unique_key(facts, FACT_KEY)


def test_runs_report_their_rows(full):
    rows = {r.job: r.rows for r in full.runs}
    assert rows["minute_electricity"] + rows["minute_other"] == full.read("minutely").count()
    assert rows["month_electricity"] + rows["month_other"] == full.read("monthly").count()
    assert all(r.seconds > 0 for r in full.runs)


def test_excluded_devices_have_no_facts(full):
    assert {r["device_id"] for r in full.read("minutely").select("device_id").distinct().collect()} == {"E1", "E2", "W1", "G1"}


def test_energy_is_conserved_from_minute_to_year(spark, estate, full):
    span = estate.ts_kv.groupBy("entity_id", "key").agg((F.max("dbl_v") - F.min("dbl_v")).alias("used")).collect()
    used = {(r["entity_id"].upper(), r["key"]): r["used"] for r in span}
    for device, counter, key in [("E1", 142, 554), ("E2", 142, 554), ("W1", 569, 626), ("G1", 612, 635)]:
        for table in ("minutely", "hourly", "daily", "monthly", "yearly"):
            total = (
                full.read(table).filter((F.col("device_id") == device) & (F.col("key_id") == key)).agg(F.sum("dbl_stats")).first()[0]
            )
            assert total == pytest.approx(used[device, counter]), (device, table)


def test_carbon_and_cost(full):
    row = full.read("hourly").filter("device_id = 'E1' AND key_id = 554 AND dbl_stats > 0").first()
    assert row["kgco2e"] == row["dbl_stats"] * 0.5
    assert row["charge"] > 0
    assert full.read("minutely").filter("device_id = 'G1' AND kgco2e IS NOT NULL").count() == 0


def test_tou_shares_add_up(full):
    days = full.read("daily").filter("key_id = 554 AND charge IS NOT NULL")
    gap = F.coalesce("peak_charge", F.lit(0)) + F.coalesce("partial_peak_charge", F.lit(0)) + F.coalesce("off_peak_charge", F.lit(0))
    assert days.count() > 0
    assert days.filter(F.abs(gap - F.col("charge")) > 1e-9).count() == 0


def test_two_halves_equal_one_run(spark, estate, full):
    store = StatStore(spark, tempfile.mkdtemp(prefix="meterfold-test-"))
    run_all(until(estate, HALF), store, SCHEDULE)
    run_all(estate, store, SCHEDULE)
    for table in ("minutely", "hourly", "daily", "minute_latest", "hour_latest", "day_latest"):
        assert contents(store, table) == contents(full, table), table


def test_a_repeated_run_changes_nothing(spark, estate, full):
    tables = ("minutely", "hourly", "daily", "monthly", "yearly", "minute_latest", "hour_latest", "day_latest")
    before = {t: contents(full, t) for t in tables}
    run_all(estate, full, SCHEDULE + CALENDAR)
    assert {t: contents(full, t) for t in tables} == before


def test_open_month_is_refreshed_on_request(spark, estate):
    """A month stored early stays as it is until a refresh is asked for."""
    chain = [("minute", "other"), ("hour", "other"), ("day", "consumption"), ("month", "other")]
    store = StatStore(spark, tempfile.mkdtemp(prefix="meterfold-test-"))
    run_all(until(estate, HALF), store, chain)
    early = contents(store, "monthly")
    run_all(estate, store, chain)
    assert contents(store, "monthly") == early
    jobs.run_grain(estate, store, "month", "other", AS_OF, refresh_open=True)
    assert contents(store, "monthly") != early


def test_insert_only_refuses_a_stored_key(full):
    again = full.read("monthly").filter("device_type = 'E'").limit(1)
    before = full.read("monthly").count()
    with pytest.raises(DuplicateKeyError):
        full.owned_by("electricity").insert_only("monthly", again)
    assert full.read("monthly").count() == before


def test_watermarks_match_the_facts(full):
    own = full.read("hour_latest")
    assert watermark_drift(own, full.read("hourly"), timedelta(minutes=59, seconds=59)).count() == 0
    assert watermark_drift(own, full.read("hourly")).count() == own.count()


def test_only_stale_devices_are_due(spark, estate):
    store = StatStore(spark, tempfile.mkdtemp(prefix="meterfold-test-"))
    mark = [("E1", "E", 142, datetime(2025, 3, 1), 0), ("E2", "E", 142, datetime(2025, 4, 30, 23, 30), 0)]
    store.advance("minute_latest", spark.createDataFrame(mark, schemas.LATEST))
    jobs.minute_electricity(estate, store, AS_OF)
    assert {r["device_id"] for r in store.read("minutely").collect()} == {"E1"}


def test_baseline_older_than_the_scan(spark, estate):
    """A meter silent for months still gets the step from its last reading before the watermark."""
    store = StatStore(spark, tempfile.mkdtemp(prefix="meterfold-test-"))
    rows = [("e1", 142, epoch_ms(datetime(2024, 6, 1)), 10.0), ("e1", 142, epoch_ms(datetime(2025, 3, 1)), 25.0)]
    silent = jobs.Estate(**{**estate.__dict__, "ts_kv": spark.createDataFrame(rows, schemas.TS_KV)})
    store.advance("minute_latest", spark.createDataFrame([("E1", "E", 142, datetime(2024, 12, 1), 0)], schemas.LATEST))
    jobs.minute_electricity(silent, store, AS_OF)
    assert [(r["stat_time"], r["dbl_stats"]) for r in store.read("minutely").collect()] == [(datetime(2025, 3, 1), 15.0)]


def test_new_device_is_computed_from_its_beginning(spark, estate):
    """One series has a watermark, the other none: the second needs the files before it."""
    store = StatStore(spark, tempfile.mkdtemp(prefix="meterfold-test-"))
    mark = [("W1", "W", 626, datetime(2025, 3, 2, 0, 0, 59), 0)]
    store.advance("minute_latest", spark.createDataFrame(mark, schemas.LATEST))
    jobs.minute_other(estate, store, AS_OF)
    first = {r["device_id"]: r["t"] for r in store.read("minutely").groupBy("device_id").agg(F.min("stat_time").alias("t")).collect()}
    assert first["W1"] >= datetime(2025, 3, 2) and first["G1"] == datetime(2025, 2, 27, 5)


def test_period_rules(frame):
    from meterfold.operators.statistics import period_other

    facts = frame(
        [("W", "w", 1, "2024-01-05", 4.0, 2), ("W", "w", 1, "2024-01-06", 8.0, 4), ("W", "w", 2, "2024-01-05", 4.0, 2),
         ("W", "w", 2, "2024-01-06", 8.0, 4), ("W", "w", 3, "2024-01-06", 8.0, 4)],
        "device_type string, device_id string, key_id int, stat_time timestamp_ntz, dbl_stats double, long_stats bigint",
    ).withColumn("kgco2e", F.lit(1.0))
    names = frame([(1, CONSUMED_VOLUMES[0]), (2, FLOW_RATES[0]), (3, "other")], "key_id int, key string")
    got = {r["key_id"]: (r["dbl_stats"], r["long_stats"], r["kgco2e"]) for r in period_other(facts, names, "month").collect()}
    assert got == {1: (12.0, 6.0, 2.0), 2: (6.0, 3.0, 2.0)}
