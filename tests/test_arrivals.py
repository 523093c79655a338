"""Jobs over loads of telemetry as they arrive: nothing is lost, nothing old is read, late readings are redone."""

import random
import shutil
import tempfile
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterfold.functions.timebucket import epoch_ms
from meterfold.operators.quality import assert_unique_key
from meterfold.operators.statistics import ELECTRICITY_COEFFICIENT, FACT_KEY
from meterfold.plans import jobs
from meterfold.plans.rewind import late_arrivals, rewind, run_arrived
from meterfold.sources import schemas
from meterfold.sources.arrivals import ArrivalLog
from meterfold.sources.store import OwnershipError, StatStore

AS_OF = datetime(2025, 5, 1)
CUT = datetime(2025, 3, 3, 10, 20, 30)
# E3 and W3 die early, E4 and W4 report nothing before the second load, and W5 never does
DEVICES = [(d, d.lower(), f"P{n % 2}", d[0], None) for n, d in enumerate(["E1", "E2", "E3", "E4", "W1", "W2", "W3", "W4", "W5"])]
DEAD, BACKLOG, NEVER = {"e3", "w3"}, {"e4", "w4"}, {"w5"}
KEYS = [(142, "Energy"), (554, "ConsumedEnergy"), (630, "Active_Power"), (627, "AVG_Active_Power"), (569, "water_total_accumulated_volume"),
        (626, "water_consumed_volume"), (700, "water_flow_rate")]
SCHEDULE = [
    ("minute", "electricity", {"stale_after": None}), ("minute", "other", {}), ("hour", "electricity", {}), ("hour", "other", {}),
    ("hour", "other_rate", {}), ("day", "consumption", {}), ("day", "tou", {}), ("day", "rate", {}), ("day", "other_rate", {}),
    ("month", "electricity", {"refresh_open": True}), ("month", "other", {"refresh_open": True}),
    ("year", "electricity", {"refresh_open": True}), ("year", "other", {"refresh_open": True}),
]
FACTS = ("minutely", "hourly", "daily", "monthly", "yearly")


def readings():
    """Six days around a month's end; every meter has a counter and a rate."""
    rng, rows = random.Random(5), []
    for _, entity, _, kind, _ in DEVICES:
        if entity in NEVER:
            continue
        ts, counter = datetime(2025, 2, 27, 5), 100.0
        while ts < (datetime(2025, 2, 28, 3) if entity in DEAD else datetime(2025, 3, 5)):
            rows.append((entity, 142 if kind == "E" else 569, epoch_ms(ts), counter))
            rows.append((entity, 630 if kind == "E" else 700, epoch_ms(ts) + 250, float(rng.randrange(40))))
            ts += timedelta(seconds=rng.choice([20, 50, 600, 3000, 20000]))
            counter += rng.randrange(8)
    return rows


ROWS = readings()


@pytest.fixture(scope="module")
def dimensions(spark):
    prices = [(1, d, s, p, 2.0 + i, 1.0 + i) for i, (d, s, p) in enumerate(
        [("O", "N", "PP"), ("O", "N", "OP"), ("T", "N", "SPP"), ("T", "N", "OP"), ("S", "A", "OP")])]
    return dict(
        ts_kv=None,
        device=spark.createDataFrame(DEVICES, schemas.DEVICE),
        key_config=spark.createDataFrame([("E", 142, 554, 630, None), ("W", 569, 626, 700, None)], schemas.KEY_CONFIG),
        param=spark.createDataFrame([(i, ELECTRICITY_COEFFICIENT, 0.5, f"P{i}", "E") for i in (0, 1)], schemas.CONFIG_PARAM),
        key_dictionary=spark.createDataFrame(KEYS, schemas.KEY_DICTIONARY),
        avg_key_config=spark.createDataFrame([(630, 627), (700, 800)], schemas.AVG_KEY_CONFIG),
        device_keys=spark.createDataFrame([("E", 554, "C"), ("E", 627, "A")], schemas.DEVICE_KEYS),
        electricity_rate=spark.createDataFrame([(1, datetime(2020, 1, 1))], schemas.ELECTRICITY_RATE),
        energy_charge=spark.createDataFrame(prices, schemas.ENERGY_CHARGE),
    )


def facts_of(store, tables=FACTS):
    """The rows of each table; averages may be added up in another order."""

    def rounded(x):
        return float(f"{x:.12g}") if isinstance(x, float) else x

    return {t: sorted((tuple(map(rounded, r)) for r in store.read(t).collect()), key=str) for t in tables}


class Plant:
    """A log and a store below temporary folders."""

    def __init__(self, spark, dimensions):
        self.spark, self.root = spark, tempfile.mkdtemp(prefix="meterfold-arrivals-")
        self.log = ArrivalLog(spark, f"{self.root}/log")
        self.estate = jobs.Estate(**dimensions, arrivals=self.log)
        self.store = StatStore(spark, f"{self.root}/stats")
        self.loads = 0

    def load(self, rows):
        self.log.load(self.spark.createDataFrame(rows, schemas.TS_KV), self.loads)
        self.loads += 1

    def run(self, schedule=SCHEDULE):
        return run_arrived(self.estate, self.store, AS_OF, schedule)

    def contents(self, tables=FACTS):
        return facts_of(self.store, tables)


@pytest.fixture(scope="module")
def whole(spark, dimensions):
    plant = Plant(spark, dimensions)
    plant.load(ROWS)
    plant.run()
    return plant.contents()


def early(row):
    return row[2] < epoch_ms(CUT) and row[0] not in BACKLOG


def test_one_load_equals_the_jobs_on_a_table(spark, dimensions, whole):
    store = StatStore(spark, tempfile.mkdtemp(prefix="meterfold-test-"))
    estate = jobs.Estate(**{**dimensions, "ts_kv": spark.createDataFrame(ROWS, schemas.TS_KV)})
    for grain, measure, options in SCHEDULE:
        jobs.run_grain(estate, store, grain, measure, AS_OF, **options)
    assert facts_of(store) == whole


def test_dead_silent_and_backlogged_meters_cost_no_old_file(spark, dimensions, whole):
    """The second run works without the files that hold only what was read before."""
    plant = Plant(spark, dimensions)
    plant.load([r for r in ROWS if early(r)])
    plant.run()
    plant.load([r for r in ROWS if not early(r)])
    # the open production day of a meter that reported before eight began on the second
    old = [p for p in Path(plant.root).glob("log/telemetry/arrival=0/date=*") if p.name < "date=2025-03-02"]
    assert len(old) == 3
    for folder in old:
        shutil.rmtree(folder)
    plant.run()
    assert plant.contents() == whole
    for table in FACTS:
        assert_unique_key(plant.store.read(table), FACT_KEY)
    # and a run for which nothing has arrived reads no telemetry at all
    shutil.rmtree(f"{plant.root}/log/telemetry")
    plant.run()
    assert plant.contents() == whole


def test_late_readings_are_redone_in_every_grain(spark, dimensions, whole):
    """Every ninth reading of the first days comes with the second load only."""
    plant = Plant(spark, dimensions)
    on_time = [r for n, r in enumerate(ROWS) if early(r) and n % 9]
    late = [r for n, r in enumerate(ROWS) if not (early(r) and n % 9)]
    plant.load(on_time)
    plant.run()
    before = plant.contents()
    assert before["daily"] != whole["daily"]
    plant.load(late)
    found = late_arrivals(plant.estate, plant.store)
    assert found.count() > 0
    moved = rewind(plant.estate, plant.store, found)
    assert moved > 0 and rewind(plant.estate, plant.store, found) == 0
    plant.run()
    assert plant.contents() == whole


def test_late_readings_outlive_the_watermarks_they_were_found_by(spark, dimensions):
    """What was found late is the same rows after a rewind has replaced the files of the watermarks."""
    steps = [("w1", 569, epoch_ms(datetime(2025, 3, d, h)), 100.0 * d + h) for d in (1, 2, 3) for h in (9, 10, 15)]
    plant, chain = Plant(spark, dimensions), [("minute", "other", {})]
    plant.load([r for n, r in enumerate(steps) if n != 4])
    plant.run(chain)
    plant.load(steps[4:5])
    found = late_arrivals(plant.estate, plant.store)
    rows = found.collect()
    assert [(r["entity_id"], r["key_id"], r["ts"]) for r in rows] == [("w1", 569, datetime(2025, 3, 2, 10))]
    assert rewind(plant.estate, plant.store, found) == 1
    assert found.select("*").collect() == rows
    assert rewind(plant.estate, plant.store, found) == 0


def test_late_readings_of_a_closed_month_and_year(spark, dimensions):
    def steps(months):
        return [("w1", 569, epoch_ms(datetime(2024 + (m - 1) // 12, (m - 1) % 12 + 1, d, h)), 100.0 * m + d + h / 24) for m in months for d in (3, 20) for h in (9, 15)]

    chain = [(g, m, {}) for g, m, _ in SCHEDULE if m in ("other", "consumption")]
    one, two = Plant(spark, dimensions), Plant(spark, dimensions)
    one.load(steps([1, 2, 3, 11, 12, 13, 14]))
    one.run(chain)
    two.load(steps([1, 3, 11, 12, 13, 14]))
    two.run(chain)
    assert two.contents(("monthly",)) != one.contents(("monthly",))
    two.load(steps([2]))
    two.run(chain)
    assert two.contents(("minutely", "hourly", "daily", "monthly", "yearly")) == one.contents()


def test_meters_that_are_not_stale_are_not_lost(spark, dimensions):
    """What comes for a meter that sits a run out is read by the next one."""
    rows = [(e, 142, epoch_ms(datetime(2025, 3, 1) + timedelta(minutes=7 * n)), float(n * n)) for e in ("e1", "e2") for n in range(60)]
    want, plant = Plant(spark, dimensions), Plant(spark, dimensions)
    want.load(rows)
    plant.load(rows[:20] + rows[60:80])
    for p in (want, plant):
        jobs.minute_electricity(p.estate, p.store, AS_OF, None)
    plant.load([r for r in rows if r[0] == "e1"][20:40])
    jobs.minute_electricity(plant.estate, plant.store, datetime(2025, 3, 1, 2, 30))  # nobody is due
    assert plant.store.read("minutely").count() == 38
    plant.load([r for r in rows if r[0] == "e2"][20:] + [r for r in rows if r[0] == "e1"][40:])
    jobs.minute_electricity(plant.estate, plant.store, AS_OF)
    assert plant.contents(("minutely",)) == want.contents(("minutely",))


def test_a_watermark_set_from_outside(spark, dimensions):
    rows = [("e1", 142, epoch_ms(datetime(2025, 3, d, 1)), 10.0 * d * d) for d in range(1, 20)]
    plant = Plant(spark, dimensions)
    plant.load([("e2", 142, epoch_ms(datetime(2025, 3, 1)), 1.0), *rows[:10]])
    jobs.minute_electricity(plant.estate, plant.store, AS_OF)  # without watermarks nobody is due
    assert plant.store.read("minutely").count() == 0
    mark = spark.createDataFrame([("E1", "E", 142, datetime(2025, 3, 5, 0, 0, 57), 0)], schemas.LATEST)
    plant.store.advance("minute_latest", mark)
    plant.load(rows[10:])
    jobs.minute_electricity(plant.estate, plant.store, AS_OF)
    got = {r["stat_time"].day: r["dbl_stats"] for r in plant.store.read("minutely").collect()}
    assert got == {d: 10.0 * (2 * d - 1) for d in range(5, 20)}


def test_a_load_again_replaces_itself(spark):
    log = ArrivalLog(spark, tempfile.mkdtemp(prefix="meterfold-test-"))
    rows = spark.createDataFrame([("a", 1, epoch_ms(datetime(2025, 1, d)), 1.0) for d in (1, 2)], schemas.TS_KV)
    assert log.newest() is None
    for _ in range(2):
        log.load(rows, 0)
    log.load(rows.limit(1), 1)
    assert log.newest() == 1 and log.values(1).count() == 3 and log.values(0).count() == 2
    assert log.values(1, after=0).count() == 1 and log.values(1, start=datetime(2025, 1, 2)).count() == 1
    seen = log.seen(1).first()
    assert (seen["first_ms"], seen["first_arrival"]) == (epoch_ms(datetime(2025, 1, 1)), 0)


def test_files_are_followed_once(spark):
    root = tempfile.mkdtemp(prefix="meterfold-test-")
    log = ArrivalLog(spark, f"{root}/log")
    for day in (1, 2):
        rows = spark.createDataFrame([("a", 1, epoch_ms(datetime(2025, 1, day)), 1.0)], schemas.TS_KV)
        rows.coalesce(1).write.mode("append").parquet(f"{root}/raw")
        raw = spark.readStream.schema(schemas.TS_KV).parquet(f"{root}/raw")
        log.follow(raw, f"{root}/checkpoint").awaitTermination()
    assert log.newest() == 1 and log.values(1).count() == 2 and log.arrived(0, 1).count() == 1


def test_a_measure_has_one_owner(spark):
    root = tempfile.mkdtemp(prefix="meterfold-test-")
    row = "device_type string, device_id string, key_id int, stat_time timestamp_ntz, dbl_stats double"

    def facts(device, key):
        return spark.createDataFrame([("W", device, key, datetime(2025, 3, 1), 1.0)], row)

    job, stream = StatStore(spark, root, "other_rate"), StatStore(spark, root, "stream")
    job.upsert("hourly", facts("w1", 700), ["dbl_stats"])
    for device in ("w1", "w2"):
        with pytest.raises(OwnershipError, match="other_rate"):
            stream.upsert("hourly", facts(device, 700), ["dbl_stats"])
    stream.upsert("hourly", facts("w1", 701), ["dbl_stats"])
    StatStore(spark, root, "other_rate").upsert("hourly", facts("w1", 700), ["dbl_stats"])
    assert job.read("hourly").count() == 2


def test_a_rewound_mark_is_one_row(spark, dimensions):
    plant = Plant(spark, dimensions)
    plant.load([r for r in ROWS if r[0] == "w1"])
    plant.run([("hour", "other_rate", {})])
    late = spark.createDataFrame([("w1", 700, datetime(2025, 3, 1, 3, 5))], "entity_id string, key_id int, ts timestamp_ntz")
    assert rewind(plant.estate, plant.store, late) == 1
    [mark] = plant.store.read("hour_latest").collect()
    assert mark["latest_stat_time"] == datetime(2025, 3, 1, 3, 59, 59) and mark["redo_until"] > mark["latest_stat_time"]
    before = plant.contents(("hourly",))
    plant.run([("hour", "other_rate", {})])
    [mark] = plant.store.read("hour_latest").collect()
    assert mark["redo_until"] is None and plant.contents(("hourly",)) == before
