"""Registered queries: every operator on the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold.catalog.views import EXCLUDED, SERIES, TABLES, Views
from meterfold.functions import period, timebucket
from meterfold.operators import carbon, consumption, incremental, quality, statistics, tariff
from meterfold.plans.jobs import Estate, run_grain
from meterfold.plans.rewind import rewind, run_arrived
from meterfold.session import fresh_path, materialise
from meterfold.sources import maintenance, telemetry
from meterfold.sources.arrivals import ArrivalLog
from meterfold.sources.store import StatStore
from meterfold.streaming.bucket_stats import stream_bucket_stats, upsert_stream
from meterfold.streaming.buckets import BucketStream, average_series, rate_series
from meterfold.streaming.delta import DeltaStream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

START, END = datetime(2024, 1, 5, 6, 30), datetime(2024, 1, 20, 12, 0)
HOUR_MARK = "INTERVAL '59:59' MINUTE TO SECOND"
DAY_MARK = "INTERVAL '07:59:59' HOUR TO SECOND"


def query(run: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    QUERIES[run.__name__] = lambda spark, sf_dir: run(Views(spark, sf_dir))
    return run


def thousandths(c: str) -> Column:
    """An average of averages, comparable across engines that add in another order."""
    return F.floor(F.col(c) * 1000 + 0.5).cast("bigint").alias(c)


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def eligible(v: Views, **choice) -> DataFrame:
    return telemetry.eligible_devices(v.device, exclude_factories=EXCLUDED, **choice)


# A: sources and selection


@query
def a1_readings(v: Views) -> DataFrame:
    values = telemetry.telemetry_values(v.ts_kv)
    found = telemetry.readings(values, eligible(v), v.key_config, "accumulation")
    return found.select("device_id", "device_type", "key_id", "consumption_key_id", "ts_ms", "ts", "value")


@query
def a1_readings_rate(v: Views) -> DataFrame:
    values = telemetry.telemetry_values(v.ts_kv, datetime(2024, 1, 8), datetime(2024, 1, 22))
    found = telemetry.readings(values, eligible(v), v.key_config, "rate")
    return found.select("device_id", "key_id", "ts_ms", "value")


@query
def a2_epoch(v: Views) -> DataFrame:
    return v.ts_kv.select(
        "entity_id", "key", F.col("ts").alias("ts_ms"), timebucket.epoch_ms_to_ts(F.col("ts")).alias("ts")
    )


@query
def a3_eligible(v: Views) -> DataFrame:
    return eligible(v).select("device_id", "factory_id", "device_type")


@query
def a3_eligible_other(v: Views) -> DataFrame:
    chosen = telemetry.eligible_devices(v.device, types=telemetry.OTHER_UTILITIES, exclude_factories=())
    return chosen.groupBy("device_type", "factory_id").agg(F.count(F.lit(1)).alias("n"))


@query
def a4_stale(v: Views) -> DataFrame:
    electric = eligible(v, types=telemetry.ELECTRICITY)
    due = telemetry.stale_devices(electric, v.latest(142), 142, datetime(2024, 1, 12, 1, 0, 57))
    return due.select("device_id", "device_type", "latest_stat_time")


@query
def a5_map_keys(v: Views) -> DataFrame:
    mapped = telemetry.map_measure_keys(v.readings, v.avg_key_config)
    return mapped.select("event_id", "entity_id", "key_id", "ts", "value_c")


@query
def a6_named_keys(v: Views) -> DataFrame:
    named = telemetry.filter_named_keys(v.readings, v.key_dictionary, statistics.ELECTRICITY_MEASURES)
    return named.groupBy("entity_id", "key_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value_c").alias("sum_c"))


@query
def a7_node_map(v: Views) -> DataFrame:
    """Suppliers stand for the reference data that assigns devices to nodes."""
    devices = v.device.select("device_id", F.concat(F.lit("D"), "device_id").alias("node_id"))
    mapping = v.table("supplier").select(
        F.col("s_suppkey").alias("device_id"), F.concat(F.lit("N"), "s_nationkey", F.lit("-"), "s_suppkey").alias("node_id")
    )
    return telemetry.apply_node_mapping(devices, mapping).select("device_id", "node_id")


@query
def a8_retain(v: Views) -> DataFrame:
    return telemetry.retain_recent(v.ts_kv, datetime(2024, 1, 15))


@query
def a9_drop_logs(v: Views) -> DataFrame:
    """Event names become log texts; purchases carry none."""
    marked = F.when(F.col("event_type") != "purchase", F.concat(F.lit("x|"), F.upper("event_type"), F.lit("|y")))
    hot = v.table("events").select("event_id", marked.alias("str_v"))
    return telemetry.drop_log_rows(hot)


def _hot(v: Views) -> str:
    """Events as a stored hot table by date, purchases without a text."""
    marked = F.when(F.col("event_type") != "purchase", F.concat(F.lit("x|"), F.upper("event_type"), F.lit("|y")))
    rows = v.table("events").select(
        "event_id", timebucket.ts_to_epoch_ms(F.col("ts")).alias("ts"), marked.alias("str_v"), F.to_date("ts").alias("date")
    )
    path = fresh_path(v.spark, "hot")
    rows.write.partitionBy("date").parquet(path)
    return path


@query
def a8_retain_stored(v: Views) -> DataFrame:
    """What is left of a stored table, and the number of folders that were dropped and rewritten for it."""
    path = _hot(v)
    changes = maintenance.retain(v.spark, path, datetime(2024, 1, 15))
    counts = {"dropped": F.lit(len(changes.dropped)), "rewritten": F.lit(len(changes.rewritten))}
    return longs(v.spark.read.parquet(path).select("event_id").withColumns(counts), "dropped", "rewritten")


@query
def a9_drop_logs_stored(v: Views) -> DataFrame:
    path = _hot(v)
    maintenance.drop_logs(v.spark, path)
    return v.spark.read.parquet(path).select("event_id", "str_v")


# B: time bucketing


def _bucket_counts(df: DataFrame, bucket: Column, value: str) -> DataFrame:
    return df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("sum_c"))


def _register_buckets(name: str, grain: str, source: str) -> None:
    def run(v: Views) -> DataFrame:
        return _bucket_counts(getattr(v, source), timebucket.calendar_bucket(F.col("ts"), grain), "value_c")

    run.__name__ = name
    query(run)


for _grain, _source in [
    ("minute", "readings"),
    ("hour", "readings"),
    ("day", "readings"),
    ("month", "clock"),
    ("year", "clock"),
]:
    _register_buckets(f"b1_{_grain}", _grain, _source)


@query
def b2_production_day(v: Views) -> DataFrame:
    return _bucket_counts(v.clock, timebucket.production_day(F.col("ts")), "value_c")


@query
def b3_grain_bucket(v: Views) -> DataFrame:
    day = timebucket.grain_bucket(F.col("ts"), "day").alias("day_bucket")
    hour = timebucket.grain_bucket(F.col("ts"), "hour").alias("hour_bucket")
    return v.readings.select("event_id", day, hour)


@query
def b4_log_day(v: Views) -> DataFrame:
    return _bucket_counts(v.readings, timebucket.log_day(F.col("ts")), "value_c")


@query
def b7_half_open(v: Views) -> DataFrame:
    buckets = v.readings.select("event_id", timebucket.calendar_bucket(F.col("ts"), "hour").alias("bucket"))
    return timebucket.half_open(buckets, "bucket", datetime(2024, 1, 5), datetime(2024, 1, 9, 3))


@query
def b8_stat_type(v: Views) -> DataFrame:
    codes = [timebucket.stat_type(g).cast("bigint").alias(g) for g in timebucket.STAT_TYPE]
    return v.readings.select("event_id", *codes)


# C: consumption


@query
def c1_delta(v: Views) -> DataFrame:
    return consumption.reading_delta(v.readings_reset, SERIES).select("event_id", "entity_id", "key_id", "ts", "delta")


@query
def c1_delta_nulls(v: Views) -> DataFrame:
    return consumption.reading_delta(v.readings_nulls, SERIES).select("event_id", "entity_id", "key_id", "ts", "delta")


@query
def c1_delta_skip_nulls(v: Views) -> DataFrame:
    deltas = consumption.reading_delta(v.readings_nulls, SERIES, skip_nulls=True)
    return deltas.select("event_id", "entity_id", "key_id", "ts", "delta")


@query
def c1_delta_per_minute(v: Views) -> DataFrame:
    return consumption.delta_per_bucket(v.readings_reset, SERIES, "minute")


@query
def c1_delta_per_hour_nulls(v: Views) -> DataFrame:
    return consumption.delta_per_bucket(v.readings_nulls, SERIES, "hour")


def _register_consumption(grain: str) -> None:
    def run(v: Views) -> DataFrame:
        return consumption.bucket_consumption_min(v.counter, grain, SERIES)

    run.__name__ = f"c2_{grain}"
    query(run)


for _grain in timebucket.STAT_TYPE:
    _register_consumption(_grain)


@query
def c2_hour_range(v: Views) -> DataFrame:
    return consumption.bucket_consumption_min(v.readings_nulls, "hour", SERIES, START, END)


@query
def c3_hour(v: Views) -> DataFrame:
    spans = consumption.bucket_consumption_first(v.readings_nulls, "hour", SERIES)
    return spans.select("entity_id", "key_id", "period_start", "energy_start", "energy_end", "consumption")


@query
def c3_day(v: Views) -> DataFrame:
    spans = consumption.bucket_consumption_first(
        v.readings_nulls, "day", SERIES, START, END, key_config=v.key_config
    )
    return spans.select(
        "entity_id", "period_start", "energy_start", "energy_end", "consumption", "consumption_key_id"
    )


@query
def c3_shared_key(v: Views) -> DataFrame:
    """One counter key under two device types: the type decides what its consumption is called."""
    shared = v.key_config.withColumn("accumulation_key_id", F.lit(142)).filter(F.col("device_type").isin("E", "W"))
    typed = v.readings_nulls.join(v.device.select("entity_id", "device_type"), "entity_id")
    series = SERIES.renamed(keys=("entity_id", "device_type", "key_id"))
    spans = consumption.bucket_consumption_first(typed, "day", series, key_config=shared)
    return spans.select("entity_id", "device_type", "period_start", "consumption", "consumption_key_id")


@query
def c4_daily(v: Views) -> DataFrame:
    return consumption.daily_consumption(
        v.readings_nulls, date(2024, 1, 30), SERIES, date(2024, 1, 3), date(2024, 1, 31)
    )


@query
def c5_fleet(v: Views) -> DataFrame:
    latest = v.latest_by_role("consumption", HOUR_MARK)
    return consumption.fleet_consumption(v.counter, eligible(v), v.key_config, "hour", latest, SERIES)


@query
def c5_fleet_production_day(v: Views) -> DataFrame:
    latest = v.latest_by_role("consumption", DAY_MARK)
    return consumption.fleet_consumption(v.counter, eligible(v), v.key_config, "day", latest, SERIES)


@query
def c6_open_bucket(v: Views) -> DataFrame:
    return consumption.open_bucket(v.readings_nulls, "day", SERIES)


# D: tariff


@query
def d1_period(v: Views) -> DataFrame:
    labelled = v.clock.select("id", period.period_type(F.col("ts")).alias("period"))
    return labelled.select("id", "period")


@query
def d2_day_season(v: Views) -> DataFrame:
    at = F.col("ts")
    return v.clock.groupBy(period.day_type(at).alias("day_type"), period.season_type(at).alias("season_type")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value_c").alias("sum_c")
    )


@query
def d4_closed(v: Views) -> DataFrame:
    return v.clock.select("id", period.rate_period_closed(F.col("ts")).alias("period"))


@query
def d3_rate(v: Views) -> DataFrame:
    return tariff.with_electricity_rate(v.clock, "ts", v.electricity_rate, v.energy_charge).select("id", "charge_rate")


@query
def d3_rate_closed(v: Views) -> DataFrame:
    priced = tariff.with_electricity_rate(v.clock, "ts", v.electricity_rate, v.energy_charge, closed=True)
    return priced.select("id", "charge_rate")


@query
def d5_charge_info(v: Views) -> DataFrame:
    """The price of each hour that has orders; versions after the first, so early hours have none."""
    hours = v.clock.select(timebucket.calendar_bucket(F.col("ts"), "hour").alias("usage_time")).distinct()
    later = v.electricity_rate.filter(F.col("id") > 1)
    return tariff.with_charge_info(hours, "usage_time", later, v.energy_charge).select(
        "usage_time", "period_type", "charge_rate"
    )


def _priced_clock(v: Views) -> DataFrame:
    priced = tariff.with_charge_info(v.clock, "ts", v.electricity_rate, v.energy_charge)
    return priced.withColumn("charge", tariff.charge(F.col("value_c"), F.col("charge_rate")))


@query
def d6_charge(v: Views) -> DataFrame:
    return _priced_clock(v).select("id", "charge")


@query
def d7_tou_split(v: Views) -> DataFrame:
    orders = v.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("device_id"))
    hourly = (
        _priced_clock(v)
        .join(orders, "id")
        .join(v.device.select("device_id", "device_type"), "device_id")
        .select(
            F.col("ts").alias("stat_time"),
            "device_id",
            "device_type",
            F.lit(554).alias("key_id"),
            F.col("value_c").alias("dbl_stats"),
            "charge",
            "period_type",
        )
    )
    return longs(tariff.tou_split(hourly), "key_id", "stat_type")


# E: carbon


def _hourly_fleet(v: Views) -> DataFrame:
    return consumption.fleet_consumption(v.counter, eligible(v), v.key_config, "hour", None, SERIES)


@query
def e1_carbon(v: Views) -> DataFrame:
    return carbon.carbon_by_device_type(_hourly_fleet(v), v.param).select(
        "device_id", "key_id", "stat_time", "consumption", "kgco2e"
    )


@query
def e2_carbon_named(v: Views) -> DataFrame:
    return carbon.carbon_by_param_name(_hourly_fleet(v), v.param, "power_coeff").select(
        "device_id", "key_id", "stat_time", "consumption", "kgco2e"
    )


@query
def e3_carbon_rollup(v: Views) -> DataFrame:
    emitted = carbon.carbon_by_device_type(_hourly_fleet(v), v.param)
    return emitted.groupBy(
        "device_id", "key_id", timebucket.calendar_bucket(F.col("stat_time"), "month").alias("stat_time")
    ).agg(F.sum("kgco2e").alias("kgco2e"))


# F: statistics per grain


def _electric(v: Views) -> DataFrame:
    return eligible(v, types=telemetry.ELECTRICITY)


def _others(v: Views) -> DataFrame:
    return eligible(v, exclude_types=telemetry.ELECTRICITY)


def _minutely_other(v: Views, latest: DataFrame | None = None) -> DataFrame:
    return statistics.minute_other(v.counter, _others(v), v.key_config, v.param, latest, SERIES)


def _hourly_electric(v: Views, latest: DataFrame | None = None) -> DataFrame:
    return statistics.hour_electricity(
        v.counter, _electric(v), v.key_config, v.param, v.electricity_rate, v.energy_charge, latest, SERIES
    )


@query
def f1_minute_electricity(v: Views) -> DataFrame:
    facts = statistics.minute_electricity(
        v.readings_reset, _electric(v), v.param, v.latest(142), SERIES, "power_coeff"
    )
    return longs(facts, "key_id", "stat_type")


@query
def f2_minute_other(v: Views) -> DataFrame:
    latest = v.latest_by_role("consumption", "INTERVAL 59 SECONDS")
    return longs(_minutely_other(v, latest), "key_id", "stat_type")


@query
def f3_hour_electricity(v: Views) -> DataFrame:
    return longs(_hourly_electric(v, v.latest(554, HOUR_MARK)), "key_id", "stat_type")


@query
def f4_hour_other(v: Views) -> DataFrame:
    latest = v.latest_by_role("consumption", HOUR_MARK)
    facts = statistics.hour_other(_minutely_other(v), _others(v), v.key_config, latest)
    return longs(facts, "key_id", "stat_type")


@query
def f5_hour_rate_other(v: Views) -> DataFrame:
    latest = v.latest_by_role("rate", HOUR_MARK)
    facts = statistics.hour_rate_other(v.readings, _others(v), v.key_config, latest, SERIES)
    return longs(facts, "key_id", "stat_type")


def _hourly(v: Views) -> DataFrame:
    """Hourly facts of all utilities, consumption doubled as the integer statistic."""
    columns = [*statistics.FACT_KEY, "dbl_stats"]
    electric = _hourly_electric(v).select(*columns)
    others = statistics.hour_other(_minutely_other(v), _others(v), v.key_config).select(*columns)
    return electric.unionByName(others).withColumn("long_stats", F.col("dbl_stats") * 2)


def _day_profile(v: Views, latest: DataFrame | None = None) -> DataFrame:
    return statistics.day_profile(_hourly(v), eligible(v), v.key_config, latest)


@query
def f6_day_profile(v: Views) -> DataFrame:
    return longs(_day_profile(v, v.latest_by_role("consumption", DAY_MARK)), "key_id", "stat_type")


@query
def f7_day_consumption(v: Views) -> DataFrame:
    """Profiles from each watermark on, updated with the consumption of all days."""
    profile = _day_profile(v, v.latest_by_role("consumption", DAY_MARK)).withColumns(
        {"dbl_stats": F.lit(None).cast("bigint"), "kgco2e": F.lit(None).cast("bigint")}
    )
    consumed = statistics.day_consumption(v.counter, eligible(v), v.key_config, v.param, None, SERIES)
    day = incremental.update_only(profile, consumed, statistics.FACT_KEY, ["dbl_stats", "kgco2e"])
    return longs(day.select(*statistics.FACT_KEY, "dbl_min", "dbl_max", "dbl_stats", "kgco2e"), "key_id")


@query
def f8_day_rate(v: Views) -> DataFrame:
    facts = statistics.day_rate(
        v.readings,
        eligible(v),
        v.avg_key_config,
        v.key_dictionary,
        v.latest_averages(DAY_MARK),
        SERIES,
        default_start=datetime(2024, 1, 9),
    )
    return longs(facts, "key_id", "stat_type")


@query
def f9_day_rate_other(v: Views) -> DataFrame:
    latest = v.latest_by_role("rate", HOUR_MARK)
    facts = statistics.day_rate_other(v.readings, _others(v), v.key_config, latest, SERIES)
    return longs(facts, "key_id", "stat_type")


@query
def f14_run_grain(v: Views) -> DataFrame:
    """The scheduled minute and hour runs of the other utilities, from telemetry to stored facts."""
    estate = Estate(
        ts_kv=v.as_telemetry(v.counter),
        device=v.device.withColumn("device_id", F.col("device_id").cast("string")),
        key_config=v.key_config,
        param=v.param,
        exclude_factories=EXCLUDED,
    )
    store = StatStore(v.spark, fresh_path(v.spark, "stats"))
    for grain in ("minute", "hour"):
        run_grain(estate, store, grain, "other", datetime(2024, 2, 1))
    columns = [*statistics.FACT_KEY, "stat_type", "dbl_stats", "dbl_avg", "dbl_min", "dbl_max", "kgco2e"]
    return longs(store.read("hourly").select(*columns), "device_id", "key_id", "stat_type")


FIRST_RUN = datetime(2024, 1, 17, 10, 20, 30)
AS_OF = datetime(2024, 2, 1)


def _twice(v: Views, schedule: list[tuple[str, str, dict]]) -> StatStore:
    """The scheduled runs on the telemetry up to a cut, and once more on all of it."""
    store = StatStore(v.spark, fresh_path(v.spark, "stats"))
    for readings in (v.counter.filter(F.col("ts") < timebucket.timestamp_literal(FIRST_RUN)), v.counter):
        estate = Estate(
            ts_kv=v.as_telemetry(readings),
            device=v.device.withColumn("device_id", F.col("device_id").cast("string")),
            key_config=v.key_config,
            param=v.param,
            key_dictionary=v.key_dictionary,
            avg_key_config=v.avg_key_config,
            electricity_rate=v.electricity_rate,
            energy_charge=v.energy_charge,
            exclude_factories=EXCLUDED,
        )
        for grain, measure, options in schedule:
            run_grain(estate, store, grain, measure, AS_OF, **options)
    return store


MINUTES = [("minute", "electricity", {"stale_after": None, "param_name": "power_coeff"}), ("minute", "other", {})]
HOURS = [("minute", "other", {}), ("hour", "electricity", {}), ("hour", "other", {}), ("hour", "other_rate", {})]
DAYS = [
    *HOURS[:3],
    ("day", "consumption", {}),
    ("day", "tou", {}),
    ("day", "rate", {"default_start": datetime(2023, 12, 1)}),
    ("day", "other_rate", {}),
]


@query
def f14_minute_runs(v: Views) -> DataFrame:
    """Both minute jobs, each run twice, equal one run over everything."""
    facts = _twice(v, MINUTES).read("minutely")
    return longs(facts.select(*statistics.FACT_KEY, "stat_type", "dbl_stats", "kgco2e"), "device_id", "key_id", "stat_type")


@query
def f14_hour_runs(v: Views) -> DataFrame:
    columns = ["stat_type", "dbl_stats", "dbl_avg", "dbl_min", "dbl_max", "charge", "period_type", "kgco2e"]
    facts = _twice(v, HOURS).read("hourly")
    return longs(facts.select(*statistics.FACT_KEY, *columns), "device_id", "key_id", "stat_type")


@query
def f14_day_runs(v: Views) -> DataFrame:
    columns = ["stat_type", "dbl_stats", "dbl_avg", "dbl_min", "dbl_max", *statistics.TOU_COLUMNS, "kgco2e"]
    facts = _twice(v, DAYS).read("daily")
    return longs(facts.select(*statistics.FACT_KEY, *columns), "device_id", "key_id", "stat_type")


# In the first load one meter in five is silent and every ninth reading is missing; both come with the second.
def _punctual(v: Views) -> Column:
    on_time = (F.col("ts") < timebucket.timestamp_literal(FIRST_RUN)) & (F.col("event_id") % 9 != 4)
    return on_time & (F.col("entity_id") % 5 != 3)


def _arriving(v: Views) -> ArrivalLog:
    telemetry = v.as_telemetry(v.counter)
    return ArrivalLog(v.spark, fresh_path(v.spark, "arrivals"), telemetry.schema)


def _in_two_loads(v: Views, schedule: list[tuple[str, str, dict]]) -> StatStore:
    """The scheduled runs after each of two loads; what the second brings too late is redone."""
    log, store = _arriving(v), StatStore(v.spark, fresh_path(v.spark, "stats"))
    estate = Estate(
        ts_kv=None,
        device=v.device.withColumn("device_id", F.col("device_id").cast("string")),
        key_config=v.key_config,
        param=v.param,
        key_dictionary=v.volumes,
        avg_key_config=v.avg_key_config,
        device_keys=v.consumed_keys,
        electricity_rate=v.electricity_rate,
        energy_charge=v.energy_charge,
        arrivals=log,
        exclude_factories=EXCLUDED,
    )
    counter = materialise(v.counter, "arriving")
    for number, load in enumerate((counter.filter(_punctual(v)), counter.filter(~_punctual(v)))):
        log.load(v.as_telemetry(load), number)
        run_arrived(estate, store, AS_OF, schedule)
    return store


@query
def a1_arrival_log(v: Views) -> DataFrame:
    """First reading and first load of every series, from the loads' summaries."""
    log = _arriving(v)
    for number, chosen in enumerate((_punctual(v), ~_punctual(v))):
        log.load(v.as_telemetry(v.counter.filter(chosen)), number)
    return longs(log.seen(log.newest()), "key_id")


@query
def i3_redone_minutes(v: Views) -> DataFrame:
    """Late readings and backlogs: minutes after a rewind equal one run over everything."""
    facts = _in_two_loads(v, MINUTES).read("minutely")
    return longs(facts.select(*statistics.FACT_KEY, "stat_type", "dbl_stats", "kgco2e"), "device_id", "key_id", "stat_type")


@query
def i3_redone_hours(v: Views) -> DataFrame:
    columns = ["stat_type", "dbl_stats", "dbl_avg", "dbl_min", "dbl_max", "charge", "period_type", "kgco2e"]
    facts = _in_two_loads(v, HOURS).read("hourly")
    return longs(facts.select(*statistics.FACT_KEY, *columns), "device_id", "key_id", "stat_type")


@query
def i3_redone_days(v: Views) -> DataFrame:
    columns = ["stat_type", "dbl_stats", "dbl_avg", "dbl_min", "dbl_max", *statistics.TOU_COLUMNS, "kgco2e"]
    facts = _in_two_loads(v, DAYS).read("daily")
    return longs(facts.select(*statistics.FACT_KEY, *columns), "device_id", "key_id", "stat_type")


CALENDAR = [*DAYS[:5], *((g, m, {"refresh_open": True}) for g in ("month", "year") for m in ("electricity", "other"))]


def _redone_periods(v: Views, table: str) -> DataFrame:
    columns = ["dbl_stats", *statistics.TOU_COLUMNS, "kgco2e"]
    return longs(_in_two_loads(v, CALENDAR).read(table).select(*statistics.FACT_KEY, *columns), "device_id", "key_id")


@query
def i3_redone_months(v: Views) -> DataFrame:
    """Months up to the newest one, among them those before it that late readings fall into."""
    return _redone_periods(v, "monthly")


@query
def i3_redone_years(v: Views) -> DataFrame:
    return _redone_periods(v, "yearly")


def _calendar_runs(v: Views, table: str) -> DataFrame:
    """Months and years rolled up when the days before 1998 are stored, and again when all are."""
    store = StatStore(v.spark, fresh_path(v.spark, "stats"))
    estate = Estate(
        ts_kv=None,
        device=v.device.withColumn("device_id", F.col("device_id").cast("string")),
        key_config=v.key_config,
        param=v.param,
        key_dictionary=v.key_dictionary,
        device_keys=v.device_keys,
        exclude_factories=EXCLUDED,
    )
    daily = v.daily.withColumn("device_id", F.col("device_id").cast("string")).withColumn("stat_type", timebucket.stat_type("day"))
    for days in (_stored(daily), daily):
        stored, _ = store.upsert("daily", days, ["dbl_stats", "long_stats", *statistics.TOU_COLUMNS, "kgco2e"])
        store.advance("day_latest", incremental.advance_watermark(stored, incremental.WATERMARK_OFFSET["day"]))
        for grain in ("month", "year"):
            for measure in ("electricity", "other"):
                # the year in which the first run ends is open then and redone by the second
                run_grain(estate, store, grain, measure, AS_OF, refresh_open=grain == "year")
    columns = [thousandths("dbl_stats"), *[F.col(c).cast("bigint").alias(c) for c in (*statistics.TOU_COLUMNS, "kgco2e")]]
    return longs(store.read(table).select(*statistics.FACT_KEY, *columns), "device_id", "key_id")


@query
def f14_month_runs(v: Views) -> DataFrame:
    return _calendar_runs(v, "monthly")


@query
def f14_year_runs(v: Views) -> DataFrame:
    return _calendar_runs(v, "yearly")


@query
def g3_repeated_runs(v: Views) -> DataFrame:
    """Two parameters per plant and utility, three runs: every fact stays one row."""
    doubled = v.param.withColumn("param_id", F.lit(1)).unionByName(
        v.param.withColumns({"param_id": F.lit(2), "float_value": F.col("float_value") + 7})
    )
    store = StatStore(v.spark, fresh_path(v.spark, "stats"))
    hours = statistics.hour_electricity(
        v.counter, _electric(v), v.key_config, doubled, v.electricity_rate, v.energy_charge, None, SERIES
    )
    for _ in range(3):
        store.upsert("hourly", hours, ["dbl_stats", "charge", "period_type", "kgco2e"])
    columns = [*statistics.FACT_KEY, "dbl_stats", "charge", "period_type", "kgco2e"]
    return longs(store.read("hourly").select(*columns), "device_id", "key_id")


STORED_UNTIL = datetime(1998, 1, 1)


def _stored(facts: DataFrame) -> DataFrame:
    return facts.filter(F.col("stat_time") < timebucket.timestamp_literal(STORED_UNTIL))


@query
def f10_month_electricity(v: Views) -> DataFrame:
    """Months after the newest stored one; those before 1998 are stored."""
    months = statistics.period_electricity(v.daily, v.device_keys, "month")
    stored = statistics.period_electricity(_stored(v.daily), v.device_keys, "month")
    return longs(incremental.beyond_high_water(months, stored, "month"), "key_id", "stat_type")


@query
def f11_month_other(v: Views) -> DataFrame:
    months = statistics.period_other(v.daily, v.key_dictionary, "month")
    stored = statistics.period_other(_stored(v.daily), v.key_dictionary, "month")
    return longs(incremental.beyond_high_water(months, stored, "month"), "key_id", "stat_type")


@query
def f12_year_electricity(v: Views) -> DataFrame:
    months = statistics.period_electricity(v.daily, v.device_keys, "month")
    years = statistics.period_electricity(months, v.device_keys, "year")
    facts = years.select(
        *statistics.FACT_KEY, thousandths("dbl_stats"), thousandths("long_stats"), *statistics.TOU_COLUMNS, "kgco2e"
    )
    return longs(facts, "key_id")


@query
def f13_year_other(v: Views) -> DataFrame:
    months = statistics.period_other(v.daily, v.key_dictionary, "month")
    years = statistics.period_other(months, v.key_dictionary, "year")
    facts = years.select(*statistics.FACT_KEY, thousandths("dbl_stats"), thousandths("long_stats"), "kgco2e")
    return longs(facts, "key_id")


# G: incremental processing


@query
def g1_since_watermark(v: Views) -> DataFrame:
    daily = v.readings.join(v.device.select("device_id", "entity_id", "device_type"), "entity_id")
    kept = incremental.since_watermark(
        daily, v.latest(142), "ts", strict=True, default=datetime(2024, 1, 20)
    )
    return kept.select("event_id", "device_id", "key_id", "ts")


@query
def g2_advance(v: Views) -> DataFrame:
    facts = v.daily.withColumn("stat_type", timebucket.stat_type("day"))
    marks = incremental.advance_watermark(facts, incremental.WATERMARK_OFFSET["day"])
    return longs(marks, "key_id")


def _half(v: Views, first: bool) -> DataFrame:
    """Meter days of the first or the last twenty days; ten of them are in both."""
    facts = v.readings.groupBy(
        F.col("entity_id").alias("device_id"), "key_id", timebucket.calendar_bucket(F.col("ts"), "day").alias("stat_time")
    ).agg(F.sum("value_c").alias("sum_c"), F.count(F.lit(1)).alias("n"))
    if first:
        return timebucket.half_open(facts, "stat_time", end=datetime(2024, 1, 21))
    return timebucket.half_open(facts, "stat_time", start=datetime(2024, 1, 11)).withColumns(
        {"sum_c": F.col("sum_c") + 1, "n": -F.col("n")}
    )


HALF_KEY = ["device_id", "key_id", "stat_time"]


@query
def g3_upsert(v: Views) -> DataFrame:
    return incremental.upsert(_half(v, True), _half(v, False), HALF_KEY, ["sum_c"])


@query
def g4_update_only(v: Views) -> DataFrame:
    return incremental.update_only(_half(v, True), _half(v, False), HALF_KEY, ["sum_c"])


@query
def g5_insert_only(v: Views) -> DataFrame:
    new = timebucket.half_open(_half(v, False), "stat_time", start=datetime(2024, 1, 21))
    return incremental.insert_only(_half(v, True), new, HALF_KEY)


@query
def g6_high_water(v: Views) -> DataFrame:
    marks = incremental.target_high_water(
        v.daily.withColumn("stat_time", timebucket.calendar_bucket(F.col("stat_time"), "month")), "month"
    )
    return longs(marks, "key_id")


# H: quality


@query
def h1_verify(v: Views) -> DataFrame:
    return quality.verify_rollup(v.counter, SERIES)


@query
def h1_verify_resets(v: Views) -> DataFrame:
    """A counter with resets does not add up, and the verdict says so."""
    return quality.verify_rollup(v.readings_reset, SERIES)


@query
def h1_mismatches(v: Views) -> DataFrame:
    """A counter that resets loses energy at the resets, so hours and days disagree there."""
    return quality.rollup_mismatches(v.readings_reset, "day", "hour", SERIES)


@query
def h2_drift(v: Views) -> DataFrame:
    newest = incremental.advance_watermark(v.daily, incremental.WATERMARK_OFFSET["day"])
    behind = newest.withColumn(
        "latest_stat_time",
        F.when(F.col("device_id") % 3 == 0, F.col("latest_stat_time") - F.expr("INTERVAL 1 DAY")).otherwise(
            F.col("latest_stat_time")
        ),
    )
    return longs(quality.watermark_drift(behind, v.daily, incremental.WATERMARK_OFFSET["day"]), "key_id")


@query
def h2_drift_raw(v: Views) -> DataFrame:
    newest = incremental.advance_watermark(v.daily, incremental.WATERMARK_OFFSET["day"])
    return longs(quality.watermark_drift(newest, v.daily), "key_id")


@query
def h3_unique(v: Views) -> DataFrame:
    """Orders per customer and month repeat; their key is not unique."""
    facts = v.table("orders").select(
        F.col("o_custkey").alias("device_id"), timebucket.calendar_bucket(F.col("o_orderdate"), "month").alias("stat_time")
    )
    return quality.duplicate_keys(facts, ["device_id", "stat_time"])


@query
def h4_truth(v: Views) -> DataFrame:
    """The period of each instant, expected from its hour; instants on a boundary minute differ if closed."""
    cases = v.clock.select(
        "id", "ts", period.period_type(timebucket.calendar_bucket(F.col("ts"), "hour")).alias("expected")
    )
    checked = quality.period_truth_table(cases, period.rate_period_closed(F.col("ts")))
    return checked.select("id", "fn_output", "expected", "verify")


@query
def h5_drop_column(v: Views) -> DataFrame:
    kept = quality.drop_column(v.daily, "entity_id")
    return longs(kept.select(*sorted(kept.columns)), "key_id")


@query
def h5_drop_stored_column(v: Views) -> DataFrame:
    """A column that goes from stored daily facts, folder by folder."""
    path = fresh_path(v.spark, "facts")
    facts = v.daily.withColumn("period", F.date_format("stat_time", "yyyy"))
    facts.write.partitionBy("period").parquet(path)
    maintenance.drop_column(v.spark, path, "entity_id")
    kept = v.spark.read.parquet(path).drop("period")
    return longs(kept.select(*sorted(kept.columns)), "key_id")


def _rewound(v: Views, grain: str, offset: str) -> DataFrame:
    """Purchases count as late readings of the electricity counter."""
    late = v.readings.filter(F.col("key_id") == 596).join(
        v.device.select("device_id", "entity_id", "device_type"), "entity_id"
    )
    marks = incremental.rewind_watermark(
        v.latest(142, offset).withColumn("latest_epoch", F.lit(0)), late.withColumn("key_id", F.lit(142)), grain
    )
    return longs(marks, "key_id")


@query
def i3_rewind(v: Views) -> DataFrame:
    return _rewound(v, "minute_electricity", "INTERVAL 57 SECONDS")


@query
def i3_rewind_hour(v: Views) -> DataFrame:
    return _rewound(v, "hour", HOUR_MARK)


@query
def i3_rewind_day(v: Views) -> DataFrame:
    return _rewound(v, "day", DAY_MARK)


@query
def i3_rewind_calendar_day(v: Views) -> DataFrame:
    return _rewound(v, "calendar_day", HOUR_MARK)


# A10, G7, I: sinks and streams


def _stored_hours(v: Views, store: StatStore) -> DataFrame:
    return longs(
        store.read("hourly").select(*statistics.FACT_KEY, "dbl_stats", "dbl_min", "dbl_max", "stat_type"),
        "device_id",
        "key_id",
        "stat_type",
    )


@query
def a10_write_stat(v: Views) -> DataFrame:
    """Hourly flow rates stored twice: the second run overwrites the first one's averages."""
    store = StatStore(v.spark, fresh_path(v.spark, "stats"))
    facts = statistics.hour_rate_other(v.readings, _others(v), v.key_config, None, SERIES)
    store.upsert("hourly", facts.withColumn("dbl_stats", F.lit(0.0)), ["dbl_stats"])
    store.upsert("hourly", facts, ["dbl_stats"])
    return _stored_hours(v, store)


@query
def g7_run_metrics(v: Views) -> DataFrame:
    """What a run reports about the rows it wrote."""
    store = StatStore(v.spark, fresh_path(v.spark, "stats"))
    facts = statistics.hour_rate_other(v.readings, _others(v), v.key_config, None, SERIES)
    _, metrics = store.upsert("hourly", facts, ["dbl_stats"])
    return v.spark.range(1).select(
        F.lit(metrics["rows"]).cast("bigint").alias("rows"),
        timebucket.timestamp_literal(metrics["first_stat_time"]).alias("first_stat_time"),
        timebucket.timestamp_literal(metrics["last_stat_time"]).alias("last_stat_time"),
    )


def _event_stream(v: Views) -> Views:
    """The same views over the events as a file stream."""
    streamed = Views(v.spark, v.sf_dir)
    # the pattern matches the table whether it is one file or a folder of parts
    events = v.spark.readStream.schema(TABLES["events"]).parquet(f"{v.sf_dir}/events.parquet*")
    streamed.table = lambda name: events if name == "events" else v.table(name)
    return streamed


@query
def i1_stream_hour(v: Views) -> DataFrame:
    return _streamed(v, "hour", "hourly")


@query
def i1_stream_production_day(v: Views) -> DataFrame:
    return _streamed(v, "day", "daily")


def _streamed(v: Views, grain: str, table: str) -> DataFrame:
    store = StatStore(v.spark, fresh_path(v.spark, "stats"))
    stats = stream_bucket_stats(_event_stream(v).readings, grain, SERIES, delay="40 days")
    upsert_stream(
        stats, v.device, store, table, grain, fresh_path(v.spark, "stream-checkpoint")
    ).awaitTermination()
    columns = [*statistics.FACT_KEY, "dbl_stats", "dbl_min", "dbl_max", "stat_type"]
    return longs(store.read(table).select(*columns), "device_id", "key_id", "stat_type")


@query
def i2_stream_delta(v: Views) -> DataFrame:
    readings = _event_stream(v).readings
    stream = DeltaStream(fresh_path(v.spark, "deltas"), readings.schema, SERIES)
    stream.start(readings, fresh_path(v.spark, "stream-checkpoint")).awaitTermination()
    return stream.deltas(v.spark).select("event_id", "entity_id", "key_id", "ts", "delta")


SLICES = [datetime(2024, 1, 8), datetime(2024, 1, 15), datetime(2024, 1, 23)]


def _in_steps(v: Views, rows: DataFrame, late: Column, start: Callable) -> None:
    """Files appended slice by slice, the late ones with the last; a stream is restarted after each."""
    raw, checkpoint = fresh_path(v.spark, "raw"), fresh_path(v.spark, "stream-checkpoint")
    rows = materialise(rows, "raw-rows")
    bounds = [None, *SLICES, None]
    for low, high in zip(bounds, bounds[1:]):
        part = timebucket.half_open(rows, "ts", low, high).filter(~late)
        part = part if high is not None else part.unionByName(rows.filter(late))
        part.write.mode("append").parquet(raw)
        start(v.spark.readStream.schema(rows.schema).parquet(raw), checkpoint).awaitTermination()


@query
def i2_restarted(v: Views) -> DataFrame:
    """Steps over four micro-batches, each of a stream that is started anew."""
    stream = DeltaStream(fresh_path(v.spark, "deltas"), v.readings.schema, SERIES)
    _in_steps(v, v.readings, F.lit(False), stream.start)
    return stream.deltas(v.spark).select("event_id", "entity_id", "key_id", "ts", "delta")


def _with_late_readings(v: Views, stream: BucketStream, store: StatStore, job: tuple[str, str, dict]) -> None:
    """A stream to which every ninth reading comes too late, and the job that redoes their buckets."""
    _in_steps(v, v.readings, F.col("event_id") % 9 == 4, stream.start)
    estate = Estate(
        ts_kv=v.ts_kv,
        device=v.device.withColumn("device_id", F.col("device_id").cast("string")),
        key_config=v.key_config,
        param=v.param,
        key_dictionary=v.key_dictionary,
        avg_key_config=v.avg_key_config,
        exclude_factories=EXCLUDED,
    )
    rewind(estate, store, stream.late())
    grain, measure, options = job
    run_grain(estate, store, grain, measure, AS_OF, **options)


@query
def i1_late_hours(v: Views) -> DataFrame:
    """Hourly flows kept by a stream in the place of their job; late readings are redone by the job."""
    store = StatStore(v.spark, fresh_path(v.spark, "stats"), "other_rate")
    series = rate_series(_others(v).withColumn("device_id", F.col("device_id").cast("string")), v.key_config)
    stream = BucketStream(fresh_path(v.spark, "buckets"), store, series, "hourly", "hour_latest", "hour", SERIES)
    _with_late_readings(v, stream, store, ("hour", "other_rate", {}))
    return _stored_hours(v, store)


@query
def i1_late_days(v: Views) -> DataFrame:
    """The day's report of instantaneous quantities under the keys of their averages, in the same way."""
    store = StatStore(v.spark, fresh_path(v.spark, "stats"), "measures")
    series = average_series(eligible(v).withColumn("device_id", F.col("device_id").cast("string")), v.avg_key_config)
    stream = BucketStream(
        fresh_path(v.spark, "buckets"), store, series, "daily", "day_latest", "day", SERIES,
        day_start=timebucket.DAY_START, extremes=True,
    )
    _with_late_readings(v, stream, store, ("day", "rate", {"default_start": datetime(2023, 12, 1)}))
    columns = [*statistics.FACT_KEY, "dbl_stats", "dbl_min", "dbl_max", "stat_type"]
    return longs(store.read("daily").select(*columns), "device_id", "key_id", "stat_type")
