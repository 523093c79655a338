"""The statistics of each grain, computed for all devices at once.

Every function returns facts keyed by (device_type, device_id, key_id, stat_time); the jobs
in ``meterfold.plans`` select the input and store the result.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterfold.functions.timebucket import (
    DAY_START,
    calendar_bucket,
    grain_bucket,
    stat_type,
    timestamp_literal,
)
from meterfold.operators.carbon import ELECTRICITY_COEFFICIENT, carbon_by_device_type, carbon_by_param_name
from meterfold.operators.consumption import delta_per_bucket, fleet_consumption, restart_bucket, with_restart
from meterfold.operators.incremental import SERIES_KEY, since_watermark
from meterfold.operators.series import Series
from meterfold.operators.tariff import charge, with_charge_info

# Keys of the electricity counter and of the consumption derived from it.
ENERGY_KEY = 142
CONSUMED_ENERGY_KEY = 554

# Keys of the other utilities by meaning.
FLOW_RATES = ("water_flow_rate", "air_flow_rate", "gas_flow_rate", "steam_flow_rate")
CONSUMED_VOLUMES = (
    "water_consumed_volume",
    "air_consumed_volume",
    "gas_consumed_volume",
    "steam_consumed_volume",
)

# Instantaneous electricity quantities that get daily statistics.
ELECTRICITY_MEASURES = ("Active_Power", "Reactive_Power", "HZ", "AVG_Voltage", "AVG_Current", "AVG_PF")

# Fixed value: daily statistics of instantaneous values start here for a series without watermark.
MEASURES_SINCE = datetime(2025, 2, 1)

FACT_KEY = ["device_type", "device_id", "key_id", "stat_time"]
TOU_COLUMNS = [
    "peak_energy",
    "partial_peak_energy",
    "off_peak_energy",
    "charge",
    "peak_charge",
    "partial_peak_charge",
    "off_peak_charge",
]


def minute_electricity(
    readings: DataFrame,
    devices: DataFrame,
    param: DataFrame,
    latest: DataFrame | None = None,
    s: Series = Series(),
    param_name: str = ELECTRICITY_COEFFICIENT,
    skip_nulls: bool = False,
) -> DataFrame:
    """Counter steps per minute, with carbon. The watermark is kept under the counter key."""
    steps = delta_per_bucket(readings.filter(F.col("key_id") == ENERGY_KEY), s, "minute", skip_nulls)
    meters = devices.select("entity_id", "device_id", "device_type", "factory_id").withColumn("key_id", F.lit(ENERGY_KEY))
    facts = (
        steps.join(with_restart(meters, latest, "minute"), ["entity_id", "key_id"])
        .filter(F.col("_restart").isNull() | (F.col("bucket") >= F.col("_restart")))
        .select(
            "device_type",
            "device_id",
            "factory_id",
            F.lit(CONSUMED_ENERGY_KEY).alias("key_id"),
            F.col("bucket").alias("stat_time"),
            F.col("delta").alias("dbl_stats"),
        )
    )
    return carbon_by_param_name(facts, param, param_name, "dbl_stats").select(
        *FACT_KEY, stat_type("minute").alias("stat_type"), "dbl_stats", "kgco2e"
    )


def _fleet_with_carbon(readings, devices, key_config, param, latest, grain, s) -> DataFrame:
    consumed = fleet_consumption(readings, devices, key_config, grain, latest, s)
    return carbon_by_device_type(consumed, param).withColumnRenamed("consumption", "dbl_stats")


def minute_other(
    readings: DataFrame,
    devices: DataFrame,
    key_config: DataFrame,
    param: DataFrame,
    latest: DataFrame | None = None,
    s: Series = Series(),
) -> DataFrame:
    """Bucket consumption per minute, with carbon."""
    return _fleet_with_carbon(readings, devices, key_config, param, latest, "minute", s).select(
        *FACT_KEY, stat_type("minute").alias("stat_type"), "dbl_stats", "kgco2e"
    )


def hour_electricity(
    readings: DataFrame,
    devices: DataFrame,
    key_config: DataFrame,
    param: DataFrame,
    electricity_rate: DataFrame,
    energy_charge: DataFrame,
    latest: DataFrame | None = None,
    s: Series = Series(),
) -> DataFrame:
    """Bucket consumption per hour with its period, cost and carbon."""
    consumed = _fleet_with_carbon(readings, devices, key_config, param, latest, "hour", s)
    return with_charge_info(consumed, "stat_time", electricity_rate, energy_charge).select(
        *FACT_KEY,
        stat_type("hour").alias("stat_type"),
        "dbl_stats",
        charge(F.col("dbl_stats"), F.col("charge_rate")).alias("charge"),
        "period_type",
        "kgco2e",
    )


def hour_other(
    minutely: DataFrame, devices: DataFrame, key_config: DataFrame, latest: DataFrame | None = None
) -> DataFrame:
    """Hourly sum, average, extremes and carbon of minute consumption."""

    def or_zero(c: Column) -> Column:
        return F.coalesce(c, F.lit(0))

    hours = (
        minutely.filter(F.col("device_type") != "E")
        .groupBy("device_type", "device_id", "key_id", calendar_bucket(F.col("stat_time"), "hour").alias("stat_time"))
        .agg(
            F.sum("dbl_stats").alias("dbl_stats"),
            or_zero(F.avg("dbl_stats")).alias("dbl_avg"),
            or_zero(F.min("dbl_stats")).alias("dbl_min"),
            or_zero(F.max("dbl_stats")).alias("dbl_max"),
            F.sum("kgco2e").alias("kgco2e"),
        )
    )
    return (
        hours.join(with_restart(_consumption_series(devices, key_config), latest, "hour"), SERIES_KEY)
        .filter(F.col("_restart").isNull() | (F.col("stat_time") >= F.col("_restart")))
        .drop("_restart")
        .withColumn("stat_type", stat_type("hour"))
    )


def _consumption_series(devices: DataFrame, key_config: DataFrame) -> DataFrame:
    """The devices' own consumption keys, as ``device_id, device_type, key_id``."""
    roles = key_config.select("device_type", F.col("consumption_key_id").alias("key_id")).distinct()
    return devices.select("device_id", "device_type").join(roles, "device_type")


def hour_rate_other(
    readings: DataFrame,
    devices: DataFrame,
    key_config: DataFrame,
    latest: DataFrame | None = None,
    s: Series = Series(),
) -> DataFrame:
    """Average flow per hour."""
    return _average_rate(readings, devices, key_config, latest, "hour", s)


def day_rate_other(
    readings: DataFrame,
    devices: DataFrame,
    key_config: DataFrame,
    latest: DataFrame | None = None,
    s: Series = Series(),
) -> DataFrame:
    """Average flow per calendar day."""
    return _average_rate(readings, devices, key_config, latest, "day", s)


def _average_rate(readings, devices, key_config, latest, grain, s) -> DataFrame:
    roles = key_config.select("device_type", F.col("rate_key_id").alias("key_id"))
    averages = (
        readings.join(roles.select("key_id"), "key_id", "left_semi")
        .groupBy(*s.keys, calendar_bucket(F.col(s.ts), grain).alias("stat_time"))
        .agg(F.coalesce(F.avg(s.value), F.lit(0)).alias("dbl_stats"))
    )
    wanted = devices.select("entity_id", "device_id", "device_type").join(roles, "device_type")
    return (
        averages.join(with_restart(wanted, latest, grain), ["entity_id", "key_id"])
        .filter(F.col("_restart").isNull() | (F.col("stat_time") >= F.col("_restart")))
        .select(*FACT_KEY, stat_type(grain).alias("stat_type"), "dbl_stats")
    )


def day_profile(
    hourly: DataFrame,
    devices: DataFrame,
    key_config: DataFrame,
    latest: DataFrame | None = None,
    day_start: timedelta | None = DAY_START,
) -> DataFrame:
    """Production-day average and extremes of hourly consumption."""
    # all three steps work on the series key, so the hours are shuffled once
    own = hourly.join(_consumption_series(devices, key_config), SERIES_KEY, "left_semi")
    if latest is not None:
        own = since_watermark(own, latest, "stat_time", strict=True)
    return (
        own.groupBy(
            "device_type", "device_id", "key_id", grain_bucket(F.col("stat_time"), "day", day_start).alias("stat_time")
        )
        .agg(
            F.avg("dbl_stats").alias("dbl_avg"),
            F.min("dbl_stats").alias("dbl_min"),
            F.max("dbl_stats").alias("dbl_max"),
            F.sum("long_stats").alias("long_stats"),
            F.avg("long_stats").alias("long_avg"),
            F.min("long_stats").alias("long_min"),
            F.max("long_stats").alias("long_max"),
        )
        .withColumn("stat_type", stat_type("day"))
    )


def day_consumption(
    readings: DataFrame,
    devices: DataFrame,
    key_config: DataFrame,
    param: DataFrame,
    latest: DataFrame | None = None,
    s: Series = Series(),
) -> DataFrame:
    """Production-day consumption and carbon, meant to update the rows of :func:`day_profile`."""
    return _fleet_with_carbon(readings, devices, key_config, param, latest, "day", s).select(
        *FACT_KEY, stat_type("day").alias("stat_type"), "dbl_stats", "kgco2e"
    )


def day_rate(
    readings: DataFrame,
    devices: DataFrame,
    avg_key_config: DataFrame,
    key_dictionary: DataFrame,
    latest: DataFrame | None = None,
    s: Series = Series(),
    names: tuple[str, ...] = ELECTRICITY_MEASURES + FLOW_RATES,
    default_start: datetime = MEASURES_SINCE,
    day_start: timedelta | None = DAY_START,
) -> DataFrame:
    """Production-day average and extremes of instantaneous values, under the average's key.

    A series without watermark counts only readings after ``default_start``. Which series
    those are is known per device, and devices are joined to day rows rather than to
    readings; so each day row carries both variants until the join decides.
    """
    named = key_dictionary.filter(F.col("key").isin(*names)).select("key_id")
    mapping = avg_key_config.join(named, F.col("rate_key_id") == F.col("key_id")).select("key_id", "avg_key_id")
    value = F.col(s.value)
    recent = F.when(F.col(s.ts) > timestamp_literal(default_start), value)
    is_recent = F.col(s.ts) > timestamp_literal(default_start)
    days = (
        readings.join(mapping, "key_id")
        .groupBy("entity_id", "avg_key_id", grain_bucket(F.col(s.ts), "day", day_start).alias("stat_time"))
        .agg(
            F.avg(value).alias("_avg_all"),
            F.min(value).alias("_min_all"),
            F.max(value).alias("_max_all"),
            F.avg(recent).alias("_avg_recent"),
            F.min(recent).alias("_min_recent"),
            F.max(recent).alias("_max_recent"),
            F.count_if(is_recent).alias("_n_recent"),
        )
    )
    facts = days.join(devices.select("entity_id", "device_id", "device_type"), "entity_id").withColumnRenamed(
        "avg_key_id", "key_id"
    )
    if latest is None:
        facts = facts.withColumn("_since", F.lit(None).cast("timestamp_ntz"))
    else:
        known = latest.select("device_id", "device_type", "key_id", F.col("latest_stat_time").alias("_since"))
        facts = facts.join(known, ["device_id", "device_type", "key_id"], "left")
    unseen = F.col("_since").isNull()
    wanted = F.when(unseen, F.col("_n_recent") > 0).otherwise(
        F.col("stat_time") >= restart_bucket(F.col("_since"), "day")
    )

    def pick(name: str) -> Column:
        return F.when(unseen, F.col(f"_{name}_recent")).otherwise(F.col(f"_{name}_all"))

    return facts.filter(wanted).select(
        *FACT_KEY,
        stat_type("day").alias("stat_type"),
        pick("avg").alias("dbl_stats"),
        pick("min").alias("dbl_min"),
        pick("max").alias("dbl_max"),
    )


def _sums_and_averages(facts: DataFrame, grain: str, columns: list[str], sums: list[str]) -> DataFrame:
    """Per series and period the sum and the average of ``columns`` and the sum of ``sums``."""
    period = calendar_bucket(F.col("stat_time"), grain).alias("stat_time")
    return facts.groupBy("device_type", "device_id", "key_id", period).agg(
        *[F.sum(c).alias(f"_sum_{c}") for c in columns],
        *[F.avg(c).alias(f"_avg_{c}") for c in columns],
        *[F.sum(c).alias(c) for c in sums],
    )


def _sum_or_avg(is_sum: Column, column: str) -> Column:
    return F.when(is_sum, F.col(f"_sum_{column}")).otherwise(F.col(f"_avg_{column}"))


def period_electricity(facts: DataFrame, device_keys: DataFrame, grain: str) -> DataFrame:
    """Month or year of electricity: sums of consumption keys, averages of all others.

    Which of both a key gets is looked up for the period rows, after the aggregation.
    """
    electricity = facts.filter(F.col("device_type") == "E")
    periods = _sums_and_averages(electricity, grain, ["dbl_stats", "long_stats"], [*TOU_COLUMNS, "kgco2e"])
    types = device_keys.select("device_type", "key_id", "key_type")
    summed = F.col("key_type") == "C"
    return periods.join(types, ["device_type", "key_id"]).select(
        *FACT_KEY,
        stat_type(grain).alias("stat_type"),
        _sum_or_avg(summed, "dbl_stats").alias("dbl_stats"),
        _sum_or_avg(summed, "long_stats").alias("long_stats"),
        *TOU_COLUMNS,
        "kgco2e",
    )


def period_other(
    facts: DataFrame,
    key_dictionary: DataFrame,
    grain: str,
    flow_rates: tuple[str, ...] = FLOW_RATES,
    volumes: tuple[str, ...] = CONSUMED_VOLUMES,
) -> DataFrame:
    """Month or year of the other utilities: average flow rates, summed volumes."""
    others = facts.filter(F.col("device_type").isin("W", "A", "G", "S"))
    periods = _sums_and_averages(others, grain, ["dbl_stats", "long_stats"], ["kgco2e"])
    keys = key_dictionary.filter(F.col("key").isin(*flow_rates, *volumes)).select(
        "key_id", F.col("key").isin(*volumes).alias("_volume")
    )
    volume = F.col("_volume")
    return periods.join(keys, "key_id").select(
        *FACT_KEY,
        stat_type(grain).alias("stat_type"),
        _sum_or_avg(volume, "long_stats").alias("long_stats"),
        F.coalesce(_sum_or_avg(volume, "dbl_stats"), F.lit(0)).alias("dbl_stats"),
        "kgco2e",
    )
