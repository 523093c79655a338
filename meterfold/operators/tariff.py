"""Time-of-use electricity prices and the cost of consumption."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterfold.functions.period import HALF_PEAK, OFF_PEAK, PEAK, SATURDAY_HALF_PEAK, day_type, is_summer, period_type, season_type
from meterfold.functions.timebucket import DAY_START, grain_bucket, stat_type


def tariff_validity(electricity_rate: DataFrame) -> DataFrame:
    """Which tariff version holds when, as ``electricity_rate_id, valid_from, valid_to``.

    At any instant the version with the highest id among those already effective holds, even
    if one with a lower id took effect later.
    """
    # the window spans the published price lists, one row each, and nothing that grows with readings
    timeline = Window.orderBy("valid_from")
    return (
        electricity_rate.groupBy(F.col("effective_on").alias("valid_from"))
        .agg(F.max("id").alias("_id"))
        .withColumn("electricity_rate_id", F.max("_id").over(timeline))
        .withColumn("valid_to", F.lead("valid_from").over(timeline))
        .select("electricity_rate_id", "valid_from", "valid_to")
    )


def with_electricity_rate(
    df: DataFrame, ts: str, electricity_rate: DataFrame, energy_charge: DataFrame, closed: bool = False
) -> DataFrame:
    """Add ``charge_rate``, the price in force at ``ts``; NULL where no tariff matches.

    An as-of join written as an equality on (day type, season, period) with the validity
    interval as residual. No broadcast is forced: Spark compares the price table with its
    broadcast threshold and sorts and merges beyond it.
    """
    prices = (
        energy_charge.join(tariff_validity(electricity_rate), "electricity_rate_id")
        .select(
            F.col("day_type").alias("_day"),
            F.col("season_type").alias("_season"),
            F.col("period_type").alias("_period"),
            F.col("valid_from").alias("_from"),
            F.col("valid_to").alias("_to"),
            F.col("summer_rate").alias("_summer"),
            F.col("non_summer_rate").alias("_other"),
        )
    )
    at = F.col(ts)
    keyed = df.withColumns({"_d": day_type(at), "_s": season_type(at), "_p": period_type(at, closed)})
    in_force = (
        (F.col("_d") == F.col("_day"))
        & (F.col("_s") == F.col("_season"))
        & (F.col("_p") == F.col("_period"))
        & (at >= F.col("_from"))
        & (F.col("_to").isNull() | (at < F.col("_to")))
    )
    return (
        keyed.join(prices, in_force, "left")
        .withColumn("charge_rate", F.when(is_summer(at), F.col("_summer")).otherwise(F.col("_other")))
        .drop("_d", "_s", "_p", "_day", "_season", "_period", "_from", "_to", "_summer", "_other")
    )


def with_charge_info(df: DataFrame, ts: str, electricity_rate: DataFrame, energy_charge: DataFrame) -> DataFrame:
    """Add ``period_type, charge_rate``; a bucket without a price is dropped."""
    priced = with_electricity_rate(df, ts, electricity_rate, energy_charge)
    return priced.filter(F.col("charge_rate").isNotNull()).withColumn("period_type", period_type(F.col(ts)))


def charge(consumption: Column, rate: Column) -> Column:
    return consumption * rate


def tou_split(hourly: DataFrame, day_start: timedelta | None = DAY_START) -> DataFrame:
    """Energy and cost per day, split into peak, partial peak and off-peak."""

    def share(column: str, *periods: str) -> Column:
        return F.sum(F.when(F.col("period_type").isin(*periods), F.col(column)))

    partial = (HALF_PEAK, SATURDAY_HALF_PEAK)
    return (
        hourly.groupBy(
            grain_bucket(F.col("stat_time"), "day", day_start).alias("stat_time"),
            "device_id",
            "device_type",
            "key_id",
        )
        .agg(
            share("dbl_stats", PEAK).alias("peak_energy"),
            share("dbl_stats", *partial).alias("partial_peak_energy"),
            share("dbl_stats", OFF_PEAK).alias("off_peak_energy"),
            F.sum("charge").alias("charge"),
            share("charge", PEAK).alias("peak_charge"),
            share("charge", *partial).alias("partial_peak_charge"),
            share("charge", OFF_PEAK).alias("off_peak_charge"),
        )
        .withColumn("stat_type", stat_type("day"))
    )
