"""Telemetry and its dimensions: selecting readings, devices and keys."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterfold.functions.timebucket import epoch_ms_to_ts, instant_ms, timestamp_literal

# Device types by utility (electricity; water, air, gas, steam).
ELECTRICITY = ("E",)
OTHER_UTILITIES = ("W", "A", "G", "S")

# Plants whose devices the electricity and minute to day jobs leave out.
EXCLUDED_FACTORIES = ("KC", "KT")

# How long hot telemetry is kept, and text marks of log lines among it.
HOT_RETENTION = timedelta(hours=8)
LOG_MARKS = ("|ERROR|", "|DEBUG|", "|INFO|")

# Fixed value: a minute watermark older than this makes a device due.
STALE_AFTER = timedelta(hours=1)

ROLES = {"accumulation": "accumulation_key_id", "rate": "rate_key_id"}


def telemetry_values(
    ts_kv: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    date_column: str | None = None,
) -> DataFrame:
    """Stored telemetry as readings ``entity_id, key_id, ts_ms, ts, value``.

    The bounds are wall-clock times of the session's zone. They are compared with the stored epoch
    column, so they reach the file scan; with ``date_column``, the local date the files are
    partitioned by, they prune whole folders.
    """
    if start is not None:
        ts_kv = ts_kv.filter(F.col("ts") >= instant_ms(start))
        if date_column:
            ts_kv = ts_kv.filter(F.col(date_column) >= F.lit(start.date()))
    if end is not None:
        ts_kv = ts_kv.filter(F.col("ts") < instant_ms(end))
        if date_column:
            ts_kv = ts_kv.filter(F.col(date_column) <= F.lit(end.date()))
    return ts_kv.select(
        "entity_id",
        F.col("key").alias("key_id"),
        F.col("ts").alias("ts_ms"),
        epoch_ms_to_ts(F.col("ts")).alias("ts"),
        F.col("dbl_v").alias("value"),
    )


def readings(
    values: DataFrame,
    devices: DataFrame,
    key_config: DataFrame,
    role: str,
    key_dictionary: DataFrame | None = None,
    names: tuple[str, ...] = (),
) -> DataFrame:
    """Readings of devices in one key role: the type's counter, its rate, or keys by name."""
    attributes = devices.select("entity_id", "device_id", "device_type", "factory_id")
    if role == "named":
        return filter_named_keys(values, key_dictionary, names).join(attributes, "entity_id")
    keys = key_config.select("device_type", F.col(ROLES[role]).alias("key_id"), "consumption_key_id")
    return values.join(attributes.join(keys, "device_type"), ["entity_id", "key_id"])


def eligible_devices(
    devices: DataFrame,
    types: tuple[str, ...] | None = None,
    exclude_factories: tuple[str, ...] = EXCLUDED_FACTORIES,
    exclude_types: tuple[str, ...] = (),
) -> DataFrame:
    """Devices with an entity, of the wanted types, outside the excluded plants.

    A device without a plant fails the exclusion too, as NULL does in SQL's NOT IN.
    """
    chosen = devices.filter(F.col("entity_id").isNotNull())
    if types is not None:
        chosen = chosen.filter(F.col("device_type").isin(*types))
    if exclude_types:
        chosen = chosen.filter(~F.col("device_type").isin(*exclude_types))
    if exclude_factories:
        chosen = chosen.filter(~F.col("factory_id").isin(*exclude_factories))
    return chosen


def stale_devices(
    devices: DataFrame, latest: DataFrame, key_id: int, as_of: datetime, older_than: timedelta = STALE_AFTER
) -> DataFrame:
    """Devices whose watermark under ``key_id`` is too old; one without a watermark is not due."""
    due = latest.filter(
        (F.col("key_id") == key_id) & (F.col("latest_stat_time") < timestamp_literal(as_of - older_than))
    ).select("device_id", "device_type", "latest_stat_time")
    return devices.join(due, ["device_id", "device_type"])


def map_measure_keys(df: DataFrame, avg_key_config: DataFrame) -> DataFrame:
    """Rename an instantaneous key to the key of its average; other keys are dropped."""
    mapping = avg_key_config.select(F.col("rate_key_id").alias("key_id"), "avg_key_id")
    return df.join(mapping, "key_id").drop("key_id").withColumnRenamed("avg_key_id", "key_id")


def filter_named_keys(df: DataFrame, key_dictionary: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Rows whose key has one of the names in the dictionary."""
    wanted = key_dictionary.filter(F.col("key").isin(*names)).select("key_id")
    return df.join(wanted, "key_id", "left_semi")


def apply_node_mapping(devices: DataFrame, mapping: DataFrame) -> DataFrame:
    """Set ``node_id`` of the devices the mapping names, leave it as it is on the others."""
    new = mapping.select("device_id", F.col("node_id").alias("_node"))
    return (
        devices.join(new, "device_id", "left")
        .withColumn("node_id", F.coalesce("_node", "node_id"))
        .drop("_node")
    )


def retain_recent(df: DataFrame, as_of: datetime, keep: timedelta = HOT_RETENTION, ts: str = "ts") -> DataFrame:
    """Drop telemetry older than the retention; ``ts`` may be epoch milliseconds or a timestamp."""
    horizon = as_of - keep
    if dict(df.dtypes)[ts] in ("bigint", "int"):
        return df.filter(F.col(ts) >= instant_ms(horizon))
    return df.filter(F.col(ts) >= timestamp_literal(horizon))


def drop_log_rows(df: DataFrame, text: str = "str_v") -> DataFrame:
    """Drop rows whose text carries a log mark; a row without text stays."""
    marked = F.lit(False)
    for mark in LOG_MARKS:
        marked = marked | F.col(text).contains(mark)
    return df.filter(~F.coalesce(marked, F.lit(False)))
