"""The star schema read as a metering estate.

Customers become devices, events become telemetry, orders become a dated fact table. Money is
kept in whole cents, so that sums are exact in any engine.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold.functions.timebucket import ts_to_epoch_ms
from meterfold.operators.ordered import running_total
from meterfold.operators.series import Series

# Event and segment names with the key and device type they stand for.
KEY_OF_EVENT = {"click": 142, "view": 569, "purchase": 596, "signup": 608}
OTHER_EVENT_KEY = 612
TYPE_OF_SEGMENT = {"AUTOMOBILE": "E", "BUILDING": "W", "FURNITURE": "A", "HOUSEHOLD": "G"}
OTHER_SEGMENT_TYPE = "S"
EXCLUDED = ("NATION_0", "NATION_1")

# Small configuration tables.
KEY_CONFIG = [("E", 142, 554, 569), ("W", 569, 626, 596), ("A", 596, 634, 608), ("S", 608, 631, 612), ("G", 612, 635, 142)]
AVG_KEY_CONFIG = [(569, 627), (596, 628), (608, 629)]
KEY_DICTIONARY = [
    (1, "water_consumed_volume"),
    (2, "air_flow_rate"),
    (3, "gas_consumed_volume"),
    (4, "steam_flow_rate"),
    (5, "unlisted"),
    (142, "Energy"),
    (554, "ConsumedEnergy"),
    (569, "Active_Power"),
    (596, "Reactive_Power"),
    (608, "HZ"),
    (612, "Run_State"),
]
VOLUMES = [(626, "water_consumed_volume"), (634, "air_consumed_volume"), (631, "steam_consumed_volume"), (635, "gas_consumed_volume")]
DEVICE_KEYS = [("E", 1, "C"), ("E", 2, "C"), ("E", 3, "A"), ("E", 4, "A")]
ELECTRICITY_RATE = [(1, "1911-01-01"), (2, "1997-05-16"), (3, "2000-10-16"), (4, "1999-01-01")]
RATES = [
    ("O", "S", "PE", 939, None),
    ("O", "S", "PP", 585, None),
    ("O", "S", "OP", 253, None),
    ("O", "N", "PP", None, 547),
    ("O", "N", "OP", None, 232),
    ("T", "S", "SPP", 260, None),
    ("T", "S", "OP", 253, None),
    ("T", "N", "SPP", None, 241),
    ("T", "N", "OP", None, 232),
    ("S", "A", "OP", 253, 232),
]

# The given tables' columns; declared, so that opening a table reads no file.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

SERIES = Series(value="value_c")
DAILY_TOU = ("peak", "partial_peak", "off_peak")


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def _one_of(column: str, choices: dict, otherwise) -> Column:
    chosen = None
    for name, result in choices.items():
        matches = F.col(column) == name
        chosen = F.when(matches, result) if chosen is None else chosen.when(matches, result)
    return chosen.otherwise(otherwise)


class Views:
    """Views of one data folder, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def _rows(self, rows: list[tuple], schema: str) -> DataFrame:
        """An inline table, whose exact size the optimizer knows."""

        def literal(x) -> str:
            return "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)

        inline = ", ".join("(" + ", ".join(literal(x) for x in row) + ")" for row in rows)
        columns = [c.strip().split(" ") for c in schema.split(",")]
        typed = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in columns)
        names = ", ".join(name for name, _ in columns)
        return self.spark.sql(f"SELECT {typed} FROM VALUES {inline} AS t({names})")

    @cached_property
    def device(self) -> DataFrame:
        customers = self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        return customers.select(
            F.col("c_custkey").alias("device_id"),
            F.when(F.col("c_custkey") % 10 != 9, F.col("c_custkey")).alias("entity_id"),
            F.col("n_name").alias("factory_id"),
            _one_of("c_mktsegment", TYPE_OF_SEGMENT, OTHER_SEGMENT_TYPE).alias("device_type"),
        )

    @cached_property
    def readings(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            F.col("user_id").alias("entity_id"),
            _one_of("event_type", KEY_OF_EVENT, OTHER_EVENT_KEY).alias("key_id"),
            "ts",
            cents("value").alias("value_c"),
        )

    @cached_property
    def ts_kv(self) -> DataFrame:
        return self.as_telemetry(self.readings)

    @staticmethod
    def as_telemetry(readings: DataFrame) -> DataFrame:
        """Readings the way telemetry is stored."""
        return readings.select(
            "entity_id",
            F.col("key_id").alias("key"),
            ts_to_epoch_ms(F.col("ts")).alias("ts"),
            F.col("value_c").alias("dbl_v"),
        )

    @cached_property
    def counter(self) -> DataFrame:
        totals = running_total(self.readings, SERIES, "_total")
        return totals.select("event_id", "entity_id", "key_id", "ts", F.col("_total").alias("value_c"))

    @cached_property
    def readings_reset(self) -> DataFrame:
        return self.counter.withColumn("value_c", F.col("value_c") % 20000)

    @cached_property
    def readings_nulls(self) -> DataFrame:
        return self.counter.withColumn("value_c", F.when(F.col("event_id") % 37 != 0, F.col("value_c")))

    @cached_property
    def clock(self) -> DataFrame:
        at = F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"), at.alias("ts"), cents("o_totalprice").alias("value_c")
        )

    @cached_property
    def daily(self) -> DataFrame:
        """Daily facts of every device, with the columns month and year are rolled up from."""
        orders = self.table("orders").select(
            F.col("o_orderdate").alias("stat_time"),
            F.col("o_custkey").alias("device_id"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("key_id"),
            "o_orderstatus",
            cents("o_totalprice").alias("c"),
        )

        def of_status(status: str) -> Column:
            return F.sum(F.when(F.col("o_orderstatus") == status, F.col("c")))

        facts = orders.groupBy("stat_time", "device_id", "key_id").agg(
            F.sum("c").alias("dbl_stats"),
            F.count(F.lit(1)).alias("long_stats"),
            of_status("F").alias("peak_energy"),
            of_status("P").alias("partial_peak_energy"),
            of_status("O").alias("off_peak_energy"),
            (F.sum("c") * 2).alias("charge"),
            (of_status("F") * 3).alias("peak_charge"),
            (of_status("P") * 2).alias("partial_peak_charge"),
            of_status("O").alias("off_peak_charge"),
            (F.sum("c") * 494).alias("kgco2e"),
        )
        return facts.join(self.device.select("device_id", "device_type", "entity_id"), "device_id")

    @cached_property
    def key_config(self) -> DataFrame:
        return self._rows(
            KEY_CONFIG, "device_type string, accumulation_key_id int, consumption_key_id int, rate_key_id int"
        )

    @cached_property
    def avg_key_config(self) -> DataFrame:
        return self._rows(AVG_KEY_CONFIG, "rate_key_id int, avg_key_id int")

    @cached_property
    def key_dictionary(self) -> DataFrame:
        return self._rows(KEY_DICTIONARY, "key_id int, key string")

    @cached_property
    def volumes(self) -> DataFrame:
        """The dictionary with the names that months of the other utilities look for."""
        names = [(k, n) for k, n in KEY_DICTIONARY if k >= 142]
        return self._rows([*names, *VOLUMES], "key_id int, key string")

    @cached_property
    def consumed_keys(self) -> DataFrame:
        return self._rows([("E", 554, "C")], "device_type string, key_id int, key_type string")

    @cached_property
    def device_keys(self) -> DataFrame:
        return self._rows(DEVICE_KEYS, "device_type string, key_id int, key_type string")

    @cached_property
    def electricity_rate(self) -> DataFrame:
        rows = self._rows(ELECTRICITY_RATE, "id int, effective_on string")
        return rows.withColumn("effective_on", F.col("effective_on").cast("timestamp_ntz"))

    @cached_property
    def energy_charge(self) -> DataFrame:
        rows = [
            (version, day, season, period, *[r if r is None else r + (version - 1) * 10 for r in rates])
            for version, _ in ELECTRICITY_RATE
            for day, season, period, *rates in RATES
        ]
        return self._rows(
            rows,
            "electricity_rate_id int, day_type string, season_type string, period_type string, "
            "summer_rate bigint, non_summer_rate bigint",
        )

    @cached_property
    def param(self) -> DataFrame:
        """Emission coefficients in thousandths: per plant one for each of three utilities."""
        nation = self.table("nation").filter(F.col("n_nationkey") % 7 != 0)
        return nation.select(
            F.col("n_name").alias("factory_id"),
            F.when(F.col("n_nationkey") % 2 == 0, "power_coeff").otherwise("other").alias("param_name"),
            F.explode(F.array(F.lit("E"), F.lit("W"), F.lit("G"))).alias("device_type"),
            (400 + F.col("n_nationkey")).cast("bigint").alias("float_value"),
        )

    def _latest(self, offset: str) -> DataFrame:
        day = F.lit("2024-01-10").cast("timestamp_ntz") + F.make_dt_interval(
            days=(F.col("device_id") % 5).cast("int")
        )
        return self.device.filter(F.col("device_id") % 7 != 0).select(
            "device_id", "device_type", (day + F.expr(offset)).alias("latest_stat_time")
        )

    def latest(self, key_id: int, offset: str = "INTERVAL 57 SECONDS") -> DataFrame:
        """Watermarks of six in seven devices under one key."""
        return self._latest(offset).withColumn("key_id", F.lit(key_id))

    def latest_by_role(self, role: str, offset: str) -> DataFrame:
        """Watermarks under the key each device type has in a role."""
        keys = self.key_config.select("device_type", F.col(f"{role}_key_id").alias("key_id"))
        return self._latest(offset).join(keys, "device_type")

    def latest_averages(self, offset: str) -> DataFrame:
        averages = F.explode(F.array(*[F.lit(avg) for _, avg in AVG_KEY_CONFIG]))
        return self._latest(offset).withColumn("key_id", averages)
