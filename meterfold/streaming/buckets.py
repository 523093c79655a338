"""Bucket statistics of a stream whose late readings are kept, in the place of a scheduled job.

Each micro-batch is a small batch job. It is split against the stream's own watermark, which the
batches before it have set: what is too late for its bucket goes to a side table, the rest is
reduced to one partial row per series and bucket. A bucket's facts come from the partials of all
batches, of which only those of open buckets are read. Everything a batch writes is its own part,
so a batch that is repeated replaces itself.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterfold.functions.timebucket import grain_bucket, stat_type, timestamp_literal
from meterfold.operators.incremental import SERIES_KEY, WATERMARK_OFFSET, marks_of
from meterfold.operators.series import Series
from meterfold.session import passing, read_or_empty
from meterfold.sources import schemas
from meterfold.sources.store import StatStore

BATCH, PERIOD = "batch_id", "period"

_PARTIAL = T.StructType(
    [
        *[f for f in schemas.LATEST.fields if f.name in SERIES_KEY],
        T.StructField("stat_time", T.TimestampNTZType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("n", T.LongType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField(PERIOD, T.StringType()),
        T.StructField(BATCH, T.LongType()),
    ]
)


def rate_series(devices: DataFrame, key_config: DataFrame) -> DataFrame:
    """The flow of each device under its own key, as the jobs of flow averages store it."""
    keys = key_config.select("device_type", F.col("rate_key_id").alias("reading_key"), F.col("rate_key_id").alias("key_id"))
    return devices.select("entity_id", "device_id", "device_type").join(keys, "device_type")


def average_series(devices: DataFrame, avg_key_config: DataFrame) -> DataFrame:
    """Instantaneous quantities under the key of their average, as the day's report stores them."""
    keys = avg_key_config.select(F.col("rate_key_id").alias("reading_key"), F.col("avg_key_id").alias("key_id")).collect()
    # a configuration table: a handful of rows
    pairs = F.array(*[F.struct(F.lit(k["reading_key"]).alias("reading_key"), F.lit(k["key_id"]).alias("key_id")) for k in keys])
    return devices.select("entity_id", "device_id", "device_type", F.explode(pairs).alias("_k")).select(
        "entity_id", "device_id", "device_type", "_k.*"
    )


class BucketStream:
    """Keeps ``table`` of ``store`` up to date with averages and extremes per bucket, and its watermarks.

    ``series`` says whose readings count and under which key: devices that are left out there have
    no facts. ``store`` must be of the owner whose job the stream takes the place of; late readings
    are rewound to that job. ``extremes`` are stored for the day's report and not for flows.
    """

    def __init__(
        self,
        root: str,
        store: StatStore,
        series: DataFrame,
        table: str,
        marks: str,
        grain: str,
        s: Series = Series(),
        delay: timedelta = timedelta(days=1),
        day_start: timedelta | None = None,
        extremes: bool = False,
    ):
        self.root, self.store, self.series, self.table, self.marks = root.rstrip("/"), store, series, table, marks
        self.grain, self.s, self.delay, self.day_start, self.extremes = grain, s, delay, day_start, extremes
        self.offset = WATERMARK_OFFSET["calendar_day" if grain == "day" and day_start is None else grain]

    def start(self, readings: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Process the stream; ``trigger`` is Spark's, by default one pass over what is available."""
        return (
            readings.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def _path(self, part: str) -> str:
        return f"{self.root}/{part}"

    def _write(self, rows: DataFrame, part: str, *partition: str) -> None:
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition)
            .parquet(self._path(part))
        )

    def watermark(self, batch_id: int) -> datetime | None:
        """The newest reading of all batches before one, less the delay."""
        schema = T.StructType([T.StructField("newest", T.TimestampNTZType()), T.StructField(BATCH, T.LongType())])
        seen = read_or_empty(self.store.spark, self._path("seen"), schema).filter(F.col(BATCH) < batch_id)
        newest = seen.agg(F.max("newest")).first()[0]
        return None if newest is None else newest - self.delay

    def late(self) -> DataFrame:
        """``entity_id, key_id, ts, value`` of the readings that came after their bucket was closed."""
        schema = T.StructType([*self._reading_fields(), T.StructField(BATCH, T.LongType())])
        return read_or_empty(self.store.spark, self._path("late"), schema).drop(BATCH)

    def _reading_fields(self) -> list[T.StructField]:
        return [
            T.StructField("entity_id", self.series.schema["entity_id"].dataType),
            T.StructField("key_id", T.IntegerType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("value", T.DoubleType()),
        ]

    def process(self, batch: DataFrame, batch_id: int) -> None:
        fields = [F.col(c).cast(f.dataType).alias(f.name) for c, f in zip((*self.s.keys, self.s.ts, self.s.value), self._reading_fields())]
        with passing(batch.select(*fields), "stream-batch") as rows:
            self._process(rows, batch_id)

    def _process(self, rows: DataFrame, batch_id: int) -> None:
        number = F.lit(batch_id).cast("bigint").alias(BATCH)
        bucket = grain_bucket(F.col("ts"), self.grain, self.day_start)
        ends = bucket + F.expr(f"INTERVAL 1 {self.grain.upper()}") + F.lit(self.day_start or timedelta(0))
        closed = self.watermark(batch_id)
        too_late = F.lit(False) if closed is None else F.coalesce(ends <= timestamp_literal(closed), F.lit(False))
        wanted = self.series.select("entity_id", F.col("reading_key").alias("key_id")).distinct()
        self._write(rows.filter(too_late).join(wanted, ["entity_id", "key_id"], "left_semi").select("*", number), "late", BATCH)
        partials = (
            rows.filter(~too_late)
            .groupBy("entity_id", F.col("key_id").alias("reading_key"), bucket.alias("stat_time"))
            .agg(F.sum("value").alias("total"), F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        )
        # devices and keys meet buckets, not readings
        summed = (
            partials.join(self.series, ["entity_id", "reading_key"])
            .groupBy(*SERIES_KEY, "stat_time")
            .agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        )
        period = F.date_format("stat_time", "yyyy-MM-dd").alias(PERIOD)
        self._write(summed.select("*", period, number), "partials", PERIOD, BATCH)
        self._store_facts(batch_id)
        self._write(rows.agg(F.max("ts").alias("newest")).select("newest", number), "seen", BATCH)

    def _store_facts(self, batch_id: int) -> None:
        stored = read_or_empty(self.store.spark, self._path("partials"), _PARTIAL)
        touched = stored.filter(F.col(BATCH) == batch_id).select(*SERIES_KEY, "stat_time", PERIOD)
        # dates of this batch's buckets: open ones, so no more than the delay spans
        dates = [r[PERIOD] for r in touched.select(PERIOD).distinct().collect()]
        if not dates:
            return
        known = stored.filter(F.col(PERIOD).isin(dates) & (F.col(BATCH) <= batch_id))
        facts = (
            known.join(touched.drop(PERIOD), [*SERIES_KEY, "stat_time"], "left_semi")
            .groupBy(*SERIES_KEY, "stat_time")
            .agg(
                F.coalesce(F.sum("total") / F.nullif(F.sum("n"), F.lit(0)), F.lit(0.0)).alias("dbl_stats"),
                *([F.min("low").alias("dbl_min"), F.max("high").alias("dbl_max")] if self.extremes else []),
            )
            .withColumn("stat_type", stat_type(self.grain))
        )
        staged, _ = self.store.upsert(self.table, facts, ["dbl_stats", *(["dbl_min", "dbl_max"] if self.extremes else [])])
        # watermarks only move on: a batch may hold readings of an open bucket before the newest one
        old = self.store.read(self.marks).select(*SERIES_KEY, F.col("latest_stat_time").alias("_old"))
        ahead = marks_of(staged, self.offset).join(old, SERIES_KEY, "left")
        ahead = ahead.filter(F.col("_old").isNull() | (F.col("latest_stat_time") > F.col("_old")))
        self.store.advance(self.marks, ahead.drop("_old"))
