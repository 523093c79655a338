"""Telemetry in the order in which it arrives, and what arrived of each series.

A file source hands every new file over once. Each load is stored as a table part of its own, by
date and clustered by series inside a date, and one row per series tells the first and the newest
reading of the load. So a job finds the series that have anything new without reading telemetry,
and reads a late or a backlogged series from the loads that brought it.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterfold.functions.timebucket import epoch_ms_to_ts
from meterfold.session import read_or_empty
from meterfold.sources import schemas
from meterfold.sources.telemetry import telemetry_values

ARRIVAL, DATE = "arrival", "date"


class ArrivalLog:
    """Telemetry below one folder: ``telemetry/arrival=n/date=d`` and ``arrived/arrival=n``.

    A load counts once its summary is there, which is written last; a load that died half way is
    written again, over its own part. The zone of the session says which date a reading is of.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType = schemas.TS_KV):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        counted = [T.StructField(c, T.LongType()) for c in ("first_ms", "last_ms", "readings", ARRIVAL)]
        self.summary_schema = T.StructType([schema["entity_id"], schema["key"], *counted])

    def follow(self, raw: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Load the files of a streaming source as they arrive; by default all that is there, then stop."""
        return (
            raw.writeStream.foreachBatch(self.load)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def load(self, rows: DataFrame, number: int) -> None:
        """Store one load; storing it again replaces it.

        Rows are ranged by date, series and time, so a large date spreads over many files and each
        file and row group holds few series: their statistics and the Bloom filter let a reader of
        few series skip the rest.
        """
        order = [DATE, "entity_id", "key", "ts"]
        dated = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).withColumn(
            DATE, F.to_date(epoch_ms_to_ts(F.col("ts")))
        )
        part = f"{self.root}/telemetry/{ARRIVAL}={number}"
        (
            dated.repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .write.mode("overwrite")
            .option("parquet.bloom.filter.enabled#entity_id", "true")
            .option("parquet.block.size", str(32 << 20))
            .partitionBy(DATE)
            .parquet(part)
        )
        stored = self.spark.read.schema(self.schema).parquet(part)
        summary = stored.groupBy("entity_id", "key").agg(
            F.min("ts").alias("first_ms"), F.max("ts").alias("last_ms"), F.count("*").alias("readings")
        )
        summary.write.mode("overwrite").parquet(f"{self.root}/arrived/{ARRIVAL}={number}")

    def _summaries(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/arrived", self.summary_schema)

    def newest(self) -> int | None:
        """The newest complete load."""
        return self._summaries().agg(F.max(ARRIVAL)).first()[0]

    def arrived(self, after: int, upto: int) -> DataFrame:
        """``entity_id, key_id, first_ms, last_ms`` of the series in the loads after one, up to another."""
        rows = self._summaries().filter((F.col(ARRIVAL) > after) & (F.col(ARRIVAL) <= upto))
        return rows.groupBy("entity_id", F.col("key").alias("key_id")).agg(
            F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms")
        )

    def seen(self, upto: int) -> DataFrame:
        """``entity_id, key_id, first_ms, first_arrival`` of every series that has ever reported."""
        rows = self._summaries().filter(F.col(ARRIVAL) <= upto)
        return rows.groupBy("entity_id", F.col("key").alias("key_id")).agg(
            F.min("first_ms").alias("first_ms"), F.min(ARRIVAL).alias("first_arrival")
        )

    def values(
        self,
        upto: int,
        start: datetime | None = None,
        end: datetime | None = None,
        after: int | None = None,
        dates: list[date] | None = None,
    ) -> DataFrame:
        """Readings of the loads after one, up to another; times and dates prune folders."""
        schema = T.StructType([*self.schema.fields, T.StructField(ARRIVAL, T.LongType()), T.StructField(DATE, T.DateType())])
        rows = read_or_empty(self.spark, f"{self.root}/telemetry", schema).filter(F.col(ARRIVAL) <= upto)
        if after is not None:
            rows = rows.filter(F.col(ARRIVAL) > after)
        if dates is not None:
            rows = rows.filter(F.col(DATE).isin(dates))
        return telemetry_values(rows, start, end, DATE)
