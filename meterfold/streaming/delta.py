"""Counter steps over a stream of readings.

A window over a stream is not possible, and a stateful operator would hand a whole series'
readings to one task. Each micro-batch is therefore a small batch job: the last reading of
every series comes from a state table, and the steps are computed by the batch operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterfold.operators.consumption import reading_delta
from meterfold.operators.series import Series
from meterfold.session import passing, read_or_empty

BATCH = "batch_id"
# After so many batches what they left behind is put together.
SNAPSHOT_EVERY = 16


class DeltaStream:
    """Steps, late readings and state below one folder.

    The state is the last reading of each series. A batch adds the last readings of the series it
    holds, as a part of its own, and reads the parts of the batches before it back to the newest
    snapshot; so what a batch writes depends on its own size, and a batch that is run again finds
    the state as it was and replaces what it wrote.
    """

    def __init__(self, root: str, schema: T.StructType, s: Series = Series(), slice_grain: str = "hour"):
        self.root, self.schema, self.s, self.slice_grain = root.rstrip("/"), schema, s, slice_grain
        self.kept = list(dict.fromkeys([s.ts, s.order, s.value]))
        self.state_schema = T.StructType([*[schema[c] for c in (*s.keys, *self.kept)], T.StructField(BATCH, T.LongType())])

    def start(self, readings: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Process the stream; ``trigger`` is Spark's, by default one pass over what is available."""
        return (
            readings.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def _read(self, spark, part: str, schema: T.StructType) -> DataFrame:
        return read_or_empty(spark, f"{self.root}/{part}", schema)

    def _with_batch(self, schema: T.StructType) -> T.StructType:
        return T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])

    def deltas(self, spark) -> DataFrame:
        """The steps found so far."""
        step = T.StructField("delta", self.schema[self.s.value].dataType)
        return self._read(spark, "deltas", self._with_batch(T.StructType([*self.schema.fields, step]))).drop(BATCH)

    def late(self, spark) -> DataFrame:
        """Readings not newer than one already processed; they need a batch run over their time."""
        return self._read(spark, "late", self._with_batch(self.schema)).drop(BATCH)

    def _write(self, rows: DataFrame, part: str, partition: str) -> None:
        (
            rows.hint("rebalance", partition)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(f"{self.root}/{part}")
        )

    def _state_before(self, spark, batch_id: int) -> DataFrame:
        """The last reading of every series in the batches before one."""
        snapshots = self._read(spark, "snapshots", self.state_schema).filter(F.col(BATCH) < batch_id)
        newest = snapshots.agg(F.max(BATCH)).first()[0]
        parts = self._read(spark, "state", self.state_schema).filter(F.col(BATCH) < batch_id)
        if newest is not None:
            parts = parts.filter(F.col(BATCH) > newest).unionByName(snapshots.filter(F.col(BATCH) == newest))
        return self._newest(parts)

    def _newest(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.s.keys).agg(*[self.s.last(c).alias(c) for c in self.kept])

    def process(self, batch: DataFrame, batch_id: int) -> None:
        s, keys = self.s, list(self.s.keys)
        before = self._state_before(batch.sparkSession, batch_id)
        # the join spreads a busy series over tasks: Spark splits the skewed side of a left join
        known = before.select(*keys, F.col(s.order).alias("_known"))
        judged = batch.join(known, keys, "left").withColumn(
            "_late", F.col("_known").isNotNull() & (F.col(s.order) <= F.col("_known"))
        )
        number = F.lit(batch_id).cast("bigint").alias(BATCH)
        with passing(judged, "stream-batch") as rows:
            fresh = rows.filter(~F.col("_late")).drop("_late", "_known")
            late = rows.filter("_late").drop("_late", "_known")
            active = before.join(fresh.select(*keys).distinct(), keys, "left_semi")
            readings = fresh.withColumn("_carried", F.lit(False)).unionByName(
                active.withColumn("_carried", F.lit(True)), allowMissingColumns=True
            )
            steps = reading_delta(readings, s, slice_grain=self.slice_grain).filter(~F.col("_carried")).drop("_carried")
            self._write(steps.select(*batch.columns, "delta", number), "deltas", BATCH)
            self._write(late.select(*batch.columns, number), "late", BATCH)
            self._write(self._newest(fresh).select("*", number), "state", BATCH)
        if batch_id % SNAPSHOT_EVERY == SNAPSHOT_EVERY - 1:
            self._write(self._state_before(batch.sparkSession, batch_id + 1).select("*", number), "snapshots", BATCH)
