"""Streams over several files must give what the batch operators give."""

import random
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterfold.operators.consumption import reading_delta
from meterfold.operators.series import Series
from meterfold.sources.store import StatStore
from meterfold.streaming.bucket_stats import stream_bucket_stats, upsert_stream
from meterfold.streaming.delta import DeltaStream

SCHEMA = "entity_id string, key_id int, ts timestamp_ntz, value bigint"


@pytest.fixture(scope="module")
def files(spark):
    """Four files, each later than the one before, and all readings together."""
    rng = random.Random(3)
    folder, ts, everything = tempfile.mkdtemp(prefix="meterfold-stream-"), datetime(2024, 1, 1, 5), []
    for i in range(4):
        rows = []
        for _ in range(60):
            ts += timedelta(minutes=rng.choice([1, 3, 40, 200]))
            rows.append((rng.choice("aab"), 142, ts, None if rng.random() < 0.1 else rng.randrange(1000)))
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        everything += rows
    return folder, spark.createDataFrame(everything, SCHEMA)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def key_rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_deltas_over_several_batches_equal_the_batch_result(spark, files):
    folder, everything = files
    deltas = DeltaStream(tempfile.mkdtemp(prefix="meterfold-test-"), stream(spark, folder).schema)
    checkpoint = tempfile.mkdtemp(prefix="meterfold-test-")
    deltas.start(stream(spark, folder), checkpoint).awaitTermination()
    columns = ["entity_id", "key_id", "ts", "delta"]
    assert key_rows(deltas.deltas(spark), *columns) == key_rows(reading_delta(everything), *columns)
    assert deltas.late(spark).count() == 0


def test_a_repeated_batch_changes_nothing(spark, frame):
    first = frame([("a", 1, "2024-01-01 00:00:00", 5), ("a", 1, "2024-01-01 01:00:00", 9)], SCHEMA)
    second = frame([("a", 1, "2024-01-02 00:00:00", 20), ("b", 1, "2024-01-02 00:00:00", 1)], SCHEMA)
    deltas = DeltaStream(tempfile.mkdtemp(prefix="meterfold-test-"), first.schema)
    deltas.process(first, 0)
    deltas.process(second, 1)
    once = key_rows(deltas.deltas(spark), "entity_id", "ts", "delta")
    assert [r[2] for r in once] == [4, 11]
    deltas.process(second, 1)
    assert key_rows(deltas.deltas(spark), "entity_id", "ts", "delta") == once
    deltas.process(frame([("a", 1, "2024-01-03 00:00:00", 21), ("b", 1, "2024-01-03 00:00:00", 4)], SCHEMA), 2)
    assert sorted(r["delta"] for r in deltas.deltas(spark).collect()) == [1, 3, 4, 11]


def test_late_readings_are_kept_aside(spark, frame):
    deltas = DeltaStream(tempfile.mkdtemp(prefix="meterfold-test-"), frame([], SCHEMA).schema)
    deltas.process(frame([("a", 1, "2024-01-02 00:00:00", 5)], SCHEMA), 0)
    deltas.process(frame([("a", 1, "2024-01-01 00:00:00", 1), ("a", 1, "2024-01-03 00:00:00", 8)], SCHEMA), 1)
    assert [(r["ts"].day, r["value"]) for r in deltas.late(spark).collect()] == [(1, 1)]
    assert [(r["ts"].day, r["delta"]) for r in deltas.deltas(spark).collect()] == [(3, 3)]


@pytest.mark.parametrize("grain, table, shift", [("hour", "hourly", 0), ("day", "daily", 8)])
def test_bucket_statistics(spark, frame, files, grain, table, shift):
    folder, everything = files
    devices = frame([("da", "a", "W"), ("db", "b", "W")], "device_id string, entity_id string, device_type string")
    store = StatStore(spark, tempfile.mkdtemp(prefix="meterfold-test-"))
    stats = stream_bucket_stats(stream(spark, folder), grain, Series(), delay="1 day")
    upsert_stream(stats, devices, store, table, grain, tempfile.mkdtemp(prefix="meterfold-test-")).awaitTermination()
    bucket = F.date_trunc(grain, F.col("ts") - F.lit(timedelta(hours=shift))).cast("timestamp_ntz")
    want = everything.groupBy(F.concat(F.lit("d"), "entity_id").alias("device_id"), bucket.alias("stat_time")).agg(
        F.avg("value").alias("dbl_stats"), F.min("value").cast("double").alias("dbl_min"), F.max("value").cast("double").alias("dbl_max")
    )
    columns = ["device_id", "stat_time", "dbl_stats", "dbl_min", "dbl_max"]
    assert key_rows(store.read(table), *columns) == key_rows(want, *columns)
