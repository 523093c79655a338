"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; on a cluster the submitter's settings apply.

    All of it runs on one machine, so where no checkpoint folder is set a temporary one will do.
    """
    builder = SparkSession.builder
    if SparkConf().get("spark.checkpoint.dir") is None:
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="meterfold-"))
    spark = (
        builder.master(f"local[{cores}]")
        .appName("meterfold")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, which the driver and all executors share."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier run has used.

    Paths are grouped by day, so that a retention rule on the folder can expire them.
    """
    return f"{shared_dir(spark)}/meterfold/{date.today().isoformat()}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage on storage that outlives any executor, so that several consumers
    share one computation and a lost executor costs a re-read, not a re-run.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """:func:`materialise` for as long as a block runs; the copy is deleted when the block is done."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    yield spark.read.schema(df.schema).parquet(path)
    discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of the library's own below the shared one."""
    if "/meterfold/" not in path:
        raise ValueError(f"not a temporary folder: {path}")
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, asked of the file system the path belongs to."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet folder with its declared schema; no rows where nothing was written yet."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
