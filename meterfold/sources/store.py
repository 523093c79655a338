"""Statistic facts and watermarks on Parquet, merged one partition at a time."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterfold.operators import incremental
from meterfold.operators.incremental import SERIES_KEY, run_metrics
from meterfold.operators.quality import assert_unique_key
from meterfold.operators.statistics import FACT_KEY
from meterfold.session import discard, fresh_path, materialise, path_exists, read_or_empty
from meterfold.sources import schemas

PERIOD, OWNER = "period", "owner"

# Schema, key and partitioning of each table. Minute and hour facts are kept per day, so that
# redoing the open bucket rewrites a day; the others are kept by the values of some columns.
TABLES = {
    "minutely": (schemas.MINUTELY, FACT_KEY, "yyyy-MM-dd"),
    "hourly": (schemas.HOURLY, FACT_KEY, "yyyy-MM-dd"),
    "daily": (schemas.DAILY, FACT_KEY, "yyyy-MM"),
    "monthly": (schemas.MONTHLY, FACT_KEY, "yyyy"),
    "yearly": (schemas.YEARLY, FACT_KEY, "yyyy"),
    "minute_latest": (schemas.MARK, SERIES_KEY, ("device_type", "key_id")),
    "hour_latest": (schemas.MARK, SERIES_KEY, ("device_type", "key_id")),
    "day_latest": (schemas.MARK, SERIES_KEY, ("device_type", "key_id")),
    "tou_latest": (schemas.MARK, SERIES_KEY, ("device_type", "key_id")),
    "minute_searched": (schemas.LATEST, SERIES_KEY, ("device_type", "key_id")),
    "hour_searched": (schemas.LATEST, SERIES_KEY, ("device_type", "key_id")),
    "day_searched": (schemas.LATEST, SERIES_KEY, ("device_type", "key_id")),
    "month_rewound": (schemas.LATEST, SERIES_KEY, ("device_type", "key_id")),
    "year_rewound": (schemas.LATEST, SERIES_KEY, ("device_type", "key_id")),
    "claims": (schemas.CLAIM, ["fact_table", "device_type", "key_id"], ("fact_table",)),
    "progress": (schemas.PROGRESS, ["job"], ("job",)),
    "sources": (schemas.SOURCE, ["job", *SERIES_KEY], ("job",)),
}
FACT_TABLES = ("minutely", "hourly", "daily", "monthly", "yearly")

# Up to where telemetry was searched for series that have no watermark yet.
SEARCHED = {"minute_latest": "minute_searched", "hour_latest": "hour_searched", "day_latest": "day_searched"}

# Owner of the tables that belong to series and not to jobs: each measure has a partition of its own.
COMMON = "all"

_STRFTIME = {"yyyy-MM-dd": "%Y-%m-%d", "yyyy-MM": "%Y-%m", "yyyy": "%Y"}


class OwnershipError(ValueError):
    """Facts of a measure that another owner writes."""


class StatStore:
    """The statistic tables below one folder.

    Facts are kept in partitions by their owner, the job that writes them, and by period. A job
    merges into its own partitions only, so jobs that share a table may run at the same time; the
    same job must not run twice at once, nor jobs of one owner (profile, consumption and shares of
    the day, which work on the same rows). Readers see all owners.

    Each measure of a fact table, a device type and key, has one owner: the first to write it, which
    is recorded. Facts of another owner's measure are refused before anything is written, so a fact
    is one row whoever computes it; a stream that takes a job's place must be of the job's owner.

    Watermarks belong to series. They are kept by measure, whoever moves or rewinds them.
    """

    def __init__(self, spark: SparkSession, root: str, owner: str = "shared"):
        self.spark, self.root, self.owner = spark, root.rstrip("/"), owner

    def owned_by(self, owner: str) -> StatStore:
        return StatStore(self.spark, self.root, owner)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _read(self, table: str) -> DataFrame:
        schema = T.StructType([*TABLES[table][0].fields, *[T.StructField(c, T.StringType()) for c in (OWNER, PERIOD)]])
        return read_or_empty(self.spark, self.path(table), schema)

    def read(
        self, table: str, since: datetime | None = None, before: datetime | None = None, dates: list[date] | None = None
    ) -> DataFrame:
        """A table, on request the partitions from that of ``since`` on, those before ``before``'s, or those of ``dates``."""
        stored = self._read(table)
        if dates is not None:
            stored = stored.filter(self._in_dates(table, dates))
        pattern = _STRFTIME.get(TABLES[table][2]) if table in FACT_TABLES else None
        if since is not None:
            stored = stored.filter(F.col(PERIOD) >= since.strftime(pattern))
        if before is not None:
            stored = stored.filter(F.col(PERIOD) < before.strftime(pattern))
        return stored.drop(OWNER, PERIOD)

    def _in_dates(self, table: str, dates: list[date]) -> Column:
        return F.col(PERIOD).isin(sorted({d.strftime(_STRFTIME[TABLES[table][2]]) for d in dates}))

    def _shaped(self, table: str, rows: DataFrame) -> DataFrame:
        """The columns ``rows`` bring, in the table's types, with their partition."""
        schema, _, pattern = TABLES[table]
        owner = self.owner if table in (*FACT_TABLES, "claims") else COMMON
        period = F.date_format("stat_time", pattern) if isinstance(pattern, str) else F.concat_ws("-", *pattern)
        present = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name in rows.columns]
        return rows.select(*present).withColumns({OWNER: F.lit(owner), PERIOD: period})

    def _claim(self, table: str, staged: DataFrame) -> None:
        """Record this owner's measures among ``staged``; one that another owner writes is an error.

        What comes to the driver are device types and keys, however many devices there are. Of two
        owners that claim a measure at the same time the first by name gets it.
        """
        if table not in FACT_TABLES:
            return
        wanted = {(r["device_type"], r["key_id"]) for r in staged.select("device_type", "key_id").distinct().collect()}

        def owners() -> dict[tuple, str]:
            held: dict[tuple, str] = {}
            for r in self._read("claims").filter(F.col("fact_table") == table).collect():
                measure = (r["device_type"], r["key_id"])
                held[measure] = min(r[OWNER], held.get(measure, r[OWNER]))
            return held

        new = wanted - owners().keys()
        if new:
            rows = [(table, *measure) for measure in sorted(new, key=str)]
            claims = self.spark.createDataFrame(rows, schemas.CLAIM).coalesce(1)
            self._write("claims", self._shaped("claims", claims), "append")
        foreign = {m: o for m, o in owners().items() if m in wanted and o != self.owner}
        if foreign:
            raise OwnershipError(f"{table} of {sorted(foreign.items(), key=str)} is not written by {self.owner}")

    def _stage(self, table: str, rows: DataFrame) -> tuple[DataFrame, dict]:
        """Compute ``rows`` once; all that follows reads the written copy."""
        shaped = self._shaped(table, rows)
        metrics = None
        if "stat_time" in shaped.columns:
            shaped, metrics = run_metrics(shaped, f"run-{table}")
        staged = materialise(shaped, f"rows-{table}")
        # a key twice among the new rows would multiply in every later merge
        assert_unique_key(staged, TABLES[table][1])
        self._claim(table, staged)
        return staged, metrics.get if metrics is not None else {}

    def _completed(self, table: str, rows: DataFrame) -> DataFrame:
        """All columns of the table; those ``rows`` lack are NULL."""
        schema = TABLES[table][0]
        columns = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        return rows.select(*columns, OWNER, PERIOD)

    def _touched(self, table: str, staged: DataFrame, owned: bool = True) -> DataFrame:
        """The stored rows in the periods of ``staged``, a list the calendar bounds; the owner's or everybody's."""
        periods = [row[PERIOD] for row in staged.select(PERIOD).distinct().collect()]
        stored = self._read(table).filter(F.col(PERIOD).isin(periods))
        owner = self.owner if table in FACT_TABLES else COMMON
        return stored.filter(F.col(OWNER) == owner) if owned else stored

    def _replace(self, table: str, merged: DataFrame) -> None:
        """Swap the partitions of ``merged`` in.

        The merge reads what it replaces, so it is written aside first: should the driver die
        during the swap, the complete partitions are still in the shared folder.
        """
        path = fresh_path(self.spark, f"merged-{table}")
        merged.write.parquet(path)
        self._write(table, self.spark.read.schema(merged.schema).parquet(path), "overwrite")
        discard(self.spark, path)

    def _write(self, table: str, rows: DataFrame, mode: str) -> None:
        order = [PERIOD, *[k for k in TABLES[table][1] if k != "device_type"]]
        self._save(table, rows.hint("rebalance", PERIOD).sortWithinPartitions(*order), mode)

    def _save(self, table: str, rows: DataFrame, mode: str) -> None:
        writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(OWNER, PERIOD).parquet(self.path(table))

    def upsert(self, table: str, rows: DataFrame, columns: list[str]) -> tuple[DataFrame, dict]:
        """Insert or overwrite ``columns``; gives the staged rows and the run's metrics."""
        staged, metrics = self._stage(table, rows)
        if path_exists(self.spark, self.path(table)):
            stored = self._touched(table, staged)
            self._replace(table, incremental.upsert(stored, staged, TABLES[table][1], columns))
        else:
            # the first load has nothing to merge with
            self._write(table, self._completed(table, staged), "overwrite")
        return staged, metrics

    def update_only(self, table: str, rows: DataFrame, columns: list[str]) -> tuple[DataFrame, dict]:
        staged, metrics = self._stage(table, rows)
        stored = self._touched(table, staged)
        self._replace(table, incremental.update_only(stored, staged, TABLES[table][1], columns))
        return staged, metrics

    def insert_only(self, table: str, rows: DataFrame) -> tuple[DataFrame, dict]:
        """Append; a key already stored, by whichever owner, is an error and nothing is written."""
        staged, metrics = self._stage(table, rows)
        incremental.insert_only(self._touched(table, staged, owned=False), staged, TABLES[table][1])
        self._write(table, self._completed(table, staged), "append")
        return staged, metrics

    def advance(self, table: str, marks: DataFrame) -> None:
        """Store watermarks next to those of other series; columns that ``marks`` lack stay as they are.

        ``first_stat_time`` is where a series' facts begin and is kept once it is set.
        """
        columns = [f.name for f in TABLES[table][0].fields if f.name in marks.columns]
        self.merge_small(table, marks, [c for c in columns if c not in (*TABLES[table][1], "first_stat_time")])

    def merge_small(self, table: str, rows: DataFrame, columns: list[str]) -> None:
        """:meth:`upsert` of rows that are unique and cheap to compute twice, without a copy of their own."""
        shaped = self._shaped(table, rows)
        if path_exists(self.spark, self.path(table)):
            self._replace(table, incremental.upsert(self._touched(table, shaped), shaped, TABLES[table][1], columns))
        else:
            self._write(table, self._completed(table, shaped), "overwrite")

    def progress(self, job: str) -> int | None:
        """The newest load of telemetry that a job has worked on."""
        row = self.read("progress").filter(F.col("job") == job).first()
        return row["arrival"] if row else None

    def set_progress(self, job: str, arrival: int) -> None:
        row = self.spark.range(1, numPartitions=1).select(F.lit(job).alias("job"), F.lit(arrival).cast("bigint").alias("arrival"))
        self._save("progress", self._shaped("progress", row), "overwrite")
