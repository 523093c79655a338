"""Stored tables that shrink: retention, log clean-up, and columns that go.

A table is changed one partition folder at a time, and only where there is something to change: a
folder that is wholly too old is deleted without being read, one without a match keeps its files.
A folder that is rewritten is completed beside the table first and then takes the old one's place;
an action that died is called again and finishes what is complete before it goes on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold.functions.timebucket import instant_ms
from meterfold.sources.store import FACT_TABLES, StatStore
from meterfold.sources.telemetry import HOT_RETENTION, LOG_MARKS


@dataclass
class Changes:
    """Folders that an action deleted and rewrote, as ``column=value/...`` below the table."""

    dropped: list[str] = field(default_factory=list)
    rewritten: list[str] = field(default_factory=list)


class Folders:
    """The partition folders of a Parquet table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.beside = f"{self.path}.rewrite"
        self._fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _below(self, root: str) -> list[str]:
        """Relative paths of the innermost folders named ``column=value``."""
        found, open_ = [], [""]
        while open_:
            folder = open_.pop()
            at = self._at(f"{root}/{folder}" if folder else root)
            if not self._fs.exists(at):
                continue
            names = [s.getPath().getName() for s in self._fs.listStatus(at) if s.isDirectory()]
            inner = [f"{folder}/{n}" if folder else n for n in names if "=" in n]
            open_ += inner
            if folder and not inner:
                found.append(folder)
        return sorted(found)

    def all(self) -> list[str]:
        return self._below(self.path)

    def read(self, folder: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{folder}")

    def drop(self, folder: str) -> None:
        self._fs.delete(self._at(f"{self.path}/{folder}"), True)

    def replace(self, folder: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.beside}/{folder}")
        self._swap(folder)

    def _swap(self, folder: str) -> None:
        new, old = self._at(f"{self.beside}/{folder}"), self._at(f"{self.path}/{folder}")
        self._fs.delete(old, True)
        self._fs.mkdirs(old.getParent())
        if not self._fs.rename(new, old):
            raise OSError(f"{new} could not take the place of {old}")

    def resume(self) -> list[str]:
        """Let folders that an earlier call completed take their place; what it left half done is deleted."""
        done = [f for f in self._below(self.beside) if self._fs.exists(self._at(f"{self.beside}/{f}/_SUCCESS"))]
        for folder in done:
            self._swap(folder)
        self._fs.delete(self._at(self.beside), True)
        return done


def _value(folder: str, column: str) -> str:
    return dict(part.split("=", 1) for part in folder.split("/"))[column]


def retain(
    spark: SparkSession, path: str, as_of: datetime, keep: timedelta = HOT_RETENTION, date_column: str = "date", ts: str = "ts"
) -> Changes:
    """Delete stored telemetry older than the retention; ``date_column`` is the local date of ``ts`` (epoch ms).

    Whole dates go without being read. Of the date in which the retention ends the later rows are kept.
    """
    folders, horizon = Folders(spark, path), as_of - keep
    changes = Changes(rewritten=folders.resume())
    for folder in folders.all():
        day = date.fromisoformat(_value(folder, date_column))
        if day < horizon.date():
            folders.drop(folder)
            changes.dropped.append(folder)
        elif day == horizon.date():
            rows, kept = folders.read(folder), F.col(ts) >= instant_ms(horizon)
            if rows.filter(~F.coalesce(kept, F.lit(False))).limit(1).collect():
                folders.replace(folder, rows.filter(kept))
                changes.rewritten.append(folder)
    return changes


def _matching(spark: SparkSession, path: str, folders: list[str], match: Column) -> list[str]:
    """The folders with a matching row, found in one pass over the columns of the match."""
    if not folders:
        return []
    file = F.col("_metadata.file_path")
    hits = spark.read.parquet(path).filter(match).select(F.regexp_replace(file, "/[^/]*$", "").alias("d")).distinct()
    # one row per folder at most
    found = [r["d"] for r in hits.collect()]
    return [f for f in folders if any(d.endswith(f"/{f}") for d in found)]


def drop_logs(spark: SparkSession, path: str, text: str = "str_v", marks: tuple[str, ...] = LOG_MARKS) -> Changes:
    """Delete stored rows whose text carries a log mark; a folder without any keeps its files."""
    folders = Folders(spark, path)
    changes = Changes(rewritten=folders.resume())
    marked = F.lit(False)
    for mark in marks:
        marked = marked | F.col(text).contains(mark)
    marked = F.coalesce(marked, F.lit(False))
    for folder in _matching(spark, path, folders.all(), marked):
        folders.replace(folder, folders.read(folder).filter(~marked))
        changes.rewritten.append(folder)
    return changes


def drop_column(spark: SparkSession, path: str, column: str, progress: Callable[[str], None] = lambda folder: None) -> Changes:
    """Rewrite the folders whose files have a column without it; those that have not stay as they are.

    ``progress`` is called after each folder.
    """
    folders = Folders(spark, path)
    changes = Changes(rewritten=folders.resume())
    for folder in folders.all():
        rows = folders.read(folder)
        if column in rows.columns:
            folders.replace(folder, rows.drop(column))
            changes.rewritten.append(folder)
            progress(folder)
    return changes


def drop_fact_column(store: StatStore, column: str = "entity_id", progress: Callable[[str], None] = lambda folder: None) -> dict[str, Changes]:
    """:func:`drop_column` on all fact tables of a store. A column of the facts' key cannot go."""
    if column in ("device_type", "device_id", "key_id", "stat_time"):
        raise ValueError(f"{column} is part of the facts' key")
    return {t: drop_column(store.spark, store.path(t), column, progress) for t in FACT_TABLES}
