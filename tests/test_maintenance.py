"""Actions on stored tables: untouched folders keep their files, and an action that died is finished."""

import tempfile
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterfold.functions.timebucket import epoch_ms
from meterfold.sources import maintenance
from meterfold.sources.store import FACT_TABLES, StatStore

AS_OF = datetime(2025, 3, 4, 17)


@pytest.fixture
def hot(spark):
    """Four days of hot telemetry by date; the third has log lines."""
    path = tempfile.mkdtemp(prefix="meterfold-hot-") + "/hot"
    rows = []
    for n in range(96):
        at = datetime(2025, 3, 1) + timedelta(hours=n)
        text = "x|ERROR|y" if at.day == 3 and n % 2 else None if n % 3 else "fine"
        rows.append((f"e{n % 5}", 1, epoch_ms(at), text, str(at.date())))
    spark.createDataFrame(rows, "entity_id string, key int, ts bigint, str_v string, date string").write.partitionBy("date").parquet(path)
    return path, rows


def files(path):
    return {str(p.relative_to(path)) for p in Path(path).rglob("*.parquet")}


def contents(spark, path):
    return sorted(str((r["entity_id"], r["ts"], r["str_v"])) for r in spark.read.parquet(path).collect())


def test_retention(spark, hot):
    path, rows = hot
    before = files(path)
    changes = maintenance.retain(spark, path, AS_OF)
    assert changes.dropped == [f"date=2025-03-0{d}" for d in (1, 2, 3)] and changes.rewritten == ["date=2025-03-04"]
    assert contents(spark, path) == sorted(str((r[0], r[2], r[3])) for r in rows if r[2] >= epoch_ms(AS_OF - timedelta(hours=8)))
    again = maintenance.retain(spark, path, AS_OF)
    assert not again.dropped and not again.rewritten
    assert not files(path) & before
    assert maintenance.retain(spark, path, AS_OF, timedelta(days=30)) == maintenance.Changes()


def test_log_lines(spark, hot):
    path, rows = hot
    before = files(path)
    assert maintenance.drop_logs(spark, path).rewritten == ["date=2025-03-03"]
    assert contents(spark, path) == sorted(str((r[0], r[2], r[3])) for r in rows if r[3] != "x|ERROR|y")
    kept = {f for f in before if "03-03" not in f}
    assert kept <= files(path)
    assert maintenance.drop_logs(spark, path) == maintenance.Changes()


def with_entity(spark, store):
    row = "device_type string, device_id string, key_id int, stat_time timestamp_ntz, dbl_stats double"
    facts = spark.createDataFrame([("W", f"w{d}", 626, datetime(2025, m, d), 1.0 * d) for m in (1, 2, 3) for d in (1, 2)], row)
    for table in FACT_TABLES:
        store.upsert(table, facts, ["dbl_stats"])
        path = store.path(table)
        whole = spark.read.parquet(path).withColumn("entity_id", F.lower("device_id"))
        whole.write.partitionBy("owner", "period").parquet(path + ".old")
        Path(path).rename(path + ".was")
        Path(path + ".old").rename(path)


def test_a_column_goes_from_all_tables_even_if_killed_in_the_middle(spark):
    store = StatStore(spark, tempfile.mkdtemp(prefix="meterfold-test-"))
    with_entity(spark, store)
    before = {t: sorted(map(tuple, store.read(t).collect()), key=str) for t in FACT_TABLES}
    seen = []

    def dies(folder):
        seen.append(folder)
        if len(seen) == 4:
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        maintenance.drop_fact_column(store, progress=dies)
    done = files(store.path("minutely"))
    changes = maintenance.drop_fact_column(store)
    assert len(changes["minutely"].rewritten) == 2 and len(changes["yearly"].rewritten) == 1
    assert len(done & files(store.path("minutely"))) >= 4
    for table in FACT_TABLES:
        assert "entity_id" not in spark.read.parquet(store.path(table)).columns
        assert sorted(map(tuple, store.read(table).collect()), key=str) == before[table]
    with pytest.raises(ValueError):
        maintenance.drop_fact_column(store, "device_id")


def test_a_folder_that_was_complete_takes_its_place(spark, hot, monkeypatch):
    """The action died after the old folder was deleted and before the new one was moved."""
    path, rows = hot
    want = sorted(str((r[0], r[2], r[3])) for r in rows if r[3] != "x|ERROR|y")

    def dies(self, folder):
        self.drop(folder)
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(maintenance.Folders, "_swap", dies)
        with pytest.raises(KeyboardInterrupt):
            maintenance.drop_logs(spark, path)
    assert not (Path(path) / "date=2025-03-03").exists()
    assert maintenance.drop_logs(spark, path).rewritten == ["date=2025-03-03"]
    assert contents(spark, path) == want
    assert not Path(path + ".rewrite").exists()
