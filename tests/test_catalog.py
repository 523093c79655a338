"""Every registered query against its SQL on the smallest data set."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import rows_of  # noqa: E402
from meterfold.catalog.oracle_queries import ORACLES  # noqa: E402
from meterfold.catalog.queries import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test data not present")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["entity_id", "key_id", "bucket", "min_value", "next_min_value", "energy_consumption"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, tables, name):
    df = QUERIES[name](spark, SF_DIR)
    result = tables.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())
