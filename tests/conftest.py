import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from meterfold.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema to a DataFrame; timestamps may be given as text."""

    def make(rows, schema):
        names = [c.strip().split(" ")[0] for c in schema.split(",")]
        kinds = [c.strip().split(" ", 1)[1] for c in schema.split(",")]
        raw = ", ".join(
            f"{n} {'string' if k.startswith('timestamp') or k == 'date' else k}" for n, k in zip(names, kinds)
        )
        df = spark.createDataFrame(rows, raw)
        return df.selectExpr(*[f"CAST({n} AS {k}) AS {n}" for n, k in zip(names, kinds)])

    return make
