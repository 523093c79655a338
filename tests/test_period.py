import pytest
from pyspark.sql import functions as F

from meterfold.functions import period
from meterfold.operators.quality import period_truth_table

# Instants at the boundaries of every span and the period that holds there.
# Midnight ending a day is written as the next day's 00:00:00.
CASES = [
    ("2025-09-01 16:00:00", "PE"),
    ("2025-09-01 21:59:59", "PE"),
    ("2025-09-01 22:00:00", "PP"),
    ("2025-09-01 09:00:00", "PP"),
    ("2025-09-01 15:59:59", "PP"),
    ("2025-09-01 23:59:59", "PP"),
    ("2025-09-02 00:00:00", "OP"),
    ("2025-12-01 06:00:00", "PP"),
    ("2025-12-01 10:59:59", "PP"),
    ("2025-12-01 11:00:00", "OP"),
    ("2025-12-01 14:00:00", "PP"),
    ("2025-12-01 23:59:59", "PP"),
    ("2025-12-02 00:00:00", "OP"),
    ("2025-09-01 00:00:00", "OP"),
    ("2025-09-01 08:59:59", "OP"),
    ("2025-12-01 00:00:00", "OP"),
    ("2025-12-01 05:59:59", "OP"),
    ("2025-12-01 13:59:59", "OP"),
    ("2025-09-06 09:00:00", "SPP"),
    ("2025-09-06 23:59:59", "SPP"),
    ("2025-09-07 00:00:00", "OP"),
    ("2025-12-06 06:00:00", "SPP"),
    ("2025-12-06 10:59:59", "SPP"),
    ("2025-12-06 11:00:01", "OP"),
    ("2025-12-06 14:00:00", "SPP"),
    ("2025-12-06 23:59:59", "SPP"),
    ("2025-12-07 00:00:00", "OP"),
    ("2025-09-07 11:23:00", "OP"),
    ("2025-12-07 11:23:00", "OP"),
]


def test_truth_table(frame):
    checked = period_truth_table(frame(CASES, "ts timestamp_ntz, expected string"))
    assert checked.filter("verify = 'N'").collect() == []
    assert checked.count() == len(CASES)


def test_truth_table_reports_a_difference(frame):
    wrong = period_truth_table(frame([("2025-09-01 16:00:00", "OP")], "ts timestamp_ntz, expected string"))
    assert wrong.first()["verify"] == "N"


@pytest.mark.parametrize(
    "ts, half_open, closed",
    [
        ("2025-09-01 22:00:00", "PP", "PE"),
        ("2025-09-01 22:00:00.5", "PP", "PP"),
        ("2025-09-01 16:00:00", "PE", "PE"),
        ("2025-12-01 11:00:00", "OP", "PP"),
        ("2025-12-01 11:00:00.000001", "OP", "OP"),
        ("2025-12-06 11:00:00", "OP", "SPP"),
        ("2025-05-15 16:00:00", "PP", "PP"),
        ("2025-05-16 16:00:00", "PE", "PE"),
        ("2025-10-15 16:00:00", "PE", "PE"),
        ("2025-10-16 16:00:00", "PP", "PP"),
    ],
)
def test_boundaries(frame, ts, half_open, closed):
    row = (
        frame([(ts,)], "ts timestamp_ntz")
        .select(period.period_type(F.col("ts")).alias("h"), period.rate_period_closed(F.col("ts")).alias("c"))
        .first()
    )
    assert (row["h"], row["c"]) == (half_open, closed)


def test_day_and_season(frame):
    df = frame([("2025-09-01",), ("2025-09-06",), ("2025-09-07",), ("2025-12-01",)], "ts timestamp_ntz")
    got = df.select(period.day_type(F.col("ts")), period.season_type(F.col("ts"))).collect()
    assert [tuple(r) for r in got] == [("O", "S"), ("T", "S"), ("S", "A"), ("O", "N")]
