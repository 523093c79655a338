from datetime import datetime

from pyspark.sql import functions as F

from meterfold.operators import carbon, tariff

RATE = "id int, effective_on timestamp_ntz"
CHARGE = (
    "electricity_rate_id int, day_type string, season_type string, period_type string, "
    "summer_rate double, non_summer_rate double"
)


def priced(frame, instants, versions, charges, **options):
    df = frame([(t,) for t in instants], "ts timestamp_ntz")
    got = tariff.with_electricity_rate(df, "ts", frame(versions, RATE), frame(charges, CHARGE), **options)
    return {r["ts"].isoformat(sep=" "): r["charge_rate"] for r in got.collect()}


def test_highest_id_in_force_wins(frame):
    """Version 3 takes effect before version 2; from then on 2 is never the highest."""
    versions = [(1, "2020-01-01"), (3, "2021-01-01"), (2, "2022-01-01"), (5, "2023-01-01"), (4, "2023-01-01")]
    charges = [(i, "S", "A", "OP", float(i), i + 0.5) for i in (1, 2, 3, 4, 5)]
    sundays = ["2019-06-02 12:00:00", "2020-06-07 12:00:00", "2021-12-05 12:00:00", "2022-06-05 12:00:00", "2024-06-02 12:00:00"]
    got = priced(frame, sundays, versions, charges)
    assert [got[s] for s in sundays] == [None, 1.0, 3.5, 3.0, 5.0]


def test_version_holds_from_its_first_instant(frame):
    versions = [(1, "2020-01-01"), (2, "2023-01-01")]
    charges = [(1, "S", "A", "OP", 1.0, 1.0), (2, "S", "A", "OP", 2.0, 2.0)]
    got = priced(frame, ["2022-12-25 23:59:59", "2023-01-01 00:00:00"], versions, charges)
    assert list(got.values()) == [1.0, 2.0]


def test_season_picks_the_column(frame):
    charges = [(1, "O", "S", "PE", 9.0, None), (1, "O", "N", "PP", None, 5.0), (1, "O", "S", "PP", 7.0, None)]
    instants = ["2025-09-01 21:59:59", "2025-09-01 22:00:00", "2025-12-01 14:00:00", "2025-12-01 12:00:00"]
    got = priced(frame, instants, [(1, "2020-01-01")], charges)
    assert [got[i] for i in instants] == [9.0, 7.0, 5.0, None]
    closed = priced(frame, instants, [(1, "2020-01-01")], charges, closed=True)
    assert [closed[i] for i in instants] == [9.0, 9.0, 5.0, None]


def test_a_missing_cell_of_the_version_in_force_gives_no_price(frame):
    """The older version has the cell, but it no longer holds."""
    versions = [(1, "2020-01-01"), (2, "2023-01-01")]
    assert priced(frame, ["2024-06-02 12:00:00"], versions, [(1, "S", "A", "OP", 1.0, 1.0)]) == {"2024-06-02 12:00:00": None}


def test_charge_info_drops_unpriced_buckets(frame):
    df = frame([("2024-06-02 12:00:00",), ("2024-06-03 12:00:00",)], "ts timestamp_ntz")
    got = tariff.with_charge_info(
        df, "ts", frame([(1, "2020-01-01")], RATE), frame([(1, "S", "A", "OP", 1.0, 1.0)], CHARGE)
    ).collect()
    assert [(r["ts"], r["period_type"], r["charge_rate"]) for r in got] == [(datetime(2024, 6, 2, 12), "OP", 1.0)]


def test_tou_split(frame):
    hourly = frame(
        [("d", "E", 554, "2025-09-01 17:00:00", 2.0, 20.0, "PE"), ("d", "E", 554, "2025-09-01 09:00:00", 3.0, 15.0, "PP"),
         ("d", "E", 554, "2025-09-02 07:00:00", 5.0, 10.0, "OP"), ("d", "E", 554, "2025-09-06 12:00:00", 7.0, 14.0, "SPP")],
        "device_id string, device_type string, key_id int, stat_time timestamp_ntz, dbl_stats double, charge double, period_type string",
    )
    first, saturday = tariff.tou_split(hourly).orderBy("stat_time").collect()
    assert first["stat_time"] == datetime(2025, 9, 1)
    assert (first["peak_energy"], first["partial_peak_energy"], first["off_peak_energy"]) == (2.0, 3.0, 5.0)
    assert (first["charge"], first["peak_charge"], first["off_peak_charge"]) == (45.0, 20.0, 10.0)
    assert (saturday["partial_peak_energy"], saturday["peak_energy"]) == (7.0, None)


USED = "factory_id string, device_type string, device_id string, consumption double"
PARAM = "factory_id string, device_type string, param_name string, float_value double"


def test_carbon_left_and_inner(frame):
    used = frame([("A", "E", "d1", 10.0), ("B", "E", "d2", 10.0), ("A", "W", "d3", 10.0)], USED)
    param = frame(
        [("A", "E", carbon.ELECTRICITY_COEFFICIENT, 0.5), ("A", "G", carbon.ELECTRICITY_COEFFICIENT, 0.5), ("B", "W", "x", 2.0)],
        PARAM,
    )
    by_type = {r["device_id"]: r["kgco2e"] for r in carbon.carbon_by_device_type(used, param).collect()}
    assert by_type == {"d1": 5.0, "d2": None, "d3": None}
    by_name = [(r["device_id"], r["kgco2e"]) for r in carbon.carbon_by_param_name(used, param).orderBy("device_id").collect()]
    assert by_name == [("d1", 5.0), ("d3", 5.0)]


def test_price_join_is_exact_without_a_broadcast(spark, frame):
    """Beyond the broadcast threshold the same prices come from a sort-merge join."""
    versions, charges = [(1, "2020-01-01")], [(1, "S", "A", "OP", 1.0, 2.0)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert priced(frame, ["2024-06-02 12:00:00", "2024-12-01 12:00:00"], versions, charges) == {
            "2024-06-02 12:00:00": 1.0,
            "2024-12-01 12:00:00": 2.0,
        }
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
