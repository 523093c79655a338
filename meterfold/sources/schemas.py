"""Explicit schemas of telemetry, dimensions and statistic facts."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_STRING, _INT, _LONG, _DOUBLE, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()

TS_KV = _struct(entity_id=_STRING, key=_INT, ts=_LONG, dbl_v=_DOUBLE)
TS_KV_HOT = _struct(
    entity_id=_STRING, key=_INT, ts=_LONG, bool_v=T.BooleanType(), str_v=_STRING, long_v=_LONG, dbl_v=_DOUBLE, json_v=_STRING
)
DEVICE = _struct(device_id=_STRING, entity_id=_STRING, factory_id=_STRING, device_type=_STRING, node_id=_STRING)
KEY_DICTIONARY = _struct(key_id=_INT, key=_STRING)
KEY_CONFIG = _struct(
    device_type=_STRING, accumulation_key_id=_INT, consumption_key_id=_INT, rate_key_id=_INT, emission_coeff=_DOUBLE
)
AVG_KEY_CONFIG = _struct(rate_key_id=_INT, avg_key_id=_INT)
DEVICE_KEYS = _struct(device_type=_STRING, key_id=_INT, key_type=_STRING)
CONFIG_PARAM = _struct(
    param_id=_INT, param_name=_STRING, float_value=_DOUBLE, factory_id=_STRING, device_type=_STRING
)
ELECTRICITY_RATE = _struct(id=_INT, effective_on=_TS)
ENERGY_CHARGE = _struct(
    electricity_rate_id=_INT,
    day_type=_STRING,
    season_type=_STRING,
    period_type=_STRING,
    summer_rate=_DOUBLE,
    non_summer_rate=_DOUBLE,
)
LATEST = _struct(device_id=_STRING, device_type=_STRING, key_id=_INT, latest_stat_time=_TS, latest_epoch=_LONG)
# A stored watermark: where its facts begin, up to where a rewound one has to be redone, and of a
# counter the reading before its bucket (`carry_ms` is -1 where there is none).
MARK = T.StructType([*LATEST.fields, *_struct(first_stat_time=_TS, redo_until=_TS, carry_ms=_LONG, carry_value=_DOUBLE).fields])
# Which owner writes a measure of a fact table, and up to which load or source a job has worked.
CLAIM = _struct(fact_table=_STRING, device_type=_STRING, key_id=_INT)
PROGRESS = _struct(job=_STRING, arrival=_LONG)
SOURCE = T.StructType([T.StructField("job", _STRING), *LATEST.fields])

_KEY = dict(device_type=_STRING, device_id=_STRING, key_id=_INT, stat_time=_TS, stat_type=_INT, dbl_stats=_DOUBLE)
_SPREAD = dict(dbl_avg=_DOUBLE, dbl_min=_DOUBLE, dbl_max=_DOUBLE)
_LONGS = dict(long_avg=_DOUBLE, long_min=_LONG, long_max=_LONG)
_TOU = dict(
    peak_energy=_DOUBLE,
    partial_peak_energy=_DOUBLE,
    off_peak_energy=_DOUBLE,
    charge=_DOUBLE,
    peak_charge=_DOUBLE,
    partial_peak_charge=_DOUBLE,
    off_peak_charge=_DOUBLE,
)

MINUTELY = _struct(**_KEY, kgco2e=_DOUBLE)
HOURLY = _struct(
    **_KEY, **_SPREAD, long_stats=_LONG, charge=_DOUBLE, period_type=_STRING, kgco2e=_DOUBLE
)
DAILY = _struct(**_KEY, **_SPREAD, long_stats=_DOUBLE, **_LONGS, **_TOU, kgco2e=_DOUBLE)
MONTHLY = _struct(**_KEY, long_stats=_DOUBLE, **_TOU, kgco2e=_DOUBLE)
YEARLY = MONTHLY
