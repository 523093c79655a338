"""The registered queries' results in plain SQL, written without the library's operators."""

from __future__ import annotations

import re

from meterfold.catalog import views as v


def _values(rows: list[tuple]) -> str:
    def literal(x) -> str:
        return "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)

    return "(VALUES " + ", ".join("(" + ", ".join(literal(x) for x in row) + ")" for row in rows) + ")"


def _case(column: str, choices: dict, otherwise: str) -> str:
    def literal(x) -> str:
        return f"'{x}'" if isinstance(x, str) else str(x)

    arms = " ".join(f"WHEN '{name}' THEN {literal(result)}" for name, result in choices.items())
    return f"CASE {column} {arms} ELSE {otherwise} END"


def _status(status: str) -> str:
    return f"CAST(sum(c) FILTER (WHERE o_orderstatus = '{status}') AS BIGINT)"


def _fleet(bucket: str) -> str:
    return f"""SELECT d.device_id, d.device_type, d.factory_id, k.consumption_key_id AS key_id, c.bucket AS stat_time,
        c.consumption
        FROM (SELECT entity_id, key_id, bucket,
                coalesce(lead(mn) OVER (PARTITION BY entity_id, key_id ORDER BY bucket), mx) - mn AS consumption
              FROM (SELECT entity_id, key_id, {bucket} AS bucket, min(value_c) AS mn, max(value_c) AS mx
                    FROM counter GROUP BY ALL) b) c
        JOIN eligible d USING (entity_id)
        JOIN key_config k ON k.device_type = d.device_type AND k.accumulation_key_id = c.key_id"""


TOU = ["peak_energy", "partial_peak_energy", "off_peak_energy", "charge", "peak_charge", "partial_peak_charge", "off_peak_charge"]


def _period(source: str, grain: str, utility: str) -> str:
    """Month or year: electricity (``e``) by key type, the others (``o``) by key name."""
    key = "f.device_type, f.device_id, f.key_id, date_trunc('{}', f.stat_time) AS stat_time".format(grain)
    if utility == "e":
        tou = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in TOU)
        return f"""SELECT {key}, CASE WHEN k.key_type = 'C' THEN sum(dbl_stats) ELSE avg(dbl_stats) END AS dbl_stats,
            CASE WHEN k.key_type = 'C' THEN sum(long_stats) ELSE avg(long_stats) END AS long_stats, {tou},
            CAST(sum(kgco2e) AS BIGINT) AS kgco2e
            FROM {source} f JOIN device_keys k ON k.device_type = f.device_type AND k.key_id = f.key_id
            WHERE f.device_type = 'E' GROUP BY f.device_type, f.device_id, f.key_id, date_trunc('{grain}', f.stat_time), k.key_type"""
    return f"""SELECT {key}, CASE WHEN k.key LIKE '%volume' THEN sum(dbl_stats) ELSE avg(dbl_stats) END AS dbl_stats,
        CASE WHEN k.key LIKE '%volume' THEN sum(long_stats) ELSE avg(long_stats) END AS long_stats,
        CAST(sum(kgco2e) AS BIGINT) AS kgco2e
        FROM {source} f JOIN key_dictionary k ON k.key_id = f.key_id
        WHERE f.device_type IN ('W', 'A', 'G', 'S') AND (k.key LIKE '%volume' OR k.key LIKE '%flow_rate')
        GROUP BY f.device_type, f.device_id, f.key_id, date_trunc('{grain}', f.stat_time), k.key"""


VIEWS = {
    "device": f"""SELECT c_custkey AS device_id, CASE WHEN c_custkey % 10 = 9 THEN NULL ELSE c_custkey END AS entity_id,
        n_name AS factory_id, {_case('c_mktsegment', v.TYPE_OF_SEGMENT, "'S'")} AS device_type
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "readings": f"""SELECT event_id, user_id AS entity_id, {_case('event_type', v.KEY_OF_EVENT, '612')} AS key_id, ts,
        CAST(round(value * 100) AS BIGINT) AS value_c FROM events""",
    "ts_kv": "SELECT entity_id, key_id AS key, epoch_us(ts) // 1000 AS ts, value_c AS dbl_v FROM readings",
    "counter": """SELECT event_id, entity_id, key_id, ts, CAST(sum(value_c) OVER (PARTITION BY entity_id, key_id
        ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS value_c FROM readings""",
    "readings_reset": "SELECT * REPLACE (value_c % 20000 AS value_c) FROM counter",
    "readings_nulls": "SELECT * REPLACE (CASE WHEN event_id % 37 = 0 THEN NULL ELSE value_c END AS value_c) FROM counter",
    "clock": """SELECT o_orderkey AS id, o_orderdate + (o_orderkey % 1440) * INTERVAL '1' MINUTE AS ts,
        CAST(round(o_totalprice * 100) AS BIGINT) AS value_c FROM orders""",
    "daily": f"""SELECT f.*, d.device_type, d.entity_id FROM (
        SELECT stat_time, device_id, key_id, CAST(sum(c) AS BIGINT) AS dbl_stats, count(*) AS long_stats,
            {_status('F')} AS peak_energy, {_status('P')} AS partial_peak_energy, {_status('O')} AS off_peak_energy,
            CAST(sum(c) * 2 AS BIGINT) AS charge, {_status('F')} * 3 AS peak_charge, {_status('P')} * 2 AS partial_peak_charge,
            {_status('O')} AS off_peak_charge, CAST(sum(c) * 494 AS BIGINT) AS kgco2e
        FROM (SELECT o_orderdate AS stat_time, o_custkey AS device_id, CAST(o_orderpriority[1] AS INT) AS key_id,
            o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders) o
        GROUP BY stat_time, device_id, key_id) f JOIN device d USING (device_id)""",
    "key_config": f"""SELECT * FROM {_values(v.KEY_CONFIG)}
        AS t(device_type, accumulation_key_id, consumption_key_id, rate_key_id)""",
    "avg_key_config": f"SELECT * FROM {_values(v.AVG_KEY_CONFIG)} AS t(rate_key_id, avg_key_id)",
    "key_dictionary": f"SELECT * FROM {_values(v.KEY_DICTIONARY)} AS t(key_id, key)",
    "device_keys": f"SELECT * FROM {_values(v.DEVICE_KEYS)} AS t(device_type, key_id, key_type)",
    "electricity_rate": f"""SELECT id, CAST(effective_on AS TIMESTAMP) AS effective_on
        FROM {_values(v.ELECTRICITY_RATE)} AS t(id, effective_on)""",
    "energy_charge": f"""SELECT id AS electricity_rate_id, day_type, season_type, period_type,
        summer_rate + (id - 1) * 10 AS summer_rate, non_summer_rate + (id - 1) * 10 AS non_summer_rate
        FROM electricity_rate, {_values(v.RATES)} AS t(day_type, season_type, period_type, summer_rate, non_summer_rate)""",
    "param": """SELECT n_name AS factory_id, CASE WHEN n_nationkey % 2 = 0 THEN 'power_coeff' ELSE 'other' END AS param_name,
        t.device_type, 400 + n_nationkey AS float_value
        FROM nation CROSS JOIN (VALUES ('E'), ('W'), ('G')) AS t(device_type) WHERE n_nationkey % 7 <> 0""",
    "latest_day": """SELECT device_id, device_type, TIMESTAMP '2024-01-10' + (device_id % 5) * INTERVAL '1' DAY AS day
        FROM device WHERE device_id % 7 <> 0""",
    "eligible": """SELECT * FROM device
        WHERE entity_id IS NOT NULL AND factory_id NOT IN ('NATION_0', 'NATION_1')""",
    "fleet_minute": _fleet("date_trunc('minute', ts)"),
    "fleet_hour": _fleet("date_trunc('hour', ts)"),
    "fleet_day": _fleet("date_trunc('day', ts - INTERVAL '8' HOUR)"),
    "fleet_clock": "SELECT *, stat_time AS ts FROM fleet_hour WHERE device_type = 'E'",
    "hours_of_clock": "SELECT DISTINCT date_trunc('hour', ts) AS ts FROM clock",
    # instants with their day type, season and period, spelled out once for all price queries
    "labelled": """SELECT *, CASE WHEN dow = 0 THEN 'S' WHEN dow = 6 THEN 'T' ELSE 'O' END AS day_type,
        CASE WHEN dow = 0 THEN 'A' WHEN summer THEN 'S' ELSE 'N' END AS season_type,
        CASE WHEN dow = 0 THEN 'OP'
             WHEN dow = 6 AND summer THEN CASE WHEN h >= 9 THEN 'SPP' ELSE 'OP' END
             WHEN dow = 6 THEN CASE WHEN h BETWEEN 6 AND 10 OR h >= 14 THEN 'SPP' ELSE 'OP' END
             WHEN summer THEN CASE WHEN h BETWEEN 16 AND 21 THEN 'PE' WHEN h >= 9 THEN 'PP' ELSE 'OP' END
             WHEN h BETWEEN 6 AND 10 OR h >= 14 THEN 'PP' ELSE 'OP' END AS half_open_period,
        CASE WHEN dow = 0 THEN 'OP'
             WHEN dow = 6 AND summer THEN CASE WHEN h >= 9 THEN 'SPP' ELSE 'OP' END
             WHEN dow = 6 THEN CASE WHEN t BETWEEN 21600 AND 39600 OR h >= 14 THEN 'SPP' ELSE 'OP' END
             WHEN summer THEN CASE WHEN t BETWEEN 57600 AND 79200 THEN 'PE' WHEN h >= 9 THEN 'PP' ELSE 'OP' END
             WHEN t BETWEEN 21600 AND 39600 OR h >= 14 THEN 'PP' ELSE 'OP' END AS closed_period
        FROM (SELECT *, dayofweek(ts) AS dow, hour(ts) AS h, hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS t,
              strftime(ts, '%m%d') BETWEEN '0516' AND '1015' AS summer FROM {labelled}) c""",
    "priced": """SELECT l.*, CASE WHEN l.summer THEN e.summer_rate ELSE e.non_summer_rate END AS charge_rate
        FROM (SELECT *, (SELECT max(id) FROM electricity_rate r WHERE r.effective_on <= l.ts AND r.id >= {first_version})
              AS version FROM labelled l) l
        LEFT JOIN energy_charge e ON e.electricity_rate_id = l.version AND e.day_type = l.day_type
            AND e.season_type = l.season_type AND e.period_type = l.{period}""",
    "hourly_electric": """SELECT p.device_type, p.device_id, p.factory_id, p.key_id, p.stat_time,
            p.consumption AS dbl_stats, p.consumption * p.charge_rate AS charge,
            p.half_open_period AS period_type, p.consumption * m.float_value AS kgco2e
        FROM priced p LEFT JOIN param m USING (factory_id, device_type) WHERE p.charge_rate IS NOT NULL""",
    "minutely_other": """SELECT f.device_type, f.device_id, f.key_id, f.stat_time, f.consumption AS dbl_stats,
            f.consumption * m.float_value AS kgco2e
        FROM fleet_minute f LEFT JOIN param m USING (factory_id, device_type) WHERE f.device_type <> 'E'""",
    "hourly": """SELECT *, dbl_stats * 2 AS long_stats FROM (
        SELECT device_type, device_id, key_id, stat_time, dbl_stats FROM hourly_electric
        UNION ALL SELECT device_type, device_id, key_id, date_trunc('hour', stat_time), CAST(sum(dbl_stats) AS BIGINT)
        FROM minutely_other GROUP BY ALL) u""",
    "month_electricity": _period("daily", "month", "e"),
    "month_other": _period("daily", "month", "o"),
    "stored_daily": "SELECT * FROM daily WHERE stat_time < TIMESTAMP '1998-01-01'",
    "stored_electricity": _period("stored_daily", "month", "e"),
    "stored_other": _period("stored_daily", "month", "o"),
    "half_days": """SELECT entity_id AS device_id, key_id, date_trunc('day', ts) AS stat_time,
        CAST(sum(value_c) AS BIGINT) AS sum_c, count(*) AS n FROM readings GROUP BY ALL""",
    "first_half": "SELECT * FROM half_days WHERE stat_time < TIMESTAMP '2024-01-21'",
    "second_half": """SELECT device_id, key_id, stat_time, sum_c + 1 AS sum_c, -n AS n FROM half_days
        WHERE stat_time >= TIMESTAMP '2024-01-11'""",
}


def sql(body: str, **settings: str) -> str:
    """A query over the views, with exactly the views it needs as WITH clauses.

    Settings fill the templated views: ``labelled`` names the instants to label, ``period`` the
    reading of the boundaries, ``first_version`` the oldest tariff considered.
    """
    chosen = {"labelled": "clock", "period": "half_open_period", "first_version": "1", **settings}
    needed: dict[str, str] = {}

    def need(text: str) -> None:
        for name, template in VIEWS.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                view = template
                for setting, value in chosen.items():
                    view = view.replace("{" + setting + "}", value)
                need(view)
                needed[name] = view

    need(body)
    clauses = ",\n".join(f"{name} AS ({view})" for name, view in needed.items())
    return f"WITH {clauses}\n{body}" if needed else body
