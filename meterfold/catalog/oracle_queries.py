"""SQL for each registered query."""

from __future__ import annotations

from meterfold.catalog.oracles import TOU, _period, sql
from meterfold.operators.quality import ROLLUP_CHECKS

PRODUCTION_DAY = "INTERVAL '28799' SECOND"
KEYED = "device_type, device_id, CAST(key_id AS BIGINT) AS key_id, stat_time"


def _buckets(bucket: str, source: str) -> str:
    return sql(f"SELECT {bucket} AS bucket, count(*) AS n, CAST(sum(value_c) AS BIGINT) AS sum_c FROM {source} GROUP BY ALL")


def _delta(source: str, keep: str = "TRUE") -> str:
    """Every reading's step; the first of a series has position 1."""
    return f"""SELECT event_id, entity_id, key_id, ts, pos,
        CASE WHEN coalesce(value_c, 0) < coalesce(prev, coalesce(value_c, 0)) THEN 0
             ELSE coalesce(value_c, 0) - coalesce(prev, coalesce(value_c, 0)) END AS delta
        FROM (SELECT *, lag(value_c) OVER w AS prev, row_number() OVER w AS pos FROM {source} WHERE {keep}
              WINDOW w AS (PARTITION BY entity_id, key_id ORDER BY ts, event_id)) x"""


def _steps(source: str, keep: str = "TRUE") -> str:
    return sql(f"SELECT event_id, entity_id, key_id, ts, delta FROM ({_delta(source, keep)}) d WHERE pos > 1")


def _steps_per(grain: str, source: str) -> str:
    return sql(
        f"""SELECT entity_id, key_id, date_trunc('{grain}', ts) AS bucket, CAST(sum(delta) AS BIGINT) AS delta
        FROM ({_delta(source)}) d WHERE pos > 1 GROUP BY ALL"""
    )


def _min_consumption(grain: str, source: str = "counter", scan: str = "TRUE", keep: str = "TRUE") -> str:
    return f"""SELECT * FROM (SELECT entity_id, key_id, bucket, min_value,
            coalesce(lead(min_value) OVER w, mx) AS next_min_value,
            coalesce(lead(min_value) OVER w, mx) - min_value AS energy_consumption
        FROM (SELECT entity_id, key_id, date_trunc('{grain}', ts) AS bucket, min(value_c) AS min_value, max(value_c) AS mx
              FROM {source} WHERE {scan} GROUP BY ALL) b WHERE min_value IS NOT NULL
        WINDOW w AS (PARTITION BY entity_id, key_id ORDER BY bucket)) c WHERE {keep}"""


def _first_consumption(bucket: str, scan: str = "TRUE") -> str:
    return f"""SELECT entity_id, key_id, bucket, v0, v1, lead(v0) OVER (PARTITION BY entity_id, key_id ORDER BY bucket) AS nxt
        FROM (SELECT entity_id, key_id, {bucket} AS bucket, arg_min(value_c, ts) AS v0, arg_max(value_c, ts) AS v1
              FROM readings_nulls WHERE value_c IS NOT NULL AND {scan} GROUP BY ALL) b"""


def _since(grain: str, facts: str = "c") -> str:
    """Only buckets from the one the device's watermark lies in; one device in seven has none."""
    return f"({facts}.device_id % 7 = 0 OR {facts}.stat_time >= (SELECT date_trunc('{grain}', l.day) FROM latest_day l WHERE l.device_id = {facts}.device_id))"


def _rollup_check(label: str, coarse: str, fine: str, source: str = "counter") -> str:
    return f"""SELECT '{label}' AS stat_type, CASE WHEN count(*) FILTER (WHERE w.energy_consumption <> n.fine_sum) > 0
            THEN 'NG' ELSE 'OK' END AS check_result
        FROM ({_min_consumption(coarse, source)}) w
        JOIN (SELECT entity_id, key_id, date_trunc('{coarse}', bucket) AS bucket, sum(energy_consumption) AS fine_sum
              FROM ({_min_consumption(fine, source)}) f GROUP BY ALL) n USING (entity_id, key_id, bucket)"""


def _codes() -> str:
    return "CAST(1 AS BIGINT) AS minute, CAST(2 AS BIGINT) AS hour, CAST(3 AS BIGINT) AS day, CAST(4 AS BIGINT) AS month, CAST(5 AS BIGINT) AS year"


def _thousandths(c: str) -> str:
    return f"CAST(floor({c} * 1000 + 0.5) AS BIGINT) AS {c}"


_FLOWS = """SELECT e.device_type, e.device_id, r.key_id, date_trunc('hour', r.ts) AS stat_time, avg(r.value_c) AS dbl_stats
    FROM readings r JOIN eligible e USING (entity_id)
    JOIN key_config k ON k.device_type = e.device_type AND k.rate_key_id = r.key_id
    WHERE e.device_type <> 'E' GROUP BY ALL"""


def _rewound(bucket: str, offset: str) -> str:
    """Watermarks set back to the own mark of the bucket of the oldest late reading."""
    mark = f"least(l.day + {offset}, r.late + {offset})"
    return sql(
        f"""SELECT l.device_id, l.device_type, CAST(142 AS BIGINT) AS key_id, CAST({mark} AS TIMESTAMP) AS latest_stat_time,
        epoch_us({mark}) // 1000 AS latest_epoch
        FROM latest_day l LEFT JOIN (SELECT d.device_id, min(CAST({bucket} AS TIMESTAMP)) AS late
            FROM readings x JOIN device d USING (entity_id) WHERE x.key_id = 596 GROUP BY ALL) r USING (device_id)"""
    )


NO_TOU = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in TOU)
_DAY = "CAST(date_trunc('day', stat_time - INTERVAL '8' HOUR) AS TIMESTAMP)"


def _share(column: str, *periods: str) -> str:
    listed = ", ".join(f"'{p}'" for p in periods)
    return f"CAST(sum({column}) FILTER (WHERE period_type IN ({listed})) AS DOUBLE)"


def _rates(bucket: str) -> str:
    """Average counter value of the other utilities under their rate keys."""
    return f"""SELECT e.device_type, e.device_id, CAST(c.key_id AS BIGINT) AS key_id, CAST({bucket} AS TIMESTAMP) AS stat_time,
        avg(c.value_c) AS dbl_stats
        FROM counter c JOIN eligible e USING (entity_id)
        JOIN key_config k ON k.device_type = e.device_type AND k.rate_key_id = c.key_id
        WHERE e.device_type <> 'E' GROUP BY ALL"""


def _measured(bucket: str, code: int) -> str:
    return f"""SELECT d.device_type, d.device_id, CAST(r.key_id AS BIGINT) AS key_id, {bucket} AS stat_time,
        avg(r.value_c) AS dbl_stats, CAST(min(r.value_c) AS DOUBLE) AS dbl_min, CAST(max(r.value_c) AS DOUBLE) AS dbl_max,
        CAST({code} AS BIGINT) AS stat_type
        FROM readings r JOIN device d USING (entity_id) GROUP BY ALL"""


_RANGE = "ts >= TIMESTAMP '2024-01-05 06:30:00'"

_DAY_RUNS = f"""SELECT p.device_type, p.device_id, CAST(p.key_id AS BIGINT) AS key_id, p.stat_time, CAST(3 AS BIGINT) AS stat_type,
    CAST(f.consumption AS DOUBLE) AS dbl_stats, p.dbl_avg, p.dbl_min, p.dbl_max, {', '.join('t.' + c for c in TOU)},
    CAST(f.consumption * m.float_value AS DOUBLE) AS kgco2e
    FROM (SELECT device_type, device_id, key_id, {_DAY} AS stat_time, avg(dbl_stats) AS dbl_avg,
            CAST(min(dbl_stats) AS DOUBLE) AS dbl_min, CAST(max(dbl_stats) AS DOUBLE) AS dbl_max FROM hourly GROUP BY ALL) p
    LEFT JOIN fleet_day f ON f.device_id = p.device_id AND f.key_id = p.key_id AND f.stat_time = p.stat_time
    LEFT JOIN param m ON m.factory_id = f.factory_id AND m.device_type = f.device_type
    LEFT JOIN (SELECT device_id, {_DAY} AS stat_time, {_share('dbl_stats', 'PE')} AS peak_energy,
            {_share('dbl_stats', 'PP', 'SPP')} AS partial_peak_energy, {_share('dbl_stats', 'OP')} AS off_peak_energy,
            CAST(sum(charge) AS DOUBLE) AS charge, {_share('charge', 'PE')} AS peak_charge,
            {_share('charge', 'PP', 'SPP')} AS partial_peak_charge, {_share('charge', 'OP')} AS off_peak_charge
          FROM hourly_electric GROUP BY ALL) t
        ON p.device_type = 'E' AND t.device_id = p.device_id AND t.stat_time = p.stat_time
    UNION ALL
    SELECT e.device_type, e.device_id, CAST(a.avg_key_id AS BIGINT),
    CAST(date_trunc('day', c.ts - INTERVAL '8' HOUR) AS TIMESTAMP), CAST(3 AS BIGINT), avg(c.value_c), NULL,
    CAST(min(c.value_c) AS DOUBLE), CAST(max(c.value_c) AS DOUBLE), {NO_TOU}, NULL
    FROM counter c JOIN eligible e USING (entity_id) JOIN avg_key_config a ON a.rate_key_id = c.key_id GROUP BY ALL
    UNION ALL
    SELECT device_type, device_id, key_id, stat_time, CAST(3 AS BIGINT), dbl_stats, NULL, NULL, NULL, {NO_TOU}, NULL
    FROM ({_rates("date_trunc('day', c.ts)")}) r"""


def _redone(grain: str) -> str:
    """Months or years of the consumption keys, summed from the days."""
    sums = ", ".join(f"sum({c}) AS {c}" for c in TOU)
    return sql(
        f"""SELECT device_type, device_id, key_id, CAST(date_trunc('{grain}', stat_time) AS TIMESTAMP) AS stat_time,
        coalesce(sum(dbl_stats), 0) AS dbl_stats, {sums}, sum(kgco2e) AS kgco2e
        FROM ({_DAY_RUNS}) d WHERE key_id = CASE device_type WHEN 'E' THEN 554 WHEN 'W' THEN 626 WHEN 'A' THEN 634
            WHEN 'S' THEN 631 WHEN 'G' THEN 635 END GROUP BY ALL""",
        labelled="fleet_clock",
    )


ORACLES: dict[str, str] = {
    "a1_readings": sql(
        """SELECT d.device_id, d.device_type, t.key AS key_id, k.consumption_key_id, t.ts AS ts_ms,
        date_trunc('second', epoch_ms(t.ts)) AS ts, t.dbl_v AS value
        FROM ts_kv t JOIN eligible d USING (entity_id)
        JOIN key_config k ON k.device_type = d.device_type AND k.accumulation_key_id = t.key"""
    ),
    "a1_readings_rate": sql(
        """SELECT d.device_id, t.key AS key_id, t.ts AS ts_ms, t.dbl_v AS value
        FROM ts_kv t JOIN eligible d USING (entity_id)
        JOIN key_config k ON k.device_type = d.device_type AND k.rate_key_id = t.key
        WHERE t.ts >= epoch_ms(TIMESTAMP '2024-01-08') AND t.ts < epoch_ms(TIMESTAMP '2024-01-22')"""
    ),
    "a2_epoch": sql("SELECT entity_id, key, ts AS ts_ms, date_trunc('second', epoch_ms(ts)) AS ts FROM ts_kv"),
    "a3_eligible": sql("SELECT device_id, factory_id, device_type FROM eligible"),
    "a3_eligible_other": sql(
        """SELECT device_type, factory_id, count(*) AS n FROM device
        WHERE entity_id IS NOT NULL AND device_type <> 'E' GROUP BY ALL"""
    ),
    "a4_stale": sql(
        """SELECT d.device_id, d.device_type, l.day + INTERVAL '57' SECOND AS latest_stat_time
        FROM eligible d JOIN latest_day l USING (device_id)
        WHERE d.device_type = 'E' AND l.day + INTERVAL '57' SECOND < TIMESTAMP '2024-01-12 00:00:57'"""
    ),
    "a5_map_keys": sql(
        """SELECT r.event_id, r.entity_id, k.avg_key_id AS key_id, r.ts, r.value_c
        FROM readings r JOIN avg_key_config k ON k.rate_key_id = r.key_id"""
    ),
    "a6_named_keys": sql(
        """SELECT entity_id, key_id, count(*) AS n, CAST(sum(value_c) AS BIGINT) AS sum_c FROM readings
        WHERE key_id IN (569, 596, 608) GROUP BY ALL"""
    ),
    "a7_node_map": sql(
        """SELECT d.device_id, CASE WHEN s.s_suppkey IS NULL THEN 'D' || d.device_id
        ELSE 'N' || s.s_nationkey || '-' || s.s_suppkey END AS node_id
        FROM device d LEFT JOIN supplier s ON s.s_suppkey = d.device_id"""
    ),
    "a8_retain": sql(
        "SELECT entity_id, key, ts, dbl_v FROM ts_kv WHERE ts >= epoch_ms(TIMESTAMP '2024-01-14 16:00:00')"
    ),
    "a9_drop_logs": """SELECT event_id, CASE WHEN event_type <> 'purchase' THEN 'x|' || upper(event_type) || '|y' END AS str_v
        FROM events WHERE event_type <> 'error'""",
    "a8_retain_stored": """SELECT event_id,
        (SELECT count(DISTINCT ts::date) FROM events WHERE ts < TIMESTAMP '2024-01-14 00:00:00') AS dropped,
        (SELECT count(DISTINCT ts::date) FROM events WHERE ts >= TIMESTAMP '2024-01-14 00:00:00' AND ts < TIMESTAMP '2024-01-14 16:00:00')
            AS rewritten
        FROM events WHERE ts >= TIMESTAMP '2024-01-14 16:00:00'""",
    "a9_drop_logs_stored": """SELECT event_id,
        CASE WHEN event_type <> 'purchase' THEN 'x|' || upper(event_type) || '|y' END AS str_v FROM events WHERE event_type <> 'error'""",
    "b1_minute": _buckets("date_trunc('minute', ts)", "readings"),
    "b1_hour": _buckets("date_trunc('hour', ts)", "readings"),
    "b1_day": _buckets("CAST(date_trunc('day', ts) AS TIMESTAMP)", "readings"),
    "b1_month": _buckets("CAST(date_trunc('month', ts) AS TIMESTAMP)", "clock"),
    "b1_year": _buckets("CAST(date_trunc('year', ts) AS TIMESTAMP)", "clock"),
    "b2_production_day": _buckets("CAST(date_trunc('day', ts - INTERVAL '8' HOUR) AS TIMESTAMP)", "clock"),
    "b3_grain_bucket": sql(
        """SELECT event_id, CAST(date_trunc('day', ts - INTERVAL '8' HOUR) AS TIMESTAMP) AS day_bucket,
        date_trunc('hour', ts) AS hour_bucket FROM readings"""
    ),
    "b4_log_day": _buckets("CAST(ts AS DATE)", "readings"),
    "b7_half_open": sql(
        """SELECT event_id, date_trunc('hour', ts) AS bucket FROM readings
        WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-09 03:00:00'"""
    ),
    "b8_stat_type": sql(f"SELECT event_id, {_codes()} FROM readings"),
    "c1_delta": _steps("readings_reset"),
    "c1_delta_nulls": _steps("readings_nulls"),
    "c1_delta_skip_nulls": _steps("readings_nulls", "value_c IS NOT NULL"),
    "c1_delta_per_minute": _steps_per("minute", "readings_reset"),
    "c1_delta_per_hour_nulls": _steps_per("hour", "readings_nulls"),
    **{f"c2_{g}": sql(_min_consumption(g)) for g in ("minute", "hour", "day", "month", "year")},
    "c2_hour_range": sql(
        _min_consumption(
            "hour",
            "readings_nulls",
            f"{_RANGE} AND ts <= TIMESTAMP '2024-02-20 12:00:00'",
            "bucket < TIMESTAMP '2024-01-20 12:00:00'",
        )
    ),
    "c3_hour": sql(
        f"""SELECT entity_id, key_id, bucket AS period_start, v0 AS energy_start, coalesce(nxt, v1) AS energy_end,
        coalesce(nxt, v1) - v0 AS consumption FROM ({_first_consumption("date_trunc('hour', ts)")}) c"""
    ),
    "c3_day": sql(
        f"""SELECT c.entity_id, c.bucket AS period_start, v0 AS energy_start, coalesce(nxt, v1) AS energy_end,
        coalesce(nxt, v1) - v0 AS consumption, k.consumption_key_id
        FROM ({_first_consumption("CAST(date_trunc('day', ts - INTERVAL '8' HOUR) AS TIMESTAMP)", _RANGE)}) c
        JOIN key_config k ON k.accumulation_key_id = c.key_id
        WHERE c.bucket >= TIMESTAMP '2024-01-05 06:30:00' AND c.bucket < TIMESTAMP '2024-01-20 12:00:00'"""
    ),
    "c3_shared_key": sql(
        f"""SELECT c.entity_id, d.device_type, c.bucket AS period_start, coalesce(nxt, v1) - v0 AS consumption, k.consumption_key_id
        FROM ({_first_consumption("CAST(date_trunc('day', ts - INTERVAL '8' HOUR) AS TIMESTAMP)")}) c
        JOIN device d USING (entity_id) JOIN key_config k ON k.device_type = d.device_type
        WHERE c.key_id = 142 AND d.device_type IN ('E', 'W')"""
    ),
    "c4_daily": sql(
        f"""SELECT entity_id, key_id, bucket AS result_day, v0 AS energy_start, coalesce(nxt, v1) AS energy_end,
        coalesce(nxt, v1) - v0 AS daily_energy FROM ({_first_consumption("CAST(ts AS DATE)")}) c
        WHERE (nxt IS NOT NULL OR bucket = DATE '2024-01-30')
        AND bucket >= DATE '2024-01-03' AND bucket < DATE '2024-01-31'"""
    ),
    "c5_fleet": sql(
        f"""SELECT device_id, device_type, factory_id, key_id, stat_time, consumption FROM fleet_hour c
        WHERE {_since('hour')}"""
    ),
    "c5_fleet_production_day": sql(
        f"""SELECT device_id, device_type, factory_id, key_id, CAST(stat_time AS TIMESTAMP) AS stat_time, consumption
        FROM fleet_day c WHERE {_since('day')}"""
    ),
    "c6_open_bucket": sql(
        """SELECT entity_id, key_id, CAST(max(date_trunc('day', ts - INTERVAL '8' HOUR)) AS TIMESTAMP) AS max_bucket
        FROM readings_nulls WHERE value_c IS NOT NULL GROUP BY ALL"""
    ),
    "d1_period": sql("SELECT id, half_open_period AS period FROM labelled"),
    "d2_day_season": sql(
        """SELECT day_type, season_type, count(*) AS n, CAST(sum(value_c) AS BIGINT) AS sum_c FROM labelled GROUP BY ALL"""
    ),
    "d4_closed": sql("SELECT id, closed_period AS period FROM labelled"),
    "d3_rate": sql("SELECT id, CAST(charge_rate AS BIGINT) AS charge_rate FROM priced"),
    "d3_rate_closed": sql("SELECT id, CAST(charge_rate AS BIGINT) AS charge_rate FROM priced", period="closed_period"),
    "d5_charge_info": sql(
        """SELECT ts AS usage_time, half_open_period AS period_type, CAST(charge_rate AS BIGINT) AS charge_rate
        FROM priced WHERE charge_rate IS NOT NULL""",
        labelled="hours_of_clock",
        first_version="2",
    ),
    "d6_charge": sql("SELECT id, CAST(value_c * charge_rate AS BIGINT) AS charge FROM priced WHERE charge_rate IS NOT NULL"),
    "d7_tou_split": sql(
        """SELECT CAST(date_trunc('day', p.ts - INTERVAL '8' HOUR) AS TIMESTAMP) AS stat_time, o.o_custkey AS device_id,
        d.device_type, CAST(554 AS BIGINT) AS key_id, CAST(3 AS BIGINT) AS stat_type,
        CAST(sum(value_c) FILTER (WHERE half_open_period = 'PE') AS BIGINT) AS peak_energy,
        CAST(sum(value_c) FILTER (WHERE half_open_period IN ('PP', 'SPP')) AS BIGINT) AS partial_peak_energy,
        CAST(sum(value_c) FILTER (WHERE half_open_period = 'OP') AS BIGINT) AS off_peak_energy,
        CAST(sum(value_c * charge_rate) AS BIGINT) AS charge,
        CAST(sum(value_c * charge_rate) FILTER (WHERE half_open_period = 'PE') AS BIGINT) AS peak_charge,
        CAST(sum(value_c * charge_rate) FILTER (WHERE half_open_period IN ('PP', 'SPP')) AS BIGINT) AS partial_peak_charge,
        CAST(sum(value_c * charge_rate) FILTER (WHERE half_open_period = 'OP') AS BIGINT) AS off_peak_charge
        FROM priced p JOIN orders o ON o.o_orderkey = p.id JOIN device d ON d.device_id = o.o_custkey
        WHERE charge_rate IS NOT NULL GROUP BY ALL"""
    ),
    "e1_carbon": sql(
        """SELECT f.device_id, f.key_id, f.stat_time, f.consumption, f.consumption * m.float_value AS kgco2e
        FROM fleet_hour f LEFT JOIN param m USING (factory_id, device_type)"""
    ),
    "e2_carbon_named": sql(
        """SELECT f.device_id, f.key_id, f.stat_time, f.consumption, f.consumption * m.float_value AS kgco2e
        FROM fleet_hour f JOIN (SELECT DISTINCT factory_id, float_value FROM param WHERE param_name = 'power_coeff') m
        USING (factory_id)"""
    ),
    "e3_carbon_rollup": sql(
        """SELECT f.device_id, f.key_id, CAST(date_trunc('month', f.stat_time) AS TIMESTAMP) AS stat_time,
        CAST(sum(f.consumption * m.float_value) AS BIGINT) AS kgco2e
        FROM fleet_hour f LEFT JOIN param m USING (factory_id, device_type) GROUP BY ALL"""
    ),
    "f1_minute_electricity": sql(
        f"""SELECT c.device_type, c.device_id, CAST(554 AS BIGINT) AS key_id, c.stat_time, CAST(1 AS BIGINT) AS stat_type,
        c.delta AS dbl_stats, c.delta * m.float_value AS kgco2e
        FROM (SELECT e.device_type, e.device_id, e.factory_id, date_trunc('minute', d.ts) AS stat_time,
                CAST(sum(d.delta) AS BIGINT) AS delta
              FROM ({_delta('readings_reset')}) d JOIN eligible e ON e.entity_id = d.entity_id AND e.device_type = 'E'
              WHERE d.pos > 1 AND d.key_id = 142 GROUP BY ALL) c
        JOIN (SELECT DISTINCT factory_id, float_value FROM param WHERE param_name = 'power_coeff') m USING (factory_id)
        WHERE {_since('minute')}"""
    ),
    "f2_minute_other": sql(
        f"""SELECT {KEYED}, CAST(1 AS BIGINT) AS stat_type, dbl_stats, kgco2e FROM minutely_other c
        WHERE {_since('minute')}"""
    ),
    "f3_hour_electricity": sql(
        f"""SELECT {KEYED}, CAST(2 AS BIGINT) AS stat_type, dbl_stats, CAST(charge AS BIGINT) AS charge, period_type, kgco2e
        FROM hourly_electric c WHERE {_since('hour')}""",
        labelled="fleet_clock",
    ),
    "f4_hour_other": sql(
        f"""SELECT device_type, device_id, CAST(key_id AS BIGINT) AS key_id, date_trunc('hour', stat_time) AS stat_time,
        CAST(2 AS BIGINT) AS stat_type, CAST(sum(dbl_stats) AS BIGINT) AS dbl_stats, avg(dbl_stats) AS dbl_avg,
        min(dbl_stats) AS dbl_min, max(dbl_stats) AS dbl_max, CAST(sum(kgco2e) AS BIGINT) AS kgco2e
        FROM minutely_other c WHERE {_since('hour')} GROUP BY ALL"""
    ),
    "f5_hour_rate_other": sql(
        f"""SELECT {KEYED}, CAST(2 AS BIGINT) AS stat_type, dbl_stats FROM (
        SELECT e.device_type, e.device_id, r.key_id, date_trunc('hour', r.ts) AS stat_time, avg(r.value_c) AS dbl_stats
        FROM readings r JOIN eligible e USING (entity_id)
        JOIN key_config k ON k.device_type = e.device_type AND k.rate_key_id = r.key_id
        WHERE e.device_type <> 'E' GROUP BY ALL) c WHERE {_since('hour')}"""
    ),
    "f6_day_profile": sql(
        """SELECT device_type, device_id, CAST(key_id AS BIGINT) AS key_id,
        CAST(date_trunc('day', stat_time - INTERVAL '8' HOUR) AS TIMESTAMP) AS stat_time, CAST(3 AS BIGINT) AS stat_type,
        avg(dbl_stats) AS dbl_avg, min(dbl_stats) AS dbl_min, max(dbl_stats) AS dbl_max,
        CAST(sum(long_stats) AS BIGINT) AS long_stats, avg(long_stats) AS long_avg, min(long_stats) AS long_min,
        max(long_stats) AS long_max
        FROM hourly h WHERE h.device_id % 7 = 0 OR h.stat_time > (SELECT l.day + INTERVAL '28799' SECOND FROM latest_day l
            WHERE l.device_id = h.device_id) GROUP BY ALL""",
        labelled="fleet_clock",
    ),
    "f7_day_consumption": sql(
        """SELECT p.device_type, p.device_id, CAST(p.key_id AS BIGINT) AS key_id, CAST(p.stat_time AS TIMESTAMP) AS stat_time,
        p.dbl_min, p.dbl_max, f.consumption AS dbl_stats, f.consumption * m.float_value AS kgco2e
        FROM (SELECT device_type, device_id, key_id, date_trunc('day', stat_time - INTERVAL '8' HOUR) AS stat_time,
                min(dbl_stats) AS dbl_min, max(dbl_stats) AS dbl_max FROM hourly h
              WHERE h.device_id % 7 = 0 OR h.stat_time > (SELECT l.day + INTERVAL '28799' SECOND FROM latest_day l
                  WHERE l.device_id = h.device_id) GROUP BY ALL) p
        LEFT JOIN fleet_day f USING (device_type, device_id, key_id, stat_time)
        LEFT JOIN param m ON m.factory_id = f.factory_id AND m.device_type = f.device_type""",
        labelled="fleet_clock",
    ),
    "f8_day_rate": sql(
        """SELECT e.device_type, e.device_id, CAST(a.avg_key_id AS BIGINT) AS key_id,
        CAST(date_trunc('day', r.ts - INTERVAL '8' HOUR) AS TIMESTAMP) AS stat_time, CAST(3 AS BIGINT) AS stat_type,
        avg(r.value_c) AS dbl_stats, min(r.value_c) AS dbl_min, max(r.value_c) AS dbl_max
        FROM readings r JOIN eligible e USING (entity_id) JOIN avg_key_config a ON a.rate_key_id = r.key_id
        LEFT JOIN latest_day l ON l.device_id = e.device_id
        WHERE r.ts > coalesce(l.day + INTERVAL '28799.999999' SECOND, TIMESTAMP '2024-01-09') GROUP BY ALL"""
    ),
    "f9_day_rate_other": sql(
        f"""SELECT {KEYED}, CAST(3 AS BIGINT) AS stat_type, dbl_stats FROM (
        SELECT e.device_type, e.device_id, r.key_id, CAST(date_trunc('day', r.ts) AS TIMESTAMP) AS stat_time,
            avg(r.value_c) AS dbl_stats
        FROM readings r JOIN eligible e USING (entity_id)
        JOIN key_config k ON k.device_type = e.device_type AND k.rate_key_id = r.key_id
        WHERE e.device_type <> 'E' GROUP BY ALL) c WHERE {_since('day')}"""
    ),
    "f10_month_electricity": sql(
        f"""SELECT m.device_type, m.device_id, CAST(m.key_id AS BIGINT) AS key_id, CAST(m.stat_time AS TIMESTAMP) AS stat_time,
        CAST(4 AS BIGINT) AS stat_type, m.dbl_stats, m.long_stats, {', '.join('m.' + c for c in TOU)}, m.kgco2e
        FROM month_electricity m LEFT JOIN (SELECT device_id, key_id, max(stat_time) AS newest FROM stored_electricity
            GROUP BY ALL) s USING (device_id, key_id)
        WHERE s.newest IS NULL OR m.stat_time > s.newest + INTERVAL '1' MONTH - INTERVAL '1' SECOND"""
    ),
    "f11_month_other": sql(
        """SELECT m.device_type, m.device_id, CAST(m.key_id AS BIGINT) AS key_id, CAST(m.stat_time AS TIMESTAMP) AS stat_time,
        CAST(4 AS BIGINT) AS stat_type, m.dbl_stats, m.long_stats, m.kgco2e
        FROM month_other m LEFT JOIN (SELECT device_id, key_id, max(stat_time) AS newest FROM stored_other
            GROUP BY ALL) s USING (device_id, key_id)
        WHERE s.newest IS NULL OR m.stat_time >= s.newest + INTERVAL '1' MONTH - INTERVAL '1' SECOND"""
    ),
    "f12_year_electricity": sql(
        f"""SELECT device_type, device_id, CAST(key_id AS BIGINT) AS key_id, CAST(stat_time AS TIMESTAMP) AS stat_time,
        {_thousandths('dbl_stats')}, {_thousandths('long_stats')}, {', '.join(TOU)}, kgco2e
        FROM ({_period('month_electricity', 'year', 'e')}) y"""
    ),
    "f13_year_other": sql(
        f"""SELECT device_type, device_id, CAST(key_id AS BIGINT) AS key_id, CAST(stat_time AS TIMESTAMP) AS stat_time,
        {_thousandths('dbl_stats')}, {_thousandths('long_stats')}, kgco2e
        FROM ({_period('month_other', 'year', 'o')}) y"""
    ),
    "f14_run_grain": sql(
        """SELECT device_type, device_id, CAST(key_id AS BIGINT) AS key_id, date_trunc('hour', stat_time) AS stat_time,
        CAST(2 AS BIGINT) AS stat_type, CAST(sum(dbl_stats) AS DOUBLE) AS dbl_stats, avg(dbl_stats) AS dbl_avg,
        CAST(min(dbl_stats) AS DOUBLE) AS dbl_min, CAST(max(dbl_stats) AS DOUBLE) AS dbl_max,
        CAST(sum(kgco2e) AS DOUBLE) AS kgco2e
        FROM minutely_other GROUP BY ALL"""
    ),
    "f14_minute_runs": sql(
        f"""SELECT s.device_type, s.device_id, CAST(554 AS BIGINT) AS key_id, s.stat_time, CAST(1 AS BIGINT) AS stat_type,
        CAST(s.delta AS DOUBLE) AS dbl_stats, CAST(s.delta * m.float_value AS DOUBLE) AS kgco2e
        FROM (SELECT e.device_type, e.device_id, e.factory_id, date_trunc('minute', d.ts) AS stat_time, sum(d.delta) AS delta
              FROM ({_delta('counter')}) d JOIN eligible e ON e.entity_id = d.entity_id AND e.device_type = 'E'
              WHERE d.pos > 1 AND d.key_id = 142 GROUP BY ALL) s
        JOIN (SELECT DISTINCT factory_id, float_value FROM param WHERE param_name = 'power_coeff') m USING (factory_id)
        UNION ALL
        SELECT {KEYED}, CAST(1 AS BIGINT), CAST(dbl_stats AS DOUBLE), CAST(kgco2e AS DOUBLE) FROM minutely_other"""
    ),
    "f14_hour_runs": sql(
        f"""SELECT {KEYED}, CAST(2 AS BIGINT) AS stat_type, CAST(dbl_stats AS DOUBLE) AS dbl_stats, CAST(NULL AS DOUBLE) AS dbl_avg,
        CAST(NULL AS DOUBLE) AS dbl_min, CAST(NULL AS DOUBLE) AS dbl_max, CAST(charge AS DOUBLE) AS charge, period_type,
        CAST(kgco2e AS DOUBLE) AS kgco2e FROM hourly_electric
        UNION ALL
        SELECT device_type, device_id, CAST(key_id AS BIGINT), date_trunc('hour', stat_time), CAST(2 AS BIGINT),
        CAST(sum(dbl_stats) AS DOUBLE), avg(dbl_stats), CAST(min(dbl_stats) AS DOUBLE), CAST(max(dbl_stats) AS DOUBLE), NULL, NULL,
        CAST(sum(kgco2e) AS DOUBLE) FROM minutely_other GROUP BY ALL
        UNION ALL
        SELECT device_type, device_id, key_id, stat_time, CAST(2 AS BIGINT), dbl_stats, NULL, NULL, NULL, NULL, NULL, NULL
        FROM ({_rates("date_trunc('hour', c.ts)")}) r""",
        labelled="fleet_clock",
    ),
    "f14_day_runs": sql(_DAY_RUNS, labelled="fleet_clock"),
    "f14_month_runs": sql(
        f"""SELECT {KEYED}, {_thousandths('dbl_stats')}, {', '.join(TOU)}, kgco2e
        FROM month_electricity JOIN eligible USING (device_id, device_type)
        UNION ALL
        SELECT {KEYED}, {_thousandths('dbl_stats')}, {', '.join('NULL' for _ in TOU)}, kgco2e
        FROM month_other JOIN device USING (device_id, device_type) WHERE entity_id IS NOT NULL"""
    ),
    "f14_year_runs": sql(
        f"""SELECT {KEYED}, {_thousandths('dbl_stats')}, {', '.join(TOU)}, kgco2e
        FROM ({_period('month_electricity', 'year', 'e')}) y JOIN eligible USING (device_id, device_type)
        UNION ALL
        SELECT {KEYED}, {_thousandths('dbl_stats')}, {', '.join('NULL' for _ in TOU)}, kgco2e
        FROM ({_period('month_other', 'year', 'o')}) y JOIN device USING (device_id, device_type) WHERE entity_id IS NOT NULL"""
    ),
    "g3_repeated_runs": sql(
        f"""SELECT {KEYED}, CAST(dbl_stats AS DOUBLE) AS dbl_stats, CAST(charge AS DOUBLE) AS charge, period_type,
        CAST(kgco2e AS DOUBLE) AS kgco2e FROM hourly_electric""",
        labelled="fleet_clock",
    ),
    "g1_since_watermark": sql(
        """SELECT r.event_id, d.device_id, r.key_id, r.ts
        FROM readings r JOIN device d USING (entity_id) LEFT JOIN latest_day l ON l.device_id = d.device_id AND r.key_id = 142
        WHERE r.ts > coalesce(l.day + INTERVAL '57' SECOND, TIMESTAMP '2024-01-20')"""
    ),
    "g2_advance": sql(
        f"""SELECT device_id, device_type, CAST(key_id AS BIGINT) AS key_id, max(stat_time) + {PRODUCTION_DAY} AS latest_stat_time,
        epoch_ms(max(stat_time) + {PRODUCTION_DAY}) AS latest_epoch FROM daily GROUP BY ALL"""
    ),
    "g3_upsert": sql(
        """SELECT device_id, key_id, CAST(stat_time AS TIMESTAMP) AS stat_time, coalesce(s.sum_c, f.sum_c) AS sum_c,
        coalesce(f.n, s.n) AS n FROM first_half f FULL JOIN second_half s USING (device_id, key_id, stat_time)"""
    ),
    "g4_update_only": sql(
        """SELECT f.device_id, f.key_id, CAST(f.stat_time AS TIMESTAMP) AS stat_time, coalesce(s.sum_c, f.sum_c) AS sum_c, f.n
        FROM first_half f LEFT JOIN second_half s USING (device_id, key_id, stat_time)"""
    ),
    "g5_insert_only": sql(
        """SELECT device_id, key_id, CAST(stat_time AS TIMESTAMP) AS stat_time, sum_c, n FROM first_half
        UNION ALL SELECT device_id, key_id, CAST(stat_time AS TIMESTAMP), sum_c, n FROM second_half
        WHERE stat_time >= TIMESTAMP '2024-01-21'"""
    ),
    "g6_high_water": sql(
        """SELECT device_id, device_type, CAST(key_id AS BIGINT) AS key_id,
        max(date_trunc('month', stat_time)) + INTERVAL '1' MONTH - INTERVAL '1' SECOND AS high_water FROM daily GROUP BY ALL"""
    ),
    "h1_verify": sql(" UNION ".join(_rollup_check(*check) for check in ROLLUP_CHECKS)),
    "h1_verify_resets": sql(" UNION ".join(_rollup_check(*check, "readings_reset") for check in ROLLUP_CHECKS)),
    "h1_mismatches": sql(
        f"""SELECT w.entity_id, w.key_id, CAST(w.bucket AS TIMESTAMP) AS bucket, w.energy_consumption AS consumption,
        CAST(n.fine_sum AS BIGINT) AS fine_sum, w.energy_consumption = n.fine_sum AS matches
        FROM ({_min_consumption('day', 'readings_reset')}) w
        JOIN (SELECT entity_id, key_id, date_trunc('day', bucket) AS bucket, sum(energy_consumption) AS fine_sum
              FROM ({_min_consumption('hour', 'readings_reset')}) f GROUP BY ALL) n USING (entity_id, key_id, bucket)"""
    ),
    "h2_drift": sql(
        f"""SELECT device_id, device_type, CAST(key_id AS BIGINT) AS key_id,
        max(stat_time) + {PRODUCTION_DAY} - INTERVAL '1' DAY AS latest_stat_time, max(stat_time) AS max_stat_time
        FROM daily WHERE device_id % 3 = 0 GROUP BY ALL"""
    ),
    "h2_drift_raw": sql(
        f"""SELECT device_id, device_type, CAST(key_id AS BIGINT) AS key_id, max(stat_time) + {PRODUCTION_DAY} AS latest_stat_time,
        max(stat_time) AS max_stat_time FROM daily GROUP BY ALL"""
    ),
    "h3_unique": """SELECT o_custkey AS device_id, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS stat_time, count(*) AS n
        FROM orders GROUP BY ALL HAVING count(*) > 1""",
    "h4_truth": sql(
        """SELECT id, closed_period AS fn_output, half_open_period AS expected,
        CASE WHEN closed_period = half_open_period THEN 'Y' ELSE 'N' END AS verify FROM labelled"""
    ),
    "h5_drop_column": sql(
        "SELECT * EXCLUDE (entity_id) REPLACE (CAST(key_id AS BIGINT) AS key_id) FROM daily"
    ),
    "i3_rewind": _rewound("date_trunc('minute', x.ts)", "INTERVAL '57' SECOND"),
    "i3_rewind_hour": _rewound("date_trunc('hour', x.ts)", "INTERVAL '3599' SECOND"),
    "i3_rewind_day": _rewound("date_trunc('day', x.ts - INTERVAL '8' HOUR)", PRODUCTION_DAY),
    "i3_rewind_calendar_day": _rewound("date_trunc('day', x.ts)", "INTERVAL '3599' SECOND"),
    "a1_arrival_log": """SELECT user_id AS entity_id, key_id, min(epoch_us(ts) // 1000) AS first_ms, CAST(min(load) AS BIGINT) AS first_arrival
        FROM (SELECT *, CASE event_type WHEN 'click' THEN 142 WHEN 'view' THEN 569 WHEN 'purchase' THEN 596 WHEN 'signup' THEN 608
                ELSE 612 END::BIGINT AS key_id,
              CASE WHEN ts < TIMESTAMP '2024-01-17 10:20:30' AND event_id % 9 <> 4 AND user_id % 5 <> 3 THEN 0 ELSE 1 END AS load FROM events) e
        GROUP BY ALL""",
    "i3_redone_months": _redone("month"),
    "i3_redone_years": _redone("year"),
    "a10_write_stat": sql(
        f"""SELECT device_type, device_id, CAST(key_id AS BIGINT) AS key_id, stat_time, dbl_stats,
        CAST(NULL AS DOUBLE) AS dbl_min, CAST(NULL AS DOUBLE) AS dbl_max, CAST(2 AS BIGINT) AS stat_type
        FROM ({_FLOWS}) f"""
    ),
    "g7_run_metrics": sql(
        f"""SELECT count(*) AS rows, min(stat_time) AS first_stat_time, max(stat_time) AS last_stat_time
        FROM ({_FLOWS}) f"""
    ),
    "i1_stream_hour": sql(_measured("date_trunc('hour', r.ts)", 2)),
    "i1_stream_production_day": sql(_measured("CAST(date_trunc('day', r.ts - INTERVAL '8' HOUR) AS TIMESTAMP)", 3)),
    "i2_stream_delta": _steps("readings"),
    "i1_late_days": sql(
        """SELECT e.device_type, e.device_id, CAST(a.avg_key_id AS BIGINT) AS key_id,
        CAST(date_trunc('day', r.ts - INTERVAL '8' HOUR) AS TIMESTAMP) AS stat_time, avg(r.value_c) AS dbl_stats,
        CAST(min(r.value_c) AS DOUBLE) AS dbl_min, CAST(max(r.value_c) AS DOUBLE) AS dbl_max, CAST(3 AS BIGINT) AS stat_type
        FROM readings r JOIN eligible e USING (entity_id) JOIN avg_key_config a ON a.rate_key_id = r.key_id GROUP BY ALL"""
    ),
}
# the same facts, however the readings came
for _redo, _runs in (
    ("h5_drop_stored_column", "h5_drop_column"),
    ("i1_late_hours", "a10_write_stat"),
    ("i2_restarted", "i2_stream_delta"),
    ("i3_redone_minutes", "f14_minute_runs"),
    ("i3_redone_hours", "f14_hour_runs"),
    ("i3_redone_days", "f14_day_runs"),
):
    ORACLES[_redo] = ORACLES[_runs]
