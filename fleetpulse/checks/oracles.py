"""The same questions as plain SQL, for DuckDB over the same tables.

Written from the definition of each result and not from the Spark code: raw rows instead of
pre-aggregates, a recursive walk instead of cut timelines.
"""

from __future__ import annotations

from fleetpulse.operators.quality import RULES, Rule, accepted, between, not_null, unique

_SEVERITY = "CASE WHEN delay <= 600 THEN 'MODERATE' WHEN delay <= 1200 THEN 'HIGH' ELSE 'SEVERE' END"
FIXED_NOW = 1_705_708_800


def _local(ts: str) -> str:
    return f"(({ts}) AT TIME ZONE 'UTC' AT TIME ZONE 'Pacific/Auckland')"


def _round(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _key(kind: str, *parts: str) -> str:
    texts = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"sha256(CAST(to_json(['{kind}', {texts}]) AS VARCHAR))"


def _gaps(source: str) -> str:
    return f"""
        SELECT *, departure - lag(departure) OVER (
                   PARTITION BY window_start, route_id, direction_id ORDER BY departure) AS gap
        FROM {source}"""


def _spread(source: str) -> str:
    return f"""
        SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, route_id, direction_id,
               count(*) AS trip_count, count(gap) AS gap_count, CAST(sum(gap) AS BIGINT) AS span,
               count(gap) * sum(CAST(gap AS HUGEINT) * gap) - sum(gap) * sum(gap) AS scatter
        FROM {source} GROUP BY ALL"""


def _measured(source: str) -> str:
    return f"""
        SELECT window_start, window_end, route_id, direction_id, trip_count,
               CASE WHEN gap_count > 0 THEN span / gap_count END AS headway_mean_s,
               CASE WHEN gap_count > 0 THEN sqrt(CAST(scatter AS DOUBLE)) / gap_count END AS headway_stddev_s,
               CASE WHEN trip_count >= 3 AND span > 0 THEN sqrt(CAST(scatter AS DOUBLE)) / span END AS headway_cv,
               coalesce(trip_count >= 3 AND span > 0 AND 4 * scatter > CAST(span AS HUGEINT) * span, false) AS is_bunching
        FROM {source}"""


def _staged_windows(source: str) -> str:
    return f"""
        SELECT *, CAST({_local('window_start')} AS DATE) AS event_date,
               CAST(hour({_local('window_start')}) AS INTEGER) AS event_hour
        FROM {source} WHERE trip_count > 0"""


def _walk(name: str, source: str, silence: int | None = None) -> str:
    """One step per reading: (moved) a new anchor, (over) too long, else one more reading."""
    silent = "false" if silence is None else f"r.ts - w.ts > {silence}"
    return f"""
        SELECT vehicle_id, i, route_id, trip_id, latitude AS a_lat, longitude AS a_lon, 1 AS n, ts AS since,
               stopped AS parked, ts, CAST(0 AS BIGINT) AS span
        FROM {source} WHERE i = 1
        UNION ALL
        SELECT vehicle_id, i, route_id, trip_id,
               CASE WHEN moved OR over THEN latitude ELSE a_lat END, CASE WHEN moved OR over THEN longitude ELSE a_lon END,
               CASE WHEN moved OR over THEN 1 ELSE k + 1 END, CASE WHEN moved OR over THEN ts ELSE since END,
               CASE WHEN moved OR over THEN stopped ELSE parked AND stopped END, ts,
               CASE WHEN moved OR over THEN 0 ELSE ts - since END
        FROM (SELECT *, NOT moved AND k + 1 >= 3 AND ts - since > 43200 AS over
              FROM (SELECT r.* EXCLUDE (n), w.a_lat, w.a_lon, w.n AS k, w.since, w.parked,
                           r.route_id <> w.route_id OR r.trip_id <> w.trip_id OR {silent}
                           OR 2 * 6371000e0 * asin(sqrt(
                                  pow(sin(radians(r.latitude - w.a_lat) / 2), 2)
                                  + cos(radians(r.latitude)) * cos(radians(w.a_lat))
                                    * pow(sin(radians(r.longitude - w.a_lon) / 2), 2))) > 15 AS moved
                    FROM {name} w JOIN {source} r ON r.vehicle_id = w.vehicle_id AND r.i = w.i + 1))"""


def _stalls(walk: str) -> str:
    return f"""
        SELECT {_key('stall', 'vehicle_id', 'route_id', 'trip_id', 'since', 'ts', 'n')} AS stall_id,
               vehicle_id, route_id, trip_id, a_lat AS latitude, a_lon AS longitude, CAST(n AS INTEGER) AS reading_count,
               CAST(span AS INTEGER) AS stall_duration_s, make_timestamp(since * 1000000) AS first_seen,
               ts AS stall_detected_ts
        FROM {walk} WHERE n >= 3 AND span >= 3600 AND NOT parked"""


# Each entry is a named subquery; _with() lists those a query needs, in this order.
PARTS = {
    "trips": """
        SELECT event_id AS n, ts, 'E' || event_id AS event_id, 'S' || user_id AS id, 'S' || user_id AS source_id,
               'T' || (user_id % 40) AS trip_id,
               CASE WHEN event_id % 71 = 3 THEN '' ELSE 'R' || (user_id % 30) END AS route_id,
               CAST(event_id % 2 AS INTEGER) AS direction_id,
               CASE WHEN event_id % 83 <> 5
                    THEN lpad(CAST(CASE WHEN hour(ts) < 4 THEN hour(ts) + 24 ELSE hour(ts) END AS VARCHAR), 2, '0')
                         || strftime(ts, ':%M:%S') END AS start_time,
               strftime(ts, '%Y%m%d') AS start_date, 0 AS schedule_relationship,
               CASE WHEN event_id % 61 <> 7 THEN CAST(floor(value * 10) - 200 AS INTEGER) END AS delay,
               date_trunc('hour', ts) AS event_ts,
               epoch_us(date_trunc('hour', ts)) // 1000000 AS timestamp,
               event_type = 'error' AS is_deleted,
               ts + to_seconds(event_id % 60) AS ingested_at, props
        FROM events""",
    "stg": f"""
        SELECT event_id, source_id, trip_id, route_id, direction_id, start_time, start_date, delay,
               round(delay / 60.0, 2) AS delay_minutes, event_ts,
               CAST({_local('event_ts')} AS DATE) AS event_date,
               CAST(hour({_local('event_ts')}) AS INTEGER) AS event_hour
        FROM (SELECT *, row_number() OVER (PARTITION BY source_id, event_ts ORDER BY ingested_at, event_id) AS rn
              FROM trips)
        WHERE rn = 1 AND NOT is_deleted""",
    "routes": """
        SELECT 'R' || n_nationkey AS route_id, n_name AS route_name, 'Line ' || n_name AS route_long_name,
               n_regionkey AS route_type,
               CASE n_regionkey WHEN 2 THEN 'Rail' WHEN 3 THEN 'Bus' ELSE 'Other' END AS route_type_label
        FROM nation WHERE n_nationkey % 12 <> 11""",
    "delays": f"""
        SELECT {_key('delay', 'id', 'trip_id', 'start_date', 'timestamp', 'delay')} AS event_id, trip_id, route_id,
               delay, {_SEVERITY} AS severity, start_time, start_date, timestamp AS event_timestamp
        FROM trips WHERE delay > 300""",
    "departures": """
        SELECT make_timestamp((epoch_us(event_ts) // 21600000000 - k) * 21600000000) AS window_start,
               n, route_id, direction_id,
               CAST(split_part(start_time, ':', 1) AS BIGINT) * 3600 + CAST(split_part(start_time, ':', 2) AS BIGINT) * 60
                   + CAST(split_part(start_time, ':', 3) AS BIGINT) + coalesce(delay, 0) AS departure
        FROM trips, (SELECT unnest([0, 1, 2, 3]) AS k) WHERE route_id <> '' AND start_time IS NOT NULL""",
    "gaps": _gaps("departures"),
    "spread": _spread("gaps"),
    "windows": _measured("spread"),
    "stg_windows": _staged_windows("windows"),
    "positions": """
        SELECT event_id AS n, 'V' || (user_id % 30) AS vehicle_id, 'D' || day(ts) AS trip_id,
               'R' || ((user_id + CASE WHEN hour(ts) >= 18 THEN 1 ELSE 0 END) % 30) AS route_id,
               CASE WHEN event_id % 97 = 11 THEN 123e0 WHEN event_type = 'error' THEN 0e0
                    ELSE -36.85e0 + floor(value / 50) * 0.00006e0 END AS latitude,
               174.76e0 AS longitude, CAST(value AS FLOAT) AS bearing,
               CASE WHEN event_type <> 'signup' THEN CAST(value AS FLOAT) END AS speed,
               CAST(event_id % 20 AS INTEGER) AS current_stop_sequence, 'P' || (event_id % 20) AS stop_id,
               CASE WHEN event_type = 'view' THEN 'STOPPED_AT' ELSE 'IN_TRANSIT_TO' END AS current_status,
               CAST(NULL AS VARCHAR) AS congestion_level, CAST(event_id % 7 AS VARCHAR) AS occupancy_status,
               epoch_us(ts) // 1000000 AS timestamp, 'E' || event_id AS event_id,
               ts + to_seconds(event_id % 60) AS ingested_at, event_type, props
        FROM events""",
    "stg_positions": f"""
        SELECT event_id, vehicle_id, trip_id, CASE WHEN n % 89 <> 2 THEN route_id END AS route_id, latitude, longitude,
               speed AS speed_kmh, current_stop_sequence,
               stop_id, current_status, event_ts, CAST({_local('event_ts')} AS DATE) AS event_date,
               CAST(hour({_local('event_ts')}) AS INTEGER) AS event_hour
        FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id, event_ts ORDER BY ingested_at, event_id) AS rn
              FROM (SELECT *, date_trunc('hour', make_timestamp(timestamp * 1000000)) AS event_ts FROM positions))
        WHERE rn = 1 AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180""",
    "notices": """
        SELECT event_id AS n, CAST(event_id AS VARCHAR) AS id, 'R' || (user_id % 30) AS route_id, event_type AS cause,
               CASE WHEN event_id % 3 = 0 THEN 'DETOUR' ELSE 'DELAYS' END AS effect,
               'notice ' || event_id AS header_text, props AS description_text,
               epoch_us(ts) // 1000000 - 3600 AS active_period_start,
               epoch_us(ts) // 1000000 + 3600 AS active_period_end,
               epoch_us(ts) // 1000000 AS timestamp, props
        FROM events""",
    "readings": """
        SELECT *, row_number() OVER (PARTITION BY vehicle_id
                                     ORDER BY ts, route_id, trip_id, latitude, longitude, stopped) AS i
        FROM (SELECT n, vehicle_id, route_id, trip_id, latitude, longitude, timestamp AS ts,
                     current_status = 'STOPPED_AT' AS stopped
              FROM positions
              WHERE latitude BETWEEN -37.05 AND -36.60 AND longitude BETWEEN 174.62 AND 174.95)""",
    "walk": _walk("walk", "readings"),
    "stalls": _stalls("walk"),
    "silent_walk": _walk("silent_walk", "readings", 7200),
    "silent_stalls": _stalls("silent_walk"),
    # When each event arrives in a replay of six parts.
    "arrivals": """
        SELECT event_id AS n, CAST(least((s - low) * 6 // (high - low + 1) + wait, 5) AS INTEGER) AS part
        FROM (SELECT event_id, epoch_us(ts) // 1000000 AS s,
                     CASE WHEN event_id % 50 = 7 THEN 2 WHEN event_id % 10 = 3 THEN 1 ELSE 0 END AS wait FROM events),
             (SELECT min(epoch_us(ts) // 1000000) AS low, max(epoch_us(ts) // 1000000) AS high FROM events)""",
    # What the watermark is when a part is taken: six days before the latest reading of all earlier parts.
    "timely_readings": """
        SELECT * EXCLUDE (i), row_number() OVER (PARTITION BY vehicle_id
                                                 ORDER BY ts, route_id, trip_id, latitude, longitude, stopped) AS i
        FROM readings r JOIN arrivals a USING (n)
        WHERE (r.ts // 86400 + 1) * 86400 > coalesce((SELECT max(o.ts) FROM readings o JOIN arrivals b USING (n)
                                                    WHERE b.part < a.part), 0) - 6 * 86400""",
    "timely_walk": _walk("timely_walk", "timely_readings"),
    "timely_stalls": _stalls("timely_walk"),
    "timely_departures": """
        SELECT d.* FROM departures d JOIN arrivals a USING (n)
        WHERE epoch_us(window_start) // 1000000 + 86400
              > coalesce((SELECT max(t.timestamp) FROM trips t JOIN arrivals b USING (n) WHERE b.part < a.part), 0) - 6 * 86400""",
    "timely_gaps": _gaps("timely_departures"),
    "timely_spread": _spread("timely_gaps"),
    "timely_windows": _measured("timely_spread"),
    "timely_stg_windows": _staged_windows("timely_windows"),
    "stg_stalls": f"""
        SELECT stall_id, vehicle_id, route_id, latitude, longitude, reading_count, first_seen,
               make_timestamp(stall_detected_ts * 1000000) AS stall_detected_at,
               CAST(stall_duration_s AS BIGINT) AS stall_duration_s,
               CAST({_local('first_seen')} AS DATE) AS event_date,
               CAST(hour({_local('first_seen')}) AS INTEGER) AS event_hour
        FROM stalls""",
    "stops": """
        SELECT CAST(s_suppkey AS VARCHAR) AS stop_id, CASE WHEN s_suppkey % 9 <> 4 THEN s_name END AS stop_name,
               CAST(-(30 + s_suppkey % 20) AS DOUBLE) AS stop_lat, CAST(160 + s_suppkey % 25 AS DOUBLE) AS stop_lon,
               'C' || s_suppkey AS stop_code
        FROM supplier
        WHERE -(30 + s_suppkey % 20) BETWEEN -48 AND -34 AND 160 + s_suppkey % 25 BETWEEN 166 AND 179""",
    "by_hour": f"""
        SELECT event_date, event_hour, {_round('avg(delay_minutes)', 2)} AS avg_delay_minutes,
               {_round('avg(CASE WHEN delay > 0 THEN delay_minutes END)', 2)} AS avg_delay_minutes_delayed_only,
               count(*) AS trip_count, count(*) FILTER (delay > 300) AS delayed_trip_count
        FROM stg GROUP BY ALL""",
    "early_by_hour": f"""
        SELECT event_date, event_hour, {_round('avg(delay_minutes)', 2)} AS avg_delay_minutes,
               {_round('avg(CASE WHEN delay > 0 THEN delay_minutes END)', 2)} AS avg_delay_minutes_delayed_only,
               count(*) AS trip_count, count(*) FILTER (delay > 300) AS delayed_trip_count
        FROM stg WHERE event_ts < TIMESTAMP '2024-01-15 06:00:00' GROUP BY ALL""",
    "fct_delays": """
        SELECT event_id, event_date, event_hour, route_id, route_name, route_type_label, trip_id, delay,
               delay_minutes, event_ts
        FROM stg LEFT JOIN routes USING (route_id) WHERE delay > 300""",
    "fct_stalls": """
        SELECT stall_id, event_date, event_hour, vehicle_id, route_id, route_name, latitude, longitude, stall_duration_s
        FROM stg_stalls LEFT JOIN routes USING (route_id)""",
    "fct_headways": f"""
        SELECT route_id, route_name, route_type_label, date_trunc('hour', window_start) AS hour_bucket,
               {_round('avg(headway_mean_s)', 1)} AS avg_headway_s, {_round('avg(headway_cv)', 3)} AS headway_cv,
               {_round('100e0 * count(*) FILTER (is_bunching) / count(*)', 1)} AS bunching_pct,
               CAST(sum(trip_count) AS BIGINT) AS trip_count, event_date
        FROM stg_windows LEFT JOIN routes USING (route_id) GROUP BY ALL""",
    "alerts": f"""
        SELECT event_id AS alert_id, 'DELAY' AS alert_type, route_id, CAST(NULL AS VARCHAR) AS vehicle_id, trip_id,
               make_timestamp(event_timestamp * 1000000) AS event_ts FROM delays
        UNION ALL
        SELECT stall_id, 'STALL', route_id, vehicle_id, trip_id, make_timestamp(stall_detected_ts * 1000000) FROM stalls
        UNION ALL
        SELECT {_key('bunching', 'route_id', 'direction_id', "strftime(window_start, '%Y-%m-%dT%H:%M:%S.%gZ')")},
               'BUNCHING', route_id, NULL, NULL, window_start FROM windows WHERE is_bunching""",
    "board_kinds": """
        SELECT 'delay' AS kind FROM delays UNION ALL SELECT 'stall' FROM stalls
        UNION ALL SELECT CASE WHEN event_id % 17 = 0 THEN 'malformed' ELSE 'other' END FROM events""",
}
_NEEDS = {
    "stg": ["trips"], "delays": ["trips"], "departures": ["trips"], "gaps": ["departures"], "spread": ["gaps"],
    "windows": ["spread"], "stg_windows": ["windows"], "stg_positions": ["positions"], "readings": ["positions"],
    "walk": ["readings"], "stalls": ["walk"], "stg_stalls": ["stalls"], "by_hour": ["stg"], "early_by_hour": ["stg"],
    "fct_delays": ["stg", "routes"], "fct_stalls": ["stg_stalls", "routes"], "fct_headways": ["stg_windows", "routes"],
    "silent_walk": ["readings"], "silent_stalls": ["silent_walk"], "timely_readings": ["readings", "arrivals"],
    "timely_walk": ["timely_readings"], "timely_stalls": ["timely_walk"], "timely_departures": ["departures", "trips", "arrivals"],
    "timely_gaps": ["timely_departures"], "timely_spread": ["timely_gaps"], "timely_windows": ["timely_spread"],
    "timely_stg_windows": ["timely_windows"],
    "alerts": ["delays", "stalls", "windows"], "board_kinds": ["delays", "stalls"],
}


def _with(select: str, *parts: str) -> str:
    wanted: set[str] = set()

    def add(part: str) -> None:
        wanted.add(part)
        for other in _NEEDS.get(part, []):
            add(other)

    for part in parts:
        add(part)
    listed = [f"{name} AS ({body})" for name, body in PARTS.items() if name in wanted]
    return f"WITH RECURSIVE {', '.join(listed)}\n{select}" if listed else select


def _windows_rounded(source: str, extra: str = "") -> str:
    return f"""
        SELECT window_start, window_end, route_id, direction_id, trip_count,
               {_round('headway_mean_s', 4)} AS headway_mean_s, {_round('headway_stddev_s', 4)} AS headway_stddev_s,
               {_round('headway_cv', 4)} AS headway_cv, is_bunching {extra}
        FROM {source}"""


def _clamp(raw: str, now: str) -> str:
    return f"""CASE WHEN {raw} < 1600000000 THEN {now} - 3600 WHEN {raw} < {now} - 3600 THEN {now} - 3600
               WHEN {raw} > {now} + 300 THEN {now} + 300 ELSE {raw} END"""


def _status(raw: str, now: str) -> str:
    return f"""CASE WHEN {raw} IS NULL THEN 'missing' WHEN {raw} < 1600000000 THEN 'dropped_invalid'
               WHEN {raw} < {now} - 3600 THEN 'clamped_past' WHEN {raw} > {now} + 300 THEN 'clamped_future'
               ELSE 'ok' END"""


def _bronze(part: str, table: str, entity: str, body: str, extra: str = "", ids: bool = True) -> str:
    ident = ""
    if ids:
        ident = _key(table, entity, "timestamp", "payload") + " AS event_id, payload AS _raw_payload,"
    return _with(
        f"""
        SELECT {ident} {body}, make_timestamp(clamped * 1000000) AS event_ts,
               make_timestamp(timestamp * 1000000) AS event_ts_raw,
               {_status('timestamp', str(FIXED_NOW))} AS event_ts_status {extra},
               CAST(make_timestamp(clamped * 1000000) AS DATE) AS event_date,
               CAST(hour(make_timestamp(clamped * 1000000)) AS INTEGER) AS event_hour
        FROM (SELECT *, {_clamp('timestamp', str(FIXED_NOW))} AS clamped, to_base64(encode(props)) AS payload FROM {part})""",
        part,
    )


def _violations(table: str, source: str, rule: Rule) -> str:
    c = rule.column
    if rule.kind == "unique":
        count = f"(SELECT count(*) FROM (SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"
    else:
        if rule.kind == "not_null":
            bad = f"{c} IS NULL"
        elif rule.kind == "accepted":
            bad = f"{c} NOT IN (" + ", ".join(f"'{v}'" for v in rule.values) + ")"
        else:
            tests = [f"{c} {op} {v}" for op, v in (("<", rule.low), (">", rule.high)) if v is not None]
            bad = " OR ".join(tests)
        count = f"(SELECT count(*) FROM {source} WHERE {bad})"
    return (
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{rule.label}' AS rule, {count} AS violations"
    )


def _report(tables: dict[str, tuple[str, list[Rule]]], *parts: str) -> str:
    return _with(
        "\nUNION ALL ".join(_violations(t, source, r) for t, (source, rules) in tables.items() for r in rules), *parts
    )


_EARLY = "event_ts < TIMESTAMP '2024-01-15 06:00:00'"
_ROUTES_STG = "(SELECT *, route_name AS route_short_name FROM routes)"
_DELAY_MESSAGES = "SELECT trip_id AS key FROM delays"
_TRIP_RECORD = (
    "source_id, trip_id, route_id, direction_id, start_time, start_date, schedule_relationship, delay"
)

_COLLECTED = f"""
        SELECT DISTINCT *, CAST(event_ts AS DATE) AS event_date FROM alerts
        UNION ALL
        SELECT DISTINCT {_key('unknown', 'props')} AS alert_id, 'UNKNOWN' AS alert_type, NULL AS route_id, NULL AS vehicle_id,
               NULL AS trip_id, CAST(NULL AS TIMESTAMP) AS event_ts, CAST(NULL AS DATE) AS event_date
        FROM events"""

ORACLES: dict[str, str] = {
    "delay_by_hour": _with("SELECT * FROM by_hour", "by_hour"),
    "delay_alerts": _with("SELECT * FROM delays", "delays"),
    "fct_delay_alerts": _with("SELECT * FROM fct_delays", "fct_delays"),
    "fct_headway_regularity": _with("SELECT * FROM fct_headways", "fct_headways"),
    "fct_stall_incidents": _with("SELECT * FROM fct_stalls", "fct_stalls"),
    "stg_trip_updates": _with("SELECT * FROM stg", "stg"),
    "stg_stall_events": _with("SELECT * FROM stg_stalls", "stg_stalls"),
    "stg_headway_metrics": _with(
        _windows_rounded("stg_windows", ", event_date, event_hour") + " WHERE route_id <> 'R7' OR direction_id <> 1", "stg_windows"
    ),
    "trip_updates_keep_first": _with(
        """
        SELECT source_id, CAST(event_ts AS DATE) AS day, event_id, delay, is_deleted FROM trips
        QUALIFY row_number() OVER (PARTITION BY source_id, CAST(event_ts AS DATE) ORDER BY ingested_at, event_id) = 1""",
        "trips",
    ),
    "positions_keep_first": _with("SELECT * FROM stg_positions", "stg_positions"),
    "keep_last_per_user": """
        SELECT user_id, event_id, ts, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "distinct_lines": _with("SELECT DISTINCT route_id, direction_id FROM trips", "trips"),
    "routes_dim": """
        SELECT 'R' || n_nationkey AS route_id, n_name AS route_name, 'Line ' || n_name AS route_long_name,
               n_regionkey AS route_type,
               CASE n_regionkey WHEN 2 THEN 'Rail' WHEN 3 THEN 'Bus' ELSE 'Other' END AS route_type_label
        FROM nation""",
    "stops_dim": _with("SELECT * FROM stops", "stops"),
    "csv_routes": _with("SELECT * FROM routes", "routes"),
    "csv_stops": _with("SELECT * FROM stops", "stops"),
    "full_refresh_and_snapshot": _with(
        """
        SELECT (SELECT count(*) FROM by_hour) AS first_copy, (SELECT count(*) FROM early_by_hour) AS second_copy,
               (SELECT count(*) FROM early_by_hour) AS held""",
        "by_hour", "early_by_hour",
    ),
    "incremental_append": _with(
        """
        SELECT * FROM early_by_hour
        UNION ALL SELECT * FROM by_hour WHERE event_date > (SELECT max(event_date) FROM early_by_hour)""",
        "by_hour", "early_by_hour",
    ),
    "incremental_replace": _with("SELECT * FROM by_hour", "by_hour"),
    "incremental_refresh": _with("SELECT * FROM by_hour", "by_hour"),
    "incremental_delay_alerts": _with("SELECT * FROM fct_delays", "fct_delays"),
    "incremental_stalls": _with("SELECT * FROM fct_stalls", "fct_stalls"),
    "incremental_headways": _with("SELECT * FROM fct_headways", "fct_headways"),
    "decode_messages": _with(
        """
        SELECT id, trip_id, route_id, direction_id, start_time, start_date, schedule_relationship, delay, timestamp,
               is_deleted FROM trips""",
        "trips",
    ),
    "header_scan": "SELECT '00' AS magic_byte, event_id % 3 + 1 AS schema_id, count(*) AS messages FROM events GROUP BY ALL",
    "latest_messages": 'SELECT event_id AS "offset", props AS value FROM events ORDER BY event_id DESC LIMIT 20',
    "delay_local_time": _with(
        f"""
        SELECT event_id, CAST({_local('event_ts')} AS DATE) AS local_date,
               CAST(hour({_local('event_ts')}) AS INTEGER) AS local_hour,
               strftime({_local('event_ts')}, '%Y-%m-%d %H:%M:%S') AS local_text
        FROM trips""",
        "trips",
    ),
    "event_time_status": f"""
        SELECT event_id, {_status('raw', 'now_s')} AS event_ts_status,
               make_timestamp(clamped * 1000000) AS event_ts, CAST(make_timestamp(clamped * 1000000) AS DATE) AS event_date,
               coalesce(CAST(hour(make_timestamp(clamped * 1000000)) AS INTEGER), -1) AS event_hour
        FROM (SELECT *, {_clamp('raw', 'now_s')} AS clamped
              FROM (SELECT event_id, epoch_us(ts) // 1000000 + event_id % 9001 - 1000 AS now_s,
                           CASE WHEN event_id % 11 = 0 THEN epoch_us(ts) // 1000000 - 200000000
                                WHEN event_id % 13 <> 0 THEN epoch_us(ts) // 1000000 END AS raw
                    FROM events))""",
    "clock_seconds": _with(
        """
        SELECT route_id, min(s) AS first_s, max(s) AS last_s, CAST(sum(s) AS BIGINT) AS sum_s
        FROM (SELECT route_id, CAST(split_part(start_time, ':', 1) AS BIGINT) * 3600
                     + CAST(split_part(start_time, ':', 2) AS BIGINT) * 60 + CAST(split_part(start_time, ':', 3) AS BIGINT) AS s
              FROM trips)
        GROUP BY 1""",
        "trips",
    ),
    "service_period": f"""
        SELECT CASE WHEN t >= TIME '06:00:00' AND t < TIME '09:00:00' THEN 'peak'
                    WHEN t >= TIME '15:00:00' AND t < TIME '18:30:00' THEN 'peak'
                    WHEN t >= TIME '22:00:00' OR t < TIME '06:00:00' THEN 'offpeak' ELSE 'shoulder' END AS service_period,
               count(*) AS events
        FROM (SELECT CAST({_local('ts')} AS TIME) AS t FROM events) GROUP BY 1""",
    "display_times": f"""
        SELECT event_id, strftime(CASE WHEN event_id % 3 = 2 THEN ts ELSE {_local('ts')} END, '%Y-%m-%d %H:%M:%S') AS shown
        FROM events""",
    "distance_from_depot": _with(
        f"""
        SELECT vehicle_id, {_round('min(m)', 3)} AS nearest_m, {_round('max(m)', 3)} AS farthest_m
        FROM (SELECT vehicle_id, 2 * 6371000e0 * asin(sqrt(pow(sin(radians(latitude + 36.8485e0) / 2), 2)
                     + cos(radians(latitude)) * cos(radians(-36.8485e0)) * pow(sin(radians(longitude - 174.7633e0) / 2), 2))) AS m
              FROM positions) GROUP BY 1""",
        "positions",
    ),
    "enrich_positions": _bronze(
        "positions", "vehicle_positions", "vehicle_id",
        "vehicle_id, trip_id, route_id, latitude, longitude, bearing, speed, current_stop_sequence, stop_id, "
        "current_status, congestion_level, occupancy_status",
    ),
    "enrich_trip_updates": _bronze("trips", "trip_updates", "id", _TRIP_RECORD, ", is_deleted"),
    "enrich_service_alerts": _bronze(
        "notices", "service_alerts", "id",
        "id AS alert_id, route_id, cause, effect, header_text, description_text, "
        "make_timestamp(active_period_start * 1000000) AS active_period_start, "
        "make_timestamp(active_period_end * 1000000) AS active_period_end",
    ),
    "feed_json_positions": _with(
        """
        SELECT vehicle_id, CASE WHEN event_type = 'signup' THEN '' ELSE trip_id END AS trip_id,
               CASE WHEN event_type = 'signup' THEN '' ELSE route_id END AS route_id, latitude, longitude, bearing, speed,
               current_stop_sequence, stop_id, current_status, congestion_level, occupancy_status, timestamp
        FROM positions""",
        "positions",
    ),
    "feed_json_trip_updates": _with(
        """
        SELECT t.id, t.trip_id, CASE WHEN e.event_type = 'signup' THEN '' ELSE t.route_id END AS route_id, t.direction_id,
               t.start_time, t.start_date, t.schedule_relationship,
               CASE WHEN t.n % 7 = 0 THEN 0 ELSE coalesce(t.delay, 0) END AS delay, t.timestamp, t.is_deleted
        FROM trips t JOIN events e ON e.event_id = t.n""",
        "trips",
    ),
    "feed_json_alerts": _with(
        """
        SELECT id, CASE WHEN n % 5 <> 0 THEN route_id END AS route_id, cause, effect, header_text, description_text,
               active_period_start, active_period_end, timestamp FROM notices""",
        "notices",
    ),
    "headway_set_form": _with(_windows_rounded("windows"), "windows"),
    "headway_lag": _with(_windows_rounded("windows"), "windows"),
    "bunching_top20": _with(
        f"""
        SELECT route_id, direction_id, headway_cv, headway_mean_s, trip_count, window_start
        FROM ({_windows_rounded('windows')}) WHERE is_bunching
        ORDER BY headway_cv DESC, route_id, direction_id, window_start LIMIT 20""",
        "windows",
    ),
    "stalls": _with("SELECT * FROM stalls", "stalls"),
    "stalls_latest": _with(
        """
        SELECT vehicle_id, route_id, trip_id, reading_count, stall_detected_ts, stall_duration_s FROM stalls
        QUALIFY row_number() OVER (PARTITION BY vehicle_id, route_id, trip_id
                                   ORDER BY reading_count DESC, stall_detected_ts, stall_id DESC) = 1""",
        "stalls",
    ),
    "alert_envelope": _with("SELECT *, CAST(event_ts AS DATE) AS event_date FROM alerts", "alerts"),
    "alerts_union": _with(
        """
        SELECT key, count(*) AS messages
        FROM (SELECT trip_id AS key FROM delays UNION ALL SELECT vehicle_id FROM stalls
              UNION ALL SELECT route_id FROM windows WHERE is_bunching) GROUP BY 1""",
        "delays", "stalls", "windows",
    ),
    "alerts_upsert": _with(_COLLECTED, "alerts"),
    "headway_message_keys": _with(
        "SELECT route_id || ':' || direction_id AS key, count(*) AS messages FROM windows GROUP BY 1", "windows"
    ),
    "live_filters": _with("SELECT kind, count(*) AS messages FROM board_kinds GROUP BY 1", "board_kinds"),
    "live_counts": _with(
        "SELECT count(*) FILTER (kind = 'delay') AS delay_alerts, count(*) FILTER (kind = 'stall') AS stall_events FROM board_kinds",
        "board_kinds",
    ),
    "drill_down": _with(
        """
        SELECT event_id, trip_id, route_id, delay, severity, event_timestamp FROM delays
        WHERE severity = 'SEVERE' AND trip_id = 'T7'""",
        "delays",
    ),
    "trip_choices": _with("SELECT DISTINCT trip_id FROM delays ORDER BY 1", "delays"),
    "severity_counts": _with(
        """
        SELECT CAST(tier AS INTEGER) AS tier, s.severity, count(d.event_id) AS alerts
        FROM (VALUES (0, 'MODERATE'), (1, 'HIGH'), (2, 'SEVERE')) s(tier, severity) LEFT JOIN delays d USING (severity)
        GROUP BY ALL ORDER BY tier""",
        "delays",
    ),
    "live_summary": _with(
        f"""
        SELECT count(DISTINCT route_id) AS routes_reporting,
               count(DISTINCT CASE WHEN is_bunching THEN route_id || ':' || direction_id END) AS bunching_lines,
               {_round('avg(headway_cv)', 6)} AS avg_headway_cv
        FROM windows""",
        "windows",
    ),
    "route_cv_top15": _with(
        f"""
        SELECT route_id, {_round('avg(headway_cv)', 6)} AS avg_headway_cv FROM windows
        WHERE route_id IN (SELECT route_id FROM windows GROUP BY 1 ORDER BY count(*) DESC, route_id LIMIT 15)
        GROUP BY 1 HAVING avg(headway_cv) IS NOT NULL ORDER BY 2 DESC, 1""",
        "windows",
    ),
    "windows_of_busiest": _with(
        """
        SELECT route_id, direction_id, window_start, trip_count, is_bunching FROM windows
        WHERE route_id IN (SELECT route_id FROM windows GROUP BY 1 ORDER BY count(*) DESC, route_id LIMIT 15)""",
        "windows",
    ),
    "latest_rows": "SELECT event_id, user_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 5",
    "live_board": _with(
        f"""
        SELECT event_id AS alert_id, trip_id, route_id, delay AS delay_s, severity,
               strftime({_local('make_timestamp(second * 1000000)')}, '%Y-%m-%d %H:%M:%S') AS detected_at
        FROM (SELECT *, {_key('delay', 'id', 'trip_id', 'start_date', 'second', 'delay')} AS event_id, {_SEVERITY} AS severity
              FROM (SELECT * EXCLUDE (event_id), epoch_us(ts) // 1000000 AS second FROM trips) WHERE delay > 300)
        QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY second DESC, event_id DESC) = 1
        ORDER BY detected_at DESC, alert_id LIMIT 50""",
        "trips",
    ),
    "map_points": _with(
        """
        SELECT latitude AS lat, longitude AS lon, count(*) AS points, CAST(sum(current_stop_sequence) AS BIGINT) AS weight
        FROM positions WHERE latitude BETWEEN -37.20 AND -36.50 AND longitude BETWEEN 174.50 AND 175.10 GROUP BY 1, 2""",
        "positions",
    ),
    "retention": f"""
        SELECT event_id, ts AS received_at FROM events
        WHERE ts >= make_timestamp(CAST({FIXED_NOW} AS BIGINT) * 1000000) - INTERVAL 1 DAY""",
    "quality_report": _report(
        {
            "stg_trip_updates": ("stg", RULES["stg_trip_updates"]),
            "stg_vehicle_positions": ("stg_positions", RULES["stg_vehicle_positions"]),
            "stg_gtfs_routes": (_ROUTES_STG, RULES["stg_gtfs_routes"]),
            "stg_gtfs_stops": ("stops", RULES["stg_gtfs_stops"]),
            "dim_routes": ("routes", RULES["dim_routes"]),
            "dim_stops": ("stops", RULES["dim_stops"]),
            "fct_delay_alerts": ("fct_delays", RULES["fct_delay_alerts"]),
            "fct_delay_by_hour": ("by_hour", RULES["fct_delay_by_hour"]),
        },
        "stg", "stg_positions", "routes", "stops", "fct_delays", "by_hour",
    ),
    "quality_detections": _report(
        {
            "stg_stall_events": ("stg_stalls", RULES["stg_stall_events"]),
            "stg_headway_metrics": ("stg_windows", RULES["stg_headway_metrics"]),
            "fct_stall_incidents": ("(SELECT *, 1 AS detected_at FROM fct_stalls)", RULES["fct_stall_incidents"]),
            "fct_headway_regularity": ("fct_headways", RULES["fct_headway_regularity"]),
        },
        "stg_stalls", "stg_windows", "fct_stalls", "fct_headways",
    ),
    "quality_on_append": _with(
        "\nUNION ALL ".join(
            f"""
        SELECT '{part}' AS table_name, 'delay' AS column_name, 'not_null' AS rule, count(*) FILTER (delay IS NULL) AS violations FROM ({rows})
        UNION ALL SELECT '{part}', 'start_time', 'not_null', count(*) FILTER (start_time IS NULL) FROM ({rows})
        UNION ALL SELECT '{part}', 'delay', 'between(,300)', count(*) FILTER (delay > 300) FROM ({rows})
        UNION ALL SELECT '{part}', 'event_id', 'unique', {repeated}"""
            for part, rows, repeated in (
                ("first", f"SELECT * FROM trips WHERE {_EARLY}", "0"),
                ("second", f"SELECT * FROM trips WHERE NOT {_EARLY} OR n % 6 = 0", f"(SELECT count(*) FROM trips WHERE {_EARLY} AND n % 6 = 0)"),
            )
        ),
        "trips",
    ),
    "quality_raw_events": _report(
        {"events": ("events", between("value", 0.01, 200) + unique("user_id")
                    + accepted("event_type", "view", "click") + not_null("event_id"))}
    ),
    "profile": _with(
        "\nUNION ALL ".join(
            f"""
        SELECT '{c}' AS column_name, count(*) AS row_count, count({c}) AS non_null,
               {_round(f'avg(CAST({c} AS DOUBLE))', 4)} AS mean, {_round(f'stddev_samp(CAST({c} AS DOUBLE))', 4)} AS stddev,
               {_round(f'min(CAST({c} AS DOUBLE))', 4)} AS min, {_round(f'max(CAST({c} AS DOUBLE))', 4)} AS max
        FROM positions"""
            for c in ("latitude", "longitude", "speed")
        ),
        "positions",
    ),
    "profile_quartiles": _with(
        "\nUNION ALL ".join(
            f"""
        SELECT '{c}' AS column_name, {_round(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)', 4)} AS p25,
               {_round(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 4)} AS p50,
               {_round(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)', 4)} AS p75, true AS sketch_within_error
        FROM positions"""
            for c in ("latitude", "longitude", "speed")
        ),
        "positions",
    ),
    "row_counts": "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in ("events", "nation", "supplier")
    ),
    "stream_bronze": _bronze("trips", "trip_updates", "id", _TRIP_RECORD, ", is_deleted", ids=False),
    "stream_delay": _with(
        """
        SELECT event_id, count(*) AS table_rows, min(severity) AS severity, count(*) AS messages FROM delays GROUP BY 1""",
        "delays",
    ),
    "stream_headway": _with(_windows_rounded("timely_stg_windows", ", event_date, event_hour"), "timely_stg_windows"),
    "stream_headway_final": _with(_windows_rounded("timely_stg_windows", ", event_date, event_hour"), "timely_stg_windows"),
    # Lateness is judged by the watermark of the trigger before, which knows the parts before that one.
    "stream_dedup_late": _with(
        """
        SELECT DISTINCT trip_id, route_id, direction_id, start_date FROM trips t JOIN arrivals a USING (n)
        WHERE epoch_us(date_trunc('day', ts)) // 1000000
              > coalesce((SELECT max(epoch_us(date_trunc('day', o.ts)) // 1000000) FROM trips o JOIN arrivals b USING (n)
                          WHERE b.part < a.part - 1), 0) - 6 * 86400""",
        "trips", "arrivals",
    ),
    "stream_dedup": _with("SELECT DISTINCT trip_id, route_id, direction_id FROM trips", "trips"),
    "stream_stalls": _with("SELECT * FROM stalls", "stalls"),
    "stream_stalls_late": _with("SELECT * FROM timely_stalls", "timely_stalls"),
    "stream_stalls_silence": _with("SELECT * FROM silent_stalls", "silent_stalls"),
    "stalls_silence": _with("SELECT * FROM silent_stalls", "silent_stalls"),
    "stream_alerts": _with(_COLLECTED, "alerts"),
}
