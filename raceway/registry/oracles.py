"""The same results in plain SQL over the same tables."""

from __future__ import annotations

# Championship points by final position.
_POINTS = """CASE {p} WHEN 1 THEN 25 WHEN 2 THEN 18 WHEN 3 THEN 15 WHEN 4 THEN 12 WHEN 5 THEN 10
    WHEN 6 THEN 8 WHEN 7 THEN 6 WHEN 8 THEN 4 WHEN 9 THEN 2 WHEN 10 THEN 1
    ELSE CASE WHEN {p} BETWEEN 11 AND 20 THEN 0 END END"""

_DAY_NUMBER = "CAST(DATE_DIFF('day', DATE '1970-01-01', {d}) AS INTEGER)"

_RESULTS = f"""
WITH final AS (
    SELECT l_suppkey AS driver_id, CAST(l_linenumber AS BIGINT) AS race_id,
           CAST(l_shipdate AS DATE) AS date, CAST(l_quantity AS INTEGER) AS final_position,
           ROW_NUMBER() OVER (PARTITION BY l_suppkey, l_linenumber
                              ORDER BY l_shipdate DESC, l_quantity DESC) AS rn
    FROM lineitem),
days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)
SELECT f.driver_id, f.race_id, f.date, f.final_position,
       CAST({_POINTS.format(p="f.final_position")} AS INTEGER) AS points_earned,
       {_DAY_NUMBER.format(d="d.date")} AS weather_id
FROM final f LEFT JOIN days d ON f.date = d.date WHERE f.rn = 1
"""

_DRIVERS = """
WITH seen AS (
    SELECT o_custkey AS driver_id, printf('Customer#%09d', o_custkey) AS full_name,
           o_orderpriority AS acronym,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS country_code,
           printf('Supplier#%09d', CAST(floor(o_totalprice / 1000) AS BIGINT)) AS team_name,
           ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn
    FROM orders)
SELECT driver_id, full_name, acronym, country_code, CAST(s_suppkey AS INTEGER) AS team_id
FROM seen LEFT JOIN supplier ON team_name = s_name WHERE rn = 1
"""

_HISTORY = """
WITH seen AS (
    SELECT o_custkey AS driver_id, o_orderkey AS session_key, MAX(CAST(s_suppkey AS INTEGER)) AS team_id
    FROM orders LEFT JOIN supplier ON printf('Supplier#%09d', CAST(floor(o_totalprice / 1000) AS BIGINT)) = s_name
    GROUP BY ALL),
begun AS (
    SELECT * FROM seen WINDOW w AS (PARTITION BY driver_id ORDER BY session_key)
    QUALIFY ROW_NUMBER() OVER w = 1 OR team_id IS DISTINCT FROM LAG(team_id) OVER w)
SELECT driver_id, team_id, session_key AS valid_from,
       LEAD(session_key) OVER (PARTITION BY driver_id ORDER BY session_key) AS valid_to
FROM begun
"""

_LATEST_EVENTS = """
SELECT event_id, ts, user_id, event_type, value FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
    FROM events) WHERE rn = 1
"""

_STINTS = """
    SELECT l_suppkey AS {driver}, l_orderkey AS {session},
           CAST(l_linenumber AS BIGINT) AS stint_number, CAST(l_quantity AS BIGINT) AS lap_start,
           CAST(l_quantity + 10 AS BIGINT) AS lap_end,
           CASE WHEN l_returnflag <> 'N' THEN l_returnflag ELSE 'Unknown' END AS compound,
           CASE WHEN l_linestatus <> 'O' THEN l_discount END AS tyre_age_at_start"""

_MEASURES = """
           o_totalprice AS humidity, CAST(o_custkey AS DOUBLE) AS pressure,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS DOUBLE) END AS rainfall,
           o_totalprice + o_custkey AS air_temperature, o_totalprice - o_custkey AS track_temperature,
           o_custkey / 2.0::DOUBLE AS wind_speed, CAST(o_orderkey AS DOUBLE) AS wind_direction"""

_EXACT_MEANS = ", ".join(
    f"CAST(SUM(CAST({m} AS DECIMAL(26,4))) AS DOUBLE) / NULLIF(COUNT({m}), 0) AS {m}"
    for m in (
        "humidity", "pressure", "rainfall", "air_temperature", "track_temperature", "wind_speed", "wind_direction"
    )
)

ORACLES: dict[str, str] = {
    "results_fact": _RESULTS,
    "pit_stops_fact": """
        SELECT DISTINCT l_suppkey AS driver_id, CAST(l_linenumber AS BIGINT) AS race_id,
               CAST(l_quantity AS BIGINT) AS lap_number, l_tax AS pit_duration,
               l_shipdate - INTERVAL 1 HOUR AS date
        FROM lineitem""",
    "teams_dim": """
        SELECT DISTINCT CAST(s_suppkey AS INTEGER) AS team_id, s_name AS name,
               CAST(s_nationkey AS VARCHAR) AS country_code, 'S' || s_suppkey AS acronym
        FROM supplier""",
    "drivers_dim": _DRIVERS,
    "races_dim": """
        SELECT DISTINCT o_orderkey AS race_id, o_orderpriority AS race_name, o_orderstatus AS type,
               split_part(o_orderpriority, '-', 2) AS circuit_name, o_orderpriority AS location,
               CAST(NULL AS VARCHAR) AS country_name,
               o_orderdate - INTERVAL 2 HOUR AS timestamp_start,
               o_orderdate + INTERVAL 210 MINUTE AS timestamp_end
        FROM orders""",
    "stints_dim": f"""
        SELECT *, ROW_NUMBER() OVER (
            ORDER BY race_id, driver_id, stint_number, lap_start, lap_end, compound,
                     tyre_age_at_start NULLS FIRST) - 1 AS stint_id
        FROM (SELECT DISTINCT * FROM ({_STINTS.format(driver="driver_id", session="race_id")}
              FROM lineitem))""",
    "drivers_history": _HISTORY,
    "results_by_team_then": f"""
        SELECT r.*, h.team_id FROM ({_RESULTS.replace("l_linenumber", "l_orderkey")}) r
        ASOF LEFT JOIN ({_HISTORY}) h ON r.driver_id = h.driver_id AND r.race_id >= h.valid_from""",
    "weather_dim": f"""
        SELECT *, ROW_NUMBER() OVER (
            ORDER BY timestamp, humidity, pressure, rainfall NULLS FIRST, air_temperature,
                     track_temperature, wind_speed, wind_direction) - 1 AS weather_id
        FROM (SELECT DISTINCT o_orderdate AS timestamp, {_MEASURES} FROM orders)""",
    "daily_weather_dim": f"""
        SELECT date, ROUND(AVG(humidity), 6) AS humidity, ROUND(AVG(pressure), 6) AS pressure,
               ROUND(AVG(rainfall), 6) AS rainfall, ROUND(AVG(air_temperature), 6) AS air_temperature,
               ROUND(AVG(track_temperature), 6) AS track_temperature,
               ROUND(AVG(wind_speed), 6) AS wind_speed,
               ROUND(AVG(wind_direction), 6) AS wind_direction,
               {_DAY_NUMBER.format(d="date")} AS weather_id
        FROM (SELECT CAST(o_orderdate AS DATE) AS date, {_MEASURES} FROM orders) GROUP BY date""",
    "stored_results": f"""
        SELECT CAST(final_position AS BIGINT) AS final_position,
               CAST(points_earned AS BIGINT) AS points_earned, driver_id, race_id,
               CAST(weather_id AS BIGINT) AS weather_id, date
        FROM ({_RESULTS})""",
    "latest_narrow": f"""
        SELECT driver_id AS driver_number, race_id AS session_key, date AS day,
               final_position AS position
        FROM ({_RESULTS})""",
    "latest_per_key": _LATEST_EVENTS,
    "map_lookup": f"""
        SELECT event_id, position, CAST({_POINTS.format(p="position")} AS INTEGER) AS points
        FROM (SELECT event_id, CAST(floor(value) AS INTEGER) AS position FROM events)""",
    "daily_mean": "SELECT CAST(ts AS DATE) AS date, ROUND(AVG(value), 6) AS value FROM events GROUP BY 1",
    "team_lookup": """
        SELECT c_custkey, printf('Supplier#%09d', c_custkey) AS team_name,
               CAST(s_suppkey AS INTEGER) AS team_id, CAST(s_nationkey AS VARCHAR) AS country_code
        FROM customer LEFT JOIN supplier ON printf('Supplier#%09d', c_custkey) = s_name""",
    "sentinel_fill": """
        SELECT d.doc_id, d.lang, CAST(COALESCE(l.quality, -1) AS INTEGER) AS quality,
               CAST(COALESCE(l.toxic, -1) AS INTEGER) AS toxic
        FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "text_fill": _STINTS.format(driver="driver_number", session="session_key")
    + ", l_partkey AS meeting_key FROM lineitem",
    "reshape_orders": """
        SELECT o_orderkey AS race_id, o_custkey AS driver_id, o_orderstatus,
               o_orderdate AS timestamp_start, o_orderpriority
        FROM orders""",
    "parse_timestamp": """
        SELECT event_id, moment, CASE WHEN event_type <> 'error' THEN moment END AS moment_or_null
        FROM (SELECT event_id, event_type,
                     CASE event_type WHEN 'click' THEN ts - INTERVAL 2 HOUR
                                     WHEN 'view' THEN ts + INTERVAL 210 MINUTE ELSE ts END AS moment
              FROM events)""",
    "distinct_rows": "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer",
    "dedupe_by_key": """
        SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
            SELECT *, ROW_NUMBER() OVER (
                PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
            FROM orders) WHERE rn = 1""",
    "distinct_keys": "SELECT DISTINCT l_partkey FROM lineitem",
    "request_manifest": """
        SELECT session_key, driver_number,
               'https://example.org/v1/car_data?session_key=' || session_key
               || '&driver_number=' || driver_number AS url
        FROM (SELECT DISTINCT l_suppkey AS session_key, CAST(l_quantity AS BIGINT) AS driver_number FROM lineitem)""",
    "request_manifest_one_key": """
        SELECT DISTINCT l_suppkey AS session_key,
               'https://example.org/v1/laps?session_key=' || l_suppkey AS url
        FROM lineitem""",
    "union_batches": """
        SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance
        FROM customer
        UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
        UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
    "endpoint_names": """
        SELECT page_id, list_extract(string_split(string_split(url, '?')[1], '/'), -1) AS name
        FROM pages""",
    "stringify_mixed": """
        SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(value AS VARCHAR) END AS gap,
               CAST(user_id AS VARCHAR) AS user_id, event_type
        FROM events""",
    "strip_attributes": "SELECT doc_id, lang, source FROM documents",
    "surrogate_key": """
        SELECT *, ROW_NUMBER() OVER (ORDER BY l_suppkey, l_shipdate, l_partkey) - 1 AS sk
        FROM (SELECT DISTINCT l_shipdate, l_suppkey, l_partkey FROM lineitem)""",
    "surrogate_key_append": f"""
        WITH stints AS (SELECT DISTINCT * FROM ({_STINTS.format(driver="driver_id", session="race_id")} FROM lineitem))
        SELECT *, (race_id % 2 = 0)::INT * (SELECT COUNT(*) FROM stints WHERE race_id % 2 = 1) + ROW_NUMBER() OVER (
            PARTITION BY race_id % 2
            ORDER BY race_id, driver_id, stint_number, lap_start, lap_end, compound,
                     tyre_age_at_start NULLS FIRST) - 1 AS stint_id
        FROM stints""",
    "day_key": f"""
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
               {_DAY_NUMBER.format(d="CAST(o_orderdate AS DATE)")} AS day_key
        FROM orders""",
    "align_contract": """
        SELECT o_orderkey AS order_id, o_orderstatus AS status, CAST(o_totalprice AS FLOAT) AS price,
               CAST(NULL AS SMALLINT) AS laps, date_trunc('second', o_orderdate) AS ordered
        FROM orders""",
    "contract_violations": """
        WITH pit AS (
            SELECT COUNT(*) AS n, COUNT(DISTINCT (l_suppkey, l_linenumber,
                       date_trunc('second', l_shipdate - INTERVAL 1 HOUR + to_milliseconds(l_quantity)))) AS k,
                   COUNT(*) FILTER (l_suppkey NOT BETWEEN 0 AND 255) AS driver,
                   COUNT(*) FILTER (l_linenumber NOT BETWEEN 0 AND 65535) AS race,
                   COUNT(*) FILTER (l_quantity NOT BETWEEN 0 AND 255) AS lap
            FROM lineitem),
        stint AS (
            SELECT COUNT(*) AS n,
                   COUNT(*) FILTER (l_returnflag = 'N') AS compound,
                   COUNT(*) FILTER (l_linestatus = 'O') AS age,
                   COUNT(*) FILTER (l_linenumber NOT BETWEEN 0 AND 255) AS stint,
                   COUNT(*) FILTER (l_quantity NOT BETWEEN 0 AND 65535) AS lap_start,
                   COUNT(*) FILTER (l_quantity + 10 NOT BETWEEN 0 AND 65535) AS lap_end,
                   COUNT(*) FILTER (l_orderkey NOT BETWEEN 0 AND 65535) AS race,
                   COUNT(*) FILTER (l_suppkey NOT BETWEEN 0 AND 255) AS driver
            FROM lineitem)
        SELECT 'PitStopsFT' AS table_name, u.* FROM pit, LATERAL (VALUES
            ('lap_number', 'null', 0), ('lap_number', 'range', lap), ('pit_duration', 'null', 0),
            ('date', 'null', 0), ('driver_id', 'null', 0), ('driver_id', 'range', driver),
            ('race_id', 'null', 0), ('race_id', 'range', race),
            ('driver_id, race_id, date', 'key', n - k)) AS u(field, rule, breaches)
        UNION ALL
        SELECT 'StintsDT', u.* FROM stint, LATERAL (VALUES
            ('stint_id', 'null', n), ('stint_id', 'range', 0), ('stint_number', 'null', 0),
            ('stint_number', 'range', stint), ('compound', 'null', compound),
            ('tyre_age_at_start', 'null', age), ('lap_start', 'null', 0),
            ('lap_start', 'range', lap_start), ('lap_end', 'null', 0), ('lap_end', 'range', lap_end),
            ('race_id', 'null', 0), ('race_id', 'range', race), ('driver_id', 'null', 0),
            ('driver_id', 'range', driver), ('stint_id', 'key', n - 1)) AS u(field, rule, breaches)""",
    "parquet_roundtrip": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "csv_roundtrip": "SELECT * FROM documents",
    "json_batches": "SELECT * FROM events",
    "warehouse_roundtrip": """
        SELECT o_orderkey AS order_id, o_orderstatus AS status, CAST(o_totalprice AS FLOAT) AS price,
               CAST(NULL AS SMALLINT) AS laps, date_trunc('second', o_orderdate) AS ordered
        FROM orders""",
    "warehouse_append": """
        SELECT o_orderkey AS order_id, o_orderstatus AS status, CAST(o_totalprice AS FLOAT) AS price,
               CAST(NULL AS SMALLINT) AS laps, date_trunc('second', o_orderdate) AS ordered
        FROM orders""",
    "warehouse_append_fact": """
        SELECT l_suppkey AS driver_id, CAST(l_linenumber AS BIGINT) AS race_id,
               CAST(MIN(l_quantity) AS BIGINT) AS lap_number, CAST(MIN(l_tax) AS FLOAT) AS pit_duration,
               l_shipdate - INTERVAL 1 HOUR AS date, TRUE AS repeat_refused
        FROM lineitem GROUP BY l_suppkey, l_linenumber, l_shipdate""",
    "warehouse_chain": f"""
        SELECT 'ResultsFactsFT' AS table_name, driver_id, race_id, date,
               CAST(final_position AS BIGINT) AS final_position, CAST(points_earned AS BIGINT) AS points_earned,
               CAST(COALESCE(weather_id, -1) AS BIGINT) AS weather_id, NULL::BIGINT AS lap_number,
               NULL::FLOAT AS pit_duration, NULL::TIMESTAMP AS moment, NULL::BIGINT AS n, NULL::BIGINT AS ids
        FROM ({_RESULTS})
        UNION ALL BY NAME
        SELECT 'PitStopsFT' AS table_name, l_suppkey AS driver_id, CAST(l_linenumber AS BIGINT) AS race_id,
               CAST(MIN(l_quantity) AS BIGINT) AS lap_number, CAST(MIN(l_tax) AS FLOAT) AS pit_duration,
               l_shipdate - INTERVAL 1 HOUR AS moment
        FROM lineitem GROUP BY l_suppkey, l_linenumber, l_shipdate
        UNION ALL BY NAME
        SELECT * FROM (
        SELECT 'DriversDT' AS table_name, COUNT(*) AS n, CAST(SUM(driver_id) AS BIGINT) AS ids FROM ({_DRIVERS})
        UNION ALL SELECT 'TeamsDT', COUNT(*), CAST(SUM(s_suppkey) AS BIGINT) FROM supplier
        UNION ALL SELECT 'RacesDT', COUNT(*), CAST(SUM(o_orderkey) AS BIGINT) FROM orders
        UNION ALL SELECT 'WeatherDT', COUNT(*), CAST(COUNT(*) * (COUNT(*) - 1) // 2 AS BIGINT)
        FROM (SELECT DISTINCT o_orderdate, {{m}} FROM orders)
        UNION ALL SELECT 'DailyWeatherDT', COUNT(*), CAST(SUM({_DAY_NUMBER.format(d="d")}) AS BIGINT)
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
        UNION ALL SELECT 'StintsDT', COUNT(*), CAST(COUNT(*) * (COUNT(*) - 1) // 2 AS BIGINT)
        FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber, l_quantity,
                     CASE WHEN l_returnflag <> 'N' THEN l_returnflag ELSE 'Unknown' END,
                     CASE WHEN l_linestatus <> 'O' THEN l_discount ELSE 0 END FROM lineitem))""".replace(
        "{m}", "o_totalprice, o_custkey, o_orderkey, o_orderstatus <> 'P'"
    ),
    "raw_ingest": """
        SELECT user_id AS driver_number, event_id AS session_key,
               CASE event_type WHEN 'click' THEN '+1 LAP' WHEN 'view' THEN NULL
                    ELSE CAST(value AS VARCHAR) END AS gap_to_leader,
               CAST(value AS VARCHAR) AS interval
        FROM events""",
    "ingest_incremental": """
        SELECT CASE WHEN event_id % 10 > 1 THEN user_id END AS driver_number, event_id AS session_key,
               CASE WHEN event_id % 10 <= 1 OR event_type = 'view' THEN NULL WHEN event_type = 'click' THEN '+1 LAP'
                    ELSE CAST(value AS VARCHAR) END AS gap_to_leader,
               CASE WHEN event_id % 10 > 1 THEN CAST(value AS VARCHAR) END AS interval,
               CASE event_id % 10 WHEN 0 THEN 'corrupt' WHEN 1 THEN 'no driver_number' END AS reason
        FROM events""",
    "drivers_export": f"""
        SELECT driver_id, full_name, acronym, country_code, COALESCE(team_id, -1) AS team_id
        FROM ({_DRIVERS})""",
    "results_export": f"""
        SELECT driver_id, race_id, date, final_position, points_earned,
               COALESCE(weather_id, -1) AS weather_id
        FROM ({_RESULTS})""",
    "stream_latest": _LATEST_EVENTS,
    "stream_upsert": _LATEST_EVENTS,
    "stream_window_mean": """
        SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, ROUND(AVG(value), 6) AS value
        FROM events GROUP BY 1""",
    "bucketed_lookup": """
        SELECT l_orderkey AS order_id, l_linenumber, l_quantity, o_custkey, o_orderstatus AS status
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "curve_layout": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem",
    "raw_variant": """
        SELECT event_id AS session_key,
               CASE WHEN event_id % 10 = 0 THEN 'absent' WHEN event_type = 'click' THEN 'text'
                    WHEN event_type = 'view' THEN 'null' ELSE 'number' END AS kind,
               CASE WHEN event_id % 10 <> 0 AND event_type NOT IN ('click', 'view') THEN value END AS number,
               CASE WHEN event_id % 10 <> 0 AND event_type = 'click' THEN '+1 LAP' END AS text
        FROM events""",
    "stream_late": """
        WITH landed AS (
            SELECT ts, value, date_trunc('day', ts)::TIMESTAMP AS window_start,
                   CASE WHEN event_id % 10 > 4 THEN 1 WHEN event_id % 10 > 0 THEN 2 ELSE 3 END AS landing FROM events),
        marks AS (SELECT landing + 1 AS landing, max(max(ts)) OVER (ORDER BY landing) AS newest FROM landed GROUP BY landing),
        told AS (
            SELECT l.*, coalesce(window_start + INTERVAL 1 DAY <= newest - INTERVAL 2 DAY, false) AS late
            FROM landed l LEFT JOIN marks USING (landing))
        SELECT window_start, ROUND(AVG(value), 6) AS value, ROUND(AVG(value) FILTER (NOT late), 6) AS in_time,
               count(*) FILTER (late) AS late_rows
        FROM told GROUP BY 1""",
    "daily_mean_incremental": f"""
        SELECT date, {_EXACT_MEANS}
        FROM (SELECT CAST(o_orderdate AS DATE) AS date, {_MEASURES} FROM orders) GROUP BY date""",
    "stream_dedupe": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "stream_ingest": "SELECT event_id, ts, user_id, event_type, value FROM events",
}
