"""The registered queries again, as plain DuckDB SQL by brute force.

The views restate ``fixtures.py``; the queries use all pairs and ranking where the
Spark side uses grids, intervals and segments.
"""

from __future__ import annotations

def geo(a: str, b: str, lat_b: str = "lat", lon_b: str = "lon") -> str:
    """Ellipsoidal distance between (a.lat, a.lon) and (b.lat_b, b.lon_b)."""
    flattening = 1 / 298.257223563
    e2 = repr(flattening * (2 - flattening)) + "::DOUBLE"
    mid = f"radians(({a}lat + {b}{lat_b}) / 2)"
    n = f"(6378137.0::DOUBLE / sqrt(1 - {e2} * power(sin({mid}), 2)))"
    north = (f"({n} * (1 - {e2}) / (1 - {e2} * power(sin({mid}), 2)) "
             f"* radians({b}{lat_b} - {a}lat))")
    east = f"({n} * cos({mid}) * radians({b}{lon_b} - {a}lon))"
    return f"sqrt(power({north}, 2) + power({east}, 2))"


def hav(a: str, b: str) -> str:
    return (f"(2 * 6371000.0::DOUBLE * asin(sqrt(power(sin(radians({b}stop_lat - {a}lat) / 2), 2)"
            f" + cos(radians({a}lat)) * cos(radians({b}stop_lat))"
            f" * power(sin(radians({b}stop_lon - {a}lon) / 2), 2))))")


def r(expression: str, digits: int = 3) -> str:
    return f"(round({expression}, {digits}) + 0.0)"


def ts(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


def clock(seconds: str) -> str:
    s = f"CAST({seconds} AS BIGINT) % 86400"
    return (f"(lpad(CAST(({s}) // 3600 AS VARCHAR), 2, '0') || ':' || "
            f"lpad(CAST((({s}) // 60) % 60 AS VARCHAR), 2, '0') || ':' || "
            f"lpad(CAST(({s}) % 60 AS VARCHAR), 2, '0'))")


_AT = "TIMESTAMP '1970-01-01 00:00:00' + to_seconds({})"

# Each view: (name, names it reads, SQL). Later views may read earlier ones.
_VIEWS: list[tuple[str, tuple[str, ...], str]] = [
    ("numbered", (), """
        SELECT event_id AS e, user_id AS u,
               row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS k
        FROM events"""),
    ("gps_raw", ("numbered",), """
        SELECT CAST(u AS VARCHAR) AS codBus,
               CASE WHEN u % 5 = 3 THEN '31.0' ELSE '11.0' END AS codLinea,
               CASE WHEN e % 89 = 0 THEN 'Ida' WHEN u % 2 = 0 THEN '1' ELSE '2' END AS sentido,
               CASE WHEN e % 97 <> 0 THEN CAST(round(CAST(36.70 AS DOUBLE)
                 + CAST(0.0030 AS DOUBLE) * (CAST((k * 30 + u * 150) % 1125 AS DOUBLE) / CAST(45.0 AS DOUBLE))
                 + ((e * 37) % 101 - 50) * CAST(0.000004 AS DOUBLE), 6) AS VARCHAR) END AS lat,
               CAST(round(CAST(-4.45 AS DOUBLE)
                 + CAST(0.0020 AS DOUBLE) * (CAST((k * 30 + u * 150) % 1125 AS DOUBLE) / CAST(45.0 AS DOUBLE))
                 + ((e * 53) % 101 - 50) * CAST(0.000004 AS DOUBLE), 6) AS VARCHAR) AS lon,
               CAST(100 + u % 25 AS VARCHAR) AS codParIni,
               strftime(CASE WHEN u % 5 = 4 THEN TIMESTAMP '2024-01-01 23:50:00'
                             ELSE TIMESTAMP '2024-01-01 06:00:00' END
                 + to_seconds(30 * (k - CASE WHEN e % 83 = 0 AND k > 0 THEN 1 ELSE 0 END)),
                 '%Y-%m-%d %H:%M:%S') AS last_update
        FROM numbered"""),
    ("all_pings", ("gps_raw",), """
        SELECT * FROM (
          SELECT codBus, regexp_replace(codLinea, '\\.0$', '') AS codLinea,
                 CASE WHEN sentido IN ('1', '1.0', 'Ida') THEN 0 ELSE 1 END AS direction_id,
                 TRY_CAST(lat AS DOUBLE) AS lat, TRY_CAST(lon AS DOUBLE) AS lon, codParIni,
                 last_update, try_strptime(last_update, '%Y-%m-%d %H:%M:%S') AS seen,
                 CAST(epoch(try_strptime(last_update, '%Y-%m-%d %H:%M:%S')) AS BIGINT) AS event_s
          FROM gps_raw WHERE codBus IS NOT NULL)
        WHERE lat IS NOT NULL AND lon IS NOT NULL AND seen IS NOT NULL"""),
    ("pings", ("all_pings",), "SELECT * FROM all_pings WHERE codLinea = '11'"),
    ("single", ("pings",), """
        SELECT * FROM pings QUALIFY row_number() OVER (
          PARTITION BY codBus, event_s ORDER BY lat, lon, direction_id) = 1"""),
    ("stops", (), """
        SELECT CAST(n_nationkey AS VARCHAR) AS stop_id,
               CAST(n_nationkey + 1000 AS VARCHAR) AS stop_code, n_name AS stop_name,
               CAST(36.70 AS DOUBLE) + CAST(0.0030 AS DOUBLE) * n_nationkey AS stop_lat,
               CAST(-4.45 AS DOUBLE) + CAST(0.0020 AS DOUBLE) * n_nationkey AS stop_lon
        FROM nation"""),
    ("trips", (), """
        SELECT CAST(o_orderkey AS VARCHAR) AS trip_id,
               CASE WHEN o_custkey % 5 = 3 THEN '31' ELSE '11' END AS route_id,
               'SVC_' || CAST(o_custkey % 4 AS VARCHAR) AS service_id,
               CAST(o_orderkey % 2 AS INTEGER) AS direction_id,
               'Terminal ' || CAST(o_orderkey % 2 AS VARCHAR) AS trip_headsign
        FROM orders"""),
    ("stop_times", (), f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(stop AS VARCHAR) AS stop_id,
               CAST(stop + 1 AS INTEGER) AS stop_sequence,
               lpad(CAST(s // 3600 AS VARCHAR), 2, '0') || ':' ||
               lpad(CAST((s // 60) % 60 AS VARCHAR), 2, '0') || ':' ||
               lpad(CAST(s % 60 AS VARCHAR), 2, '0') AS arrival_time
        FROM (SELECT l_orderkey, l_partkey % 25 AS stop,
                     min(18000 + (o_orderkey * 97) % 72000 + (l_partkey % 25) * 45
                         + l_suppkey % 10) AS s
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"""),
    ("calendar_dates", (), """
        SELECT DISTINCT 'SVC_' || CAST(o_custkey % 4 AS VARCHAR) AS service_id,
               '2024' || strftime(o_orderdate, '%m%d') AS "date",
               CASE WHEN (o_custkey % 4 + day(o_orderdate)) % 3 = 0 THEN 2 ELSE 1 END
                 AS exception_type
        FROM orders"""),
    ("full_schedule", ("trips", "stop_times", "stops"), """
        SELECT trip_id, route_id, service_id, stop_id, stop_sequence, arrival_time, direction_id,
               trip_headsign, stop_code, stop_name, stop_lat, stop_lon,
               CAST(split_part(arrival_time, ':', 1) AS INTEGER) * 3600
               + CAST(split_part(arrival_time, ':', 2) AS INTEGER) * 60
               + CAST(split_part(arrival_time, ':', 3) AS INTEGER) AS service_s
        FROM stop_times JOIN trips USING (trip_id) JOIN stops USING (stop_id)"""),
    ("schedule", ("full_schedule",), "SELECT * FROM full_schedule WHERE route_id = '11'"),
    ("valid", ("schedule",), "SELECT * FROM schedule WHERE service_s < 86400"),
    ("geometry", ("schedule",), """
        SELECT direction_id, stop_sequence, stop_id, stop_code, stop_name, stop_lat, stop_lon
        FROM schedule QUALIFY row_number() OVER (
          PARTITION BY direction_id, stop_sequence ORDER BY trip_id, stop_id) = 1"""),
    ("due", ("schedule",), """
        SELECT DISTINCT stop_id, direction_id,
               CASE WHEN service_s >= 86400 THEN 86400 + service_s % 86400 ELSE service_s END AS t
        FROM schedule"""),
    ("matched", ("pings", "valid"), f"""
        SELECT * FROM (
          SELECT p.codBus, p.seen, p.event_s, p.lat, p.lon, s.*, {hav('p.', 's.')} AS distance_m
          FROM pings p, (SELECT DISTINCT stop_id, stop_name, stop_lat, stop_lon, stop_sequence
                         FROM valid) s)
        QUALIFY row_number() OVER (PARTITION BY codBus, seen
          ORDER BY distance_m, stop_sequence, stop_id, lat, lon) = 1"""),
    ("first_arrivals", ("matched",), """
        SELECT codBus, stop_id, min(seen) AS actual_time FROM matched
        WHERE distance_m < 150 GROUP BY ALL"""),
    ("true_delays", ("first_arrivals", "valid"), f"""
        SELECT codBus, stop_id, actual_time, {_AT.format('day_s + service_s')} AS scheduled_time,
               a - day_s - service_s AS true_delay_seconds
        FROM (SELECT f.*, v.service_s, CAST(epoch(actual_time) AS BIGINT) AS a,
                     CAST(epoch(actual_time) AS BIGINT) // 86400 * 86400 AS day_s
              FROM first_arrivals f JOIN valid v USING (stop_id))
        QUALIFY row_number() OVER (PARTITION BY codBus, stop_id
          ORDER BY abs(a - day_s - service_s), service_s) = 1"""),
    ("labelled", ("matched", "true_delays"), """
        SELECT m.codBus, m.seen, m.lat, m.lon, d.stop_id, m.stop_sequence, m.distance_m,
               d.scheduled_time, d.actual_time,
               CAST(epoch(d.scheduled_time) AS BIGINT) - m.event_s AS seconds_to_scheduled,
               d.true_delay_seconds
        FROM matched m JOIN true_delays d ON m.codBus = d.codBus
          AND m.seen >= d.actual_time - INTERVAL 5 MINUTE AND m.seen < d.actual_time"""),
    ("near", ("single", "geometry"), f"""
        SELECT * FROM (
          SELECT p.*, g.stop_id, g.stop_name, g.stop_lat, g.stop_lon, g.stop_sequence,
                 {geo('p.', 'g.', 'stop_lat', 'stop_lon')} AS distance_m
          FROM single p JOIN geometry g USING (direction_id))
        QUALIFY row_number() OVER (PARTITION BY codBus, event_s
          ORDER BY distance_m, stop_sequence, stop_id) = 1"""),
    ("near_key", ("near",), """
        SELECT codBus, event_s, stop_id, direction_id, event_s % 86400 AS s FROM near"""),
    ("nearest_due", ("near_key", "due"), """
        SELECT codBus, event_s, min(abs(t - s) * 1000000 + t) % 1000000 AS t
        FROM near_key JOIN due USING (stop_id, direction_id)
        WHERE abs(t - s) < 7200 GROUP BY ALL"""),
    ("next_due", ("near_key", "due"), """
        SELECT codBus, event_s, t FROM near_key k ASOF JOIN due d
          ON k.stop_id = d.stop_id AND k.direction_id = d.direction_id AND k.s <= d.t"""),
    ("enriched", ("near", "nearest_due"), f"""
        SELECT near.*, event_s // 86400 * 86400 + t AS scheduled_epoch_s,
               coalesce({clock('t')}, 'N/A') AS scheduled_time,
               CAST(hour(seen) AS INTEGER) AS hour, CAST(minute(seen) AS INTEGER) AS minute,
               CAST(dayofweek(seen) - 1 AS INTEGER) AS weekday,
               CAST(hour(seen) * 60 + minute(seen) AS INTEGER) AS time_of_day
        FROM near LEFT JOIN nearest_due USING (codBus, event_s)"""),
    ("stepped", ("enriched",), f"""
        SELECT *, CASE WHEN moved > 5 THEN moved / (event_s - p_s) END AS step
        FROM (SELECT *, {geo('p_', '')} AS moved
              FROM (SELECT *, lag(event_s) OVER w AS p_s, lag(lat) OVER w AS p_lat,
                           lag(lon) OVER w AS p_lon, lag(stop_sequence) OVER w AS p_seq
                    FROM enriched WINDOW w AS (PARTITION BY codBus ORDER BY event_s)))"""),
    ("tracked", ("stepped",), """
        SELECT *, eta - wait AS delay FROM (
          SELECT *, coalesce(CAST(scheduled_epoch_s - event_s AS DOUBLE), eta) AS wait FROM (
            SELECT *, distance_m / greatest(speed, 1.0) AS eta FROM (
              SELECT *, coalesce(last_value(step IGNORE NULLS) OVER (
                       PARTITION BY codBus ORDER BY event_s
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                       CAST(5.5 AS DOUBLE)) AS speed,
                     CASE WHEN stop_sequence > p_seq AND p_seq >= 0 THEN p_seq END AS passed
              FROM stepped)))"""),
    ("fresh_starts", ("enriched",), f"""
        SELECT *, sum(fresh) OVER (PARTITION BY codBus ORDER BY event_s) AS run,
               CASE WHEN fresh = 0 AND moved > 5 THEN moved / (event_s - p_s) END AS step
        FROM (SELECT *, {geo('p_', '')} AS moved,
                     CASE WHEN p_s IS NULL OR event_s - p_s >= 60 THEN 1 ELSE 0 END AS fresh
              FROM (SELECT *, lag(event_s) OVER w AS p_s, lag(lat) OVER w AS p_lat,
                           lag(lon) OVER w AS p_lon, lag(stop_sequence) OVER w AS p_seq
                    FROM enriched WINDOW w AS (PARTITION BY codBus ORDER BY event_s)))"""),
    ("expired", ("fresh_starts",), """
        SELECT codBus, event_s, speed, passed,
               eta - coalesce(CAST(scheduled_epoch_s - event_s AS DOUBLE), eta) AS delay FROM (
          SELECT *, distance_m / greatest(speed, 1.0) AS eta FROM (
            SELECT *, coalesce(last_value(step IGNORE NULLS) OVER (
                     PARTITION BY codBus, run ORDER BY event_s
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                     CAST(5.5 AS DOUBLE)) AS speed,
                   CASE WHEN fresh = 0 AND stop_sequence > p_seq AND p_seq >= 0 THEN p_seq END
                     AS passed
            FROM fresh_starts))"""),
    ("projected", ("tracked", "geometry"), f"""
        SELECT t.*, g.stop_id AS passed_stop_id,
               event_s - {geo('t.', 'g.', 'stop_lat', 'stop_lon')} / greatest(speed, 1.0)
                 AS arrival_s
        FROM tracked t LEFT JOIN geometry g
          ON t.direction_id = g.direction_id AND t.passed = g.stop_sequence"""),
    ("actual", ("projected", "due"), """
        SELECT p.*, coalesce(arrival_s - CAST(floor(arrival_s / 86400) * 86400 AS DOUBLE) - t,
                             0.0) AS actual_delay
        FROM projected p LEFT JOIN (
          SELECT codBus, event_s, t FROM projected j JOIN due d
            ON j.passed_stop_id = d.stop_id AND j.direction_id = d.direction_id
          WHERE abs(t - (arrival_s - floor(arrival_s / 86400) * 86400)) < 7200
          QUALIFY row_number() OVER (PARTITION BY codBus, event_s
            ORDER BY abs(t - (arrival_s - floor(arrival_s / 86400) * 86400)), t) = 1)
        USING (codBus, event_s)"""),
    ("scored", ("actual",), """
        WITH arrivals AS (
          SELECT codBus, event_s, actual_delay,
                 lag(event_s) OVER (PARTITION BY codBus ORDER BY event_s) AS since
          FROM actual WHERE passed IS NOT NULL),
        errors AS (
          SELECT a.codBus, a.event_s, avg(abs(p.delay - a.actual_delay)) AS error
          FROM arrivals a JOIN actual p ON p.codBus = a.codBus AND p.event_s < a.event_s
            AND a.event_s - p.event_s < 600 AND p.event_s >= coalesce(a.since, 0)
          GROUP BY ALL)
        SELECT actual.*, CASE WHEN passed_stop_id IS NOT NULL THEN error END AS error
        FROM actual LEFT JOIN errors USING (codBus, event_s)"""),
    ("newest", ("pings",), """
        SELECT * FROM pings QUALIFY row_number() OVER (
          PARTITION BY codBus ORDER BY event_s DESC, lat DESC, lon DESC) = 1"""),
    ("route", ("schedule",), """
        SELECT DISTINCT direction_id, stop_sequence, stop_id, stop_name, stop_lat, stop_lon
        FROM schedule"""),
    ("route_ends", ("route",), """
        SELECT *, lag(stop_id) OVER w AS b_id, lag(stop_name) OVER w AS b_name,
               lag(stop_sequence) OVER w AS b_seq,
               lead(stop_id) OVER w AS a_id, lead(stop_name) OVER w AS a_name,
               lead(stop_lat) OVER w AS a_lat, lead(stop_lon) OVER w AS a_lon
        FROM route WINDOW w AS (PARTITION BY direction_id ORDER BY stop_sequence, stop_id)"""),
]


def _position(source: str) -> str:
    """Current and next stop of the pings of a view; sequences are unique per direction."""
    near = f"""
        SELECT * FROM (
          SELECT p.*, e.stop_sequence AS seq, e.stop_id, e.stop_name, e.stop_lat, e.stop_lon,
                 b_id, b_name, b_seq, a_id, a_name, a_lat, a_lon,
                 {geo('p.', 'e.', 'stop_lat', 'stop_lon')} AS d
          FROM {source} p JOIN route_ends e USING (direction_id))
        QUALIFY row_number() OVER (PARTITION BY codBus, event_s, lat, lon
          ORDER BY d, seq, stop_id) = 1"""
    return f"""
        SELECT codBus, seen, event_s, lat, lon, direction_id,
               CASE WHEN d <= 150 OR b_id IS NULL THEN stop_id ELSE b_id END AS current_stop_id,
               CASE WHEN d <= 150 OR b_id IS NULL THEN stop_name ELSE b_name END
                 AS current_stop_name,
               CASE WHEN d <= 150 OR b_id IS NULL THEN seq ELSE b_seq END AS stop_sequence,
               CASE WHEN d <= 150 OR b_id IS NULL THEN a_id ELSE stop_id END AS next_stop_id,
               CASE WHEN d <= 150 OR b_id IS NULL THEN a_name ELSE stop_name END
                 AS next_stop_name,
               CASE WHEN d <= 150 OR b_id IS NOT NULL OR a_id IS NULL THEN d
                    ELSE {geo('n.', 'n.', 'a_lat', 'a_lon')} END AS distance_m
        FROM ({near}) n"""


_VIEWS += [
    ("placed", ("pings", "route_ends"), _position("pings")),
    ("newest_placed", ("newest", "route_ends"), _position("newest")),
    ("status", ("newest_placed", "valid"), f"""
        SELECT * EXCLUDE (n), {_AT.format('n')} AS next_scheduled_time FROM (
          SELECT p.*, n FROM newest_placed p LEFT JOIN (
            SELECT j.codBus, min(event_s // 86400 * 86400 + service_s
                     + CASE WHEN service_s < event_s % 86400 THEN 86400 ELSE 0 END) AS n
            FROM newest_placed j JOIN valid v
              ON j.next_stop_id = v.stop_id AND j.direction_id = v.direction_id
            GROUP BY ALL) USING (codBus))"""),
    ("newest_parts", ("pings",), """
        SELECT * FROM pings QUALIFY row_number() OVER (
          PARTITION BY codBus, last_update < '2024-01-01 06:20:00'
          ORDER BY event_s DESC, lat DESC, lon DESC) = 1"""),
    ("parts_placed", ("newest_parts", "route_ends"), _position("newest_parts")),
    ("parts_status", ("parts_placed", "valid"), f"""
        SELECT * EXCLUDE (n), {_AT.format('n')} AS next_scheduled_time FROM (
          SELECT p.*, n FROM parts_placed p LEFT JOIN (
            SELECT j.codBus, j.event_s, min(event_s // 86400 * 86400 + service_s
                     + CASE WHEN service_s < event_s % 86400 THEN 86400 ELSE 0 END) AS n
            FROM parts_placed j JOIN valid v
              ON j.next_stop_id = v.stop_id AND j.direction_id = v.direction_id
            GROUP BY ALL) USING (codBus, event_s))"""),
    ("final_state", ("scored",), """
        SELECT * FROM scored QUALIFY row_number() OVER (
          PARTITION BY codBus ORDER BY event_s DESC) = 1"""),
]

_NEEDS = {name: needs for name, needs, _ in _VIEWS}

# Over all lines the views are the same, with route and direction as one number.
_WAY = "CAST({} AS INTEGER) * 10 + direction_id"
_ALL_LINES = {
    "pings": f"SELECT * REPLACE ({_WAY.format('codLinea')} AS direction_id) FROM all_pings",
    "schedule": f"SELECT * REPLACE ({_WAY.format('route_id')} AS direction_id) FROM full_schedule",
}


def _all_lines(sql: str) -> str:
    """A query of one line, over all lines; its direction_id is split again in the result."""
    for name, view in _ALL_LINES.items():
        own = next(text for n, _, text in _VIEWS if n == name)
        sql = sql.replace(f"{name} AS MATERIALIZED ({own})", f"{name} AS MATERIALIZED ({view})")
    return (f"SELECT * REPLACE (CAST(direction_id % 10 AS INTEGER) AS direction_id), "
            f"CAST(direction_id // 10 AS VARCHAR) AS route_id FROM ({sql})")


def _with(final: str, *needs: str) -> str:
    """Prefix a query with the views it needs, in order."""
    wanted, todo = set(), list(needs)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo.extend(_NEEDS[name])
    parts = [f"{name} AS MATERIALIZED ({sql})" for name, _, sql in _VIEWS if name in wanted]
    return f"WITH {', '.join(parts)} {final}" if parts else final


_CLEAN = f"""SELECT codBus, codLinea, direction_id, lat, lon, codParIni, last_update,
    {ts('seen')} AS "timestamp", event_s FROM pings"""
_CLEAN_JSON = f"""SELECT codBus, codLinea, direction_id, lat, lon, last_update,
    {ts('seen')} AS "timestamp", event_s FROM pings"""
_TRAINING = f"""SELECT {ts('seen')} AS "timestamp", lat, lon, stop_id, stop_sequence,
    {r('distance_m')} AS distance_m, {ts('scheduled_time')} AS scheduled_time,
    {ts('actual_time')} AS actual_time, seconds_to_scheduled, true_delay_seconds"""
_OUTPUT = f"""SELECT codBus AS bus_id, lat, lon, stop_name AS next_stop_name,
    {r('stop_lat', 6)} AS next_stop_lat, {r('stop_lon', 6)} AS next_stop_lon,
    {r('wait')} AS seconds_to_scheduled, scheduled_time, {r('delay')} AS predicted_delay_math,
    CASE WHEN passed IS NOT NULL THEN 1 ELSE 0 END AS is_arrival_event,
    {r('CASE WHEN passed_stop_id IS NOT NULL THEN actual_delay ELSE 0.0 END')} AS actual_delay,
    {r('coalesce(error, -1.0)')} AS final_math_error, direction_id, last_update, stop_sequence,
    {r('distance_m')} AS distance_m, hour, minute, weekday, time_of_day FROM scored"""
_STATUS = """CASE WHEN delay < -60 THEN 'Early' WHEN delay <= 60 THEN 'On Time'
    WHEN delay <= 300 THEN 'Delayed' ELSE 'Very Late' END"""
_BOARD = f"""SELECT codBus AS bus_id, lat, lon, stop_name AS next_stop,
    scheduled_time AS sched_time, {r('delay')} AS delay_math, {r('delay')} AS delay_ml,
    {r('delay')} AS delay_display, {r('stop_lat', 6)} AS next_lat, {r('stop_lon', 6)} AS next_lon,
    'Terminal ' || CAST(direction_id AS VARCHAR) ||
      CASE WHEN direction_id = 0 THEN ' (Outbound)' ELSE ' (Inbound)' END AS direction_formatted,
    'heuristic' AS prediction_method, {_STATUS} AS status, last_update FROM final_state"""
_MAE = f"""SELECT 'heuristic' AS predictor, count(*) AS samples, {r('avg(error)')} AS mae
    FROM scored WHERE error IS NOT NULL HAVING count(*) > 0"""
_LIVE = f"""SELECT codBus, {ts('seen')} AS "timestamp", lat, lon, direction_id, current_stop_id,
    current_stop_name, stop_sequence, next_stop_id, next_stop_name, {r('distance_m')} AS distance_m,
    {ts('next_scheduled_time')} AS next_scheduled_time FROM status"""
_KEY = f"""{ts('seen')} || '|' || stop_id || '|' || {ts('actual_time')} || '|' ||
    CAST(CAST(round(lat * 1000000) AS BIGINT) AS VARCHAR)"""


def oracle_sql() -> dict[str, str]:
    next_due = f"""SELECT codBus, event_s, stop_id, direction_id,
        CAST(coalesce(t - event_s % 86400, 0) AS DOUBLE) AS seconds_to_scheduled,
        coalesce({clock('t')}, 'N/A') AS scheduled_arrival
        FROM near LEFT JOIN next_due USING (codBus, event_s)"""
    motion = "SELECT codBus, event_s, {} FROM {}"
    clean = _with(_CLEAN, "pings")
    replay = _with(_OUTPUT, "scored")
    board = _with(_BOARD, "final_state")
    mae = _with(_MAE, "scored")
    geometry = f"""SELECT direction_id, stop_sequence, stop_id, stop_code,
            stop_name, {r('stop_lat', 6)} AS stop_lat, {r('stop_lon', 6)} AS stop_lon
            FROM geometry"""
    return {
        "schedule_stopless": _with("""SELECT trip_id, route_id, direction_id, stop_id, stop_sequence,
            CASE WHEN CAST(stop_id AS INTEGER) % 2 = 0 THEN stop_name END AS stop_name
            FROM full_schedule""", "full_schedule"),
        "trip_patterns": _with("""SELECT *, row_number() OVER (
              PARTITION BY route_id, direction_id ORDER BY n_trips DESC, pattern) = 1 AS canonical
            FROM (
              SELECT route_id, direction_id, pattern, count(*) AS n_trips,
                     min(n_stops) AS n_stops, min(trip_id) AS first_trip
              FROM (SELECT route_id, direction_id, trip_id, CAST(count(*) AS INTEGER) AS n_stops,
                           md5(string_agg(CAST(stop_sequence AS VARCHAR) || ':' || stop_id, ','
                               ORDER BY stop_sequence, stop_id)) AS pattern
                    FROM full_schedule GROUP BY ALL)
              GROUP BY ALL)""", "full_schedule"),
        "route_geometry_all": _all_lines(_with(geometry, "geometry")),
        "live_status_all": _all_lines(_with(_LIVE, "status")),
        "vehicle_replay_all": _all_lines(replay),
        "stream_vehicles_all": _all_lines(replay),
        "clean_pings": clean,
        "dedup_pings": _with("SELECT codBus, event_s, lat, lon, direction_id FROM single",
                             "single"),
        "ping_history": clean,
        "stream_ping_csv": clean,
        "stream_ping_json": _with(_CLEAN_JSON, "pings"),
        "stream_dedup": _with(f"""SELECT DISTINCT codBus, {ts('seen')} AS "timestamp" FROM pings""",
                              "pings"),
        "timetable_scan": _with("""SELECT trip_id, route_id, service_id, direction_id,
            trip_headsign, stop_id, stop_sequence, arrival_time
            FROM stop_times JOIN trips USING (trip_id)""", "stop_times", "trips"),
        "active_services": _with("""SELECT DISTINCT service_id FROM calendar_dates
            WHERE "date" = '20240101' AND exception_type = 1""", "calendar_dates"),
        "active_trips": _with("""SELECT * FROM trips WHERE service_id IN (
            SELECT service_id FROM calendar_dates
            WHERE "date" = '20240101' AND exception_type = 1)""", "trips", "calendar_dates"),
        "active_trips_fallback": _with("SELECT * FROM trips", "trips"),
        "line_trips": _with("SELECT * FROM trips WHERE route_id = '11'", "trips"),
        "schedule_master": _with(f"""SELECT trip_id, stop_id, stop_sequence, arrival_time,
            direction_id, trip_headsign, stop_code, stop_name, {r('stop_lat', 6)} AS stop_lat,
            {r('stop_lon', 6)} AS stop_lon FROM schedule""", "schedule"),
        "schedule_distinct": _with("""SELECT stop_id, direction_id, arrival_time,
            min(stop_sequence) AS stop_sequence FROM schedule GROUP BY ALL""", "schedule"),
        "schedule_valid": _with("""SELECT trip_id, stop_id, stop_sequence, arrival_time
            FROM valid""", "valid"),
        "schedule_times": _with("""SELECT stop_id, direction_id, arrival_time,
            count(*) AS n_trips FROM schedule GROUP BY ALL""", "schedule"),
        "schedule_arrays": _with("""SELECT stop_id, direction_id,
            string_agg(arrival_time || 'x' || CAST(n AS VARCHAR), ' ' ORDER BY arrival_time)
              AS times
            FROM (SELECT stop_id, direction_id, arrival_time, count(*) AS n
                  FROM schedule GROUP BY ALL) GROUP BY ALL""", "schedule"),
        "service_seconds": _with("SELECT DISTINCT arrival_time, service_s FROM full_schedule",
                                 "full_schedule"),
        "route_geometry": _with(f"""SELECT direction_id, stop_sequence, stop_id, stop_code,
            stop_name, {r('stop_lat', 6)} AS stop_lat, {r('stop_lon', 6)} AS stop_lon
            FROM geometry ORDER BY direction_id, stop_sequence""", "geometry"),
        "route_stops": _with(f"""SELECT direction_id, stop_id, stop_name,
            {r('stop_lat', 6)} AS stop_lat, {r('stop_lon', 6)} AS stop_lon, stop_sequence
            FROM route""", "route"),
        "headsigns": _with("""SELECT direction_id, min(trip_headsign) AS trip_headsign FROM trips
            WHERE route_id = '11' GROUP BY ALL""", "trips"),
        "line_stop_names": _with("""SELECT DISTINCT direction_id, stop_name FROM schedule
            ORDER BY direction_id, stop_name""", "schedule"),
        "stop_timetable": _with("""SELECT direction_id, any_value(trip_headsign) AS trip_headsign,
            count(*) AS n_trips,
            string_agg(DISTINCT arrival_time, ' ' ORDER BY arrival_time) AS times
            FROM schedule WHERE contains(lower(stop_name), 'nation_2') GROUP BY direction_id""",
                                "schedule"),
        "stop_neighbours": _with("""SELECT direction_id, stop_sequence,
            lag(stop_id) OVER w AS previous_stop_id, lead(stop_id) OVER w AS after_stop_id
            FROM route WINDOW w AS (PARTITION BY direction_id ORDER BY stop_sequence)""",
                                 "route"),
        "haversine": _with(f"""SELECT codBus, event_s, p.lat, p.lon, stop_id,
            {r(hav('p.', 's.'))} AS distance_m
            FROM pings p JOIN stops s ON s.stop_id = CAST(CAST(codParIni AS INTEGER) - 100 AS VARCHAR)
            """, "pings", "stops"),
        "geodistance": _with(f"""SELECT codBus, event_s, p.lat, p.lon, stop_id,
            {r(geo('p.', 's.', 'stop_lat', 'stop_lon'))} AS distance_m
            FROM pings p JOIN stops s ON s.stop_id = CAST(CAST(codParIni AS INTEGER) - 100 AS VARCHAR)
            """, "pings", "stops"),
        "nearest_stop": _with(f"""SELECT codBus, {ts('seen')} AS "timestamp", lat, lon, stop_id,
            stop_name, stop_sequence, {r('distance_m')} AS distance_m FROM matched""", "matched"),
        "nearest_stop_dir": _with(f"""SELECT codBus, event_s, direction_id, stop_id,
            stop_sequence, {r('distance_m')} AS distance_m FROM (
              SELECT p.*, g.stop_id, g.stop_sequence, {hav('p.', 'g.')} AS distance_m
              FROM single p JOIN geometry g USING (direction_id))
            QUALIFY row_number() OVER (PARTITION BY codBus, event_s
              ORDER BY distance_m, stop_sequence, stop_id) = 1""", "single", "geometry"),
        "nearest_stop_grid": _with(f"""SELECT codBus, codLinea, event_s, lat, lon, stop_id,
            {r('distance_m')} AS distance_m FROM (
              SELECT p.*, s.stop_id, {hav('p.', 's.')} AS distance_m FROM all_pings p, stops s)
            QUALIFY row_number() OVER (PARTITION BY codBus, codLinea, event_s, lat, lon
              ORDER BY distance_m, stop_id) = 1""", "all_pings", "stops"),
        "nearest_stop_far": _with(f"""SELECT codBus, event_s, lat, lon, stop_id,
            {r('distance_m')} AS distance_m FROM (
              SELECT f.*, s.stop_id, s.stop_sequence, {hav('f.', 's.')} AS distance_m
              FROM (SELECT DISTINCT codBus, event_s,
                      CASE WHEN event_s % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE lat - 60 END AS lat,
                      CASE WHEN event_s % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE lon + 120 END AS lon
                    FROM pings) f,
                (SELECT DISTINCT stop_id, stop_sequence, stop_lat, stop_lon FROM route) s)
            QUALIFY row_number() OVER (PARTITION BY codBus, event_s, lat, lon
              ORDER BY distance_m, stop_sequence, stop_id) = 1""", "pings", "route"),
        "route_position": _with(f"""SELECT codBus, event_s, lat, lon, direction_id,
            current_stop_id, current_stop_name, stop_sequence, next_stop_id, next_stop_name,
            {r('distance_m')} AS distance_m FROM placed""", "placed"),
        "asof_nearest": _with("""SELECT codBus, event_s, stop_id, direction_id, scheduled_epoch_s,
            scheduled_time FROM enriched""", "enriched"),
        "asof_next": _with(next_due, "near", "next_due"),
        "true_delay": _with(f"""SELECT codBus, stop_id, {ts('scheduled_time')} AS scheduled_time,
            {ts('actual_time')} AS actual_time, true_delay_seconds FROM true_delays""",
                            "true_delays"),
        "live_status": _with(_LIVE, "status"),
        "seconds_to_scheduled": _with("""SELECT codBus,
            CAST(epoch(next_scheduled_time) AS BIGINT) - event_s AS seconds_to_scheduled
            FROM status""", "status"),
        "sink_roundtrip": _with(_LIVE, "status"),
        "speed_instant": _with(motion.format(f"{r('speed')} AS speed_mps", "tracked"), "tracked"),
        "speed_ewma": _with(f"""SELECT codBus, event_s, {r('''list_reduce([CAST(5.5 AS DOUBLE)] || coalesce(list(used) FILTER (WHERE used IS NOT NULL)
              OVER (PARTITION BY codBus ORDER BY event_s), []), lambda s, v: 0.8 * s + 0.2 * v)''')}
            AS speed_mps FROM (SELECT *, CASE WHEN moved / (event_s - p_s) > 0.1
              AND moved / (event_s - p_s) < 25 THEN moved / (event_s - p_s) END AS used
              FROM stepped)""", "stepped"),
        "heuristic_delay": _with(motion.format(
            f"""{r('wait')} AS seconds_to_scheduled, {r('delay')} AS predicted_delay_math,
            scheduled_epoch_s IS NOT NULL AS has_schedule""", "tracked"), "tracked"),
        "delay_status": _with(f"""SELECT {_STATUS} AS status,
            CASE WHEN delay < -60 THEN 'Early' WHEN delay > 60 THEN 'Late' ELSE 'On Time' END
              AS status_3way, count(*) AS pings FROM tracked GROUP BY ALL""", "tracked"),
        "display_delay": _with(motion.format(
            f"""{r('CASE WHEN stop_sequence % 2 = 0 THEN delay / 2 ELSE delay END')}
                AS delay_machine_learning, {r('delay')} AS delay_heuristic""", "tracked"),
            "tracked"),
        "arrivals_radius": _with(f"""SELECT codBus, stop_id, {ts('actual_time')} AS actual_time
            FROM first_arrivals""", "first_arrivals"),
        "arrivals_visit": _with(f"""SELECT codBus, stop_id, {ts('seen')} AS actual_time FROM (
            SELECT *, event_s - lag(event_s) OVER (PARTITION BY codBus, stop_id ORDER BY event_s)
              AS gap FROM matched WHERE distance_m < 150) WHERE gap IS NULL OR gap > 600""",
                                "matched"),
        "arrivals_seq": _with("""SELECT codBus, event_s, passed AS passed_sequence, stop_sequence
            FROM tracked WHERE passed IS NOT NULL""", "tracked"),
        "arrival_backproject": _with(f"""SELECT codBus, event_s, passed_stop_id,
            {r('arrival_s')} AS arrival_s FROM projected WHERE passed IS NOT NULL""",
                                     "projected"),
        "actual_delay": _with(f"""SELECT codBus, event_s, passed_stop_id,
            {r('actual_delay')} AS actual_delay FROM actual WHERE passed IS NOT NULL""", "actual"),
        "label_window": _with(f"""SELECT codBus, {ts('seen')} AS "timestamp", stop_id,
            stop_sequence, {ts('actual_time')} AS actual_time, true_delay_seconds
            FROM labelled""", "labelled"),
        "training_set": _with(_TRAINING + " FROM labelled", "labelled"),
        "train_clean": _with(f"""SELECT {ts('seen')} AS "timestamp", lat, lon, stop_id,
            stop_sequence, {r('distance_m')} AS distance_m,
            CAST(hour(seen) AS INTEGER) AS hour, CAST(minute(seen) AS INTEGER) AS minute,
            CAST(dayofweek(seen) - 1 AS INTEGER) AS weekday,
            CAST(hour(seen) * 60 + minute(seen) AS INTEGER) AS time_of_day,
            CAST(seconds_to_scheduled AS DOUBLE) AS seconds_to_scheduled,
            CAST(true_delay_seconds AS DOUBLE) AS true_delay_seconds
            FROM labelled WHERE distance_m < 500 AND abs(true_delay_seconds) < 900""",
                             "labelled"),
        "calendar_features": _with("""SELECT codBus, event_s, CAST(hour(seen) AS INTEGER) AS hour,
            CAST(minute(seen) AS INTEGER) AS minute, CAST(dayofweek(seen) - 1 AS INTEGER) AS weekday,
            CAST(hour(seen) * 60 + minute(seen) AS INTEGER) AS time_of_day FROM pings""", "pings"),
        "split_counts": _with(f"""SELECT substr(md5({_KEY}), 1, 8) < 'cccccccc' AS is_train,
            count(*) AS n_rows, CAST(sum(true_delay_seconds) AS BIGINT) AS sum_delay
            FROM labelled GROUP BY ALL""", "labelled"),
        "stream_microbatch": _with(_LIVE.replace("FROM status", "FROM parts_status"),
                                   "parts_status"),
        "score_batch_keys": _with(f"""SELECT codBus, {ts('seen')} AS "timestamp", stop_sequence,
            CAST(epoch(next_scheduled_time) - event_s AS DOUBLE) AS seconds_to_scheduled,
            true AS in_range FROM status WHERE next_scheduled_time IS NOT NULL""", "status"),
        "feature_importance_sum": """SELECT 9::BIGINT AS n_features, 1.0::DOUBLE AS total,
            true AS all_shares""",
        "model_metrics_bounds": _with(f"""SELECT count(*) AS n_rows,
            CAST(sum(abs(true_delay_seconds)) AS DOUBLE) AS sum_abs_delay,
            {r('avg(abs(true_delay_seconds - mean))')} AS mean_label_mae, true AS beats_mean
            FROM labelled, (SELECT avg(true_delay_seconds) AS mean FROM labelled
              WHERE distance_m < 500 AND abs(true_delay_seconds) < 900
                AND substr(md5({_KEY}), 1, 8) < 'cccccccc')
            WHERE distance_m < 500 AND abs(true_delay_seconds) < 900
              AND substr(md5({_KEY}), 1, 8) >= 'cccccccc'""", "labelled"),
        "stream_score_keys": _with(f"""SELECT codBus, {ts('seen')} AS "timestamp",
            min(stop_sequence) AS stop_sequence, true AS in_range FROM enriched
            GROUP BY ALL""", "enriched"),
        "metric_mae_rmse": _with(f"""SELECT {r('avg(abs(actual_delay - delay))')} AS mae,
            {r('sqrt(avg(power(actual_delay - delay, 2)))')} AS rmse
            FROM actual WHERE passed IS NOT NULL""", "actual"),
        "metric_mape": _with(f"""SELECT
            {r('avg(abs(actual_delay - delay) / (abs(actual_delay) + 1)) * 100')} AS mape
            FROM actual WHERE passed IS NOT NULL""", "actual"),
        "arrival_mae": _with(f"""SELECT codBus, event_s, {r('error')} AS final_math_error
            FROM scored WHERE error IS NOT NULL""", "scored"),
        "mae_summary": mae,
        "stream_mae": mae,
        "latest_ping": _with("""SELECT codBus, event_s, lat, lon, direction_id FROM newest""",
                             "newest"),
        "vehicle_replay": replay,
        "stream_vehicle_state": replay,
        "stream_late": _with("""SELECT codBus, event_s, 'accepted' AS state FROM pings
            WHERE last_update >= '2024-01-01 06:20:00' GROUP BY codBus, event_s
            UNION ALL SELECT codBus, event_s, 'late' FROM pings
            WHERE last_update < '2024-01-01 06:20:00'""", "pings"),
        "stream_timeout": _with(f"""SELECT codBus, event_s, {r('speed')} AS speed_mps,
            {r('delay')} AS predicted_delay_math, passed AS passed_sequence FROM expired""",
                                "expired"),
        "stream_enrich": _with(next_due, "near", "next_due"),
        "board": board,
        "stream_board": board,
    }
