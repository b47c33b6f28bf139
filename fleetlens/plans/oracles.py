"""The registered queries in SQL for DuckDB, over the same star-schema tables."""

from __future__ import annotations

import math

from fleetlens.contracts import OCCUPANCY
from fleetlens.functions.grid import EDGE_0, STEP
from fleetlens.functions.scalars import EARTH_M, ROUTE_MODES
from fleetlens.operators.spatial import DRIVEN
from fleetlens.plans import hexagon_oracles
from fleetlens.plans.adapters import SOUTH, TYPES, WEST
from fleetlens.plans.registry import DIGITS, NUDGE, QUERY_GAP_S, QUERY_MOVE_M
from fleetlens.plans.stores import DAY


def _distance(a: str, b: str, c: str, d: str) -> str:
    half = (
        f"(pow(sin((radians({c}) - radians({a})) / 2), 2.0) "
        f"+ cos(radians({a})) * cos(radians({c})) * pow(sin((radians({d}) - radians({b})) / 2), 2.0))"
    )
    return f"(2.0 * {EARTH_M}::DOUBLE * asin(sqrt(CASE WHEN {half} > 1 THEN 1.0::DOUBLE ELSE {half} END)))"


def _cell(lat: str, lon: str, resolution: int) -> str:
    size = EDGE_0 / STEP**resolution
    q = f"({lon} * {math.sqrt(3) / 3 / size!r}::DOUBLE - {lat} * {1 / 3 / size!r}::DOUBLE)"
    r = f"({lat} * {2 / 3 / size!r}::DOUBLE)"
    s = f"(-{q} - {r})"
    rq, rr, rs = (f"floor({x} + 0.5::DOUBLE)" for x in (q, r, s))
    dq, dr, ds = f"abs({rq} - {q})", f"abs({rr} - {r})", f"abs({rs} - {s})"
    most_q = f"{dq} > {dr} AND {dq} > {ds}"
    cq = f"CASE WHEN {most_q} THEN -{rr} - {rs} ELSE {rq} END"
    cr = f"CASE WHEN {most_q} THEN {rr} WHEN {dr} > {ds} THEN -{rq} - {rs} ELSE {rr} END"
    return f"CASE WHEN {lat} IS NOT NULL AND {lon} IS NOT NULL THEN '{resolution}:' || ({cq})::BIGINT || ':' || ({cr})::BIGINT END"


def _centre(cell: str) -> tuple[str, str]:
    part = lambda n: f"split_part({cell}, ':', {n})::DOUBLE"
    size = f"({EDGE_0!r}::DOUBLE / pow({STEP!r}::DOUBLE, {part(1)}))"
    return f"({size} * 1.5::DOUBLE * {part(3)})", f"({size} * {math.sqrt(3)!r}::DOUBLE * ({part(2)} + {part(3)} / 2))"


# Half the height and width of a cell of resolution 8.
TALL = f"{EDGE_0 / STEP**8!r}::DOUBLE"
WIDE = f"{EDGE_0 / STEP**8 * math.cos(math.pi / 6)!r}::DOUBLE"
MODES = "CASE route_type " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in ROUTE_MODES.items()) + " END"
LOCAL = "timezone('Pacific/Auckland', timezone('UTC', {}))"
LATE = "coalesce(arrival_delay, departure_delay)"

VIEWS = f"""
WITH vp AS (
  SELECT event_id::VARCHAR AS record_id, user_id::VARCHAR AS vehicle_id, date_trunc('second', ts) AS ts,
    CASE WHEN event_id % 97 <> 0 THEN -36.85::DOUBLE + (props->>'$.k')::INT / 1000.0::DOUBLE END AS latitude,
    174.76::DOUBLE + (event_id % 100) / 1000.0::DOUBLE AS longitude, value AS speed, (props->>'$.k')::INT * 3.6::DOUBLE AS bearing,
    event_type AS occupancy_status,
    CASE WHEN event_type <> 'error' THEN 'R' || (user_id % 10) END AS route_id,
    CASE WHEN event_type <> 'error' THEN 'U' || user_id END AS trip_id
  FROM events
), feeds AS (
  SELECT r_regionkey AS k, r_name AS feed_hash, 0 AS older FROM region
  UNION ALL SELECT r_regionkey, r_name || '_OLD', 1 FROM region WHERE r_regionkey = 0
), feed_rows AS (
  SELECT feed_hash, 'publisher ' || k AS feed_publisher_name, 'v' || k AS feed_version, DATE '2024-01-01' + (k * 5)::INT AS feed_start_date_declared,
    DATE '2024-12-31' AS feed_end_date_declared, TIMESTAMP '2024-01-01' + to_hours(k::INT) - to_minutes((older * 30)::INT) AS ingested_at_utc
  FROM feeds
), feed_kept AS (
  SELECT * FROM feed_rows QUALIFY row_number() OVER (PARTITION BY feed_start_date_declared ORDER BY ingested_at_utc DESC, feed_hash) = 1
), dim_feed AS (
  SELECT *, feed_start_date_declared AS effective_from_date,
    (lead(feed_start_date_declared) OVER (ORDER BY feed_start_date_declared) - 1)::DATE AS effective_to_date,
    lead(feed_start_date_declared) OVER (ORDER BY feed_start_date_declared) IS NULL AS is_current
  FROM feed_kept
), route_rows AS (
  SELECT DISTINCT 'R' || n_nationkey AS route_id, 'A1' AS agency_id, substr(n_name, 1, 3) AS route_short_name, n_name AS route_long_name,
    {list(TYPES)}[(n_nationkey % {len(TYPES)} + 1)::INT]::BIGINT AS route_type, r_name AS feed_hash
  FROM nation JOIN region ON n_regionkey = r_regionkey OR r_regionkey = 0
), dim_route AS (
  SELECT feed_hash, route_id, agency_id, route_short_name, route_long_name, route_type, ingested_at_utc, {MODES} AS route_mode
  FROM route_rows JOIN dim_feed USING (feed_hash)
  QUALIFY row_number() OVER (PARTITION BY route_id ORDER BY ingested_at_utc DESC, feed_hash DESC) = 1
), trip_rows AS (
  SELECT 'U' || c_custkey AS trip_id, 'R' || (c_custkey % 10) AS route_id, 'S' || (c_custkey % 4) AS service_id,
    (c_custkey % 2)::BIGINT AS direction_id, 'H' || (c_custkey % 7) AS shape_id, 'AFRICA' AS feed_hash
  FROM customer
), lines AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity,
      l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) AS nth,
    TIMESTAMP '2024-01-01' + to_days((l_linenumber * 4)::INT) AS planned
  FROM lineitem
), schedule AS (
  SELECT 20240101::BIGINT AS service_date, DATE '2024-01-01' AS service_date_dt, 'AFRICA' AS feed_hash, 'R' || (l_orderkey % 10) AS route_id,
    (l_orderkey % 2)::BIGINT AS direction_id, 'U' || l_orderkey AS trip_id, 'N' || (l_orderkey % 10) AS route_short_name,
    'to ' || (l_orderkey % 5) AS trip_headsign, 'H' || (l_orderkey % 7) AS shape_id, l_partkey::VARCHAR AS stop_id, 'Stop ' || l_partkey AS stop_name,
    l_linenumber::BIGINT AS stop_sequence, CASE WHEN l_orderkey % 13 <> 0 THEN planned END AS scheduled_arrival, planned + INTERVAL 30 SECOND AS scheduled_departure,
    l_linenumber * 500.0::DOUBLE AS shape_dist_traveled
  FROM lines WHERE nth = 1
), stop_of AS (
  SELECT *, first_value(l_partkey) OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY nth) AS stop, ((l_quantity - 25) * 12)::BIGINT AS late FROM lines
), updates AS (
  SELECT 'U' || l_orderkey AS trip_id, '20240101' AS start_date, stop::VARCHAR AS stop_id, l_linenumber::BIGINT AS stop_sequence,
    l_suppkey::VARCHAR AS vehicle_id, l_orderkey || '-' || l_linenumber || '-' || nth AS record_id, l_orderkey || '-' || l_linenumber AS entity_id,
    CASE WHEN l_returnflag = 'A' THEN 'SCHEDULED' WHEN l_suppkey % 5 = 0 THEN 'CANCELED' ELSE 'NO_DATA' END AS schedule_relationship,
    planned + to_seconds(nth * 60) AS rt_timestamp, planned + to_seconds(late) AS actual_arrival,
    CASE WHEN l_tax > 0.01::DOUBLE THEN planned + to_seconds(late + 40) END AS actual_departure, late AS arrival_delay,
    CASE WHEN l_tax > 0.01::DOUBLE THEN late + 10 END AS departure_delay,
    (CASE WHEN l_linestatus = 'O' THEN 0 WHEN l_tax > 0.04::DOUBLE THEN 30 END)::BIGINT AS arrival_uncertainty,
    (CASE WHEN l_tax <= 0.01::DOUBLE THEN NULL WHEN l_linestatus = 'O' THEN 0 WHEN l_tax > 0.04::DOUBLE THEN 30 END)::BIGINT AS departure_uncertainty
  FROM stop_of WHERE l_returnflag <> 'N'
), alerts AS (
  SELECT o_orderkey::VARCHAR AS alert_id, TIMESTAMP '2024-01-01' + to_seconds(o_orderkey * 1800 % 2592000) AS period_start,
    CASE WHEN o_orderstatus <> 'O' THEN TIMESTAMP '2024-01-01' + to_seconds(o_orderkey * 1800 % 2592000 + 7200) END AS period_end
  FROM orders
), shape_edges AS (
  SELECT 'H' || (p_partkey % 7) AS shape_id, 'E' || (p_partkey % 50) AS edge_id, min(p_brand) AS road_name, sum(p_size::DOUBLE) AS overlap_m
  FROM part GROUP BY 1, 2
), bridge AS (
  SELECT trip_id, route_id, edge_id, road_name, overlap_m FROM trip_rows JOIN shape_edges USING (shape_id)
), plan AS (
  SELECT *, coalesce(scheduled_arrival, scheduled_departure) AS event_ts_utc,
    hour({LOCAL.format("coalesce(scheduled_arrival, scheduled_departure)")})::BIGINT AS hour_of_day,
    (dayofweek(service_date_dt) + 1)::BIGINT AS day_of_week
  FROM schedule
), flagged AS (
  SELECT * EXCLUDE (arrival_delay, departure_delay), arrival_delay AS arrival_delay_s, departure_delay AS departure_delay_s,
    coalesce(actual_arrival IS NOT NULL AND actual_arrival <= rt_timestamp AND coalesce(arrival_uncertainty, 1) = 0, false) AS arrival_is_observed,
    coalesce(actual_arrival IS NOT NULL AND (actual_arrival > rt_timestamp OR coalesce(arrival_uncertainty, 0) > 0), false) AS arrival_is_predicted,
    coalesce(actual_departure IS NOT NULL AND actual_departure <= rt_timestamp AND coalesce(departure_uncertainty, 1) = 0, false) AS departure_is_observed,
    coalesce(actual_departure IS NOT NULL AND (actual_departure > rt_timestamp OR coalesce(departure_uncertainty, 0) > 0), false) AS departure_is_predicted,
    coalesce(actual_arrival, actual_departure, rt_timestamp) AS event_ts_utc, {LATE} AS early_late_s
  FROM updates WHERE trip_id IS NOT NULL AND stop_id IS NOT NULL
), trip_update AS (
  SELECT *, CASE WHEN actual_arrival IS NOT NULL THEN arrival_is_observed WHEN actual_departure IS NOT NULL THEN departure_is_observed ELSE false END AS is_observed,
    CASE WHEN actual_arrival IS NOT NULL THEN arrival_is_predicted WHEN actual_departure IS NOT NULL THEN departure_is_predicted ELSE false END AS is_predicted,
    hour(event_ts_utc)::BIGINT AS hour_of_day, (dayofweek(event_ts_utc) + 1)::BIGINT AS day_of_week,
    coalesce(early_late_s BETWEEN -60 AND 300, false) AS otp_flag
  FROM flagged
), last_known AS (
  SELECT trip_id, start_date, stop_id, stop_sequence, max(rt_timestamp) AS rt_timestamp,
    arg_max(vehicle_id, rt_timestamp) AS vehicle_id, arg_max(entity_id, rt_timestamp) AS entity_id, arg_max(record_id, rt_timestamp) AS record_id,
    arg_max(actual_arrival, rt_timestamp) AS actual_arrival, arg_max(actual_departure, rt_timestamp) AS actual_departure,
    arg_max(arrival_delay_s, rt_timestamp) AS arrival_delay_s, arg_max(arrival_uncertainty, rt_timestamp) AS arrival_uncertainty,
    arg_max(departure_delay_s, rt_timestamp) AS departure_delay_s, arg_max(departure_uncertainty, rt_timestamp) AS departure_uncertainty,
    arg_max(schedule_relationship, rt_timestamp) AS schedule_relationship,
    arg_max(arrival_is_observed, rt_timestamp) AS arrival_is_observed, arg_max(arrival_is_predicted, rt_timestamp) AS arrival_is_predicted,
    arg_max(departure_is_observed, rt_timestamp) AS departure_is_observed, arg_max(departure_is_predicted, rt_timestamp) AS departure_is_predicted
  FROM trip_update GROUP BY ALL
), rt AS (
  SELECT *, coalesce(actual_arrival, actual_departure, rt_timestamp) AS rt_event_ts_utc,
    hour(coalesce(actual_arrival, actual_departure, rt_timestamp))::BIGINT AS rt_hour_of_day,
    (dayofweek(coalesce(actual_arrival, actual_departure, rt_timestamp)) + 1)::BIGINT AS rt_day_of_week,
    coalesce(arrival_delay_s, departure_delay_s) AS early_late_s,
    coalesce(coalesce(arrival_delay_s, departure_delay_s) BETWEEN -60 AND 300, false) AS otp_flag,
    coalesce(arrival_is_observed, departure_is_observed, false) AS is_observed, coalesce(arrival_is_predicted, departure_is_predicted, false) AS is_predicted
  FROM last_known
), trip_event AS (
  SELECT p.* RENAME (event_ts_utc AS scheduled_event_ts_utc, hour_of_day AS scheduled_hour_of_day, day_of_week AS scheduled_day_of_week),
    rt.* EXCLUDE (trip_id, start_date, stop_id, stop_sequence)
  FROM plan p LEFT JOIN rt ON p.trip_id = rt.trip_id AND p.service_date::VARCHAR = rt.start_date AND p.stop_id = rt.stop_id AND p.stop_sequence = rt.stop_sequence
), trip_mode AS (
  SELECT * EXCLUDE (n) FROM (SELECT service_date, trip_id, feed_hash, route_id, direction_id, vehicle_id, count(*) AS n FROM trip_event GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY service_date, trip_id, feed_hash, route_id, direction_id ORDER BY n DESC, vehicle_id ASC NULLS LAST) = 1
), trip_sums AS (
  SELECT service_date_dt, service_date, feed_hash, route_id, direction_id, trip_id, min(route_short_name) AS route_short_name,
    min(trip_headsign) AS trip_headsign, min(shape_id) AS shape_id, arg_min(stop_id, stop_sequence) AS first_stop_id, arg_min(stop_name, stop_sequence) AS first_stop_name,
    arg_max(stop_id, stop_sequence) AS last_stop_id, arg_max(stop_name, stop_sequence) AS last_stop_name, min(scheduled_departure) AS planned_first_departure,
    max(scheduled_arrival) AS planned_last_arrival, min(actual_departure) AS actual_first_departure, max(actual_arrival) AS actual_last_arrival,
    sum(CASE WHEN scheduled_arrival IS NOT NULL AND scheduled_departure IS NOT NULL THEN greatest(date_sub('second', scheduled_arrival, scheduled_departure), 0) END)::BIGINT AS planned_dwell_s,
    sum(CASE WHEN actual_arrival IS NOT NULL AND actual_departure IS NOT NULL THEN greatest(date_sub('second', actual_arrival, actual_departure), 0) ELSE 0 END)::BIGINT AS actual_dwell_s,
    count(*)::BIGINT AS planned_stop_count, count(*) FILTER (actual_arrival IS NOT NULL OR actual_departure IS NOT NULL)::BIGINT AS rt_stop_count,
    count(*) FILTER (is_observed)::BIGINT AS observed_stop_count, count(*) FILTER (is_predicted)::BIGINT AS predicted_stop_count,
    avg(early_late_s) AS avg_early_late_s, quantile_disc(early_late_s, 0.5)::BIGINT AS p50_early_late_s,
    avg(CASE WHEN otp_flag THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS otp_stop_ratio, arg_max_null(otp_flag, stop_sequence) AS trip_otp_flag,
    min(rt_event_ts_utc) AS first_rt_event_ts_utc, max(rt_event_ts_utc) AS last_rt_event_ts_utc,
    bool_or(schedule_relationship IN ('CANCELED', '3')) AS is_canceled, bool_or(schedule_relationship = 'NO_DATA') AS is_no_data,
    bool_or(is_observed) AS any_observed, bool_or(is_predicted) AS any_predicted
  FROM trip_event GROUP BY ALL
), trip AS (
  SELECT t.*, date_sub('second', planned_first_departure, planned_last_arrival) AS planned_runtime_s,
    date_sub('second', actual_first_departure, actual_last_arrival) AS actual_runtime_s,
    date_sub('second', planned_first_departure, planned_last_arrival) - planned_dwell_s AS planned_travel_s,
    date_sub('second', actual_first_departure, actual_last_arrival) - actual_dwell_s AS actual_travel_s,
    rt_stop_count / planned_stop_count AS rt_coverage_ratio, m.vehicle_id
  FROM trip_sums t JOIN trip_mode m USING (service_date, trip_id, feed_hash, route_id, direction_id)
), dwell AS (
  SELECT service_date, feed_hash, route_id, direction_id, trip_id, stop_id, stop_sequence,
    CASE WHEN scheduled_arrival IS NOT NULL AND scheduled_departure IS NOT NULL THEN greatest(date_sub('second', scheduled_arrival, scheduled_departure), 0) END AS planned_dwell_s,
    date_sub('second', actual_arrival, actual_departure) AS rt_dwell_s,
    coalesce(date_sub('second', actual_arrival, actual_departure),
      CASE WHEN scheduled_arrival IS NOT NULL AND scheduled_departure IS NOT NULL THEN greatest(date_sub('second', scheduled_arrival, scheduled_departure), 0) END) AS dwell_s,
    arrival_is_observed AND departure_is_observed AS dwell_is_observed,
    (arrival_is_predicted OR departure_is_predicted) AND NOT (arrival_is_observed AND departure_is_observed) AS dwell_is_predicted
  FROM trip_event
), legs AS (
  SELECT *, lead(stop_id) OVER w AS to_stop_id, lead(stop_name) OVER w AS to_stop_name, lead(stop_sequence) OVER w AS to_stop_sequence, lead(scheduled_arrival) OVER w AS to_scheduled_arrival,
    lead(actual_arrival) OVER w AS to_actual_arrival, lead(shape_dist_traveled) OVER w AS to_dist, lead(arrival_is_observed) OVER w AS to_observed
  FROM trip_event WINDOW w AS (PARTITION BY trip_id, service_date ORDER BY stop_sequence)
), leg AS (
  SELECT DISTINCT service_date, feed_hash, route_id, direction_id, trip_id, stop_id AS from_stop_id, stop_name AS from_stop_name, to_stop_id, to_stop_name,
    stop_sequence AS from_stop_sequence, to_stop_sequence, scheduled_departure AS from_scheduled_departure, to_scheduled_arrival, actual_departure AS from_actual_departure, to_actual_arrival,
    date_sub('second', scheduled_departure, to_scheduled_arrival) AS planned_travel_s, date_sub('second', actual_departure, to_actual_arrival) AS rt_travel_s,
    coalesce(date_sub('second', actual_departure, to_actual_arrival), date_sub('second', scheduled_departure, to_scheduled_arrival)) AS travel_s,
    CASE WHEN to_dist - shape_dist_traveled IS NOT NULL THEN greatest(to_dist - shape_dist_traveled, 0) END AS segment_length_m,
    coalesce(actual_departure, scheduled_departure) AS from_time, coalesce(to_actual_arrival, to_scheduled_arrival) AS to_time,
    departure_is_observed AND to_observed AS travel_is_observed
  FROM legs WHERE to_stop_id IS NOT NULL
), leg_met AS (
  SELECT l.trip_id, l.service_date, l.from_stop_sequence, l.to_stop_sequence, l.from_time, l.to_time, v.speed, v.occupancy_status
  FROM leg l JOIN vp v ON l.trip_id = v.trip_id AND v.ts BETWEEN l.from_time AND l.to_time
), leg_speed AS (
  SELECT trip_id, service_date, from_stop_sequence, to_stop_sequence, from_time, to_time, avg(speed) AS vp_avg_speed_kmh, count(*)::BIGINT AS vp_count FROM leg_met GROUP BY ALL
), leg_mode AS (
  SELECT * EXCLUDE (n) FROM (SELECT trip_id, service_date, from_stop_sequence, to_stop_sequence, from_time, to_time, occupancy_status, count(*) AS n FROM leg_met GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY trip_id, service_date, from_stop_sequence, to_stop_sequence, from_time, to_time ORDER BY n DESC, occupancy_status ASC NULLS LAST) = 1
), segment AS (
  SELECT l.*, segment_length_m * 3.6::DOUBLE / nullif(planned_travel_s, 0) AS planned_speed_kmh, segment_length_m * 3.6::DOUBLE / nullif(rt_travel_s, 0) AS rt_speed_kmh,
    segment_length_m * 3.6::DOUBLE / nullif(travel_s, 0) AS speed_kmh, s.vp_avg_speed_kmh, coalesce(s.vp_count, 0) AS vp_count, o.occupancy_status AS vp_occupancy_status
  FROM leg l
  LEFT JOIN leg_speed s ON l.trip_id = s.trip_id AND l.service_date = s.service_date AND l.from_stop_sequence = s.from_stop_sequence AND l.to_stop_sequence = s.to_stop_sequence AND l.from_time = s.from_time AND l.to_time = s.to_time
  LEFT JOIN leg_mode o ON l.trip_id = o.trip_id AND l.service_date = o.service_date AND l.from_stop_sequence = o.from_stop_sequence AND l.to_stop_sequence = o.to_stop_sequence AND l.from_time = o.from_time AND l.to_time = o.to_time
), pings AS (
  SELECT vp.*, r.route_type, r.route_mode AS own_mode, t.direction_id, lag(ts) OVER w AS prev_ts, lag(latitude) OVER w AS prev_lat, lag(longitude) OVER w AS prev_lon,
    {LOCAL.format("ts")} AS datetime_local, ({LOCAL.format("ts")} - INTERVAL 4 HOUR)::DATE AS service_date
  FROM vp LEFT JOIN dim_route r USING (route_id) LEFT JOIN trip_rows t USING (trip_id)
  WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts, record_id)
), measured AS (
  SELECT *, date_sub('second', prev_ts, ts) AS update_interval_seconds, {_distance("latitude", "longitude", "prev_lat", "prev_lon")} AS position_delta_m,
    max(own_mode) OVER (PARTITION BY vehicle_id, service_date) AS route_mode
  FROM pings
), vehicle AS (
  SELECT ts AS timestamp_utc, record_id, vehicle_id, trip_id, route_id, direction_id, speed AS speed_kmh, bearing AS bearing_deg, occupancy_status, latitude, longitude,
    update_interval_seconds, position_delta_m, prev_ts AS prev_timestamp_utc, prev_lat AS prev_latitude, CASE WHEN prev_lat IS NOT NULL THEN prev_lon END AS prev_longitude,
    datetime_local, service_date, hour(datetime_local)::BIGINT AS hour_local, dayname(datetime_local) AS dow_local, route_mode, route_type,
    update_interval_seconds > {QUERY_GAP_S} AND position_delta_m > {QUERY_MOVE_M}::DOUBLE AS is_unmonitored_movement
  FROM measured
), vehicle_day AS (
  SELECT service_date, vehicle_id, route_mode, count(*)::BIGINT AS position_count, sum(update_interval_seconds)::BIGINT AS unmonitored_duration_seconds,
    sum(position_delta_m) AS unmonitored_distance_m
  FROM vehicle WHERE is_unmonitored_movement GROUP BY ALL
), grid_day AS (
  SELECT service_date, {_cell("latitude", "longitude", 10)} AS cell, route_mode, count(*)::BIGINT AS position_count,
    sum(update_interval_seconds)::BIGINT AS unmonitored_duration_seconds, sum(position_delta_m) AS unmonitored_distance_m
  FROM vehicle WHERE is_unmonitored_movement AND latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL
), route_hour AS (
  SELECT route_id, direction_id, route_mode, service_date, hour(timestamp_utc)::BIGINT AS hour_utc, dayname(service_date) AS day_of_week,
    avg(speed_kmh) AS avg_speed_kmh, count(vehicle_id)::BIGINT AS position_count
  FROM vehicle WHERE trip_id IS NOT NULL AND route_id IS NOT NULL AND direction_id IS NOT NULL GROUP BY ALL
), grid_hour AS (
  SELECT {_cell("latitude", "longitude", 8)} AS cell, route_mode, service_date, hour(timestamp_utc)::BIGINT AS hour_utc, dayname(service_date) AS day_of_week,
    avg(speed_kmh) AS avg_speed_kmh, count(vehicle_id)::BIGINT AS position_count
  FROM vehicle WHERE route_mode = 'bus' AND latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL
), detail AS (
  SELECT vehicle_id, route_id, route_mode, service_date, prev_timestamp_utc AS start_timestamp_utc, timestamp_utc AS end_timestamp_utc, prev_latitude AS start_latitude,
    prev_longitude AS start_longitude, latitude AS end_latitude, longitude AS end_longitude, update_interval_seconds AS gap_seconds, position_delta_m AS distance_m
  FROM vehicle WHERE is_unmonitored_movement AND prev_latitude IS NOT NULL
), v2_position AS (
  SELECT ts AS timestamp_utc, record_id, datetime_local, service_date, hour(datetime_local)::BIGINT AS hour_local, dayname(datetime_local) AS dow_local,
    vehicle_id, trip_id, route_id, speed, latitude, longitude, {_cell("latitude", "longitude", 10)} AS cell,
    last_value(own_mode IGNORE NULLS) OVER (PARTITION BY vehicle_id, service_date ORDER BY ts, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS route_mode
  FROM pings
), v2_next AS (
  SELECT *, lead(timestamp_utc) OVER w AS end_ts, lead(latitude) OVER w AS end_lat, lead(longitude) OVER w AS end_lon, lead(cell) OVER w AS end_cell
  FROM v2_position WINDOW w AS (PARTITION BY vehicle_id ORDER BY timestamp_utc, record_id)
), v2_measured AS (
  SELECT *, date_sub('second', timestamp_utc, end_ts) AS delta_seconds, {_distance("latitude", "longitude", "end_lat", "end_lon")} AS distance_m FROM v2_next WHERE end_ts IS NOT NULL
), v2_segment AS (
  SELECT vehicle_id || '_' || strftime(timestamp_utc, '%Y%m%d%H%M%S') AS segment_id, vehicle_id, trip_id, route_id, route_mode, service_date, hour_local, dow_local,
    cell AS start_cell, end_cell, timestamp_utc AS start_timestamp_utc, end_ts AS end_timestamp_utc, delta_seconds, distance_m,
    CASE WHEN delta_seconds > 0 THEN distance_m / delta_seconds * 3.6::DOUBLE END AS speed_kmh, delta_seconds > {QUERY_GAP_S} AS is_gap,
    delta_seconds > {QUERY_GAP_S} AND coalesce(distance_m > {QUERY_MOVE_M}::DOUBLE, false) AS is_unmonitored_movement, delta_seconds <= 0 AS flag_nonpositive_gap,
    coalesce(CASE WHEN delta_seconds > 0 THEN distance_m / delta_seconds * 3.6::DOUBLE END > 1.0::DOUBLE, false) AS flag_implausible_speed
  FROM v2_measured
), v2_vehicle_cell AS (
  SELECT service_date, hour_local, {_cell(*_centre("cell"), 8)} AS parent, route_mode, p.route_id, direction_id, vehicle_id, avg(speed) AS x
  FROM v2_position p LEFT JOIN trip_rows t USING (trip_id) WHERE cell IS NOT NULL GROUP BY ALL
), v2_grid_hour AS (
  SELECT service_date, hour_local, parent AS cell, route_mode, count(*)::BIGINT AS vehicle_cnt, avg(x) AS avg_speed_kmh, quantile_disc(x, 0.5) AS p50_speed_kmh,
    quantile_disc(x, 0.85) AS p85_speed_kmh, quantile_disc(x, 0.95) AS p95_speed_kmh, max(x) AS max_speed_kmh
  FROM v2_vehicle_cell GROUP BY ALL
), v2_vehicle_route AS (
  SELECT service_date, hour_local, p.route_id, direction_id, route_mode, vehicle_id, avg(speed) AS x
  FROM v2_position p LEFT JOIN trip_rows t USING (trip_id) WHERE p.route_id IS NOT NULL GROUP BY ALL
), v2_route_hour AS (
  SELECT service_date, hour_local, route_id, direction_id, route_mode, count(*)::BIGINT AS vehicle_cnt, avg(x) AS avg_speed_kmh, quantile_disc(x, 0.5) AS p50_speed_kmh,
    quantile_disc(x, 0.85) AS p85_speed_kmh, quantile_disc(x, 0.95) AS p95_speed_kmh, max(x) AS max_speed_kmh
  FROM v2_vehicle_route GROUP BY ALL
), services AS (
  SELECT DISTINCT 'AFRICA' AS feed_hash, 'S' || c_custkey % 4 AS service_id FROM customer WHERE c_custkey % 4 IN (0, 2)
  UNION ALL SELECT 'AFRICA', 'P' || s_suppkey FROM supplier
  WHERE (s_suppkey % 3 <> 0 AND s_suppkey % 4 <> 3 OR s_suppkey % 5 = 2) AND s_suppkey % 5 <> 1
), kpis AS (
  SELECT rt_timestamp::DATE AS day, count(*) FILTER (abs({LATE}) <= 300) / nullif(count({LATE}), 0) AS on_time_share, count(DISTINCT trip_id)::BIGINT AS trips,
    count(DISTINCT trip_id) FILTER (schedule_relationship IN ('CANCELED', '3'))::BIGINT AS canceled_trips, avg({LATE}) AS avg_delay_seconds,
    count(*) FILTER (schedule_relationship IN ('CANCELED', '3'))::BIGINT AS canceled_updates, max(rt_timestamp) AS last_update
  FROM updates GROUP BY 1
), day_vehicles AS (
  SELECT ts::DATE AS day, count(DISTINCT vehicle_id)::BIGINT AS active_vehicles FROM vp GROUP BY 1
), daily AS (
  SELECT day, on_time_share, trips, canceled_trips, canceled_trips / trips AS canceled_share, avg_delay_seconds, canceled_updates / trips AS cancellation_rate, coalesce(active_vehicles, 0) AS active_vehicles, last_update
  FROM kpis LEFT JOIN day_vehicles USING (day)
), hours AS (
  SELECT TIMESTAMP '2024-01-05' + to_hours(h::INT) AS hour_ts FROM range(24) AS r(h)
), edge_counts AS (
  SELECT trip_id, count(DISTINCT edge_id) AS n FROM bridge GROUP BY 1
), cells AS (
  SELECT DISTINCT {_cell("latitude", "longitude", 8)} AS cell FROM vp WHERE latitude IS NOT NULL AND longitude IS NOT NULL
), roads AS (
  SELECT *, {_distance("lat", "west", "lat", "west + 0.0001::DOUBLE + (p_size % 7) * 0.0005::DOUBLE")} AS length_m,
    (p_partkey % 4) * 0.00003::DOUBLE * radians(1.0) * {EARTH_M}::DOUBLE <= 6 AS near
  FROM (SELECT *, {SOUTH}::DOUBLE + (p_partkey % 25) * 0.0003::DOUBLE + (p_partkey % 4) * 0.00003::DOUBLE AS lat,
    {WEST}::DOUBLE + 0.0001::DOUBLE + (p_partkey % 40) * 0.001::DOUBLE AS west FROM part)
)
"""


def _mean(keys: str, x: str = "avg_speed_kmh", frame: str = "ROWS BETWEEN 27 PRECEDING AND CURRENT ROW", fn: str = "avg") -> str:
    return f"{fn}({x}) OVER (PARTITION BY {keys} ORDER BY service_date {frame})"


DAYS = "RANGE BETWEEN INTERVAL 27 DAYS PRECEDING AND CURRENT ROW"


def _compared(table: str, keys: str, mean: str, change: str, frame: str = "ROWS BETWEEN 27 PRECEDING AND CURRENT ROW") -> str:
    over = _mean(keys, frame=frame)
    return f"SELECT *, {over} AS {mean}, (avg_speed_kmh - {over}) / nullif({over}, 0) AS {change} FROM {table}"


def _unmonitored(keys: str, where: str = "true", more: str = "") -> str:
    return f"""SELECT {keys}, count(*)::BIGINT AS seg_cnt, count(*) FILTER (is_gap)::BIGINT AS gap_seg_cnt, count(*) FILTER (is_gap) / count(*) AS gap_seg_ratio,
      sum(CASE WHEN is_gap THEN delta_seconds ELSE 0 END)::BIGINT AS gap_seconds_total, avg(CASE WHEN is_gap THEN delta_seconds END) AS gap_seconds_avg,
      count(*) FILTER (is_unmonitored_movement)::BIGINT AS unmonitored_cnt, sum(CASE WHEN is_unmonitored_movement THEN distance_m ELSE 0 END) AS unmonitored_total_m,
      avg(CASE WHEN is_unmonitored_movement THEN distance_m END) AS unmonitored_avg_m, max(CASE WHEN is_unmonitored_movement THEN distance_m END) AS unmonitored_max_m,
      {more} count(DISTINCT route_id)::BIGINT AS route_cnt FROM v2_segment WHERE {where} GROUP BY ALL"""


SELECTS: dict[str, tuple[str, str]] = {  # name: (SQL, columns of doubles)
    "dim_feed": ("SELECT * FROM dim_feed", ""),
    "dim_route": ("SELECT * FROM dim_route", ""),
    "active_services": ("SELECT * FROM services", ""),
    "daily_schedule": (
        """SELECT 20240102::BIGINT AS service_date, DATE '2024-01-02' AS service_date_dt, 'AFRICA' AS feed_hash, t.service_id, t.route_id, r.route_short_name, r.route_type,
          t.direction_id, t.trip_id, l_partkey::VARCHAR AS stop_id, p_size::VARCHAR AS stop_code, p_name AS stop_name, l_linenumber::BIGINT AS stop_sequence,
          CASE WHEN l_orderkey % 13 <> 0 THEN c END AS scheduled_arrival_time, c AS scheduled_departure_time,
          CASE WHEN l_orderkey % 13 <> 0 THEN u END AS scheduled_arrival, u AS scheduled_departure,
          CASE WHEN l_orderkey % 13 <> 0 THEN epoch(u)::BIGINT END AS scheduled_arrival_s, epoch(u)::BIGINT AS scheduled_departure_s
        FROM (SELECT *, format('{:02d}:{:02d}:00', 20 + l_linenumber, l_orderkey % 60) AS c,
          TIMESTAMP '2024-01-02' + to_hours((20 + l_linenumber)::INT) + to_minutes((l_orderkey % 60)::INT) - INTERVAL 13 HOUR AS u FROM lines WHERE nth = 1) l
        JOIN trip_rows t ON t.trip_id = 'U' || l_orderkey JOIN services s ON t.service_id = s.service_id
        LEFT JOIN route_rows r ON r.route_id = t.route_id AND r.feed_hash = 'AFRICA' LEFT JOIN part ON p_partkey = l_partkey""",
        "",
    ),
    "fct_trip_plan": ("SELECT * FROM plan", "shape_dist_traveled"),
    "fct_trip_update": ("SELECT * FROM trip_update", ""),
    "fct_trip_event": ("SELECT * FROM trip_event", "shape_dist_traveled"),
    "fct_trip": ("SELECT * FROM trip", "avg_early_late_s otp_stop_ratio rt_coverage_ratio"),
    "fct_trip_dwell": ("SELECT * FROM dwell", ""),
    "fct_trip_segment": ("SELECT * FROM segment", "segment_length_m planned_speed_kmh rt_speed_kmh speed_kmh vp_avg_speed_kmh"),
    "fct_vehicle_position": ("SELECT * FROM vehicle", "speed_kmh bearing_deg latitude longitude position_delta_m prev_latitude prev_longitude"),
    "agg_position_vehicle_day": ("SELECT * FROM vehicle_day", "unmonitored_distance_m"),
    "agg_position_grid_day": ("SELECT * FROM grid_day", "unmonitored_distance_m"),
    "agg_speed_route_hour": ("SELECT * FROM route_hour", "avg_speed_kmh"),
    "agg_speed_grid_hour": ("SELECT * FROM grid_hour", "avg_speed_kmh"),
    "mdl_unmonitored_vehicle_daily": (
        f"SELECT *, {_mean('vehicle_id, route_mode', 'unmonitored_distance_m')} AS rolling_28_day_avg_distance_m FROM vehicle_day",
        "unmonitored_distance_m rolling_28_day_avg_distance_m",
    ),
    "mdl_unmonitored_grid_daily": (
        f"SELECT *, {_mean('cell, route_mode', 'unmonitored_distance_m')} AS rolling_28_day_avg_distance_m FROM grid_day",
        "unmonitored_distance_m rolling_28_day_avg_distance_m",
    ),
    "mdl_unmonitored_detail": ("SELECT * FROM detail", "start_latitude start_longitude end_latitude end_longitude distance_m"),
    "mdl_speed_route_hourly": (
        _compared("route_hour", "route_id, direction_id, route_mode, hour_utc, day_of_week", "avg_speed_kmh_rolling", "pct_change_from_rolling"),
        "avg_speed_kmh avg_speed_kmh_rolling pct_change_from_rolling",
    ),
    "mdl_speed_grid_hourly": (
        _compared("grid_hour", "cell, hour_utc, route_mode", "avg_speed_kmh_28_day_rolling", "pct_change_from_28_day_avg"),
        "avg_speed_kmh avg_speed_kmh_28_day_rolling pct_change_from_28_day_avg",
    ),
    "v2_fct_vehicle_position": ("SELECT * FROM v2_position", "speed latitude longitude"),
    "v2_fct_vehicle_segment": ("SELECT * FROM v2_segment", "distance_m speed_kmh"),
    "v2_agg_speed_grid_hour": ("SELECT * FROM v2_grid_hour", "avg_speed_kmh p50_speed_kmh p85_speed_kmh p95_speed_kmh max_speed_kmh"),
    "v2_agg_speed_route_hour": ("SELECT * FROM v2_route_hour", "avg_speed_kmh p50_speed_kmh p85_speed_kmh p95_speed_kmh max_speed_kmh"),
    "v2_agg_unmonitored_grid_day": (
        _unmonitored("service_date, start_cell, route_mode", "start_cell IS NOT NULL", "count(DISTINCT vehicle_id)::BIGINT AS vehicle_cnt,"),
        "gap_seg_ratio gap_seconds_avg unmonitored_total_m unmonitored_avg_m unmonitored_max_m",
    ),
    "v2_agg_unmonitored_vehicle_day": (
        _unmonitored("service_date, vehicle_id, route_mode"), "gap_seg_ratio gap_seconds_avg unmonitored_total_m unmonitored_avg_m unmonitored_max_m",
    ),
    "v2_mdl_speed_grid_hourly": (
        _compared("v2_grid_hour", "cell, route_mode, hour_local", "avg_speed_kmh_rolling", "pct_change_from_rolling", DAYS),
        "avg_speed_kmh p50_speed_kmh p85_speed_kmh p95_speed_kmh max_speed_kmh avg_speed_kmh_rolling pct_change_from_rolling",
    ),
    "v2_mdl_speed_route_hourly": (
        _compared("v2_route_hour", "route_id, direction_id, route_mode, hour_local", "avg_speed_kmh_rolling", "pct_change_from_rolling", DAYS),
        "avg_speed_kmh p50_speed_kmh p85_speed_kmh p95_speed_kmh max_speed_kmh avg_speed_kmh_rolling pct_change_from_rolling",
    ),
    "rolling_stddev": (
        "SELECT *, (unmonitored_distance_m - mean_m) / nullif(stddev_m, 0) AS z FROM (SELECT *, "
        + _mean("vehicle_id, route_mode", "unmonitored_distance_m") + " AS mean_m, "
        + _mean("vehicle_id, route_mode", "unmonitored_distance_m", fn="stddev_samp") + " AS stddev_m FROM vehicle_day)",
        "unmonitored_distance_m mean_m stddev_m z",
    ),
    "rolling_stddev_days": (
        "SELECT *, (unmonitored_distance_m - mean_m) / nullif(stddev_m, 0) AS z FROM (SELECT *, "
        + _mean("vehicle_id, route_mode", "unmonitored_distance_m", DAYS) + " AS mean_m, "
        + _mean("vehicle_id, route_mode", "unmonitored_distance_m", DAYS, "stddev_samp") + " AS stddev_m FROM vehicle_day)",
        "unmonitored_distance_m mean_m stddev_m z",
    ),
    "hourly_dashboard": (
        f"""SELECT h.hour_ts,
          (SELECT count(DISTINCT vehicle_id) FROM vp WHERE date_trunc('hour', ts) = h.hour_ts)::BIGINT AS active_vehicles,
          (SELECT count(*) FILTER (abs({LATE}) <= 300) / nullif(count({LATE}), 0) FROM updates WHERE date_trunc('hour', rt_timestamp) = h.hour_ts) AS on_time_pct,
          (SELECT avg({LATE}) FROM updates WHERE date_trunc('hour', rt_timestamp) = h.hour_ts) AS avg_delay_seconds,
          (SELECT count(*) FROM updates WHERE date_trunc('hour', rt_timestamp) = h.hour_ts)::BIGINT AS updates_count,
          (SELECT count(*) FROM alerts WHERE period_start <= h.hour_ts + INTERVAL 59 MINUTE AND (period_end IS NULL OR period_end >= h.hour_ts))::BIGINT AS active_alerts
        FROM hours h""",
        "on_time_pct avg_delay_seconds",
    ),
    "daily_kpis": ("SELECT * FROM daily", "on_time_share canceled_share avg_delay_seconds cancellation_rate"),
    "kpis_fallback": (
        "SELECT * FROM daily WHERE day BETWEEN DATE '2024-01-22' AND DATE '2024-02-05' ORDER BY day DESC LIMIT 1",
        "on_time_share canceled_share avg_delay_seconds cancellation_rate",
    ),
    "unmonitored_latest": (
        "SELECT * FROM detail ORDER BY end_timestamp_utc DESC, vehicle_id, start_timestamp_utc LIMIT 200",
        "start_latitude start_longitude end_latitude end_longitude distance_m",
    ),
    "top_routes": (
        """SELECT route_id, service_date, hour_utc, direction_id, route_mode, avg_speed_kmh, position_count FROM route_hour
        WHERE route_id IN (SELECT route_id FROM route_hour GROUP BY 1 ORDER BY sum(position_count) DESC, route_id LIMIT 10)""",
        "avg_speed_kmh",
    ),
    "latest_slice": (
        "SELECT * FROM grid_hour WHERE (service_date, hour_utc) = (SELECT (service_date, hour_utc) FROM grid_hour ORDER BY service_date DESC, hour_utc DESC LIMIT 1)",
        "avg_speed_kmh",
    ),
    "agg_vehicle_hour": (
        """SELECT service_date, hour_local, vehicle_id, count(*)::BIGINT AS seg_cnt, sum(distance_m) AS distance_m, sum(delta_seconds)::BIGINT AS seconds,
          sum(distance_m) * 3.6::DOUBLE / nullif(sum(delta_seconds), 0) AS speed_kmh
        FROM v2_segment WHERE NOT flag_nonpositive_gap AND distance_m IS NOT NULL GROUP BY ALL""",
        "distance_m speed_kmh",
    ),
    "agg_vehicle_route_hour": (
        """SELECT service_date, hour_local, vehicle_id, route_id, count(*)::BIGINT AS seg_cnt, sum(distance_m) AS distance_m, sum(delta_seconds)::BIGINT AS seconds,
          sum(distance_m) * 3.6::DOUBLE / nullif(sum(delta_seconds), 0) AS speed_kmh
        FROM v2_segment WHERE NOT flag_nonpositive_gap AND distance_m IS NOT NULL GROUP BY ALL""",
        "distance_m speed_kmh",
    ),
    "agg_vehicle_cell_hour": (
        """SELECT service_date, hour_local, vehicle_id, start_cell, count(*)::BIGINT AS seg_cnt, sum(distance_m) AS distance_m, sum(delta_seconds)::BIGINT AS seconds,
          sum(distance_m) * 3.6::DOUBLE / nullif(sum(delta_seconds), 0) AS speed_kmh
        FROM v2_segment WHERE NOT flag_nonpositive_gap AND distance_m IS NOT NULL GROUP BY ALL""",
        "distance_m speed_kmh",
    ),
    "clean_segments": (
        """SELECT segment_id, vehicle_id, service_date, delta_seconds FROM v2_segment
        WHERE NOT flag_nonpositive_gap AND NOT flag_implausible_speed AND NOT is_gap AND service_date >= DATE '2024-01-10'""",
        "",
    ),
    "agg_vehicle_day": (
        """SELECT service_date, vehicle_id, count(*)::BIGINT AS seg_cnt, sum(distance_m) AS distance_m, sum(delta_seconds)::BIGINT AS seconds,
          sum(distance_m) * 3.6::DOUBLE / nullif(sum(delta_seconds), 0) AS speed_kmh
        FROM v2_segment WHERE NOT flag_nonpositive_gap AND distance_m IS NOT NULL GROUP BY ALL""",
        "distance_m speed_kmh",
    ),
    "shape_road_match": (  # lines due east overlap as far as they are long, if they are near
        f"""SELECT 'N' || n_nationkey AS shape_id, p_partkey::VARCHAR AS edge_id,
          round((0.0001::DOUBLE + (p_size % 7) * 0.0005::DOUBLE) * radians(1.0) * {EARTH_M}::DOUBLE
            * cos(radians({SOUTH}::DOUBLE + (p_partkey % 25) * 0.0003::DOUBLE + (p_partkey % 4) * 0.00003::DOUBLE)), 1) AS overlap_m
        FROM part JOIN nation ON n_nationkey = p_partkey % 25
        WHERE (p_partkey % 4) * 0.00003::DOUBLE * radians(1.0) * {EARTH_M}::DOUBLE <= 6 AND p_size % 7 > 0""",
        "",
    ),
    "trip_edges": ("SELECT * FROM bridge", "overlap_m"),
    "edge_route_rollup": (
        """SELECT route_id, edge_id, min(road_name) AS road_name, count(DISTINCT trip_id)::BIGINT AS trips_using_edge, sum(overlap_m) AS total_overlap_m
        FROM bridge GROUP BY ALL""",
        "total_overlap_m",
    ),
    "edge_diagnostics": (
        """SELECT (SELECT count(*) FROM bridge)::BIGINT AS row_count, (SELECT count(DISTINCT (trip_id, edge_id)) FROM bridge)::BIGINT AS pair_count,
          k::INT AS decile, (SELECT quantile_disc(n, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) FROM edge_counts)[(k + 1)::INT]::BIGINT AS edges
        FROM range(11) AS r(k)""",
        "",
    ),
    "edge_incremental_antijoin": ("SELECT trip_id, edge_id, overlap_m FROM bridge WHERE trip_id NOT LIKE '%7'", "overlap_m"),
    "shape_variant_union": (
        """SELECT 'current' AS variant, shape_id, count(DISTINCT edge_id)::BIGINT AS edges, sum(overlap_m) AS overlap_m FROM shape_edges WHERE overlap_m > 100 GROUP BY ALL
        UNION ALL SELECT 'strict', shape_id, count(DISTINCT edge_id)::BIGINT, sum(overlap_m) FROM shape_edges WHERE overlap_m > 200 GROUP BY ALL""",
        "overlap_m",
    ),
    "manifest_candidates": (
        """SELECT 'vehicle_positions' AS dataset, 'o/' || o_orderkey AS object_uri, o_orderdate::TIMESTAMP AS capture_ts, 'pending' AS status
        FROM orders WHERE o_orderstatus = 'O' ORDER BY capture_ts DESC, object_uri LIMIT 32""",
        "",
    ),
    "conform_dedup": (
        """SELECT TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:01:00' AS updated_at, date_trunc('second', ts) AS timestamp,
          epoch(date_trunc('second', ts))::BIGINT AS timestamp_s, event_id::VARCHAR AS vehicle_id,
          (CASE event_id % 6 WHEN 0 THEN 'EMPTY' WHEN 1 THEN 'MANY_SEATS_AVAILABLE' WHEN 2 THEN 'FEW_SEATS_AVAILABLE' WHEN 3 THEN 'STANDING_ROOM_ONLY' END) AS occupancy_status,
          round_even(value, 2) AS speed, NULL::DOUBLE AS odometer FROM events""",
        "speed",
    ),
    "record_id_hash": (
        "SELECT o_orderkey, substr(md5(o_orderkey || chr(31) || o_custkey || chr(31) || coalesce(o_orderstatus, '∅')), 1, 16) AS record_id FROM orders", "",
    ),
    "upsert_result": (
        f"""SELECT event_id::VARCHAR AS record_id, ts AS timestamp, CASE WHEN event_id % 2 = 1 OR event_id % 3 = 0 THEN value * 2 ELSE value END AS v,
          CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:01:00' END AS created_at,
          CASE WHEN event_id % 2 = 1 OR event_id % 3 = 0 THEN TIMESTAMP '2024-01-01 00:01:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS updated_at
        FROM events""",
        "v",
    ),
    "realtime_round_trip": (
        f"""SELECT DISTINCT vehicle_id, trip_id, route_id, ts AS timestamp, epoch(ts)::BIGINT AS timestamp_s, round_even(latitude, 6) AS latitude,
          round_even(longitude, 6) AS longitude, round_even(speed, 2) AS speed,
          CASE record_id::BIGINT % 9 {" ".join(f"WHEN {k} THEN '{v}'" for k, v in OCCUPANCY.items())} END AS occupancy_status FROM vp""",
        "latitude longitude speed",
    ),
    "protobuf_round_trip": (
        """SELECT DISTINCT vehicle_id, trip_id, route_id, ts AS timestamp, round_even(latitude::FLOAT::DOUBLE, 6) AS latitude,
          round_even(longitude::FLOAT::DOUBLE, 6) AS longitude, round_even(speed::FLOAT::DOUBLE, 2) AS speed FROM vp""",
        "latitude longitude speed",
    ),
    "updates_round_trip": (
        """SELECT record_id, trip_id, start_date, stop_id, stop_sequence, vehicle_id, schedule_relationship, epoch(rt_timestamp)::BIGINT AS timestamp_s,
          epoch(actual_arrival)::BIGINT AS actual_arrival_s, arrival_delay, arrival_uncertainty, epoch(actual_departure)::BIGINT AS actual_departure_s,
          departure_delay, departure_uncertainty FROM updates""",
        "",
    ),
    "alerts_round_trip": (
        """SELECT alert_id, epoch(period_start)::BIGINT AS period_start_s, epoch(period_end)::BIGINT AS period_end_s, 'R' || alert_id::BIGINT % 10 AS route_id,
          'alert ' || alert_id AS header, (1 + alert_id::BIGINT % 3)::VARCHAR AS cause FROM alerts""",
        "",
    ),
    "static_members": ("SELECT p_partkey::VARCHAR AS stop_id, p_name AS stop_name, p_size::VARCHAR AS stop_code, (p_partkey % 8)::BIGINT AS archive, 2::BIGINT AS tables FROM part", ""),
    "snapshot_difference": (
        """SELECT 0::BIGINT AS batch, o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0
        UNION ALL SELECT 1::BIGINT, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 3 = 0""",
        "",
    ),
    "archive_store": (
        """SELECT md5(text) AS feed_hash, strlen(text)::BIGINT AS n_bytes, TIMESTAMP '2024-01-01' + to_minutes(k::INT) AS updated_at, k = max(k) OVER () AS is_latest
        FROM (SELECT p_partkey % 8 AS k, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) AS text FROM part GROUP BY 1)""",
        "",
    ),
    "quarantine_rejects": (
        """SELECT concat_ws('; ', CASE WHEN trip_id IS NULL THEN 'trip_id is null' END, CASE WHEN latitude IS NULL THEN 'latitude is null' END) AS kind, count(*)::BIGINT AS n
        FROM vp WHERE trip_id IS NULL OR latitude IS NULL GROUP BY 1
        UNION ALL SELECT 'in clean files', coalesce(sum(n) FILTER (good), 0)::BIGINT
        FROM (SELECT count(*) AS n, bool_and(trip_id IS NOT NULL AND latitude IS NOT NULL) AS good FROM vp GROUP BY record_id::BIGINT // 8)""",
        "",
    ),
    "bucketed_join": (
        "SELECT o_orderkey, o_orderstatus, count(*)::BIGINT AS n, sum(l_quantity) AS quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL",
        "quantity",
    ),
    "flatten_orders": (
        """SELECT o_orderkey AS order_key, o_orderstatus AS order_state_status, l_linenumber AS lines_number, l_quantity AS lines_price_quantity, l_tax AS lines_price_tax
        FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity > 25) ON l_orderkey = o_orderkey""",
        "lines_price_quantity lines_price_tax",
    ),
    "landed_hours": (
        f"SELECT event_id, user_id, hour(ts)::INTEGER AS hour_utc FROM events WHERE ts::DATE = DATE '{DAY}' AND event_type <> 'error'",
        "",
    ),
    "stream_ingest": (
        """SELECT vehicle_id, ts AS timestamp, substr(md5(vehicle_id || chr(31) || coalesce(trip_id, '∅')), 1, 16) AS entity_id, 16 AS id_length, true AS stamped FROM vp""",
        "",
    ),
    "mapped_fields": (
        "SELECT o_orderkey::BIGINT AS order_id, o_orderstatus AS status, o_orderdate::TIMESTAMP AS placed, NULL::VARCHAR AS clerk FROM orders",
        "",
    ),
    "declared_table": (
        """SELECT p_partkey::VARCHAR AS stop_id, p_name AS stop_name, -36.5::DOUBLE AS stop_lat, p_partkey / 100.0::DOUBLE AS stop_lon, 'AFRICA' AS feed_hash,
          NULL::VARCHAR AS zone_id FROM part""",
        "stop_lat stop_lon",
    ),
    "compacted_files": ("SELECT event_type, count(*)::BIGINT AS n, sum(value) AS total, true AS fewer_files FROM events GROUP BY 1", "total"),
    "clustered_edges": ("SELECT edge_id, count(*)::BIGINT AS n FROM bridge WHERE edge_id BETWEEN 'E1' AND 'E2' GROUP BY 1", ""),
    "curated_merge": (
        """SELECT vehicle_id, ts AS event_ts, record_id, longitude + CASE WHEN record_id::BIGINT % 3 = 0 THEN 1 ELSE 0 END AS lng, TIMESTAMP '2024-01-01' AS created_at,
          CASE WHEN record_id::BIGINT % 3 = 0 THEN TIMESTAMP '2024-01-01 00:01:00' ELSE TIMESTAMP '2024-01-01' END AS updated_at FROM vp""",
        "lng",
    ),
    "shape_statistics": (
        "SELECT shape_id, count(*)::BIGINT AS edges, sum(overlap_m) AS total_m, median(overlap_m)::DOUBLE AS median_m FROM shape_edges GROUP BY 1", "total_m median_m",
    ),
    "near_roads": ("SELECT p_partkey::VARCHAR AS edge_id, 'N' || p_partkey % 25 AS shape_id FROM part WHERE p_partkey % 4 < 2", ""),
    "append_by_day": ("SELECT ts::DATE AS day, (2 * count(*))::BIGINT AS row_count, count(DISTINCT vehicle_id)::BIGINT AS vehicles FROM vp GROUP BY 1", ""),
    "manifest_merge": (
        """SELECT 'vehicle_positions' AS dataset, 'o/' || o_orderkey AS object_uri,
          CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'archived' ELSE 'failed' END AS status, TIMESTAMP '2024-01-01' AS created_at,
          CASE WHEN o_orderstatus = 'F' THEN TIMESTAMP '2024-01-01 00:01:00' ELSE TIMESTAMP '2024-01-01' END AS updated_at FROM orders""",
        "",
    ),
    "cell_boundary": (
        f"""SELECT cell, {_cell("lat", "lon", 6)} AS parent, 7::INT AS points, round(lon - {WIDE}, 7) AS lon_min, round(lat - {TALL}, 7) AS lat_min,
          round(lon + {WIDE}, 7) AS lon_max, round(lat + {TALL}, 7) AS lat_max
        FROM (SELECT cell, {_centre("cell")[0]} AS lat, {_centre("cell")[1]} AS lon FROM cells)""",
        "lon_min lat_min lon_max lat_max",
    ),
    "cell_disk": (
        """SELECT '8:' || (split_part(cell, ':', 2)::BIGINT + i) || ':' || (split_part(cell, ':', 3)::BIGINT + j) AS cell, count(*)::BIGINT AS near
        FROM cells, range(-2, 3) AS u(i), range(-2, 3) AS w(j) WHERE abs(i + j) <= 2 GROUP BY 1""",
        "",
    ),
    "osm_roads": (
        f"""SELECT p_partkey::VARCHAR AS edge_id, p_brand AS name, {list(DRIVEN)}[(p_partkey % {len(DRIVEN) + 2} + 1)::INT] AS highway, round(length_m, 1) AS length_m
        FROM roads WHERE p_partkey % {len(DRIVEN) + 2} < {len(DRIVEN)} AND lat <= {SOUTH}::DOUBLE + 0.00325::DOUBLE""",
        "length_m",
    ),
    "shape_road_strict": (
        f"""SELECT 'N' || (p_partkey % 25) AS shape_id, p_partkey::VARCHAR AS edge_id, p_brand AS road_name,
          {list(DRIVEN)}[(p_partkey % {len(DRIVEN) + 2} + 1)::INT] AS highway, round(length_m, 1) AS overlap_m, 1.0::DOUBLE AS overlap_ratio
        FROM roads WHERE p_partkey % {len(DRIVEN) + 2} < {len(DRIVEN)} AND near AND p_size % 7 > 0""",
        "overlap_m overlap_ratio",
    ),
    "unmatched_roads": ("SELECT p_partkey::VARCHAR AS edge_id FROM roads WHERE NOT (near AND p_size % 7 > 0)", ""),
    "edge_statistics": (
        """SELECT count(*)::BIGINT AS trips, min(n)::BIGINT AS min_edges, avg(n) AS avg_edges, max(n)::BIGINT AS max_edges, median(n)::DOUBLE AS median_edges,
          (SELECT count(*) FROM shape_edges)::BIGINT AS shape_edge_rows, (SELECT count(DISTINCT shape_id) FROM shape_edges)::BIGINT AS shapes,
          (SELECT count(*) / count(DISTINCT shape_id) FROM shape_edges) AS avg_edges_per_shape FROM edge_counts""",
        "avg_edges median_edges avg_edges_per_shape",
    ),
    "recent_positions": (
        """SELECT record_id, vehicle_id, ts AS timestamp FROM vp
        WHERE ts > (SELECT max(ts) FROM vp) - INTERVAL 36 HOUR AND occupancy_status NOT IN ('error', 'logout')""",
        "",
    ),
    "date_slice": ("SELECT * FROM grid_hour WHERE service_date = (SELECT max(service_date) FROM grid_hour)", "avg_speed_kmh"),
}


SELECTS["schedule_head"] = (
    f"""SELECT route_id, direction_id, trip_id, stop_sequence, stop_id, scheduled_departure FROM ({SELECTS["daily_schedule"][0]})
    ORDER BY route_id NULLS FIRST, direction_id NULLS FIRST, trip_id NULLS FIRST, stop_sequence NULLS FIRST, stop_id NULLS FIRST LIMIT 500""",
    "",
)


def oracle_sql() -> dict[str, str]:
    out, cells = {}, hexagon_oracles.views(hexagon_oracles.COARSE, hexagon_oracles.FINE)
    known = [(name, "", select, doubles) for name, (select, doubles) in SELECTS.items()]
    known += [(name, f", {cells}{', ' if more else ''}{more}", select, doubles) for name, (more, select, doubles) in hexagon_oracles.SELECTS.items()]
    for name, more, select, doubles in known:
        rounded = ", ".join(f"round({c} + {NUDGE!r}::DOUBLE, {DIGITS}) AS {c}" for c in doubles.split())
        replaced = f" REPLACE ({rounded})" if rounded else ""
        out[name] = f"{VIEWS}{more} SELECT *{replaced} FROM ({select})"
    return out
