"""Contracts of the staged tables: their columns, where raw values come from, and how they are laid out."""

from __future__ import annotations

from pyspark.sql import types as T

from fleetlens.operators.conform import Contract

STAMPS = "created_at timestamp, updated_at timestamp, "

# Columns of the staged tables, and labels of codes in feeds.
COLUMNS = {
    "stg_agency": "agency_id string, agency_name string NOT NULL, agency_url string NOT NULL, agency_timezone string NOT NULL, agency_lang string, agency_phone string, agency_fare_url string, agency_email string, feed_hash string NOT NULL",
    "stg_calendar": "service_id string NOT NULL, monday bigint NOT NULL, tuesday bigint NOT NULL, wednesday bigint NOT NULL, thursday bigint NOT NULL, friday bigint NOT NULL, saturday bigint NOT NULL, sunday bigint NOT NULL, start_date bigint NOT NULL, end_date bigint NOT NULL, feed_hash string NOT NULL",
    "stg_calendar_dates": "service_id string NOT NULL, date bigint NOT NULL, exception_type bigint NOT NULL, feed_hash string NOT NULL",
    "stg_daily_schedule": "service_date bigint NOT NULL, service_id string NOT NULL, route_id string NOT NULL, trip_id string NOT NULL, stop_id string NOT NULL, route_short_name string, route_type bigint, direction_id bigint, trip_headsign string, stop_headsign string, shape_id string, shape_dist_traveled double, stop_sequence bigint, stop_code string, stop_name string, stop_lat double, stop_lon double, scheduled_arrival_time string, scheduled_departure_time string, scheduled_arrival timestamp, scheduled_departure timestamp, scheduled_arrival_s bigint, scheduled_departure_s bigint, service_date_dt date NOT NULL, feed_hash string NOT NULL",
    "stg_fare_attributes": "fare_id string NOT NULL, agency_id string, price double NOT NULL, currency_type string NOT NULL, payment_method bigint NOT NULL, transfers bigint, transfer_duration bigint, feed_hash string NOT NULL",
    "stg_fare_rules": "fare_rules_fare_id string NOT NULL, route_id string, origin_id string, destination_id string, contains_id string, feed_hash string NOT NULL",
    "stg_feed_info": "feed_publisher_name string NOT NULL, feed_publisher_url string NOT NULL, feed_lang string NOT NULL, feed_start_date bigint, feed_end_date bigint, feed_version string, feed_hash string NOT NULL",
    "stg_frequencies": "trip_id string NOT NULL, start_time string NOT NULL, end_time string NOT NULL, headway_secs bigint NOT NULL, exact_times bigint, feed_hash string NOT NULL",
    "stg_routes": "route_id string NOT NULL, agency_id string, route_short_name string, route_long_name string, route_desc string, route_type bigint NOT NULL, route_url string, route_color string, route_text_color string, route_sort_order bigint, contract_id string, feed_hash string NOT NULL",
    "stg_service_alerts": "record_id string NOT NULL, entity_id string NOT NULL, alert_id string, timestamp timestamp NOT NULL, timestamp_s bigint, header string, description string, url string, cause string, effect string, effect_detail string, severity_level string, period_start timestamp, period_end timestamp, period_start_s bigint, period_end_s bigint, route_id string, agency_id string, trip_id string, stop_id string, direction_id bigint",
    "stg_shapes": "shape_id string NOT NULL, shape_pt_lat double NOT NULL, shape_pt_lon double NOT NULL, shape_pt_sequence bigint NOT NULL, shape_dist_traveled double, feed_hash string NOT NULL",
    "stg_stop_times": "trip_id string NOT NULL, stop_id string NOT NULL, stop_sequence bigint NOT NULL, arrival_time string, departure_time string, stop_headsign string, pickup_type bigint, drop_off_type bigint, timepoint bigint, shape_dist_traveled double, feed_hash string NOT NULL",
    "stg_stops": "stop_id string NOT NULL, stop_code string, stop_name string NOT NULL, stop_desc string, stop_lat double NOT NULL, stop_lon double NOT NULL, zone_id string, stop_url string, location_type bigint, parent_station string, platform_code string, stop_timezone string, wheelchair_boarding bigint, start_date string, end_date string, feed_hash string NOT NULL",
    "stg_transfers": "from_stop_id string NOT NULL, to_stop_id string NOT NULL, transfer_type bigint NOT NULL, min_transfer_time bigint, feed_hash string NOT NULL",
    "stg_trip_updates": "record_id string NOT NULL, entity_id string NOT NULL, timestamp timestamp NOT NULL, timestamp_s bigint, route_id string, trip_id string NOT NULL, start_date string, start_time string, direction_id bigint, schedule_relationship string, delay bigint, stop_sequence bigint, stop_id string, actual_arrival timestamp, actual_arrival_s bigint, arrival_delay bigint, arrival_uncertainty bigint, actual_departure timestamp, actual_departure_s bigint, departure_delay bigint, departure_uncertainty bigint, vehicle_id string, vehicle_label string, vehicle_license_plate string",
    "stg_trips": "trip_id string NOT NULL, route_id string NOT NULL, service_id string NOT NULL, trip_headsign string, trip_short_name string, direction_id bigint, block_id string, shape_id string, wheelchair_accessible bigint, bikes_allowed bigint, feed_hash string NOT NULL",
    "stg_vehicle_positions": "record_id string NOT NULL, entity_id string NOT NULL, timestamp timestamp NOT NULL, timestamp_s bigint, vehicle_id string, vehicle_label string, vehicle_license_plate string, latitude double, longitude double, bearing double, speed double, odometer double, occupancy_status string, route_id string, trip_id string, direction_id bigint, start_date string, start_time string, schedule_relationship string",
}
# Codes 4 to 7 are those of the public feed specification, where 4 is not in use.
RELATION = {0: "SCHEDULED", 1: "ADDED", 2: "UNSCHEDULED", 3: "CANCELED", 5: "REPLACEMENT", 6: "DUPLICATED", 7: "DELETED"}
OCCUPANCY = {
    0: "EMPTY", 1: "MANY_SEATS_AVAILABLE", 2: "FEW_SEATS_AVAILABLE", 3: "STANDING_ROOM_ONLY", 4: "CRUSHED_STANDING_ROOM_ONLY", 5: "FULL",
    6: "NOT_ACCEPTING_PASSENGERS", 7: "NO_DATA_AVAILABLE", 8: "NOT_BOARDABLE",
}
# Columns that change between reports of one record.
STAMPED = ("created_at", "updated_at")
FEED_KEYS = {
    "stg_calendar": ("service_id",), "stg_calendar_dates": ("service_id", "date"), "stg_fare_attributes": ("fare_id",),
    "stg_fare_rules": ("fare_rules_fare_id", "route_id"), "stg_frequencies": ("trip_id",), "stg_routes": ("route_id",),
    "stg_shapes": ("shape_id", "shape_pt_sequence"), "stg_stop_times": ("trip_id", "stop_sequence"), "stg_stops": ("stop_id",),
    "stg_transfers": ("from_stop_id", "to_stop_id"), "stg_trips": ("route_id", "trip_id"),
}
LIVE = {
    "stg_vehicle_positions": {
        "entity": ("vehicle_id", "trip_id"), "not_null": ("vehicle_id",), "labels": {"occupancy_status": OCCUPANCY, "schedule_relationship": RELATION},
        "digits": {"latitude": 6, "longitude": 6, "bearing": 2, "speed": 2, "odometer": 2},
    },
    "stg_trip_updates": {"entity": ("trip_id", "start_date", "stop_id", "stop_sequence"), "not_null": ("trip_id",), "labels": {"schedule_relationship": RELATION}},
    "stg_service_alerts": {"entity": ("alert_id", "route_id", "stop_id", "trip_id")},
}


def contract(name: str) -> Contract:
    schema = T.StructType.fromDDL(STAMPS + COLUMNS[name])
    if name in LIVE:
        return Contract(name, schema, volatile=STAMPED, partition="timestamp", cluster=("record_id", "entity_id"), **LIVE[name])
    day = "service_date_dt" if name == "stg_daily_schedule" else None
    keys = ("route_id", "trip_id", "stop_sequence") if day else FEED_KEYS.get(name, ())
    return Contract(name, schema, partition=day, cluster=("feed_hash", *keys))


def contracts() -> dict[str, Contract]:
    return {name: contract(name) for name in COLUMNS}
