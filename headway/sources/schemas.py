"""Column types of the source tables and the keys a row can't do without."""

from __future__ import annotations

# The columns that the jobs read, by table, as Spark types.
SOURCE_SCHEMAS: dict[str, str] = {
    "agency": "agency_id int, agency_name string, agency_id_import string, agency_url string, agency_timezone string, agency_lang_id int, agency_short_name string, agency_phone string, agency_fare_url string, agency_info string, query_tracking boolean, last_modified date, no_frequencies boolean",
    "agency_group_assoc": "agency_id int, agency_group_id int",
    "agency_groups": "agency_group_id int, group_name string, feed_contact_email string, feed_contact_url string, feed_license string, last_modified date",
    "blocks": "block_id bigint, agency_id int, block_label string",
    "calendar": "calendar_id int, service_schedule_group_id int, agency_id int, monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int",
    "calendar_date_service_exceptions": "calendar_date_id bigint, exception_type int, service_exception int, agency_id int, last_modified date",
    "calendar_dates": "calendar_date_id bigint, date date, agency_id int, description string, last_modified date",
    "directions": "direction_id int, direction_label string",
    "fare_attributes": "fare_id bigint, agency_id int, price double, currency_type string, payment_method int, transfers int, transfer_duration int, last_modified date, fare_id_import string",
    "fare_rider_categories": "fare_rider_category_id bigint, fare_id bigint, rider_category_custom_id int, price decimal(10,4), agency_id int",
    "fare_rules": "fare_rule_id bigint, fare_id bigint, route_id bigint, origin_id bigint, destination_id bigint, contains_id bigint, agency_id int, last_modified date, fare_id_import string, route_id_import string, origin_id_import string, destination_id_import string, contains_id_import string",
    "frequencies": "trip_id bigint, start_time int, end_time int, headway_secs int",
    "headsigns": "headsign_id bigint, headsign string, agency_id int",
    "routes": "route_id bigint, agency_id int, route_long_name string, route_short_name string, route_color string, route_sort_order bigint, hidden boolean, route_text_color string, route_desc string, route_type int, route_url string, route_bikes_allowed int, route_id_import string, last_modified date",
    "sample_colors": "color_id bigint, color string",
    "service_schedule_bounds": "service_schedule_group_id int, agency_id int, start_date date, end_date date",
    "service_schedule_groups": "service_schedule_group_id int, service_schedule_group_label string, agency_id int",
    "shape_points": "shape_segment_id bigint, shape_pt_sequence int, lon double, lat double",
    "shape_segments": "shape_segment_id bigint, start_coordinate_id bigint, end_coordinate_id bigint, last_modified timestamp",
    "stop_times": "trip_id bigint, agency_id int, stop_sequence int, stop_id bigint, arrival_time bigint, departure_time bigint, pickup_type int, drop_off_type int, headsign_id bigint",
    "stops": "stop_id bigint, stop_name string, agency_id int, zone_id int, stop_lon double, stop_lat double, stop_timezone string, publish_status boolean, stop_code string, platform_code string, location_type int, parent_station bigint, stop_desc string, stop_comments string, city string, direction_id int, stop_url string",
    "transfers": "transfer_id bigint, from_stop_id bigint, to_stop_id bigint, transfer_type int, agency_id int, min_transfer_time int, last_modified date, from_stop_id_import string, to_stop_id_import string",
    "trips": "trip_id bigint, route_id bigint, agency_id int, direction_id int, service_id int, headsign_id bigint, block_id bigint, based_on bigint, trip_start_time bigint, in_seat_transfer int",
    "tz_polygons": "tzid string, ring_id int, vertex_no int, lon double, lat double",
    "user_permissions": "permission_id bigint, agency_id int, user_id bigint, last_modified date",
    "users": "user_id bigint, email string, read_only int, admin int, pass string, first_name string, last_name string, active boolean, registration_date date, language_id int, last_modified date",
    "zones": "zone_id int, zone_name string, agency_id int, last_modified date, zone_id_import string",
}

# Columns without which a row means nothing; a row that lacks one is rejected.
REQUIRED: dict[str, list[str]] = {
    "agency": ["agency_id"], "agency_groups": ["agency_group_id"], "agency_group_assoc": ["agency_id", "agency_group_id"],
    "zones": ["zone_id"], "stops": ["stop_id", "stop_lon", "stop_lat"], "routes": ["route_id"], "headsigns": ["headsign_id"],
    "directions": ["direction_id"], "calendar": ["calendar_id"], "trips": ["trip_id"], "stop_times": ["trip_id", "stop_id"],
    "frequencies": ["trip_id", "start_time", "headway_secs"], "fare_rules": ["fare_rule_id", "fare_id"], "fare_attributes": ["fare_id"],
    "fare_rider_categories": ["fare_rider_category_id"], "transfers": ["transfer_id"], "blocks": ["block_id"],
    "sample_colors": ["color_id", "color"], "service_schedule_groups": ["service_schedule_group_id"],
    "calendar_dates": ["calendar_date_id", "date"], "calendar_date_service_exceptions": ["calendar_date_id", "service_exception"],
    "users": ["user_id"], "user_permissions": ["permission_id"], "shape_points": ["shape_segment_id", "lon", "lat"],
    "shape_segments": ["shape_segment_id"], "tz_polygons": ["tzid", "ring_id", "vertex_no", "lon", "lat"],
}
