"""Columns and code maps of the inputs and outputs."""

from __future__ import annotations

ZONE = "America/New_York"

# Column names of the daily stop records.
DAILY_INPUT = (
    "service_date route_id trip_id stop_id direction_id stop_sequence vehicle_id vehicle_label move_timestamp stop_timestamp "
    "travel_time_seconds dwell_time_seconds headway_trunk_seconds headway_branch_seconds scheduled_travel_time "
    "scheduled_headway_trunk scheduled_headway_branch vehicle_consist"
).split()

# Column names of the daily events.
DAILY_OUTPUT = (
    "service_date route_id trip_id direction_id stop_id stop_sequence vehicle_id vehicle_label event_type event_time "
    "travel_time_seconds dwell_time_seconds headway_seconds headway_branch_seconds scheduled_tt scheduled_headway "
    "scheduled_headway_branch vehicle_consist"
).split()

#: Spark types of the daily input; direction_id may be boolean or a number in the file.
DAILY_TYPES = {c: "bigint" for c in DAILY_INPUT} | {c: "string" for c in ("route_id", "trip_id", "stop_id", "vehicle_id", "vehicle_label", "vehicle_consist")} | {"stop_sequence": "smallint", "direction_id": "smallint"}

# New names of daily columns.
DAILY_RENAMES = {"headway_trunk_seconds": "headway_seconds", "scheduled_headway_trunk": "scheduled_headway", "scheduled_travel_time": "scheduled_tt"}

# Monthly subway files, up to 2023 and from 2024 on.
SUBWAY_INPUT = "service_date route_id trip_id direction_id stop_id stop_sequence vehicle_id vehicle_label event_type event_time_sec".split()
SUBWAY_INPUT_2024 = [c.replace("stop_sequence", "sync_stop_sequence") for c in SUBWAY_INPUT]

# Old names of bus columns.
BUS_RENAMES = {
    "ServiceDate": "service_date",
    "Route": "route_id",
    "Direction": "direction_id",
    "HalfTripId": "half_trip_id",
    "Stop": "stop_id",
    "stop_name": "time_point_id",
    "stop_sequence": "time_point_order",
    "Timepoint": "time_point_id",
    "TimepointOrder": "time_point_order",
    "PointType": "point_type",
    "StandardType": "standard_type",
    "Scheduled": "scheduled",
    "Actual": "actual",
    "ScheduledHeadway": "scheduled_headway",
    "Headway": "headway",
    "direction": "direction_id",
}
BUS_OUTPUT = "service_date route_id trip_id direction_id stop_id stop_sequence vehicle_id vehicle_label event_type event_time scheduled_headway scheduled_tt".split()
BUS_DIRECTIONS = {"Outbound": 0, "Inbound": 1}
BUS_EVENTS = {"Startpoint": ["DEP"], "Midpoint": ["ARR", "DEP"], "Endpoint": ["ARR"]}

# Ferry columns, routes, directions and terminals.
FERRY_REQUIRED = "travel_direction departure_terminal mbta_sched_arrival mbta_sched_departure actual_departure actual_arrival".split()
FERRY_OUTPUT = "service_date route_id trip_id direction_id stop_id stop_sequence vehicle_id vehicle_label event_type event_time vehicle_consist".split()
FERRY_DIRECTIONS = {"From Boston": 0, "To Boston": 1}
FERRY_ROUTES = {"F1": "Boat-F1", "F2H": "Boat-F1", "F3": "Boat-EastBoston", "F4": "Boat-F4", "F5": "Boat-Lynn", "F6": "Boat-F6", "F7": "Boat-F7", "F8": "Boat-F8"}
FERRY_TERMINALS = {
    "Aquarium": "Boat-Aquarium",
    "Boston": "Boat-Long",
    "Central Whf": "Boat-Aquarium",
    "Georges": "Boat-George",
    "Hingham": "Boat-Hingham",
    "Hull": "Boat-Hull",
    "Lewis": "Boat-Lewis",
    "Logan": "Boat-Logan",
    "Long Wharf N": "Boat-Long",
    "Long Wharf S": "Boat-Long-South",
    "Lynn": "Boat-Blossom",
    "Navy Yard": "Boat-Charlestown",
    "Quincy": "Boat-Quincy",
    "Rowes": "Boat-Rowes",
    "Rowes Wharf": "Boat-Rowes",
    "Seaport": "Boat-Fan",
    "Winthrop": "Boat-Winthrop",
    "HULL": "Boat-Hull",
    "LOGAN": "Boat-Logan",
}

# Stop ids that live data reports under another name.
STOP_ALIASES = {
    "Alewife-01": "70061",
    "Alewife-02": "70061",
    "Forest Hills-01": "70001",
    "Forest Hills-02": "70001",
    "Braintree-01": "70105",
    "Braintree-02": "70105",
    "Oak Grove-01": "70036",
    "Oak Grove-02": "70036",
    "Union Square-01": "70503",
    "Union Square-02": "70504",
}

# The route with branches, and the stops that only one branch has.
BRANCHED_ROUTE = "Red"
BRANCH_STOPS = {"Red-A": [str(s) for s in range(70085, 70095)], "Red-B": [str(s) for s in range(70095, 70106)]}

# Trips that carry nobody, dropped before the cutoff.
NON_REVENUE_PREFIX = "NONREV-"
NON_REVENUE_CUTOFF = "2023-11-30"

ROUTE_DIRECTION_STOP = ("route_id", "direction_id", "stop_id")
EVENT_TYPES = ("ARR", "DEP")
WEEKDAYS = "monday tuesday wednesday thursday friday saturday sunday".split()
