"""Regions, layouts, routing and compatibility switches: the one place for configuration."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

MODERN, LEGACY_V1, LEGACY_V2 = "MODERN", "LEGACY_V1", "LEGACY_V2"
LAYOUTS = (MODERN, LEGACY_V1, LEGACY_V2)
LEGACY_LAYOUTS = (LEGACY_V1, LEGACY_V2)


@dataclass(frozen=True)
class Region:
    """A service region: its staging schema and the box that station coordinates must lie in."""

    name: str
    staging_schema: str
    lat: tuple[float, float]
    lng: tuple[float, float]
    # Column names the route report uses for the start coordinates in this region.
    route_start_columns: tuple[str, str] = ("start_lat", "start_lng")


# Bounding boxes, schema names and fingerprint routing.
NYC = Region("nyc", "STAGING_NYC", (40.0, 42.0), (-75.0, -72.0))
JERSEY_CITY = Region(
    "jersey_city", "STAGING_JC", (40.0, 41.0), (-74.5, -73.9), ("station_lat", "station_lng")
)
REGIONS = {r.name: r for r in (NYC, JERSEY_CITY)}

LAYOUT_OF_KEY = {
    "dc497b4333c4": MODERN,
    "473144999085": LEGACY_V1,
    "e24ee8457e0e": LEGACY_V2,
}
# The two legacy headers hash the other way round; both layouts hold the same 15 positions, so
# only the label differs. Pass this map to get the labels the headers themselves imply.
LAYOUT_OF_KEY_BY_HEADER = {
    "dc497b4333c4": MODERN,
    "e24ee8457e0e": LEGACY_V1,
    "473144999085": LEGACY_V2,
}
TABLE_OF_LAYOUT = {layout: f"TRIPS_{layout}" for layout in LAYOUTS}
LAYOUT_OF_TABLE = {table: layout for layout, table in TABLE_OF_LAYOUT.items()}

# Quality limits, retry limit and file-part sizes.
MIN_TRIP_SECONDS, MAX_TRIP_SECONDS = 60, 86_400
CALENDAR_START, CALENDAR_END = dt.date(2013, 1, 1), dt.date(2030, 12, 31)
MAX_RETRIES = 3
SIZE_TOLERANCE_BYTES = 1024
MAX_PART_BYTES = 250 * 1024 * 1024


@dataclass(frozen=True)
class Compat:
    """Switches between the intended meaning (default) and literal legacy behaviour."""

    # Layout key = second '_' field of the file name, wrong for region names holding '_'.
    key_by_split: bool = False
    # Keep both names when a date is listed as two holidays (the date then appears twice).
    holiday_fanout: bool = False
    # Three-letter day and month names in the columns declared for full names.
    short_names: bool = False
