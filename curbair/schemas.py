"""Declared shapes of the datasets and the fixed values results depend on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: column names and formats of the data sets -----------------

STAMP = "yyyyMMddHHmmss"
RUN_ID = "yyyyMMdd_HHmmss"
TRIP_FILES = r"(green|yellow)_.*\.(csv|parquet)"
TRIP_PREFIX = "taxi_data"
MERGED_TRIPS = "{taxi_type}_tripdata_merged"
STATION_MAPPING = "location_mapping"

STATION_COLUMNS = [
    "location_id", "location_name", "timezone", "latitude", "longitude",
    "country_iso", "isMobile", "isMonitor",
]
FACT_COLUMNS = [
    "datetime_hour", "location_id", "parameter", "unit",
    "value_mean", "value_min", "value_max", "value_count",
]
SERIES_KEYS = ["location_id", "parameter", "unit"]
ATTRIBUTE_KEYS = [
    "location_name", "timezone", "latitude", "longitude",
    "country_iso", "isMobile", "isMonitor", "owner_name", "provider",
]
TEXT_ATTRIBUTES = ["location_name", "timezone", "country_iso", "owner_name", "provider"]
NUMBER_ATTRIBUTES = ["latitude", "longitude"]
FLAG_ATTRIBUTES = ["isMobile", "isMonitor"]
SORT_PREFERENCE = ["datetime_hour", "datetimeUtc", "datetime", "date", "time"]

# --- nested station pages ----------------------------------------------------

_INSTANT = "struct<utc: string, local: string>"
_POINT = "struct<latitude: double, longitude: double>"
_PARAMETER = "struct<id: bigint, name: string, units: string, display_name: string>"
_MEASUREMENT = (
    f"struct<period: struct<datetimeFrom: {_INSTANT}, datetimeTo: {_INSTANT}>, "
    f"parameter: {_PARAMETER}, value: double, coordinates: {_POINT}>"
)
_SENSOR = f"struct<id: string, parameter: {_PARAMETER}, measurements: array<{_MEASUREMENT}>>"

_STATION = (
    f"id bigint, name string, timezone string, coordinates {_POINT}, "
    "country struct<code: string>, isMobile boolean, isMonitor boolean, "
    "owner struct<name: string>, provider struct<name: string>"
)
STATION_PAGE = f"{_STATION}, sensors array<{_SENSOR}>"

# The part of a page that the flat form uses. Column pruning does not reach below
# two nested explodes, so a scan reads only this much if the schema says so.
_USED = (
    f"struct<period: struct<datetimeFrom: {_INSTANT}>, "
    "parameter: struct<name: string, units: string>, value: double>"
)
STATION_PAGE_USED = f"{_STATION}, sensors array<struct<measurements: array<{_USED}>>>"

ZONE_LOOKUP = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

FILE_CATALOGUE = "map<string, map<string, array<struct<type: string, url: string>>>>"


# --- trips -------------------------------------------------------------------


@dataclass(frozen=True)
class TripSpec:
    """Column names of one taxi type; everything else about cleaning is shared."""

    taxi_type: str
    pickup: str
    dropoff: str

    @property
    def columns(self) -> dict[str, str]:
        """Kept columns in output order with the type they are read as."""
        return {
            "VendorID": "bigint",
            self.pickup: "timestamp_ntz",
            self.dropoff: "timestamp_ntz",
            "passenger_count": "double",
            "trip_distance": "double",
            "PULocationID": "bigint",
            "DOLocationID": "bigint",
        }

    @property
    def required(self) -> tuple[str, ...]:
        return ("trip_distance",)


GREEN = TripSpec("green", "lpep_pickup_datetime", "lpep_dropoff_datetime")
YELLOW = TripSpec("yellow", "tpep_pickup_datetime", "tpep_dropoff_datetime")
TRIP_SPECS = {spec.taxi_type: spec for spec in (GREEN, YELLOW)}
