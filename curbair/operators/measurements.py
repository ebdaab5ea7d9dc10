"""Measurements: flattening, time range, hourly statistics, station filters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from curbair.functions.times import as_time, bound_literal, floor_hour, lenient_time, utc_bound
from curbair.functions.values import field_or, without_nan
from curbair.operators.conform import fill_defaults
from curbair.operators.joins import lookup_join
from curbair.schemas import ATTRIBUTE_KEYS, SERIES_KEYS


def station_attributes(schema: T.StructType) -> list[Column]:
    """Flat attributes of a nested station, with defaults for what is absent."""
    text = F.lit("")
    flag = F.lit(False)
    nothing = F.lit(None).cast("double")
    return [
        F.col("id").cast("string").alias("location_id"),
        field_or(schema, "name", text).alias("location_name"),
        field_or(schema, "timezone", text).alias("timezone"),
        field_or(schema, "coordinates.latitude", nothing).alias("latitude"),
        field_or(schema, "coordinates.longitude", nothing).alias("longitude"),
        field_or(schema, "country.code", text).alias("country_iso"),
        field_or(schema, "isMobile", flag).alias("isMobile"),
        field_or(schema, "isMonitor", flag).alias("isMonitor"),
        field_or(schema, "owner.name", text).alias("owner_name"),
        field_or(schema, "provider.name", text).alias("provider"),
    ]


_FLAT_ORDER = [
    "location_id", "location_name", "parameter", "value", "unit", "datetimeUtc",
    "datetimeLocal", "timezone", "latitude", "longitude", "country_iso",
    "isMobile", "isMonitor", "owner_name", "provider",
]


def flatten_stations(pages: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Station -> sensors -> measurements as one row per measurement.

    Stations without sensors and sensors without measurements give no row. ``carry``
    names columns of the pages, such as a folder's, that every row keeps.
    """
    # outer, or a test for empty lists would evaluate a computed page a second time;
    # the inner explode below drops what has no measurements
    sensors = pages.select(
        *carry, *station_attributes(pages.schema), F.explode_outer("sensors.measurements").alias("__list")
    )
    rows = sensors.withColumn("__m", F.explode("__list")).drop("__list")
    m = T.StructType([f for f in rows.schema.fields if f.name == "__m"])
    flat = rows.withColumns({
        "parameter": field_or(m, "__m.parameter.name", F.lit("")),
        "unit": field_or(m, "__m.parameter.units", F.lit("")),
        "value": F.col("__m.value"),
        "datetimeUtc": field_or(m, "__m.period.datetimeFrom.utc", F.lit("")),
        "datetimeLocal": field_or(m, "__m.period.datetimeFrom.local", F.lit("")),
    })
    return flat.select(*_FLAT_ORDER, *carry)


def attach_stations(
    measurements: DataFrame, stations: DataFrame, key: str = "location_id", how: str = "inner"
) -> DataFrame:
    """The flat form when stations and measurements landed as separate tables."""
    return lookup_join(measurements, stations, [key], how=how)


def time_of(df: DataFrame, column: str) -> tuple[Column, T.DataType]:
    """The column as an instant, text parsed leniently, and the instant's type."""
    data_type = df.schema[column].dataType
    if isinstance(data_type, T.StringType):
        return lenient_time(F.col(column), "timestamp"), T.TimestampType()
    return F.col(column), data_type


def in_range(
    df: DataFrame, column: str, start: str | datetime | None, end: str | datetime | None
) -> Column | None:
    """Inclusive range test that is TRUE for missing or unparseable times.

    None when a bound does not parse: then nothing is filtered.
    """
    low, high = utc_bound(start), utc_bound(end)
    if low is None or high is None:
        return None
    time, data_type = time_of(df, column)
    return time.isNull() | (
        (time >= bound_literal(low, data_type)) & (time <= bound_literal(high, data_type))
    )


def filter_time_range(
    df: DataFrame, column: str, start: str | datetime | None, end: str | datetime | None
) -> DataFrame:
    keep = in_range(df, column, start, end)
    return df if keep is None else df.filter(keep)


def time_range_report(
    df: DataFrame, column: str, start: str | datetime | None, end: str | datetime | None
) -> DataFrame:
    """One row: total, filtered_out, kept, and how many times were missing."""
    keep = in_range(df, column, start, end)
    time, _ = time_of(df, column)
    kept = F.lit(True) if keep is None else keep
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~kept).alias("filtered_out"),
        F.count_if(kept).alias("kept"),
        F.count_if(time.isNull()).alias("without_time"),
    )


def look_back(end_date: Column, days: int) -> tuple[Column, Column]:
    """Half-open range of the look-back request: [end - days, end + 1 day)."""
    return F.date_sub(end_date, days), F.date_add(end_date, 1)


def filter_bbox(
    df: DataFrame, box: tuple[float, float, float, float], longitude: str = "longitude",
    latitude: str = "latitude", drop_origin: bool = False,
) -> DataFrame:
    """Rows inside (min_lon, min_lat, max_lon, max_lat), borders included.

    ``drop_origin`` removes (0, 0), which stands for unknown coordinates.
    """
    min_lon, min_lat, max_lon, max_lat = box
    lon, lat = F.col(longitude), F.col(latitude)
    inside = lon.between(min_lon, max_lon) & lat.between(min_lat, max_lat)
    if drop_origin:
        inside = inside & ~((lon == 0) & (lat == 0))
    return df.filter(inside)


def filter_values(df: DataFrame, **values: object) -> DataFrame:
    """Equality (scalar) or membership (list) on columns; None means no filter."""
    for column, value in values.items():
        if value is None:
            continue
        test = F.col(column).isin(list(value)) if isinstance(value, (list, tuple, set)) \
            else F.col(column) == value
        df = df.filter(test)
    return df


def group_keys(df: DataFrame, drop_all_null: bool = False) -> list[str]:
    """Series and attribute columns that exist.

    A key without any value does not change the groups; ``drop_all_null`` leaves
    such series keys out of the result as well, at the price of a pass over them.
    """
    series = [c for c in SERIES_KEYS if c in df.columns]
    if drop_all_null and series:
        filled = df.agg(*[F.count(c).alias(c) for c in series]).first()
        series = [c for c in series if filled[c] > 0]
    if not series:
        raise ValueError("hourly statistics need at least one key besides the hour")
    return series + [c for c in ATTRIBUTE_KEYS if c in df.columns]


def hourly_rows(
    df: DataFrame, time: str, value: str, keys: Sequence[str]
) -> DataFrame:
    """(datetime_hour, keys, __value): defaults filled, NaN as NULL, times floored."""
    filled = fill_defaults(df)
    instant, data_type = time_of(filled, time)
    measure = without_nan(F.col(value), filled.schema[value].dataType).cast("double")
    return filled.select(
        floor_hour(instant, data_type).alias("datetime_hour"), *keys, measure.alias("__value")
    )


def hourly_statistics(
    df: DataFrame, time: str = "datetimeUtc", value: str = "value",
    keys: Sequence[str] | None = None, drop_all_null: bool = False, ordered: bool = False,
) -> DataFrame:
    """Mean, minimum, maximum and non-missing count of ``value`` per hour and key.

    Missing keys form groups of their own, unparseable times the NULL hour. All
    four aggregates combine map-side, so one hot group costs one row per task in
    the shuffle. ``ordered`` sorts the result by hour and keys, missing ones last.
    """
    keys = list(keys) if keys is not None else group_keys(df, drop_all_null)
    found = hourly_rows(df, time, value, keys).groupBy("datetime_hour", *keys).agg(
        F.avg("__value").alias("value_mean"),
        F.min("__value").alias("value_min"),
        F.max("__value").alias("value_max"),
        F.count("__value").alias("value_count"),
    )
    return found.orderBy(*[F.col(c).asc_nulls_last() for c in ("datetime_hour", *keys)]) if ordered else found


def sensor_extent(df: DataFrame, keys: Sequence[str], time: str = "datetimeUtc") -> DataFrame:
    """First and last measurement time and the number of rows per sensor."""
    instant, _ = time_of(df, time)
    return df.groupBy(*keys).agg(
        F.min(instant).alias("first_time"),
        F.max(instant).alias("last_time"),
        F.count(F.lit(1)).alias("measurements"),
    )


def time_column(df: DataFrame, column: str, kind: str = "timestamp") -> DataFrame:
    """Parse ``column`` in place if it is text."""
    return df.withColumn(column, as_time(F.col(column), df.schema[column].dataType, kind))
