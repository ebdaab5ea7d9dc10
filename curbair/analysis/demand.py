"""Trip demand by place and time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from curbair.functions.times import floor_hour
from curbair.operators.joins import fits_broadcast, lookup_join
from curbair.sources.staging import staged

ENDS = {"pickup": "PULocationID", "dropoff": "DOLocationID"}


def attach_zones(
    df: DataFrame, zones: DataFrame, ends: dict[str, str] | None = None,
    columns: Sequence[str] = ("Borough", "Zone"), computed: bool = False,
) -> DataFrame:
    """Zone columns for each end of a trip, by zone id (names repeat)."""
    ends = ENDS if ends is None else ends
    small = fits_broadcast(zones)
    for end, column in ends.items():
        named = zones.select(
            F.col("LocationID").cast(df.schema[column].dataType).alias(column),
            *[F.col(c).alias(f"{end}_{c.lower()}") for c in columns],
        )
        df = lookup_join(df, named, [column], how="left", small=small, computed=computed)
        computed = True
    return df


def hourly_demand(
    trips: DataFrame, place: Sequence[str] = ("PULocationID",), time: str = "pickup_ts"
) -> DataFrame:
    """Trips per hour and place."""
    hour = floor_hour(F.col(time), trips.schema[time].dataType)
    return (
        trips.select(hour.alias("datetime_hour"), *place)
        .groupBy("datetime_hour", *place)
        .agg(F.count(F.lit(1)).alias("trips"))
    )


def demand_by_unit(
    demand: DataFrame, unit: str, keys: Sequence[str] = ("PULocationID",), time: str = "datetime_hour"
) -> DataFrame:
    """Demand at a coarser time unit (day, week, month, ...), from finer counts."""
    start = F.date_trunc(unit, F.col(time))
    if isinstance(demand.schema[time].dataType, T.TimestampNTZType):
        start = start.cast("timestamp_ntz")
    return demand.groupBy(start.alias(f"{unit}_start"), *keys).agg(F.sum("trips").alias("trips"))


def demand_rollup(trips: DataFrame, zones: DataFrame, place: str = "PULocationID") -> DataFrame:
    """Trips by (borough, zone), by borough, and in total.

    Counted by place id first: the zone join and the rollup's three copies of a
    row then work on one row per place.
    """
    per_place = trips.groupBy(place).agg(F.count(F.lit(1)).alias("trips"))
    named = attach_zones(per_place, zones, {"at": place}, computed=True)
    return named.rollup("at_borough", "at_zone").agg(
        F.sum("trips").alias("trips"),
        F.grouping("at_borough").cast("long").alias("all_boroughs"),
        F.grouping("at_zone").cast("long").alias("all_zones"),
    )


def demand_lattice(
    trips: DataFrame, zones: DataFrame, place: str = "PULocationID", time: str = "pickup_ts"
) -> DataFrame:
    """Trips at every scale of time (hour, day, month) and place (zone, borough, all).

    (time_unit, period_start, place_level, borough, zone, trips). The trips are read once:
    hours of zones are counted from them, and every other level from the nearest finer
    one, so each aggregation reads counts that are already small. A place that the zone
    table does not have counts under borough and zone NULL; a NULL time is a period of
    its own.
    """
    kind = trips.schema[time].dataType
    counted = hourly_demand(trips, (place,), time)
    named = attach_zones(counted, zones, {"at": place}, computed=True)

    def rolled(df: DataFrame, unit: str, keys: Sequence[str]) -> DataFrame:
        start = F.date_trunc(unit, F.col("period_start"))
        if isinstance(kind, T.TimestampNTZType):
            start = start.cast("timestamp_ntz")
        return df.groupBy(start.alias("period_start"), *keys).agg(F.sum("trips").alias("trips"))

    zone, borough = ["borough", "zone"], ["borough"]
    hours = named.select(F.col("datetime_hour").alias("period_start"), F.col("at_borough").alias("borough"),
                         F.col("at_zone").alias("zone"), "trips")
    levels: dict[tuple[str, str], DataFrame] = {}
    # each level is staged where coarser ones start from it
    levels["hour", "zone"] = staged(rolled(hours, "hour", zone), "hour-zone")
    levels["day", "zone"] = staged(rolled(levels["hour", "zone"], "day", zone), "day-zone")
    levels["month", "zone"] = rolled(levels["day", "zone"], "month", zone)
    levels["hour", "borough"] = staged(rolled(levels["hour", "zone"], "hour", borough), "hour-borough")
    levels["day", "borough"] = staged(rolled(levels["hour", "borough"], "day", borough), "day-borough")
    levels["month", "borough"] = rolled(levels["day", "borough"], "month", borough)
    levels["hour", "all"] = rolled(levels["hour", "borough"], "hour", [])
    levels["day", "all"] = staged(rolled(levels["day", "borough"], "day", []), "day-all")
    levels["month", "all"] = rolled(levels["day", "all"], "month", [])
    text = F.lit(None).cast("string")
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(unit).alias("time_unit"), "period_start", F.lit(level).alias("place_level"),
                  (F.col("borough") if level != "all" else text).alias("borough"),
                  (F.col("zone") if level == "zone" else text).alias("zone"), "trips")
        for (unit, level), df in levels.items()])
