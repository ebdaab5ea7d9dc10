"""Trip cleaning: projection, validity checks, time normalisation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from curbair.functions.times import stamp
from curbair.functions.values import is_positive
from curbair.operators.conform import conform
from curbair.schemas import TripSpec

REASONS = ["distance", "passengers", "unparseable_time", "time_order", "location"]


def conform_trips(df: DataFrame, spec: TripSpec, carry: tuple[str, ...] = ()) -> DataFrame:
    """The trip columns that exist, cast to their types, plus the carried ones.

    With only one of the two time columns, neither is touched.
    """
    columns = dict(spec.columns)
    if not {spec.pickup, spec.dropoff} <= set(df.columns):
        for c in (spec.pickup, spec.dropoff):
            if c in df.columns:
                columns[c] = df.schema[c].dataType.simpleString()
    return conform(df, columns, spec.required, f"{spec.taxi_type} trips", carry)


def trip_checks(trips: DataFrame, spec: TripSpec) -> list[tuple[str, Column]]:
    """(reject reason, condition a valid row meets) in order of precedence."""

    def positive(name: str) -> Column:
        return is_positive(F.col(name), trips.schema[name].dataType)

    present = set(trips.columns)
    checks = [("distance", positive("trip_distance"))]
    if "passenger_count" in present:
        checks.append(("passengers", positive("passenger_count")))
    if {spec.pickup, spec.dropoff} <= present:
        pickup, dropoff = F.col(spec.pickup), F.col(spec.dropoff)
        checks.append(("unparseable_time", pickup.isNotNull() & dropoff.isNotNull()))
        checks.append(("time_order", pickup < dropoff))
    places = [positive(c) for c in ("PULocationID", "DOLocationID") if c in present]
    if places:
        checks.append(("location", reduce(lambda a, b: a & b, places)))
    return checks


def stamp_times(trips: DataFrame, spec: TripSpec) -> DataFrame:
    """Both times as 14-digit text, if both are there as times."""
    if not {spec.pickup, spec.dropoff} <= set(trips.columns):
        return trips
    return trips.withColumns({
        c: stamp(F.col(c)) for c in (spec.pickup, spec.dropoff)
        if not isinstance(trips.schema[c].dataType, T.StringType)
    })


def clean_trips(
    df: DataFrame, spec: TripSpec, stamped: bool = True, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Valid trips only. ``carry`` names extra columns to keep (e.g. the source file).

    A single narrow pass: no shuffle, and the number checks reach a Parquet scan.
    """
    trips = conform_trips(df, spec, carry)
    for _, valid in trip_checks(trips, spec):
        trips = trips.filter(valid)
    return stamp_times(trips, spec) if stamped else trips


def with_reject_reason(
    df: DataFrame, spec: TripSpec, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Trips plus ``reject_reason``: the first failed check, NULL for valid rows."""
    trips = conform_trips(df, spec, carry)
    failed = [
        F.when(~F.coalesce(valid, F.lit(False)), F.lit(reason))
        for reason, valid in trip_checks(trips, spec)
    ]
    return trips.withColumn("reject_reason", F.coalesce(*failed))


def canonical_trips(df: DataFrame, spec: TripSpec) -> DataFrame:
    """Type-independent names: taxi_type, pickup_ts, dropoff_ts."""
    return df.withColumnsRenamed({spec.pickup: "pickup_ts", spec.dropoff: "dropoff_ts"}).withColumn(
        "taxi_type", F.lit(spec.taxi_type)
    )
