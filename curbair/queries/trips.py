"""Trip queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from curbair.analysis.demand import (
    attach_zones, demand_by_unit, demand_lattice as all_scales, demand_rollup as rollup_demand, hourly_demand,
)
from curbair.operators import quality, trips as trip_ops, unions
from curbair.operators.conform import conform
from curbair.operators.joins import unprocessed
from curbair.queries.registry import query
from curbair.queries.views import (
    CLEAN_TRIPS, RAW_TRIPS, ZONES, raw_trips, table, zones,
)
from curbair.schemas import GREEN, YELLOW
from curbair.sources.files import scan_parquet as scan


@query("SELECT * FROM orders")
def scan_parquet(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, f"{folder}/orders.parquet")


@query("""
    SELECT CAST(l_linenumber AS BIGINT) AS VendorID, l_tax AS trip_distance,
           l_partkey AS PULocationID, l_suppkey AS DOLocationID
    FROM lineitem
""")
def project_conform(spark: SparkSession, folder: str) -> DataFrame:
    """Green columns wanted, yellow times found: those are left out."""
    raw = raw_trips(spark, folder, YELLOW).drop("passenger_count")
    return trip_ops.conform_trips(raw, GREEN)


@query(f"""
    SELECT taxi_type, VendorID, strftime(pickup_ts, '%Y%m%d%H%M%S') AS pickup_ts,
           strftime(dropoff_ts, '%Y%m%d%H%M%S') AS dropoff_ts,
           passenger_count, trip_distance, PULocationID, DOLocationID
    FROM ({CLEAN_TRIPS}) clean
""")
def clean_trips(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_trips(spark, folder, YELLOW)
    cleaned = trip_ops.clean_trips(raw, YELLOW, carry=("taxi_type",))
    return cleaned.withColumnsRenamed({YELLOW.pickup: "pickup_ts", YELLOW.dropoff: "dropoff_ts"})


@query(f"""
    WITH marked AS (
      SELECT taxi_type, CASE
        WHEN NOT trip_distance > 0 THEN 'distance'
        WHEN NOT passenger_count > 0 THEN 'passengers'
        WHEN pickup_ts IS NULL OR dropoff_ts IS NULL THEN 'unparseable_time'
        WHEN NOT pickup_ts < dropoff_ts THEN 'time_order'
        WHEN NOT (PULocationID > 0 AND DOLocationID > 0) THEN 'location' END AS reason
      FROM ({RAW_TRIPS}) raw)
    SELECT taxi_type, count(*) AS rows_in, count(*) FILTER (reason IS NULL) AS rows_kept,
           count(*) FILTER (reason = 'distance') AS rejected_distance,
           count(*) FILTER (reason = 'passengers') AS rejected_passengers,
           count(*) FILTER (reason = 'unparseable_time') AS rejected_unparseable_time,
           count(*) FILTER (reason = 'time_order') AS rejected_time_order,
           count(*) FILTER (reason = 'location') AS rejected_location
    FROM marked GROUP BY taxi_type
""")
def clean_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.clean_report(raw_trips(spark, folder, GREEN), GREEN, by=("taxi_type",))


def _cleaned_file(spark: SparkSession, folder: str, taxi_type: str) -> DataFrame:
    """Cleaned trips of one instalment, as a merge reads them."""
    raw = raw_trips(spark, folder, YELLOW).filter(F.col("taxi_type") == taxi_type)
    return trip_ops.clean_trips(raw, YELLOW, stamped=False)


@query(f"""
    SELECT VendorID, strftime(pickup_ts, '%Y%m%d%H%M%S') AS tpep_pickup_datetime,
           strftime(dropoff_ts, '%Y%m%d%H%M%S') AS tpep_dropoff_datetime,
           passenger_count, trip_distance, PULocationID, DOLocationID
    FROM ({CLEAN_TRIPS}) clean ORDER BY pickup_ts NULLS LAST
""")
def merge_trips(spark: SparkSession, folder: str) -> DataFrame:
    parts = [_cleaned_file(spark, folder, t) for t in ("green", "yellow")]
    return unions.merge_trips(parts, YELLOW)


@query(f"""
    SELECT VendorID, pickup_ts AS tpep_pickup_datetime, dropoff_ts AS tpep_dropoff_datetime,
           CASE WHEN taxi_type = 'yellow' THEN passenger_count END AS passenger_count,
           trip_distance, PULocationID, DOLocationID,
           CASE WHEN taxi_type = 'green' THEN taxi_type END AS trip_type
    FROM ({RAW_TRIPS}) raw
""")
def union_missing_cols(spark: SparkSession, folder: str) -> DataFrame:
    """Two shapes of one data set: a column missing on either side."""
    raw = raw_trips(spark, folder, YELLOW)
    older = trip_ops.conform_trips(raw.filter("taxi_type = 'yellow'"), YELLOW)
    newer = conform(
        raw.filter("taxi_type = 'green'").withColumn("trip_type", F.col("taxi_type")),
        [c for c in YELLOW.columns if c != "passenger_count"] + ["trip_type"],
    )
    return unions.union_all([older, newer], casts={"VendorID": "bigint"})


@query(f"""
    SELECT t.VendorID, t.PULocationID, t.DOLocationID, t.trip_distance,
           p.Borough AS pickup_borough, p.Zone AS pickup_zone,
           d.Borough AS dropoff_borough, d.Zone AS dropoff_zone
    FROM ({RAW_TRIPS}) t LEFT JOIN ({ZONES}) p ON t.PULocationID = p.LocationID
         LEFT JOIN ({ZONES}) d ON t.DOLocationID = d.LocationID
""")
def zone_join(spark: SparkSession, folder: str) -> DataFrame:
    trips = conform(
        raw_trips(spark, folder), {
            "VendorID": "bigint", "PULocationID": "bigint", "DOLocationID": "bigint",
            "trip_distance": "double",
        })
    return attach_zones(trips, zones(spark, folder))


def demand(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = trip_ops.clean_trips(raw_trips(spark, folder), YELLOW, stamped=False)
    return hourly_demand(trip_ops.canonical_trips(cleaned, YELLOW))


@query(f"""
    SELECT date_trunc('hour', pickup_ts) AS datetime_hour, PULocationID, count(*) AS trips
    FROM ({CLEAN_TRIPS}) clean GROUP BY 1, 2
""")
def trip_demand_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return demand(spark, folder)


@query(f"""
    SELECT CAST(date_trunc('month', pickup_ts) AS TIMESTAMP) AS month_start, PULocationID,
           count(*) AS trips
    FROM ({CLEAN_TRIPS}) clean GROUP BY 1, 2
""")
def demand_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return demand_by_unit(demand(spark, folder), "month")


@query(f"""
    SELECT Borough AS at_borough, Zone AS at_zone, count(*) AS trips,
           CAST(grouping(Borough) AS BIGINT) AS all_boroughs,
           CAST(grouping(Zone) AS BIGINT) AS all_zones
    FROM ({CLEAN_TRIPS}) t LEFT JOIN ({ZONES}) z ON t.DOLocationID = z.LocationID
    GROUP BY ROLLUP (Borough, Zone)
""")
def demand_rollup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = trip_ops.clean_trips(raw_trips(spark, folder), YELLOW, stamped=False)
    return rollup_demand(cleaned, zones(spark, folder), "DOLocationID")


_PLACES = {"zone": "Borough AS borough, Zone AS zone", "borough": "Borough AS borough, NULL AS zone", "all": "NULL AS borough, NULL AS zone"}


@query(" UNION ALL ".join(f"""
    SELECT '{unit}' AS time_unit, CAST(date_trunc('{unit}', pickup_ts) AS TIMESTAMP) AS period_start,
           '{level}' AS place_level, {place}, count(*) AS trips
    FROM ({CLEAN_TRIPS}) t LEFT JOIN ({ZONES}) z ON t.DOLocationID = z.LocationID GROUP BY 1, 2, 3, 4, 5
""" for unit in ("hour", "day", "month") for level, place in _PLACES.items()))
def demand_lattice(spark: SparkSession, folder: str) -> DataFrame:
    """Demand at every scale of time and place, the trips read once."""
    cleaned = trip_ops.clean_trips(raw_trips(spark, folder), YELLOW, stamped=False)
    return all_scales(cleaned, zones(spark, folder), "DOLocationID", YELLOW.pickup)


@query("""
    SELECT 'part_' || CAST(p_partkey AS VARCHAR) || '.csv' AS source_file, p_brand AS dataset
    FROM part WHERE p_partkey NOT IN
          (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_tax = 0)
""")
def anti_unprocessed(spark: SparkSession, folder: str) -> DataFrame:
    """Files listed by part without a finished output; untaxed returns stand for outputs."""

    def named(column: str):
        return F.concat(F.lit("part_"), F.col(column), F.lit(".csv")).alias("source_file")

    inputs = table(spark, folder, "part").select(named("p_partkey"), F.col("p_brand").alias("dataset"))
    returned = table(spark, folder, "lineitem").filter("l_returnflag = 'R' AND l_tax = 0")
    done = returned.select(named("l_partkey"))
    return unprocessed(inputs, done)
