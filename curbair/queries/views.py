"""The given tables in the shape of the library's data sets, and the same in SQL.

    events          measurements: station = user, parameter = event type
    lineitem        raw trips; the line status stands for the taxi type
    supplier        zones, with nation and region as zone group and borough
    customer        stations
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from curbair.functions.times import add_minutes
from curbair.schemas import TripSpec, YELLOW


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def flat_measurements(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("ts").alias("datetimeUtc"),
        F.col("user_id").alias("location_id"),
        F.col("event_type").alias("parameter"),
        F.lit("unit").alias("unit"),
        "value",
    )


def stations(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    return customer.select(
        F.col("c_custkey").alias("location_id"),
        F.col("c_name").alias("location_name"),
        F.col("c_mktsegment").alias("timezone"),
        F.col("c_acctbal").alias("latitude"),
        F.col("c_nationkey").cast("double").alias("longitude"),
        F.col("c_nationkey").cast("string").alias("country_iso"),
        (F.col("c_acctbal") < 0).alias("isMobile"),
        (F.col("c_acctbal") >= 5000).alias("isMonitor"),
    )


STATIONS = """
    SELECT c_custkey AS location_id, c_name AS location_name, c_mktsegment AS timezone,
           c_acctbal AS latitude, CAST(c_nationkey AS DOUBLE) AS longitude,
           CAST(c_nationkey AS VARCHAR) AS country_iso,
           c_acctbal < 0 AS isMobile, c_acctbal >= 5000 AS isMonitor
    FROM customer
"""


def raw_trips(spark: SparkSession, folder: str, spec: TripSpec = YELLOW) -> DataFrame:
    """All line items as raw trips of one type, next to columns cleaning drops."""
    item = table(spark, folder, "lineitem")
    started = add_minutes(F.col("l_shipdate"), F.col("l_quantity") * 37)
    ended = add_minutes(F.col("l_shipdate"), F.floor(F.col("l_extendedprice") / 60))
    return item.select(
        F.col("l_linenumber").alias("VendorID"),
        started.alias(spec.pickup),
        ended.alias(spec.dropoff),
        F.col("l_discount").alias("passenger_count"),
        F.col("l_tax").alias("trip_distance"),
        F.col("l_partkey").alias("PULocationID"),
        F.col("l_suppkey").alias("DOLocationID"),
        F.when(F.col("l_linestatus") == "O", "green").otherwise("yellow").alias("taxi_type"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        F.col("l_extendedprice").alias("total_amount"),
    )


RAW_TRIPS = """
    SELECT CAST(l_linenumber AS BIGINT) AS VendorID,
           l_shipdate + to_minutes(CAST(l_quantity * 37 AS BIGINT)) AS pickup_ts,
           l_shipdate + to_minutes(CAST(floor(l_extendedprice / 60) AS BIGINT)) AS dropoff_ts,
           l_discount AS passenger_count, l_tax AS trip_distance,
           l_partkey AS PULocationID, l_suppkey AS DOLocationID,
           CASE WHEN l_linestatus = 'O' THEN 'green' ELSE 'yellow' END AS taxi_type
    FROM lineitem
"""

CLEAN_TRIPS = f"""
    SELECT * FROM ({RAW_TRIPS}) raw
    WHERE trip_distance > 0 AND passenger_count > 0 AND pickup_ts < dropoff_ts
      AND PULocationID > 0 AND DOLocationID > 0
"""


def zones(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return (
        table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.col("n_name").alias("Zone"),
        )
    )


ZONES = """
    SELECT s_suppkey AS LocationID, r_name AS Borough, n_name AS Zone
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey
"""


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Floating results to six digits: their last bits depend on summation order."""
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})
