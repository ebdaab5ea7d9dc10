"""Demand and pollution queries: views and clicks are demand, the rest is measured."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from curbair.analysis import relation as ops
from curbair.analysis.demand import hourly_demand
from curbair.operators import measurements, spines
from curbair.queries.registry import query
from curbair.queries.views import rounded, table
from curbair.sources.staging import staged

DEMAND = """
    SELECT date_trunc('hour', ts) AS datetime_hour, count(*) AS trips
    FROM events WHERE event_type IN ('view', 'click') GROUP BY 1
"""
AIR = """
    SELECT date_trunc('hour', ts) AS datetime_hour, event_type AS parameter,
           avg(value) AS value_mean, max(value) AS value_max
    FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY 1, 2
"""


def demand(spark: SparkSession, folder: str) -> DataFrame:
    trips = table(spark, folder, "events").filter(F.col("event_type").isin("view", "click"))
    return hourly_demand(trips, place=(), time="ts")


def air(spark: SparkSession, folder: str) -> DataFrame:
    readings = table(spark, folder, "events").filter(~F.col("event_type").isin("view", "click"))
    named = readings.withColumn("parameter", F.col("event_type"))
    stats = measurements.hourly_statistics(named, time="ts", keys=["parameter"])
    return stats.select("datetime_hour", "parameter", "value_mean", "value_max")


@query(f"""
    SELECT datetime_hour, parameter, trips, round(value_mean, 6) AS value_mean
    FROM ({AIR}) a JOIN ({DEMAND}) d USING (datetime_hour)
""")
def demand_air_join(spark: SparkSession, folder: str) -> DataFrame:
    met = ops.demand_air(demand(spark, folder), air(spark, folder).drop("value_max"))
    return rounded(met, "value_mean")


@query(f"""
    SELECT parameter, round(corr(CAST(trips AS DOUBLE), value_mean), 6) AS correlation,
           count(*) AS hours
    FROM ({AIR}) a JOIN ({DEMAND}) d USING (datetime_hour) GROUP BY 1
""")
def demand_air_corr(spark: SparkSession, folder: str) -> DataFrame:
    found = ops.demand_air_correlation(demand(spark, folder), air(spark, folder))
    return rounded(found, "correlation")


@query(f"""
    WITH lags AS (SELECT unnest(generate_series(0, 24)) AS lag_hours)
    SELECT parameter, CAST(lag_hours AS INTEGER) AS lag_hours,
           round(corr(CAST(trips AS DOUBLE), value_mean), 6) AS correlation, count(*) AS hours
    FROM ({DEMAND}) d CROSS JOIN lags JOIN ({AIR}) a
         ON a.datetime_hour = d.datetime_hour + to_hours(CAST(lag_hours AS BIGINT))
    GROUP BY 1, 2
""")
def lag_corr(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        ops.lag_correlation(demand(spark, folder), air(spark, folder), 24), "correlation"
    )


@query(f"""
    WITH lags AS (SELECT unnest(generate_series(0, 24)) AS lag_hours)
    SELECT parameter, CAST(lag_hours AS INTEGER) AS lag_hours,
           round(corr(CAST(trips AS DOUBLE), value_mean), 6) AS correlation, count(*) AS hours
    FROM ({DEMAND}) d CROSS JOIN lags JOIN ({AIR}) a
         ON a.datetime_hour = d.datetime_hour + to_hours(CAST(lag_hours AS BIGINT))
    GROUP BY 1, 2
""")
def lag_corr_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """All lags from dense blocks, each demand hour sent to two of them at most."""
    found = ops.lag_correlation_blocks(demand(spark, folder), air(spark, folder), 24, block_hours=168)
    return rounded(found, "correlation")


_SPINE = f"""
    SELECT s.parameter, s.datetime_hour, a.value_mean, a.value_max FROM (
      SELECT parameter, unnest(generate_series(min(datetime_hour), max(datetime_hour),
                               INTERVAL 1 HOUR)) AS datetime_hour
      FROM ({AIR}) x GROUP BY 1) s
    LEFT JOIN ({AIR}) a ON a.parameter = s.parameter AND a.datetime_hour = s.datetime_hour
"""


@query(f"SELECT parameter, datetime_hour, round(value_mean, 6) AS value_mean FROM ({_SPINE}) z")
def hourly_spine(spark: SparkSession, folder: str) -> DataFrame:
    series = air(spark, folder).drop("value_max")
    return rounded(spines.hourly_spine(series, ["parameter"]), "value_mean")


@query(f"""
    SELECT parameter, datetime_hour, value_max,
           round(avg(value_max) OVER (PARTITION BY parameter ORDER BY datetime_hour
                 ROWS BETWEEN 23 PRECEDING AND CURRENT ROW), 6) AS moving_mean
    FROM ({_SPINE}) z
""")
def moving_avg_24h(spark: SparkSession, folder: str) -> DataFrame:
    """Trend of the hourly peak."""
    averaged = ops.moving_average(air(spark, folder), ["parameter"], "value_max")
    return rounded(averaged, "moving_mean")


@query(f"""
    WITH cells AS (
      SELECT datetime_hour, parameter, trips, value_mean
      FROM ({AIR}) a JOIN ({DEMAND}) d USING (datetime_hour)),
    ranked AS (
      SELECT *, percent_rank() OVER (PARTITION BY parameter ORDER BY trips) AS by_trips,
             percent_rank() OVER (PARTITION BY parameter ORDER BY value_mean) AS by_air
      FROM cells)
    SELECT datetime_hour, parameter, trips, round(value_mean, 6) AS value_mean
    FROM ranked WHERE by_trips >= 0.8 AND by_air >= 0.8
""")
def hotspots(spark: SparkSession, folder: str) -> DataFrame:
    """All hours high in both demand and pollution."""
    cells = ops.demand_air(demand(spark, folder), air(spark, folder).drop("value_max"))
    return rounded(ops.hotspots(cells, 0.8), "value_mean")


@query("""
    WITH h AS (SELECT DISTINCT user_id, date_trunc('hour', ts) AS h FROM events),
    n AS (SELECT *, lead(h) OVER (PARTITION BY user_id ORDER BY h) AS following FROM h)
    SELECT user_id AS location_id, h + INTERVAL 1 HOUR AS gap_start, following AS gap_end,
           date_diff('hour', h, following) - 1 AS hours
    FROM n WHERE date_diff('hour', h, following) > 1
""")
def series_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of hours without a reading, per station."""
    named = table(spark, folder, "events").withColumn("location_id", F.col("user_id"))
    stats = measurements.hourly_statistics(named, time="ts", keys=["location_id"])
    return spines.series_gaps(staged(stats.select("location_id", "datetime_hour"), "hours"), ["location_id"], block_days=7)
