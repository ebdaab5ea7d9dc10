"""Measurement queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from curbair.functions.values import field_or
from curbair.operators import impute as imputing, measurements as ops, organise, unions
from curbair.operators.conform import fill_defaults as fill
from curbair.operators.joins import known_ids, lookup_join
from curbair.operators.spines import period_spine, uncovered_ranges
from curbair.plans.manifest import finished, read_manifest
from curbair.plans.measurements import DATASET, land_days, read_hourly
from curbair.queries.registry import query
from curbair.queries.views import (
    STATIONS, flat_measurements, rounded, stations, table,
)
from curbair.schemas import FACT_COLUMNS, STATION_COLUMNS
from curbair.sources import extents
from curbair.sources.staging import fresh_path, staged

STATS = """round(avg(value), 6) AS value_mean, min(value) AS value_min,
           max(value) AS value_max, count(value) AS value_count"""

HOURLY = f"""
    SELECT date_trunc('hour', ts) AS datetime_hour, user_id AS location_id,
           event_type AS parameter, 'unit' AS unit, {STATS}
    FROM events GROUP BY 1, 2, 3, 4
"""


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    return ops.hourly_statistics(flat_measurements(spark, folder))


@query(HOURLY)
def hourly_agg(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(hourly(spark, folder), "value_mean")


@query(f"""
    SELECT date_trunc('hour', CASE WHEN event_type = 'error' AND user_id % 2 = 0 THEN NULL ELSE ts END) AS datetime_hour,
           user_id AS location_id, event_type AS parameter, 'unit' AS unit, {STATS}
    FROM events GROUP BY 1, 2, 3, 4
""")
def rolling_land(spark: SparkSession, folder: str) -> DataFrame:
    """Three requests that overlap, landed one after the other: every hour once, and so
    are the rows without a time."""
    untimed = (F.col("parameter") == "error") & (F.col("location_id") % 2 == 0)
    flat = flat_measurements(spark, folder).withColumn(
        "datetimeUtc", F.when(untimed, None).otherwise(F.col("datetimeUtc")))
    first, last = flat.agg(F.min("datetimeUtc").cast("date"), F.max("datetimeUtc").cast("date")).first()
    third = (last - first) // 3
    out, manifest = fresh_path(spark, "rolling-hours"), fresh_path(spark, "rolling-manifest")
    for number, (start, end) in enumerate([(first, first + 2 * third), (first + third, last - third // 2), (first, last)]):
        request = spark.createDataFrame([(start, end)], "since date, until date").select(
            F.col("since").cast("timestamp_ntz"), (F.col("until").cast("timestamp_ntz") + F.expr(
                "interval '0 23:59:59.999999' day to second")).alias("until"))
        covered = finished(read_manifest(spark, manifest), DATASET).select(
            F.col("range_start").alias("period_start"), F.col("range_end").alias("period_end"))
        ranges = staged(uncovered_ranges(period_spine(request, "since", "until"), covered), "open-ranges")
        land_days(flat, out, ranges, f"r{number}", manifest)
    return rounded(read_hourly(spark, out, manifest), "value_mean")


@query(f"""
    SELECT date_trunc('hour', ts) AS datetime_hour, nullif(event_type, 'error') AS parameter,
           nullif(user_id, 8) AS location_id, {STATS}
    FROM events GROUP BY 1, 2, 3
""")
def group_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Missing station or parameter forms groups of its own."""
    flat = flat_measurements(spark, folder).withColumns({
        "parameter": F.nullif(F.col("parameter"), F.lit("error")),
        "location_id": F.nullif(F.col("location_id"), F.lit(8)),
    })
    stats = ops.hourly_statistics(flat, keys=["parameter", "location_id"])
    return rounded(stats, "value_mean")


# --- nested pages ------------------------------------------------------------

# (parameter name, unit, line item column) of the four sensors of a station page
SENSORS = [
    ("quantity", "pieces", "l_quantity"),
    ("price", "currency", "l_extendedprice"),
    ("discount", "share", "l_discount"),
    ("tax", "share", "l_tax"),
]


def station_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as landed station pages: one supplier, four sensors each.

    A sensor whose value is 0 has an empty measurement list, and suppliers of
    returned items have no coordinates.
    """
    def sensor(number: int, name: str, unit: str, value: str) -> Column:
        parameter = F.struct(
            F.lit(number).cast("bigint").alias("id"), F.lit(name).alias("name"),
            F.lit(unit).alias("units"), F.lit(name).alias("display_name"),
        )
        instant = F.struct("utc", F.lit(None).cast("string").alias("local"))
        one = F.struct(
            F.struct(instant.alias("datetimeFrom")).alias("period"),
            parameter.alias("parameter"),
            F.col(value).alias("value"),
        )
        listed = F.array(one)
        return F.struct(
            F.lit(str(number)).alias("id"), parameter.alias("parameter"),
            F.when(F.col(value) != 0, listed).otherwise(F.slice(listed, 1, 0)).alias("measurements"),
        )

    point = F.struct(
        F.col("l_tax").alias("latitude"), F.col("l_discount").alias("longitude")
    )
    utc = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return table(spark, folder, "lineitem").withColumn("utc", utc).select(
        F.col("l_suppkey").alias("id"),
        F.concat(F.lit("station "), F.col("l_linenumber")).alias("name"),
        F.lit(None).cast("string").alias("timezone"),
        F.when(F.col("l_returnflag") != "R", point).alias("coordinates"),
        (F.col("l_linestatus") == "O").alias("isMonitor"),
        F.array(*[sensor(i, *s) for i, s in enumerate(SENSORS)]).alias("sensors"),
    )


_FLAT_SELECT = " UNION ALL ".join(f"""
    SELECT CAST(l_suppkey AS VARCHAR) AS location_id,
           'station ' || CAST(l_linenumber AS VARCHAR) AS location_name,
           '{name}' AS parameter, {column} AS value, '{unit}' AS unit,
           strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS datetimeUtc, '' AS datetimeLocal,
           '' AS timezone,
           CASE WHEN l_returnflag <> 'R' THEN l_tax END AS latitude,
           CASE WHEN l_returnflag <> 'R' THEN l_discount END AS longitude,
           '' AS country_iso, false AS isMobile, l_linestatus = 'O' AS isMonitor,
           '' AS owner_name, '' AS provider
    FROM lineitem WHERE {column} <> 0""" for name, unit, column in SENSORS)


@query(_FLAT_SELECT)
def nested_flatten(spark: SparkSession, folder: str) -> DataFrame:
    return ops.flatten_stations(station_pages(spark, folder))


@query("""
    SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           '' AS unit, 0.0::DOUBLE AS latitude
    FROM events
""")
def json_field_default(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded JSON: a field that is there, one that is not, one below a missing object."""
    shape = "struct<k: bigint, unit: string, coordinates: struct<latitude: double>>"
    decoded = table(spark, folder, "events").select("event_id", F.from_json("props", shape).alias("p"))
    schema = decoded.schema
    return decoded.select(
        "event_id",
        F.col("p.k").alias("k"),
        field_or(schema, "p.unit", F.lit("")).alias("unit"),
        field_or(schema, "p.coordinates.latitude", F.lit(0.0)).alias("latitude"),
    )


@query("""
    SELECT l_orderkey, l_partkey, coalesce(nullif(l_returnflag, 'R'), '') AS location_name,
           coalesce(nullif(l_tax, 0.05), 0) AS latitude,
           CASE WHEN l_linestatus = 'O' THEN true ELSE false END AS isMobile
    FROM lineitem
""")
def fill_defaults(spark: SparkSession, folder: str) -> DataFrame:
    gaps = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey",
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("location_name"),
        F.nullif(F.col("l_tax"), F.lit(0.05)).alias("latitude"),
        F.when(F.col("l_linestatus") == "O", F.lit(True)).alias("isMobile"),
    )
    return fill(gaps)


# --- filters -----------------------------------------------------------------

START, END = "2024-01-08T00:00:00Z", "2024-01-20T23:59:59Z"


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements with text times; those of errors do not parse."""
    iso = F.date_format("datetimeUtc", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    flat = flat_measurements(spark, folder)
    return flat.withColumn(
        "datetimeUtc", F.when(F.col("parameter") == "error", F.lit("n/a")).otherwise(iso)
    )


@query("""
    SELECT user_id AS location_id, event_type AS parameter, value,
           CASE WHEN event_type = 'error' THEN 'n/a'
                ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS datetimeUtc
    FROM events
    WHERE event_type = 'error' OR date_trunc('second', ts) BETWEEN
          TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-20 23:59:59'
""")
def filter_time_range(spark: SparkSession, folder: str) -> DataFrame:
    kept = ops.filter_time_range(texts(spark, folder), "datetimeUtc", START, END)
    return kept.drop("unit")


@query("""
    SELECT count(*) AS total,
           count(*) FILTER (NOT (ts BETWEEN TIMESTAMP '2024-01-08 00:00:00'
                                 AND TIMESTAMP '2024-01-20 23:59:59')) AS filtered_out,
           count(*) FILTER (ts BETWEEN TIMESTAMP '2024-01-08 00:00:00'
                            AND TIMESTAMP '2024-01-20 23:59:59') AS kept,
           count(*) FILTER (ts IS NULL) AS without_time
    FROM events
""")
def time_range_report(spark: SparkSession, folder: str) -> DataFrame:
    return ops.time_range_report(flat_measurements(spark, folder), "datetimeUtc", START, END)


@query("""
    SELECT * FROM part WHERE p_size BETWEEN 10 AND 30 AND p_retailprice BETWEEN 950 AND 1050
""")
def filter_bbox(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return ops.filter_bbox(part, (10, 950.0, 30, 1050.0), "p_size", "p_retailprice", True)


@query("""
    SELECT user_id AS location_id, event_type AS parameter, ts AS datetimeUtc, value FROM events
    WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
      AND event_type IN ('purchase', 'signup')
""")
def filter_id_list(spark: SparkSession, folder: str) -> DataFrame:
    flat = flat_measurements(spark, folder).drop("unit")
    listed = ops.filter_values(stations(spark, folder), timezone="BUILDING")
    wanted = ops.filter_values(flat, parameter=["purchase", "signup"])
    return known_ids(wanted, listed, "location_id", require_known=False)


@query("SELECT * FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'")
def filter_parameter_station(spark: SparkSession, folder: str) -> DataFrame:
    return ops.filter_values(table(spark, folder, "lineitem"), l_returnflag="A", l_linestatus="F")


EXTENT_BOX = (0.0, 0.0, 12.0, 5000.0)
_LOCATED = f"""
    SELECT ts AS datetimeUtc, user_id AS location_id, event_type AS parameter, value, longitude, latitude
    FROM events JOIN ({STATIONS}) s ON user_id = s.location_id
"""


def _landed_files(spark: SparkSession, folder: str) -> str:
    """Located measurements as many files, each of a few hours; the folder."""
    where = stations(spark, folder).select("location_id", "longitude", "latitude")
    flat = ops.attach_stations(flat_measurements(spark, folder).drop("unit"), where)
    path = fresh_path(spark, "extent-files")
    flat.repartitionByRange(64, "datetimeUtc").write.parquet(path)
    return path


@query(f"""
    SELECT * FROM ({_LOCATED}) l
    WHERE date_trunc('second', datetimeUtc) BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-09 11:59:59'
      AND longitude BETWEEN {EXTENT_BOX[0]} AND {EXTENT_BOX[2]} AND latitude BETWEEN {EXTENT_BOX[1]} AND {EXTENT_BOX[3]}
""")
def extent_range(spark: SparkSession, folder: str) -> DataFrame:
    """A range and a box from landed files, of which only those are opened that the index
    says can match."""
    path, index = _landed_files(spark, folder), fresh_path(spark, "extents")
    scan = extents.parquet_rows(spark)
    extents.update_index(spark, path, index, scan)
    return extents.read_range(spark, path, index, scan, "2024-01-08T00:00:00Z", "2024-01-09T11:59:59Z", EXTENT_BOX)


@query(f"""
    SELECT count(*) AS measurements, count(*) FILTER (datetimeUtc IS NULL) AS untimed,
           min(datetimeUtc) AS first_time, max(datetimeUtc) AS last_time,
           min(longitude) AS min_longitude, max(latitude) AS max_latitude
    FROM ({_LOCATED}) l
""")
def extent_index(spark: SparkSession, folder: str) -> DataFrame:
    """What the index holds of all files together."""
    path, index = _landed_files(spark, folder), fresh_path(spark, "extents")
    extents.update_index(spark, path, index, extents.parquet_rows(spark))
    extents.update_index(spark, path, index, extents.parquet_rows(spark))  # nothing is new
    return extents.read_index(spark, index).agg(
        F.sum("measurements").alias("measurements"), F.sum("untimed").alias("untimed"),
        F.min("first_time").cast("timestamp_ntz").alias("first_time"), F.max("last_time").cast("timestamp_ntz").alias("last_time"),
        F.min("min_longitude").alias("min_longitude"), F.max("max_latitude").alias("max_latitude"))


# --- imputation --------------------------------------------------------------


def _fill(value: str, group: str) -> str:
    mean = f"avg(nullif({value}, 0)) OVER (PARTITION BY {group})"
    return (f"round(CASE WHEN {value} IS NULL OR {value} = 0 THEN coalesce({mean}, 0) "
            f"ELSE {value} END, 6)")


@query(f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_linestatus,
           {_fill('l_discount', 'l_returnflag, l_linestatus')} AS value
    FROM lineitem
""")
def impute_group_mean(spark: SparkSession, folder: str) -> DataFrame:
    item = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        F.col("l_discount").alias("value"),
    )
    return rounded(imputing.impute(item, ["l_returnflag", "l_linestatus"]), "value")


@query(f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_linestatus,
           {_fill('l_discount', 'l_returnflag, l_linestatus')} AS value
    FROM lineitem
""")
def impute_from_increments(spark: SparkSession, folder: str) -> DataFrame:
    """Three increments landed one after the other; the fill uses their kept parts."""
    keys = ["l_returnflag", "l_linestatus"]
    item = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", *keys, "l_linenumber", F.col("l_discount").alias("value"))
    path = fresh_path(spark, "mean-parts")
    for number in range(3):
        new = item.filter(F.col("l_linenumber") % 3 == number)
        imputing.add_mean_increment(new, path, f"i{number}", keys, ["value"])
    imputing.add_mean_increment(item.filter("l_linenumber % 3 = 1"), path, "i1", keys, ["value"])  # landed again
    filled = imputing.impute(item.drop("l_linenumber"), keys, ["value"], means=imputing.read_means(spark, path))
    return rounded(filled, "value")


@query(f"""
    SELECT l_orderkey, l_returnflag AS parameter, l_suppkey AS location_id,
           {_fill('l_discount', 'l_returnflag, l_suppkey')} AS value_mean,
           {_fill('l_tax', 'l_returnflag, l_suppkey')} AS value_min,
           {_fill('(l_linenumber - 1)', 'l_returnflag, l_suppkey')} AS value_count
    FROM lineitem
""")
def impute_all_value_cols(spark: SparkSession, folder: str) -> DataFrame:
    fact = _value_columns(table(spark, folder, "lineitem"))
    filled = imputing.impute(fact, ["parameter", "location_id"])
    return rounded(filled, "value_mean", "value_min", "value_count")


def _value_columns(item: DataFrame) -> DataFrame:
    return item.select(
        "l_orderkey", F.col("l_returnflag").alias("parameter"),
        F.col("l_suppkey").alias("location_id"), F.col("l_discount").alias("value_mean"),
        F.col("l_tax").alias("value_min"), (F.col("l_linenumber") - 1).alias("value_count"),
    )


_STATS_OF_ITEMS = """
    SELECT l_shipdate AS datetime_hour, l_linestatus AS location_id, l_returnflag AS parameter,
           avg(l_discount) AS value_mean, min(l_discount) AS value_min,
           max(l_discount) AS value_max, count(l_discount) AS value_count
    FROM lineitem GROUP BY 1, 2, 3
"""


@query(f"""
    SELECT datetime_hour, location_id, parameter,
           {', '.join(_fill(c, 'parameter, location_id') + ' AS ' + c
                      for c in ('value_mean', 'value_min', 'value_max', 'value_count'))}
    FROM ({_STATS_OF_ITEMS}) s
""")
def impute_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly statistics with their zeros filled, column by column."""
    flat = table(spark, folder, "lineitem").select(
        F.col("l_shipdate").alias("datetimeUtc"), F.col("l_linestatus").alias("location_id"),
        F.col("l_returnflag").alias("parameter"), F.col("l_discount").alias("value"),
    )
    stats = staged(ops.hourly_statistics(flat), "hourly")
    filled = imputing.impute(stats, ["parameter", "location_id"])
    return rounded(filled, "value_mean", "value_min", "value_max", "value_count")


_PROFILE = " UNION ALL ".join(f"""
    SELECT l_returnflag AS parameter, l_suppkey AS location_id, '{name}' AS column_name,
           count(*) FILTER ({value} IS NULL) AS nulls, count(*) FILTER ({value} = 0) AS zeros,
           round(coalesce(avg(nullif({value}, 0)), 0), 6) AS fill_mean
    FROM lineitem GROUP BY 1, 2""" for name, value in [
    ("value_mean", "l_discount"), ("value_min", "l_tax"), ("value_count", "(l_linenumber - 1)"),
])


@query(_PROFILE)
def missing_profile(spark: SparkSession, folder: str) -> DataFrame:
    fact = _value_columns(table(spark, folder, "lineitem"))
    return rounded(imputing.missing_profile(fact, ["parameter", "location_id"]), "fill_mean")


# --- stations and facts ------------------------------------------------------

STATION_LIST = ", ".join(STATION_COLUMNS)


def located(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly measurements with the attributes of their station on every row."""
    flat = ops.attach_stations(flat_measurements(spark, folder), stations(spark, folder))
    return ops.hourly_statistics(flat)


@query(f"""
    SELECT DISTINCT {STATION_LIST}
    FROM events JOIN ({STATIONS}) s ON user_id = s.location_id
""")
def station_dimension(spark: SparkSession, folder: str) -> DataFrame:
    flat = ops.attach_stations(flat_measurements(spark, folder), stations(spark, folder))
    return organise.station_dimension(flat)


@query(f"""
    SELECT h.datetime_hour, h.parameter, h.value_mean, h.value_count, s.*
    FROM ({HOURLY}) h LEFT JOIN ({STATIONS}) s ON h.location_id = s.location_id
""")
def station_join(spark: SparkSession, folder: str) -> DataFrame:
    """Facts re-attached to their station by id."""
    fact = hourly(spark, folder).select(
        "datetime_hour", "parameter", "value_mean", "value_count", "location_id"
    )
    joined = lookup_join(fact, stations(spark, folder), ["location_id"], computed=True)
    return rounded(joined, "value_mean")


@query(f"""
    SELECT strftime(datetime_hour, '%Y%m%d%H%M%S') AS datetime_hour,
           {', '.join(FACT_COLUMNS[1:])} FROM ({HOURLY}) h
""")
def organize_fact(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(organise.organised_fact(hourly(spark, folder)), "value_mean")


@query("""
    SELECT strftime(min(date_trunc('hour', ts)), '%Y%m%d') AS first_day,
           strftime(max(date_trunc('hour', ts)), '%Y%m%d') AS last_day FROM events
""")
def time_extent(spark: SparkSession, folder: str) -> DataFrame:
    return organise.time_extent(flat_measurements(spark, folder), time="datetimeUtc")


@query("""
    SELECT event_type AS parameter, count(DISTINCT user_id) AS stations FROM events GROUP BY 1
""")
def stations_per_parameter(spark: SparkSession, folder: str) -> DataFrame:
    return organise.stations_per_parameter(flat_measurements(spark, folder))


@query(f"""
    SELECT parameter, location_id, count(*) AS "rows" FROM ({HOURLY}) h GROUP BY 1, 2
""")
def rows_per_partition(spark: SparkSession, folder: str) -> DataFrame:
    return organise.rows_per_partition(hourly(spark, folder))


@query("""
    SELECT user_id AS location_id, event_type AS parameter, min(ts) AS first_time,
           max(ts) AS last_time, count(*) AS measurements
    FROM events GROUP BY 1, 2
""")
def sensor_extent(spark: SparkSession, folder: str) -> DataFrame:
    return ops.sensor_extent(flat_measurements(spark, folder), ["location_id", "parameter"])


@query(f"SELECT *, NULL::VARCHAR AS provider FROM ({HOURLY}) h "
       "WHERE datetime_hour < TIMESTAMP '2024-01-16' UNION ALL "
       f"SELECT *, 'p' AS provider FROM ({HOURLY}) h "
       "WHERE datetime_hour >= TIMESTAMP '2024-01-16' ORDER BY datetime_hour")
def merge_measurements(spark: SparkSession, folder: str) -> DataFrame:
    """Two period files whose count column drifted in type, one with an extra column."""
    flat = flat_measurements(spark, folder)
    first = ops.hourly_statistics(flat.filter("datetimeUtc < timestamp_ntz'2024-01-16'"))
    second = ops.hourly_statistics(flat.filter("datetimeUtc >= timestamp_ntz'2024-01-16'"))
    drifted = second.withColumns({
        "value_count": F.col("value_count").cast("double"), "provider": F.lit("p"),
    })
    periods = [staged(first, "period"), staged(drifted, "period")]
    merged = unions.merge_measurements(periods, casts={"value_count": "bigint"})
    return rounded(merged, "value_mean")
