"""Round trips through sinks, sources and streams.

Everything is written below the session's shared folder, to a new path each time.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from curbair.functions.names import base_name
from curbair.operators import intervals, partials, quality, spines
from curbair.operators.measurements import hourly_statistics
from curbair.operators.organise import organised_fact, time_extent
from curbair.operators.unions import distinct_rows, union_all
from curbair.plans import sorted_set
from curbair.plans.runs import run_trips
from curbair.queries.measurements import HOURLY
from curbair.queries.registry import query
from curbair.queries.trips import clean_report as trip_report
from curbair.queries.views import CLEAN_TRIPS, RAW_TRIPS, flat_measurements, raw_trips, rounded, table
from curbair.schemas import TRIP_SPECS, YELLOW
from curbair.sources import files, sinks
from curbair.sources.catalogue import explode_catalogue
from curbair.sources.staging import fresh_path
from curbair.streaming.arrivals import write_once
from curbair.streaming.hourly import closed_hours, write_parts
from curbair.streaming.trips import clean_arrivals, trip_stream


@query("SELECT * FROM customer")
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    source = table(spark, folder, "customer")
    path = fresh_path(spark, "csv-roundtrip")
    sinks.write_csv(source, path)
    return files.scan_csv(spark, path, source.schema)


@query("SELECT * FROM orders")
def convert_parquet(spark: SparkSession, folder: str) -> DataFrame:
    """Orders converted from Parquet to CSV and read back."""
    path = fresh_path(spark, "converted")
    sinks.convert_parquet_to_csv(spark, folder, path, pattern="orders.parquet")
    schema = table(spark, folder, "orders").schema
    return files.scan_csv(spark, f"{path}/source_file=orders.parquet", schema)


@query("""
    SELECT strftime(l_shipdate, '%Y%m%d%H%M%S') AS datetime_hour, l_linestatus AS location_id,
           l_returnflag AS parameter, 'pieces' AS unit, round(avg(l_quantity), 6) AS value_mean,
           min(l_quantity) AS value_min, max(l_quantity) AS value_max,
           count(l_quantity) AS value_count,
           l_returnflag AS parameter_p, l_linestatus AS location_id_p
    FROM lineitem GROUP BY l_shipdate, l_linestatus, l_returnflag
""")
def organised_layout(spark: SparkSession, folder: str) -> DataFrame:
    """Facts written by (parameter, station) and read back, bodies and paths."""
    flat = table(spark, folder, "lineitem").select(
        F.col("l_shipdate").alias("datetimeUtc"), F.col("l_linestatus").alias("location_id"),
        F.col("l_returnflag").alias("parameter"), F.lit("pieces").alias("unit"),
        F.col("l_quantity").alias("value"),
    )
    fact = organised_fact(hourly_statistics(flat))
    path = fresh_path(spark, "organised")
    sinks.write_by_group(fact, path, ["parameter", "location_id"], fmt="parquet",
                         sort_by=["datetime_hour"])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fact.schema.fields)
    paths = "parameter_p string, location_id_p string"
    return rounded(spark.read.schema(f"{schema}, {paths}").parquet(path), "value_mean")


@query(f"""
    SELECT VendorID, pickup_ts AS tpep_pickup_datetime, dropoff_ts AS tpep_dropoff_datetime,
           passenger_count, trip_distance, PULocationID, DOLocationID
    FROM ({CLEAN_TRIPS}) clean
""")
def incremental_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Trips landed in two instalments, each cleaned by one run of the stream."""
    landing, output, progress = (
        fresh_path(spark, name) for name in ("landing", "cleaned", "progress")
    )
    raw = raw_trips(spark, folder, YELLOW)
    for instalment in ("green", "yellow"):
        raw.filter(F.col("taxi_type") == instalment).write.mode("append").parquet(landing)
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in raw.schema.fields)
        stream = trip_stream(spark, landing, YELLOW, schema, "parquet", pattern="*.parquet")
        clean_arrivals(stream, YELLOW, output, progress).awaitTermination()
    kept = ", ".join(f"{c} {t}" for c, t in YELLOW.columns.items())
    return spark.read.schema(kept).parquet(output).drop("source_file")


@query(f"""
    SELECT taxi_type, VendorID, strftime(pickup_ts, '%Y%m%d%H%M%S') AS pickup,
           strftime(dropoff_ts, '%Y%m%d%H%M%S') AS dropoff,
           passenger_count, trip_distance, PULocationID, DOLocationID
    FROM ({CLEAN_TRIPS}) clean
""")
def merge_files(spark: SparkSession, folder: str) -> DataFrame:
    """Trips as CSV files per taxi type, ids written as decimals, cleaned and merged by one run."""
    raw, work, output = (fresh_path(spark, name) for name in ("raw", "work", "merged"))
    decimals = {c: F.col(c).cast("double") for c in ("VendorID", "PULocationID", "DOLocationID")}
    for taxi_type, spec in TRIP_SPECS.items():
        mine = raw_trips(spark, folder, spec).filter(F.col("taxi_type") == taxi_type)
        sinks.write_csv(mine.drop("taxi_type").withColumns(decimals), f"{raw}/{taxi_type}_all.csv")
    paths = run_trips(spark, raw, work, output, date(1992, 1, 1), date(1998, 12, 31), "run")
    return union_all([
        spark.read.parquet(paths[taxi_type]).select(
            F.lit(taxi_type).alias("taxi_type"), "VendorID", F.col(spec.pickup).alias("pickup"),
            F.col(spec.dropoff).alias("dropoff"), "passenger_count", "trip_distance", "PULocationID", "DOLocationID")
        for taxi_type, spec in TRIP_SPECS.items() if taxi_type in paths
    ])


@query("""
    WITH kept AS (SELECT * FROM orders WHERE o_orderkey % 7 <> 0 OR o_orderstatus <> 'P')
    SELECT o.o_custkey, CAST(max(n) AS BIGINT) AS expected, count(*) AS received, count(*) >= max(n) AS complete
    FROM kept o JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) a USING (o_custkey)
    GROUP BY o.o_custkey
""")
def page_completeness(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as landed pages of their customer; some of the pending ones did not arrive."""
    orders = table(spark, folder, "orders")
    announced = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("expected_pages"))
    landed = orders.filter("o_orderkey % 7 <> 0 OR o_orderstatus <> 'P'")
    pages = landed.join(announced, "o_custkey").withColumn("page", F.col("o_orderkey"))
    return quality.page_completeness(pages, ["o_custkey"])


@query("""
    SELECT o_orderpriority AS dataset, o_orderstatus AS status, count(*) AS files FROM orders GROUP BY 1, 2
""")
def status_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as files of a manifest, counted by data set and status."""
    manifest = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("dataset"), F.col("o_orderstatus").alias("status"))
    return quality.status_totals(manifest)


@query(HOURLY)
def hourly_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly statistics merged from increments that overlap in time."""
    flat = flat_measurements(spark, folder)
    path = fresh_path(spark, "increments")
    cheap = F.col("value") < 50
    for name, rows in (("a", flat.filter(cheap)), ("b", flat.filter(~cheap | F.col("value").isNull()))):
        partials.add_increment(rows, path, name)
    return rounded(partials.read_increments(spark, path), "value_mean")


@query(f"""
    WITH counted AS (
      SELECT taxi_type, count(*) AS rows_in,
             count(*) FILTER (WHERE NOT trip_distance > 0) AS rejected_distance
      FROM ({RAW_TRIPS}) raw GROUP BY 1)
    SELECT 'run' AS run_id, 'trips' AS dataset, taxi_type AS source_file,
           'rows_in' AS metric, CAST(rows_in AS DOUBLE) AS value FROM counted
    UNION ALL
    SELECT 'run', 'trips', taxi_type, 'rejected_distance', CAST(rejected_distance AS DOUBLE)
    FROM counted
""")
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    counts = trip_report(spark, folder).select("taxi_type", "rows_in", "rejected_distance")
    return quality.as_report(counts, "run", "trips", "taxi_type")


@query("""
    WITH requests AS (
      SELECT o_orderpriority, min(o_orderdate) AS since, max(o_orderdate) AS until
      FROM orders GROUP BY 1),
    wanted AS (
      SELECT o_orderpriority, unnest(generate_series(since, until, INTERVAL 1 DAY)) AS day
      FROM requests),
    months AS (
      SELECT w.*, date_diff('month', date_trunc('month', since), date_trunc('month', day)) // 2 AS n
      FROM wanted w JOIN requests USING (o_orderpriority)),
    open_days AS (
      SELECT * FROM months WHERE day NOT IN (
        SELECT o_orderdate FROM orders WHERE o_totalprice > 450000)),
    runs AS (
      SELECT *, day - to_days(CAST(row_number() OVER (
               PARTITION BY o_orderpriority, n ORDER BY day) AS INTEGER)) AS run
      FROM open_days)
    SELECT o_orderpriority, strftime(min(day), '%Y-%m-%d') AS range_start,
           strftime(max(day) + INTERVAL 1 DAY, '%Y-%m-%d') AS range_end
    FROM runs GROUP BY o_orderpriority, n, run
""")
def uncovered_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Days of each priority's order history without a large order, as ranges per period."""
    orders = table(spark, folder, "orders")
    requests = orders.groupBy("o_orderpriority").agg(
        F.min("o_orderdate").alias("since"), F.max("o_orderdate").alias("until")
    )
    periods = spines.period_spine(requests, "since", "until")
    covered = orders.filter("o_totalprice > 450000").select(
        F.col("o_orderdate").alias("period_start"),
        (F.col("o_orderdate") + F.expr("interval 1 day")).alias("period_end"),
    )
    found = spines.uncovered_ranges(periods, covered, keys=("o_orderpriority", "period_name"))
    return found.select(
        "o_orderpriority",
        F.date_format("range_start", "yyyy-MM-dd").alias("range_start"),
        F.date_format("range_end", "yyyy-MM-dd").alias("range_end"),
    )


@query("""
    SELECT strftime(o_orderdate, '%Y') AS "year", strftime(o_orderdate, '%m') AS "month",
           o_orderstatus AS type,
           'http://host/' || CAST(o_orderkey AS VARCHAR) || '.parquet' AS url,
           CAST(o_orderkey AS VARCHAR) || '.parquet' AS source_file
    FROM orders
""")
def catalogue_files(spark: SparkSession, folder: str) -> DataFrame:
    """Nested catalogue documents (year, month, files), decoded and flattened."""
    listed = F.array(F.struct(
        F.col("o_orderstatus").alias("type"),
        F.concat(F.lit(" http://host/"), "o_orderkey", F.lit(".parquet ")).alias("url"),
    ))
    months = F.create_map(F.date_format("o_orderdate", "MM"), listed)
    documents = table(spark, folder, "orders").select(
        F.to_json(F.create_map(F.date_format("o_orderdate", "yyyy"), months)).alias("value")
    )
    return explode_catalogue(documents).select(
        "year", "month", "type", F.trim("url").alias("url"), base_name(F.trim("url")).alias("source_file")
    )


@query("""
    SELECT 'file_' || CAST(l_linenumber AS VARCHAR) AS source_file,
           strftime(min(l_shipdate), '%Y%m%d') AS first_day,
           strftime(max(l_shipdate), '%Y%m%d') AS last_day
    FROM lineitem GROUP BY 1
""")
def file_extents(spark: SparkSession, folder: str) -> DataFrame:
    """The time extent of each of many files, in one pass."""
    named = table(spark, folder, "lineitem").withColumn(
        "source_file", F.concat(F.lit("file_"), "l_linenumber")
    )
    return time_extent(named, by=["source_file"], time="l_shipdate")


@query("SELECT * FROM orders")
def merge_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Overlapping period files merged with one row per key."""
    orders = table(spark, folder, "orders")
    late = orders.filter("o_orderdate >= timestamp_ntz'1997-01-01'")
    return distinct_rows(union_all([orders, late]), ["o_orderkey"])


_REQUESTS = """
    SELECT o_orderpriority, min(o_orderdate) + INTERVAL 5 HOUR AS since,
           max(o_orderdate) + INTERVAL 13 HOUR AS until FROM orders GROUP BY 1
"""
_COVERED = """
    SELECT o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS since,
           CAST(o_custkey % 50 + 1 AS INTEGER) AS hours FROM orders WHERE o_totalprice > 450000
"""


@query(f"""
    WITH c AS (
      SELECT DISTINCT unnest(generate_series(since, since + to_hours(hours - 1), INTERVAL 1 HOUR)) AS h FROM ({_COVERED}) x),
    w AS (SELECT o_orderpriority, unnest(generate_series(since, until - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS h FROM ({_REQUESTS}) r),
    o AS (SELECT * FROM w WHERE h NOT IN (SELECT h FROM c)),
    r AS (SELECT *, h - to_hours(CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY h) AS INTEGER)) AS run FROM o)
    SELECT o_orderpriority, min(h) AS range_start, max(h) + INTERVAL 1 HOUR AS range_end FROM r GROUP BY o_orderpriority, run
""")
def uncovered_hours(spark: SparkSession, folder: str) -> DataFrame:
    """What landed ranges leave of each priority's request, both cut at any hour."""
    orders = table(spark, folder, "orders")
    hours = lambda n: F.make_dt_interval(hours=n.cast("int"))
    wanted = orders.groupBy("o_orderpriority").agg(
        (F.min("o_orderdate") + hours(F.lit(5))).alias("range_start"), (F.max("o_orderdate") + hours(F.lit(13))).alias("range_end"))
    start = F.col("o_orderdate") + hours(F.col("o_orderkey") % 24)
    covered = orders.filter("o_totalprice > 450000").select(
        start.alias("range_start"), (start + hours(F.col("o_custkey") % 50 + 1)).alias("range_end"))
    return intervals.interval_difference(wanted, covered, ["o_orderpriority"])


@query(f"""
    WITH c AS (
      SELECT DISTINCT unnest(generate_series(since, since + to_hours(hours - 1), INTERVAL 1 HOUR)) AS h FROM ({_COVERED}) x),
    r AS (SELECT h, h - to_hours(CAST(row_number() OVER (ORDER BY h) AS INTEGER)) AS run FROM c)
    SELECT min(h) AS range_start, max(h) + INTERVAL 1 HOUR AS range_end FROM r GROUP BY run
""")
def covered_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Landed ranges of any length as disjoint ones."""
    start = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    covered = table(spark, folder, "orders").filter("o_totalprice > 450000").select(
        start.alias("range_start"),
        (start + F.make_dt_interval(hours=(F.col("o_custkey") % 50 + 1).cast("int"))).alias("range_end"))
    return intervals.interval_union(covered)


@query("SELECT * FROM orders")
def sorted_take_in(spark: SparkSession, folder: str) -> DataFrame:
    """A sorted set of the early orders that takes in the late ones and a few others."""
    orders = table(spark, folder, "orders")
    late, few = F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"), F.col("o_orderkey") % 97 == 0
    path = fresh_path(spark, "sorted-orders")
    sorted_set.create(orders, path, "o_orderdate", 16)
    for version, rows in (("first", orders.filter(~late & ~few)), ("late", orders.filter(late & ~few)), ("few", orders.filter(few))):
        sorted_set.take_in(rows, path, "o_orderdate", version)
    sorted_set.clear_superseded(spark, path)
    return sorted_set.read_sorted(spark, path, "o_orderdate")


@query(f"SELECT * EXCLUDE (unit) FROM ({HOURLY}) h")
def hourly_stream_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Exact hours of a stream whose files are in no order: rows come later than any delay."""
    source, parts, progress = (fresh_path(spark, n) for n in ("unordered", "parts", "progress"))
    flat = flat_measurements(spark, folder).drop("unit").withColumn("datetimeUtc", F.col("datetimeUtc").cast("timestamp"))
    flat.repartition(9, F.xxhash64("value", "datetimeUtc")).write.parquet(source)
    stream = spark.readStream.schema(flat.schema).option("maxFilesPerTrigger", 4).parquet(source)
    write_parts(stream, parts, progress, ["location_id", "parameter"]).awaitTermination()
    hours = partials.read_increments(spark, parts)
    return rounded(hours.withColumn("datetime_hour", F.col("datetime_hour").cast("timestamp_ntz")), "value_mean")


@query("""
    WITH last AS (SELECT max(ts) AS seen FROM events)
    SELECT date_trunc('hour', ts) AS datetime_hour, event_type AS parameter,
           round(avg(value), 6) AS value_mean, min(value) AS value_min, max(value) AS value_max,
           count(value) AS value_count
    FROM events, last
    WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= seen - INTERVAL 1 HOUR
    GROUP BY 1, 2
""")
def hourly_closed(spark: SparkSession, folder: str) -> DataFrame:
    """Hours closed by the watermark of a stream over the events file."""
    output, progress = fresh_path(spark, "closed"), fresh_path(spark, "progress")
    events = (
        # a stream takes a single file only by way of a glob
        spark.readStream.schema(table(spark, folder, "events").schema)
        .parquet(f"{folder}/{{events}}.parquet")
        .select(F.col("ts").cast("timestamp").alias("datetimeUtc"),
                F.col("event_type").alias("parameter"), "value")
    )
    closed = closed_hours(events, ["parameter"], "1 hour")
    write_once(closed, output, progress).awaitTermination()
    stats = spark.read.schema(closed.schema).parquet(output)
    return rounded(
        stats.withColumn("datetime_hour", F.col("datetime_hour").cast("timestamp_ntz")), "value_mean"
    )
