"""Queries on times, names and calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from curbair.functions import names, times
from curbair.operators import spines
from curbair.operators.measurements import look_back
from curbair.queries.registry import query
from curbair.queries.views import table
from curbair.schemas import RUN_ID
from curbair.sources.staging import staged


@query("""
    SELECT event_id, CASE event_type
        WHEN 'view' THEN date_trunc('second', ts)
        WHEN 'click' THEN date_trunc('second', ts)
        WHEN 'purchase' THEN date_trunc('day', ts) END AS parsed
    FROM events
""")
def parse_time_lenient(spark: SparkSession, folder: str) -> DataFrame:
    """ISO, stamp and date forms parse; other text and '' give NULL."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == "click", F.date_format("ts", "yyyyMMddHHmmss"))
        .when(kind == "purchase", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "error", F.lit("bad"))
        .otherwise(F.lit(""))
    )
    return table(spark, folder, "events").select("event_id", times.lenient_time(text).alias("parsed"))


@query("SELECT event_id, date_trunc('second', ts) AS parsed FROM events")
def time_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", times.strict_time(times.stamp(F.col("ts"))).alias("parsed")
    )


@query("""
    SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS stamp, strftime(ts, '%Y%m%d') AS day,
           strftime(ts, '%Y-%m') AS year_month, strftime(ts, '%Y-%m-%d') AS iso_day,
           strftime(ts, '%Y%m%d_%H%M%S') AS run_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso
    FROM events
""")
def time_format(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id",
        times.stamp(F.col("ts")).alias("stamp"),
        F.date_format("ts", "yyyyMMdd").alias("day"),
        F.date_format("ts", "yyyy-MM").alias("year_month"),
        F.date_format("ts", "yyyy-MM-dd").alias("iso_day"),
        F.date_format("ts", RUN_ID).alias("run_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"),
    )


@query("""
    SELECT o_orderkey,
           strftime(o_orderdate - INTERVAL 30 DAY, '%Y-%m-%d') AS look_back_start,
           strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS look_back_end,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start,
           strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_month,
           strftime(date_trunc('month', o_orderdate) + INTERVAL 2 MONTH, '%Y-%m-%d') AS next_period,
           date_diff('day', date_trunc('month', o_orderdate), o_orderdate) AS days_into_month,
           strftime(greatest(o_orderdate, TIMESTAMP '1998-01-01'), '%Y-%m-%d') AS not_before,
           strftime(least(o_orderdate, TIMESTAMP '1998-01-01'), '%Y-%m-%d') AS not_after
    FROM orders
""")
def date_arith(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    first = times.month_start(day)
    low, high = look_back(day, 30)
    pivot = F.lit("1998-01-01").cast("date")

    def text(column):
        return F.date_format(column, "yyyy-MM-dd")

    return table(spark, folder, "orders").select(
        "o_orderkey",
        text(low).alias("look_back_start"),
        text(high).alias("look_back_end"),
        text(first).alias("month_start"),
        text(F.add_months(first, 1)).alias("next_month"),
        text(F.add_months(first, 2)).alias("next_period"),
        F.datediff(day, first).cast("long").alias("days_into_month"),
        text(F.greatest(day, pivot)).alias("not_before"),
        text(F.least(day, pivot)).alias("not_after"),
    )


@query(r"""
    WITH named AS (
      SELECT page_id, url, split_part(url, '/', -1) AS file FROM pages)
    SELECT page_id, split_part(url, '/', 3) AS host, file,
           regexp_replace(file, '\.[^.]+$', '') AS stem,
           regexp_replace(file, '\.[^.]+$', '') || '.csv' AS csv_name,
           trim('  ' || url || ' ') AS trimmed, lower(url) LIKE '%example%' AS has_example,
           substring(url, 1, 10) AS prefix, replace(url, '/', '') AS unslashed,
           lpad(CAST(length(file) AS VARCHAR), 2, '0') AS file_length,
           concat_ws('_to_', substring(url, 1, 10), file) AS joined
    FROM named
""")
def string_parts(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    file = names.base_name(url)
    return table(spark, folder, "pages").select(
        "page_id",
        names.part_of(url, "/", 3).alias("host"),
        file.alias("file"),
        names.stem(file).alias("stem"),
        names.with_suffix(file, ".csv").alias("csv_name"),
        F.trim(F.concat(F.lit("  "), url, F.lit(" "))).alias("trimmed"),
        names.contains_folded(url, "EXAMPLE").alias("has_example"),
        F.substring(url, 1, 10).alias("prefix"),
        F.replace(url, F.lit("/"), F.lit("")).alias("unslashed"),
        names.two_digits(F.length(file)).alias("file_length"),
        F.concat_ws("_to_", F.substring(url, 1, 10), file).alias("joined"),
    )


_MONTH_REQUESTS = "SELECT o_custkey, max(o_orderdate) AS until FROM orders GROUP BY 1"


@query(f"""
    WITH spine AS (
      SELECT o_custkey, unnest(generate_series(
               date_trunc('month', until - INTERVAL 80 DAY)::TIMESTAMP, until,
               INTERVAL 1 MONTH)) AS m
      FROM ({_MONTH_REQUESTS}) r),
    files AS (
      SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS year_month, l_linestatus AS type
      FROM lineitem WHERE l_linestatus = 'O')
    SELECT o_custkey, year_month, type,
           'http://host/' || type || '_' || year_month || '.parquet' AS url,
           type || '_' || year_month || '.parquet' AS source_file
    FROM spine JOIN files ON strftime(m, '%Y-%m') = year_month
""")
def month_spine_join(spark: SparkSession, folder: str) -> DataFrame:
    """Months of each customer's last 80 days, looked up in a catalogue of files."""
    requests = (
        table(spark, folder, "orders").groupBy("o_custkey")
        .agg(F.max("o_orderdate").alias("until"))
        .withColumn("since", F.date_sub(F.col("until").cast("date"), 80))
    )
    listed = table(spark, folder, "lineitem").select(
        times.month_start(F.col("l_shipdate")).alias("first"), F.col("l_linestatus").alias("type")
    ).distinct()
    catalogue = staged(listed, "catalogue").select(
        F.date_format("first", "yyyy").alias("year"), F.date_format("first", "MM").alias("month"), "type"
    ).withColumn("url", F.concat(
        F.lit(" http://host/"), "type", F.lit("_"), "year", F.lit("-"), "month", F.lit(".parquet ")
    ))
    spine = spines.month_spine(requests, "since", "until")
    files = spines.work_list(spine, catalogue, types=["O"])
    return files.select("o_custkey", "year_month", "type", "url", "source_file")


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("since"),
        (F.max("o_orderdate") + F.expr("interval '23:59:59' hour to second")).alias("until"),
    )


def _periods(end: str) -> str:
    return f"""
    WITH requests AS (
      SELECT o_custkey, min(o_orderdate) AS since,
             max(o_orderdate) + to_seconds(86399) AS until FROM orders GROUP BY 1),
    firsts AS (
      SELECT *, unnest(generate_series(date_trunc('month', since)::TIMESTAMP, until,
                       INTERVAL 2 MONTH)) AS first FROM requests)
    SELECT o_custkey, greatest(first, since) AS period_start, {end} AS period_end,
           strftime(greatest(first, since), '%Y-%m') || '_to_' ||
           strftime(least(first + INTERVAL 2 MONTH - INTERVAL 1 DAY, until), '%Y-%m') AS period_name
    FROM firsts"""


@query(_periods("least(first + INTERVAL 2 MONTH, date_trunc('day', until) + INTERVAL 1 DAY)"))
def period_spine(spark: SparkSession, folder: str) -> DataFrame:
    """Adjoining two-month periods over the order history of each customer."""
    return spines.period_spine(_requests(spark, folder), "since", "until").drop("since", "until")


@query(_periods("least(first + INTERVAL 2 MONTH - INTERVAL 1 DAY, until)"))
def period_spine_compatible(spark: SparkSession, folder: str) -> DataFrame:
    """The same periods ending at the start of their last day."""
    spine = spines.period_spine(_requests(spark, folder), "since", "until", compatible=True)
    return spine.drop("since", "until")
