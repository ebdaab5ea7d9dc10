"""Calendar rows: months, two-month periods, hours, uncovered days.

Every function takes a table of requests, so one call plans any number of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame, functions as F, Window

from curbair.functions.times import month_start
from curbair.operators.joins import lookup_join, unprocessed
from curbair.sources.staging import staged


def month_spine(requests: DataFrame, start: str, end: str) -> DataFrame:
    """One row per month touched by [start, end], as year and month text."""
    first = month_start(F.col(start).cast("date"))
    months = F.sequence(first, F.col(end).cast("date"), F.expr("interval 1 month"))
    return requests.withColumn("month_start", F.explode(months)).withColumns({
        "year": F.date_format("month_start", "yyyy"),
        "month": F.date_format("month_start", "MM"),
        "year_month": F.date_format("month_start", "yyyy-MM"),
    })


def available_months(spine: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Months of the spine that the catalogue lists."""
    listed = catalogue.select("year", "month").distinct()
    return lookup_join(spine, listed, ["year", "month"], how="left_semi")


def work_list(
    spine: DataFrame, catalogue: DataFrame, types: Sequence[str] | None = None,
    done: DataFrame | None = None,
) -> DataFrame:
    """Files to fetch: spine x catalogue, by type, URLs trimmed, minus ``done``."""
    files = catalogue if types is None else catalogue.filter(F.col("type").isin(list(types)))
    trimmed = files.select("year", "month", "type", F.trim("url").alias("url"))
    listed = lookup_join(spine, trimmed, ["year", "month"], how="inner").withColumn(
        "source_file", F.regexp_extract("url", r"([^/]*)$", 1)
    )
    if done is not None:
        listed = unprocessed(listed, done)
    return listed


def period_spine(requests: DataFrame, start: str, end: str, compatible: bool = False) -> DataFrame:
    """Two-month periods covering each request, clipped to it, with a name.

    ``start`` and ``end`` are times, the end inclusive. Periods are half-open and
    adjoin each other. ``compatible`` ends a period at the *beginning* of its last
    day instead, and the last one at the requested end.
    """
    begin, finish = F.col(start), F.col(end)
    kind = requests.schema[start].dataType.simpleString()
    firsts = F.sequence(
        month_start(begin.cast("date")), finish.cast("date"), F.expr("interval 2 month")
    )
    rows = requests.withColumn("__first", F.explode(firsts))
    following: Column = F.add_months("__first", 2)
    last_day = F.date_sub(following, 1).cast(kind)
    clipped_end = F.least(last_day, finish)
    if compatible:
        period_end = clipped_end
    else:
        period_end = F.least(following, F.date_add(finish.cast("date"), 1)).cast(kind)
    period_start = F.greatest(F.col("__first").cast(kind), begin)
    return rows.withColumns({
        "period_start": period_start,
        "period_end": period_end,
        "period_name": F.concat_ws(
            "_to_", F.date_format(period_start, "yyyy-MM"), F.date_format(clipped_end, "yyyy-MM")
        ),
    }).drop("__first")


def uncovered_ranges(
    periods: DataFrame, covered: DataFrame, keys: Sequence[str] = ("period_name",),
    start: str = "period_start", end: str = "period_end",
) -> DataFrame:
    """Day ranges of the periods that no covered range holds (all half-open).

    ``keys`` name a period. Runs of days are found within one period, so a window
    never sees more days than a period has. A day counts as wanted if a period holds
    any of it, and as covered only if one covered range holds all of it.
    """

    def days(df: DataFrame, whole: bool) -> Column:
        first, last = F.col(start).cast("date"), F.date_sub(F.col(end).cast("date"), 1)
        if whole:
            part = F.col(start) > first.cast(df.schema[start].dataType)
            first = F.when(part, F.date_add(first, 1)).otherwise(first)
        else:
            part = F.col(end) > F.col(end).cast("date").cast(df.schema[end].dataType)
            last = F.when(part, F.date_add(last, 1)).otherwise(last)
        return F.explode(F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day"))))

    wanted = periods.select(*keys, days(periods, whole=False).alias("day"))
    taken = staged(covered.select(days(covered, whole=True).alias("day")).distinct(), "covered-days")
    open_days = lookup_join(wanted, taken, ["day"], how="left_anti")
    order = Window.partitionBy(*keys).orderBy("day")
    runs = open_days.withColumn("__run", F.date_sub("day", F.row_number().over(order)))
    return runs.groupBy(*keys, "__run").agg(
        F.min("day").alias("range_start"), F.date_add(F.max("day"), 1).alias("range_end")
    ).drop("__run")


def hour_number(hour: Column) -> Column:
    """Hours since 1970-01-01 of a floored hour."""
    days = F.datediff(hour.cast("date"), F.lit("1970-01-01").cast("date"))
    return (days * 24 + F.hour(hour)).cast("bigint")


def series_gaps(
    hourly: DataFrame, keys: Sequence[str], hour: str = "datetime_hour", block_days: int = 31
) -> DataFrame:
    """Runs of hours without a row between a series' first and last: one row per gap, with
    the keys, ``gap_start``, ``gap_end`` (half-open) and ``hours``.

    A series is cut into blocks of ``block_days`` days. Within a block each hour looks at
    the next one; between blocks only their first and last hours are compared, so no
    window holds a whole series. Rows without an hour take no part; repeated hours count
    once; a NULL key names a series like any other. The input is read twice: stage what
    is costly to compute.
    """
    placed = hourly.filter(F.col(hour).isNotNull()).select(
        *keys, F.col(hour).alias("__at"), F.floor(hour_number(F.col(hour)) / (24 * block_days)).alias("__block"))
    inside = placed.withColumn("__next", F.lead("__at").over(Window.partitionBy(*keys, "__block").orderBy("__at")))
    ends = placed.groupBy(*keys, "__block").agg(F.min("__at").alias("__first"), F.max("__at").alias("__at"))
    between = ends.withColumn("__next", F.lead("__first").over(Window.partitionBy(*keys).orderBy("__block")))
    columns = [*keys, "__at", "__next"]
    steps = inside.select(columns).unionByName(between.select(columns))
    missing = hour_number(F.col("__next")) - hour_number(F.col("__at")) - 1
    return steps.filter(missing > 0).select(
        *keys, (F.col("__at") + F.expr("interval 1 hour")).alias("gap_start"), F.col("__next").alias("gap_end"),
        missing.alias("hours"))


def hourly_spine(hourly: DataFrame, keys: Sequence[str], hour: str = "datetime_hour") -> DataFrame:
    """Every hour between a series' first and last, with the series' own columns.

    Hours without a row appear with NULL measures: the known rows as they are, and the
    gaps' hours beside them. Rows without an hour have no place on the spine and are left
    out. A NULL key names a series like any other. The input is read once: gaps and rows
    use a staged copy.
    """
    known = staged(hourly.filter(F.col(hour).isNotNull()), "series")
    names = [*keys, hour]
    measures = [c for c in known.columns if c not in names]
    step = F.expr("interval 1 hour")
    absent = series_gaps(known, keys, hour).select(
        *keys, F.explode(F.sequence("gap_start", F.col("gap_end") - step, step)).alias(hour))
    nothing = [F.lit(None).cast(known.schema[c].dataType).alias(c) for c in measures]
    return known.select(*names, *measures).unionByName(absent.select(*names, *nothing))
