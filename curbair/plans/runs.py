"""Both data sets in one application."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, time

from pyspark.sql import SparkSession, functions as F

from curbair.operators import quality
from curbair.operators.spines import period_spine, uncovered_ranges
from curbair.plans import manifest as log
from curbair.plans import measurements as air
from curbair.plans import trips as taxi


def run_together(**jobs: Callable[[], object]) -> dict[str, object]:
    """Submit independent jobs from driver threads and wait for all.

    Results come back by name. If any job failed, the first error is raised once
    all have ended, so a failure never passes for success.
    """
    with ThreadPoolExecutor(max(len(jobs), 1)) as pool:
        futures = {name: pool.submit(job) for name, job in jobs.items()}
    errors = [f.exception() for f in futures.values() if f.exception() is not None]
    if errors:
        raise errors[0]
    return {name: f.result() for name, f in futures.items()}


def run_trips(
    spark: SparkSession, raw: str, work: str, output: str, start: date, end: date, run_id: str,
    incremental: bool = True, fmt: str = "parquet",
) -> dict[str, str]:
    """Clean the trip files not cleaned yet, then merge all cleaned ones per taxi type.

    What was read, kept and rejected per file goes to ``<work>/quality``.
    """
    cleaned = f"{work}/cleaned"
    done = taxi.clean_files(spark, raw, cleaned, f"{work}/manifest", run_id, incremental, fmt)
    quality.record(f"{work}/quality", *done.reports)
    days = (d.strftime("%Y%m%d") for d in (start, end))
    return taxi.merge_files(spark, cleaned, output, *days, run_id, fmt)


def run_measurements(
    spark: SparkSession, pages: str, work: str, output: str, start: date, end: date, run_id: str,
    prefix: str = "air_data", fmt: str = "csv",
) -> air.OrganisedRun:
    """Hourly statistics of all days not covered yet, then one organised set.

    Landed pages lie in ``<pages>/period=<name>``, by two-month periods of the request.
    Requests may overlap: a covered day is neither read again nor replaced. The run's
    counts go to ``<work>/quality``.
    """
    request = spark.createDataFrame(
        [(datetime.combine(start, time.min), datetime.combine(end, time.max))],
        "since timestamp_ntz, until timestamp_ntz",
    )
    periods = period_spine(request, "since", "until")
    manifest = f"{work}/manifest"
    covered = log.finished(log.read_manifest(spark, manifest), air.DATASET).select(
        F.col("range_start").alias("period_start"), F.col("range_end").alias("period_end")
    )
    hourly = f"{work}/hourly"
    air.land_ranges(spark, pages, hourly, uncovered_ranges(periods, covered), run_id, manifest)
    done = air.organise_hourly(spark, air.read_hourly(spark, hourly, manifest), output, run_id, prefix, fmt)
    quality.record(f"{work}/quality", done.report)
    return done
