"""Hourly statistics over a stream of measurements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from curbair.functions.values import without_nan
from curbair.operators.measurements import flatten_stations, time_column
from curbair.operators.partials import add_increment
from curbair.schemas import STATION_PAGE_USED


def measurement_stream(
    spark: SparkSession, folder: str, fmt: str = "json", files_per_batch: int | None = None
) -> DataFrame:
    """Flat measurements of station pages as they land, with parsed times."""
    reader = spark.readStream.format(fmt).schema(STATION_PAGE_USED)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return time_column(flatten_stations(reader.load(folder)), "datetimeUtc")


def closed_hours(
    stream: DataFrame, keys: Sequence[str], delay: str = "1 hour", time: str = "datetimeUtc",
    value: str = "value",
) -> DataFrame:
    """Statistics of each hour once it is closed, i.e. ``delay`` past the latest time.

    State is bounded by the delay. Rows older than that, or without a time, belong
    to no open hour; ``curbair.operators.partials`` covers those exactly.
    """
    measure = without_nan(F.col(value), stream.schema[value].dataType)
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, "1 hour").alias("__w"), *keys)
        .agg(
            F.avg(measure).alias("value_mean"),
            F.min(measure).alias("value_min"),
            F.max(measure).alias("value_max"),
            F.count(measure).alias("value_count"),
        )
        .select(F.col("__w.start").alias("datetime_hour"), *keys, "value_mean", "value_min",
                "value_max", "value_count")
    )


def write_parts(
    stream: DataFrame, path: str, progress: str, keys: Sequence[str] | None = None,
    time: str = "datetimeUtc", value: str = "value",
) -> StreamingQuery:
    """Store the parts of every batch of a stream, once all of its input is there.

    Each batch becomes the increment of its number. A batch that is replayed after a
    failure replaces its own increment, and a row counts however late it comes, so
    ``partials.read_increments`` over ``path`` is exact at any time. ``path`` belongs to
    ``progress``: a stream that starts anew needs a new folder.
    """
    def store(batch: DataFrame, number: int) -> None:
        add_increment(batch, path, f"batch-{number}", time=time, value=value, keys=keys)

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", progress).trigger(
        availableNow=True).start()
