"""Cleaning trip files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from curbair.operators.trips import clean_trips
from curbair.schemas import TripSpec
from curbair.sources.files import SOURCE_FILE, with_source_file
from curbair.streaming.arrivals import write_once


def trip_stream(
    spark: SparkSession, folder: str, spec: TripSpec, schema: str, fmt: str = "csv",
    pattern: str | None = None, files_per_batch: int | None = None,
) -> DataFrame:
    """Raw trips of one type as a stream of files with one declared header."""
    reader = (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("pathGlobFilter", pattern or f"{spec.taxi_type}_*.{fmt}")
    )
    if fmt == "csv":
        reader = reader.options(header=True, enforceSchema=False, escape='"')
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_source_file(reader.load(folder))


def clean_arrivals(
    raw: DataFrame, spec: TripSpec, output: str, checkpoint: str, stamped: bool = False
) -> StreamingQuery:
    """Clean the files that arrived since the last run; the transform is the batch one."""
    cleaned = clean_trips(raw, spec, stamped=stamped, carry=(SOURCE_FILE,))
    return write_once(cleaned, output, checkpoint, [SOURCE_FILE])
