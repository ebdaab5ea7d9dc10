"""Record of what was processed: one row per data set, file and run."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from curbair.sources.files import path_missing

SCHEMA = (
    "run_id string, dataset string, source_file string, status string, detail string, "
    "range_start timestamp, range_end timestamp"
)


def new_run_id(now: datetime | None = None) -> str:
    """Shared name of one run's outputs."""
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest so far; empty before the first run."""
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as error:
        if not path_missing(error):
            raise
        return spark.createDataFrame([], SCHEMA)


def finished(manifest: DataFrame, dataset: str) -> DataFrame:
    return manifest.filter((F.col("dataset") == dataset) & (F.col("status") == "done"))


def record(spark: SparkSession, path: str, rows: Iterable[dict]) -> None:
    """Append rows; written after the outputs they speak of."""
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    values = [tuple(row.get(n) for n in names) for row in rows]
    if values:
        spark.createDataFrame(values, SCHEMA).coalesce(1).write.mode("append").parquet(path)
