"""Counts of what was read, kept, rejected and filled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from curbair.operators.trips import REASONS, with_reject_reason
from curbair.schemas import TripSpec


def clean_report(df: DataFrame, spec: TripSpec, by: Sequence[str] = ()) -> DataFrame:
    """Rows in, rows kept and rejects by first reason, in one pass."""
    marked = with_reject_reason(df, spec, carry=tuple(by))
    reason = F.col("reject_reason")
    return marked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(reason.isNull()).alias("rows_kept"),
        *[F.count_if(reason == r).alias(f"rejected_{r}") for r in REASONS],
    )


def page_completeness(pages: DataFrame, keys: Sequence[str] = ("sensor_id",)) -> DataFrame:
    """Landed pages against the number each source announced.

    ``pages`` holds keys, ``page`` and ``expected_pages``; a series whose pull broke
    off shows as incomplete instead of passing for whole.
    """
    return pages.groupBy(*keys).agg(
        F.max("expected_pages").alias("expected"), F.countDistinct("page").alias("received")
    ).withColumn("complete", F.col("received") >= F.col("expected"))


def status_totals(manifest: DataFrame) -> DataFrame:
    """Files by data set and status."""
    return manifest.groupBy("dataset", "status").agg(F.count(F.lit(1)).alias("files"))


def record(path: str, *reports: DataFrame) -> None:
    """Append quality rows to the table of all runs."""
    for report in reports:
        report.coalesce(1).write.mode("append").parquet(path)


def as_report(
    wide: DataFrame, run_id: str, dataset: str, source: str | None = None
) -> DataFrame:
    """Counters of any of the reports as quality rows.

    (run_id, dataset, source_file, metric, value), one row per counter.
    """
    metrics = [
        f.name for f in wide.schema.fields
        if f.name != source and f.dataType.typeName() in ("long", "integer", "double")
    ]
    rows = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
    ])
    return wide.select(
        F.lit(run_id).alias("run_id"),
        F.lit(dataset).alias("dataset"),
        (F.col(source) if source else F.lit(None).cast("string")).alias("source_file"),
        F.inline(rows),
    )
