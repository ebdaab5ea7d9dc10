"""Hourly statistics kept as mergeable parts.

Each increment of new measurements becomes one small table of sums, extremes and
counts; the statistics over everything landed are the merge of those tables. A
late row is simply part of a later increment, so nothing is ever dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from curbair.operators.measurements import group_keys, hourly_rows

PARTS = ["part_sum", "part_min", "part_max", "part_count"]


def hourly_parts(
    df: DataFrame, time: str = "datetimeUtc", value: str = "value",
    keys: Sequence[str] | None = None,
) -> DataFrame:
    keys = list(keys) if keys is not None else group_keys(df)
    return hourly_rows(df, time, value, keys).groupBy("datetime_hour", *keys).agg(
        F.sum("__value").alias("part_sum"),
        F.min("__value").alias("part_min"),
        F.max("__value").alias("part_max"),
        F.count("__value").alias("part_count"),
    )


def combine_parts(parts: DataFrame) -> DataFrame:
    """Parts of several increments as the parts of one."""
    keys = [c for c in parts.columns if c not in PARTS]
    return parts.groupBy(*keys).agg(
        F.sum("part_sum").alias("part_sum"),
        F.min("part_min").alias("part_min"),
        F.max("part_max").alias("part_max"),
        F.sum("part_count").alias("part_count"),
    )


def merge_parts(parts: DataFrame) -> DataFrame:
    """Statistics over all increments, as ``hourly_statistics`` gives them."""
    keys = [c for c in parts.columns if c not in PARTS]
    total = F.col("part_count")
    return combine_parts(parts).select(
        *keys,
        F.when(total > 0, F.col("part_sum") / total).alias("value_mean"),
        F.col("part_min").alias("value_min"),
        F.col("part_max").alias("value_max"),
        total.alias("value_count"),
    )


def add_increment(new_rows: DataFrame, path: str, increment: str, **options) -> None:
    """Store the parts of one increment; storing it again replaces it."""
    hourly_parts(new_rows, **options).write.mode("overwrite").parquet(f"{path}/increment={increment}")


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("increment")


def read_increments(spark: SparkSession, path: str) -> DataFrame:
    return merge_parts(read_parts(spark, path))


def compact_increments(spark: SparkSession, path: str, target: str, increment: str) -> None:
    """All increments of ``path`` as one increment of a new folder."""
    combine_parts(read_parts(spark, path)).write.mode("overwrite").parquet(
        f"{target}/increment={increment}"
    )
