"""UNION ALL by name and global ordering."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from curbair.functions.times import stamp, strict_time
from curbair.operators.conform import first_existing
from curbair.operators.measurements import filter_time_range
from curbair.schemas import SORT_PREFERENCE, TripSpec
from curbair.sources.staging import staged

_TIE = "__tie"


def union_all(frames: Iterable[DataFrame], casts: dict[str, str] | None = None) -> DataFrame:
    """Rows of all frames; columns matched by name, absent ones NULL, no de-duplication."""

    def aligned(df: DataFrame) -> DataFrame:
        named = {c: t for c, t in (casts or {}).items() if c in df.columns}
        return df.withColumns({c: F.col(c).cast(t) for c, t in named.items()}) if named else df

    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [aligned(f) for f in frames]
    )


def spread_sort(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Global ascending sort, missing last, in range partitions.

    Rows equal on ``columns`` have no defined order, so a running id breaks the
    ties: however many rows share one key, or are copies of one another, the
    range partitioning can still cut between them. Ids repeat on a task retry
    because the input is a file scan; stage anything else first.
    """
    keys = [F.col(c).asc_nulls_last() for c in columns]
    return (
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .orderBy(*keys, F.col(_TIE))
        .drop(_TIE)
    )


def distinct_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Whole rows once, or one row per key."""
    return df.dropDuplicates(list(keys)) if keys else df.distinct()


def _narrowed(
    merged: DataFrame, time: str | None, date_range: tuple | None, dedup_keys: Sequence[str] | None
) -> DataFrame:
    if date_range is not None and time is not None:
        merged = filter_time_range(merged, time, *date_range)
    if dedup_keys is not None:
        merged = staged(distinct_rows(merged, dedup_keys), "distinct")
    return merged


def merge_trips(
    frames: Iterable[DataFrame], spec: TripSpec, date_range: tuple | None = None,
    dedup_keys: Sequence[str] | None = None,
) -> DataFrame:
    """All cleaned trips of one taxi type in pickup order.

    Stamped pickup text is parsed strictly: a malformed value fails the job. Times
    come out stamped; a dropoff that is text already passes through as it is.
    Everything is kept unless a ``date_range`` of pickups is given, or
    ``dedup_keys`` ([] for whole rows). The frames should be scans (see ``spread_sort``).
    """
    merged = union_all(frames)
    if spec.pickup not in merged.columns:
        return _narrowed(merged, None, None, dedup_keys)
    if isinstance(merged.schema[spec.pickup].dataType, T.StringType):
        merged = merged.withColumn(spec.pickup, strict_time(F.col(spec.pickup)))
    merged = _narrowed(merged, spec.pickup, date_range, dedup_keys)
    return spread_sort(merged, [spec.pickup]).withColumns({
        c: stamp(F.col(c)) for c in (spec.pickup, spec.dropoff)
        if c in merged.columns and not isinstance(merged.schema[c].dataType, T.StringType)
    })


def merge_measurements(
    frames: Iterable[DataFrame], casts: dict[str, str] | None = None, kind: str = "timestamp",
    date_range: tuple | None = None, dedup_keys: Sequence[str] | None = None,
) -> DataFrame:
    """All measurements, sorted by the first time column there is (if any).

    The frames should be scans (see ``spread_sort``).
    """
    merged = union_all(frames, casts)
    column = first_existing(merged, SORT_PREFERENCE)
    if column is None:
        return _narrowed(merged, None, None, dedup_keys)
    data_type = merged.schema[column].dataType
    if not isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        merged = merged.withColumn(column, F.col(column).cast(kind))
    return spread_sort(_narrowed(merged, column, date_range, dedup_keys), [column])
