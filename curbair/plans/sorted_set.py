"""A sorted data set that takes in new rows range by range.

The borders of its ranges are fixed when it is made. Taking in rows re-sorts only the
ranges they fall into and writes them as a new version; the record of versions says which
one of each range counts, so a broken run changes nothing and can be repeated.

    <path>/borders      the lowest key of each range
    <path>/versions     range, version, sequence, rows: appended after the data is written
    <path>/data/version=<name>/range=<number>/
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from curbair.operators.unions import spread_sort
from curbair.sources.files import path_missing
from curbair.sources.staging import staged

RANGES, MOST_RANGES = 64, 4096
_STRIDE = 64
_RANGE = "range"
_VERSIONS = "range int, version string, sequence int, rows long"


def choose_borders(df: DataFrame, key: str, ranges: int = RANGES) -> DataFrame:
    """(range, low): about equal shares of the rows by approximate quantiles; the first
    range has no lower border. Equal quantiles give one border, so a key that many rows
    share is one range, and the ranges may be fewer."""
    if not 0 < ranges <= MOST_RANGES:
        raise ValueError(f"between 1 and {MOST_RANGES} ranges")
    kind = df.schema[key].dataType
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)]).cast("array<double>")
    # instants are counted in microseconds, which quantiles of numbers take
    text = kind.simpleString()
    number = F.unix_micros(F.col(key).cast("timestamp")) if text.startswith(("timestamp", "date")) else F.col(key)
    lows = df.filter(F.col(key).isNotNull()).select(number.alias("v")).agg(
        F.percentile_approx("v", shares, 100 * ranges).alias("q")) if ranges > 1 else None
    first = df.sparkSession.range(1).select(F.lit(0).alias(_RANGE), F.lit(None).cast(kind).alias("low"))
    if lows is None:
        return first
    back = F.timestamp_micros(F.col("low")).cast(kind) if text.startswith(("timestamp", "date")) else F.col("low").cast(kind)
    inner = lows.select(F.posexplode(F.array_sort(F.array_distinct("q"))).alias("at", "low")).select(
        (F.col("at") + 1).cast("int").alias(_RANGE), back.alias("low"))
    return first.unionByName(inner)


def _range_of(key: Column, lows: Sequence[object], kind) -> Column:
    """The range a key falls into; a missing key sorts last. Borders are met in two steps
    of at most 64 comparisons each."""
    if not lows:
        return F.lit(0)
    strides = [list(lows[i : i + _STRIDE]) for i in range(0, len(lows), _STRIDE)]
    literal = lambda values: F.array(*[F.lit(v).cast(kind) for v in values])
    coarse = F.size(F.filter(literal([s[0] for s in strides]), lambda low: low <= key))
    fine = F.get(F.array(*map(literal, strides)), coarse - 1)
    inside = F.when(coarse == 0, 0).otherwise((coarse - 1) * _STRIDE + F.size(F.filter(fine, lambda low: low <= key)))
    return F.when(key.isNull(), len(lows)).otherwise(inside)


def _borders(spark: SparkSession, path: str) -> list[object]:
    """Lower borders in order, without the first range's; at most ``MOST_RANGES``."""
    rows = spark.read.parquet(f"{path}/borders").orderBy(_RANGE).collect()
    return [r.low for r in rows[1:]]


def versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions that were recorded; empty before the first rows."""
    try:
        return spark.read.schema(_VERSIONS).parquet(f"{path}/versions")
    except AnalysisException as error:
        if not path_missing(error):
            raise
        return spark.createDataFrame([], _VERSIONS)


def _current(spark: SparkSession, path: str) -> dict[int, tuple[str, int]]:
    """Version and rows of each range that has any; at most ``MOST_RANGES``."""
    latest = versions(spark, path).groupBy(_RANGE).agg(
        F.max_by(F.struct("version", "rows"), "sequence").alias("v")).collect()
    return {r[_RANGE]: (r.v.version, r.v.rows) for r in latest}


def create(df: DataFrame, path: str, key: str, ranges: int = RANGES) -> None:
    """Fix the borders of a new set by the rows it starts with (not written yet)."""
    choose_borders(df, key, ranges).coalesce(1).write.parquet(f"{path}/borders")


def take_in(new: DataFrame, path: str, key: str, version: str) -> list[int]:
    """Add rows to the set; returns the ranges that were written anew.

    ``version`` names the rows: the same name again, after a run that broke before its
    record, replaces what that run left. Nothing is de-duplicated. Rows without a key go
    to the last range.
    """
    spark = new.sparkSession
    borders = _borders(spark, path)
    if versions(spark, path).filter(F.col("version") == version).limit(1).count():
        raise ValueError(f"version {version} was taken in already")
    placed = staged(new.withColumn(_RANGE, _range_of(F.col(key), borders, new.schema[key].dataType).cast("int")), "placed")
    counts = {r[0]: r[1] for r in placed.groupBy(_RANGE).count().collect()}  # at most MOST_RANGES
    if not counts:
        return []
    now = _current(spark, path)
    stale = [f"{path}/data/version={now[r][0]}/range={r}" for r in sorted(counts) if r in now]
    merged = placed
    if stale:
        old = spark.read.schema(new.schema).option("basePath", f"{path}/data").parquet(*stale)
        merged = placed.unionByName(
            old.withColumn(_RANGE, F.regexp_extract(F.col("_metadata.file_path"), r"/range=(\d+)/", 1).cast("int"))
            .select(placed.columns))
    spread_sort(merged, [_RANGE, key]).write.mode("overwrite").partitionBy(_RANGE).parquet(f"{path}/data/version={version}")
    sequence = (versions(spark, path).agg(F.max("sequence")).first()[0] or 0) + 1
    record = [(r, version, sequence, n + (now[r][1] if r in now else 0)) for r, n in sorted(counts.items())]
    spark.createDataFrame(record, _VERSIONS).coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return sorted(counts)


def read_sorted(
    spark: SparkSession, path: str, key: str, low: object = None, high: object = None
) -> DataFrame:
    """Rows of the set with ``low`` <= key <= ``high`` (None: open), from the ranges that
    can hold them. Files of a range are sorted and follow each other by name, as ranges do
    by number; rows without a key are only in the whole set."""
    borders = _borders(spark, path)
    now = _current(spark, path)
    if not now:
        raise ValueError("the set has no rows yet")
    first = sum(b <= low for b in borders) if low is not None else 0
    last = sum(b <= high for b in borders) if high is not None else len(borders)
    wanted = [r for r in sorted(now) if first <= r <= last] or [min(now)]
    paths = [f"{path}/data/version={now[r][0]}/range={r}" for r in wanted]
    rows = spark.read.parquet(*paths)
    if low is not None:
        rows = rows.filter(F.col(key) >= F.lit(low))
    return rows if high is None else rows.filter(F.col(key) <= F.lit(high))


def clear_superseded(spark: SparkSession, path: str) -> int:
    """Remove the data of versions that no range counts on any more; their number."""
    now = {(v, r) for r, (v, _) in _current(spark, path).items()}
    known = {(r.version, r[_RANGE]) for r in versions(spark, path).select("version", _RANGE).distinct().collect()}
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs
    store = paths.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = sorted(known - now)
    return sum(bool(store.delete(paths.Path(f"{path}/data/version={v}/range={r}"), True)) for v, r in gone)
