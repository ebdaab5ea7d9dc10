"""An index of what landed files hold: times and bounding box per file.

Range and box filters consult the index first and open only files that can match. A file
the index does not know in its present length and age is always opened, so an index that
is behind costs time, never rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from curbair.functions.times import bound_literal, utc_bound
from curbair.operators.joins import lookup_join
from curbair.operators.measurements import filter_bbox, filter_time_range, flatten_stations, time_of
from curbair.sources.catalogue import station_pages
from curbair.sources.files import list_files, path_missing, paths_of
from curbair.sources.staging import staged

FILE = "__file"
SCHEMA = (
    "path string, length long, modificationTime timestamp, measurements long, untimed long, "
    "first_time timestamp, last_time timestamp, min_longitude double, max_longitude double, "
    "min_latitude double, max_latitude double"
)
_IDENTITY = ["path", "length", "modificationTime"]

#: Rows of some files, each with the name of its file in the column ``FILE``.
Scan = Callable[[list[str]], DataFrame]
Box = tuple[float, float, float, float]


def _one_form(path: Column) -> Column:
    """Listings and scans write local paths with one slash or three."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def scanned_file() -> Column:
    """The file a scan read a row from, as listings name it; apply directly on a scan."""
    return _one_form(F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B")))


def parquet_rows(spark: SparkSession, schema=None) -> Scan:
    """Rows of flat Parquet files."""
    def scan(paths: list[str]) -> DataFrame:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(*paths).withColumn(FILE, scanned_file())

    return scan


def page_rows(spark: SparkSession, carry: tuple[str, ...] = (), **options) -> Scan:
    """Flat measurements of station pages; ``options`` are those of ``station_pages``."""
    def scan(paths: list[str]) -> DataFrame:
        pages = station_pages(spark, paths, **options).withColumn(FILE, scanned_file())
        return flatten_stations(pages, carry=[*carry, FILE])

    return scan


def read_index(spark: SparkSession, index: str) -> DataFrame:
    """The index so far; empty before its first update."""
    try:
        return spark.read.schema(SCHEMA).parquet(index)
    except AnalysisException as error:
        if not path_missing(error):
            raise
        return spark.createDataFrame([], SCHEMA)


def _listing(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Data files below a folder; names that scans hide are left out."""
    listed = list_files(spark, folder, pattern, recursive=True)
    return listed.filter(~F.col("source_file").rlike("^[_.]")).select(
        _one_form(F.col("path")).alias("path"), "length", "modificationTime")


def file_extents(rows: DataFrame, time: str, longitude: str | None, latitude: str | None) -> DataFrame:
    """One row per file of ``rows``: number of rows, rows without a usable time, first and
    last time, and the box of all coordinates. Combined map-side: a row per file and task."""
    instant, _ = time_of(rows, time)
    number = lambda c: F.col(c).cast("double") if c else F.lit(None).cast("double")
    return rows.select(FILE, instant.cast("timestamp").alias("at"), number(longitude).alias("x"), number(latitude).alias("y")).groupBy(FILE).agg(
        F.count(F.lit(1)).alias("measurements"), F.count_if(F.col("at").isNull()).alias("untimed"),
        F.min("at").alias("first_time"), F.max("at").alias("last_time"),
        F.min("x").alias("min_longitude"), F.max("x").alias("max_longitude"),
        F.min("y").alias("min_latitude"), F.max("y").alias("max_latitude"))


def update_index(
    spark: SparkSession, folder: str, index: str, scan: Scan, time: str = "datetimeUtc",
    longitude: str | None = "longitude", latitude: str | None = "latitude", pattern: str = "*",
) -> int:
    """Read the files the index does not know yet and append what they hold; their number.

    A file that was replaced counts as new: the row of its former self stays, and matches
    no listing any more. A file without rows is recorded too, and never opened again.
    """
    listed = staged(_listing(spark, folder, pattern), "listing")
    new = staged(lookup_join(listed, read_index(spark, index).select(_IDENTITY).distinct(), _IDENTITY, how="left_anti"), "new-files")
    paths = paths_of(new)
    if not paths:
        return 0
    held = file_extents(scan(paths), time, longitude, latitude).withColumnRenamed(FILE, "path")
    found = lookup_join(new, staged(held, "extents"), ["path"]).withColumns(
        {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("measurements", "untimed")})
    columns = [part.split()[0] for part in SCHEMA.split(", ")]
    found.select(columns).write.mode("append").parquet(index)
    return len(paths)


def matching_files(
    spark: SparkSession, folder: str, index: str, start: str | datetime | None = None,
    end: str | datetime | None = None, box: Box | None = None, pattern: str = "*",
) -> DataFrame:
    """Paths of the files that can hold a row of the range and the box.

    The range is inclusive, and rows without a usable time belong to every range, as in
    ``filter_time_range``; a bound that does not parse filters nothing. Rows without
    coordinates are in no box.
    """
    known = F.col("measurements").isNotNull()
    fits = F.col("measurements") > 0
    low, high = utc_bound(start), utc_bound(end)
    if low is not None and high is not None:
        kind = read_index(spark, index).schema["first_time"].dataType
        fits &= (F.col("untimed") > 0) | (
            (F.col("first_time") <= bound_literal(high, kind)) & (F.col("last_time") >= bound_literal(low, kind)))
    if box is not None:
        min_lon, min_lat, max_lon, max_lat = box
        fits &= F.coalesce(
            (F.col("min_longitude") <= max_lon) & (F.col("max_longitude") >= min_lon)
            & (F.col("min_latitude") <= max_lat) & (F.col("max_latitude") >= min_lat), F.lit(False))
    rows = staged(read_index(spark, index).dropDuplicates(_IDENTITY), "extent-index")
    judged = lookup_join(_listing(spark, folder, pattern), rows, _IDENTITY)
    return judged.filter(~known | fits).select("path")


def read_range(
    spark: SparkSession, folder: str, index: str, scan: Scan, start: str | datetime | None = None,
    end: str | datetime | None = None, box: Box | None = None, time: str = "datetimeUtc",
    longitude: str = "longitude", latitude: str = "latitude", pattern: str = "*",
) -> DataFrame:
    """Rows of the range and the box, from the files that can hold them."""
    paths = paths_of(staged(matching_files(spark, folder, index, start, end, box, pattern), "matching-files"))
    if paths:
        rows = scan(paths)
    else:  # the columns of any file, and none of its rows
        rows = scan([_listing(spark, folder, pattern).agg(F.min("path")).first()[0]]).filter(F.lit(False))
    rows = filter_time_range(rows.drop(FILE), time, start, end)
    return filter_bbox(rows, box, longitude, latitude) if box is not None else rows
