"""File scans.

Parquet sets and CSV files are grouped by their shape before reading: one scan
per distinct shape, however many inputs share it. Shapes are found by tasks, per *input*
(a file, or a directory of like files), never per part file.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from curbair.functions.names import base_name, taxi_type_of
from curbair.sources.shapes import grouped_inputs, schema_of

log = logging.getLogger(__name__)

READ_ERRORS = (PySparkException, Py4JJavaError)
CORRUPT = "_corrupt_record"
SOURCE_FILE = "source_file"
# up to the first path component that is named like a data file
_INPUT_PATH = r"^(.*?/[^/]+\.(?:csv|parquet|parq))(?:/.*)?$"


def scan_parquet(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
    skip_corrupt: bool = False,
) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if skip_corrupt:
        reader = reader.option("ignoreCorruptFiles", True)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def list_files(
    spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = False
) -> DataFrame:
    """Files of a folder by name pattern: path, source_file, length, modificationTime.

    The binary source lists files without opening them as long as their content
    is not selected.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(folder).select(
        "path",
        F.regexp_extract("path", r"([^/]+)$", 1).alias(SOURCE_FILE),
        "length",
        "modificationTime",
    )


def list_inputs(spark: SparkSession, folder: str, pattern: str = ".*") -> DataFrame:
    """Data sets directly in a folder whose name matches: path, source_file.

    A data set is a file, or a directory of part files named like one. ``folder`` may
    be written in any form its file system takes, globs included.
    """
    inputs = list_files(spark, folder, recursive=True).select(
        F.regexp_extract("path", _INPUT_PATH, 1).alias("path")
    ).distinct()
    parent = F.regexp_extract(
        F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", ""), r"^(.*)/[^/]+$", 1)
    return inputs.filter(parent.isin(_folder_paths(spark, folder))).select("path", _input_name(F.col("path")).alias(SOURCE_FILE)).filter(
        F.col(SOURCE_FILE).rlike(f"^(?:{pattern})$")
    )


def _folder_paths(spark: SparkSession, folder: str) -> list[str]:
    """The folders a path or glob stands for, as the file system names them."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toUri().getPath().rstrip("/") for status in found or []]


def _input_name(path: Column) -> Column:
    return base_name(F.regexp_extract(path, _INPUT_PATH, 1))


def path_missing(error: Exception) -> bool:
    """Does this error say that a path does not exist?"""
    return isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"


def folders_of(listing: DataFrame) -> list[str]:
    """Distinct folders of a listing in name order."""
    folders = listing.select(F.regexp_replace("path", r"/[^/]+$", "").alias("path")).distinct()
    return paths_of(folders)


def paths_of(listing: DataFrame) -> list[str]:
    """Paths of a listing in name order."""
    return [r[0] for r in listing.select("path").orderBy("path").toLocalIterator()]


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the name of the data set each row came from; apply directly on a scan.

    A scan names its files percent-encoded (a plus stays a plus); listings do not.
    """
    path = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    return df.withColumn(SOURCE_FILE, _input_name(path))


def with_taxi_type(df: DataFrame) -> DataFrame:
    return df.withColumn("taxi_type", taxi_type_of(_input_name(F.col("_metadata.file_path"))))


def first_line(error: Exception) -> str:
    return next(iter(str(error).splitlines()), type(error).__name__)


def parquet_shapes(
    spark: SparkSession, paths: Sequence[str]
) -> tuple[list[tuple[T.StructType, list[str]]], dict[str, str]]:
    """Inputs grouped by schema, plus the inputs that could not be opened.

    Footers are read by tasks; the driver reads the schema of one input per shape. A
    shape that Spark cannot read counts as unreadable, all its inputs with it.
    """
    groups, failed = grouped_inputs(spark, paths, "parquet")
    shapes: dict[str, tuple[T.StructType, list[str]]] = {}
    for members in groups:
        try:
            schema = schema_of(spark, members[0])
        except READ_ERRORS as error:
            failed.update(dict.fromkeys(members, first_line(error)))
            continue
        # footers can differ where the schemas Spark makes of them do not
        shapes.setdefault(schema.json(), (schema, []))[1].extend(members)
    _warn(failed)
    return list(shapes.values()), failed


def _warn(failed: dict[str, str]) -> None:
    for path, error in failed.items():
        log.warning("skipping unreadable input %s: %s", path, error)


def scan_parquet_sets(
    spark: SparkSession, paths: Sequence[str], casts: dict[str, str] | None = None,
    skip_corrupt: bool = False,
) -> list[DataFrame]:
    """One scan per distinct schema, with drifting columns cast to one type.

    Parquet readers cannot convert between, say, long and double files of one
    column within a single scan; separate scans with a cast on top can. Inputs that
    cannot be opened are reported and left out.
    """
    shapes, _ = parquet_shapes(spark, paths)
    frames = []
    for schema, members in shapes:
        df = scan_parquet(spark, members, schema, skip_corrupt)
        frames.append(df.select(*[
            F.col(c).cast(casts[c]).alias(c) if casts and c in casts else F.col(c)
            for c in df.columns
        ]))
    return frames


def scan_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    keep_corrupt: bool = False,
    skip_corrupt_files: bool = False,
) -> DataFrame:
    """CSV files that share one header, under a declared schema.

    Values are matched to columns by position, so the header is checked against
    the schema and a mismatch fails instead of swapping columns. With
    ``keep_corrupt`` a malformed row is kept with its text in ``_corrupt_record``.
    ``skip_corrupt_files`` goes on past unreadable files, whose rows are then lost
    without a trace: for salvage only.
    """
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("ignoreCorruptFiles", skip_corrupt_files)
    )
    if keep_corrupt:
        declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        schema = T.StructType([*declared.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv([path] if isinstance(path, str) else list(path))


def csv_shapes(
    spark: SparkSession, paths: Sequence[str]
) -> tuple[list[tuple[tuple[str, ...], list[str]]], dict[str, str]]:
    """CSV inputs grouped by their header line, which tasks read from the first block."""
    reader = spark.read.option("header", True).option("escape", '"')
    groups, failed = grouped_inputs(spark, paths, "csv")
    shapes: dict[tuple[str, ...], list[str]] = {}
    for members in groups:
        try:
            header = tuple(reader.csv(members[0]).columns)
        except READ_ERRORS as error:
            failed.update(dict.fromkeys(members, first_line(error)))
            continue
        shapes.setdefault(header, []).extend(members)
    _warn(failed)
    return list(shapes.items()), failed


def scan_csv_sets(
    spark: SparkSession,
    paths: Sequence[str],
    types: dict[str, str] | None = None,
    keep_corrupt: bool = False,
) -> list[DataFrame]:
    """One scan per distinct header; columns not in ``types`` are read as text."""
    shapes, _ = csv_shapes(spark, paths)
    frames = []
    for header, members in shapes:
        schema = ", ".join(f"`{c}` {(types or {}).get(c, 'string')}" for c in header)
        frames.append(scan_csv(spark, members, schema, keep_corrupt))
    return frames


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows, and the malformed ones for a quarantine table.

    The reader converts only the columns a query uses, so a bad value in another
    one would go unseen. Both sides therefore refer to every column: a row is
    judged as a whole, whatever is selected from it later.
    """
    nulls = reduce(
        lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in df.columns if c != CORRUPT]
    )
    read_all = nulls >= 0
    good = df.filter(F.col(CORRUPT).isNull() & read_all).drop(CORRUPT)
    return good, df.filter(F.col(CORRUPT).isNotNull() & read_all)


def scan_tree_csv(spark: SparkSession, folder: str, schema: T.StructType | str) -> DataFrame:
    """Every CSV file below a folder, at any depth."""
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .schema(schema)
        .csv(folder)
    )
