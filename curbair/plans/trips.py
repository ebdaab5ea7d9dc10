"""Trip files: clean each of them once, merge them per taxi type."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from curbair.operators import quality
from curbair.operators.conform import ConformError, conform
from curbair.operators.joins import unprocessed
from curbair.operators.organise import dataset_name
from curbair.operators.trips import clean_trips
from curbair.operators.unions import merge_trips
from curbair.plans import manifest as log
from curbair.plans.errors import EmptyResult
from curbair.schemas import MERGED_TRIPS, TRIP_FILES, TRIP_PREFIX, TRIP_SPECS, TripSpec
from curbair.sources import files, sinks
from curbair.sources.staging import staged

DATASET = "clean_trips"


@dataclass
class CleanResult:
    """Status by file name, and the reject counts per file."""

    status: dict[str, str] = field(default_factory=dict)
    reports: list[DataFrame] = field(default_factory=list)


Scan = Callable[[list[str]], DataFrame]


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _shape_groups(
    spark: SparkSession, paths: list[str], spec: TripSpec, keep_corrupt: bool = False
) -> tuple[list[tuple[Scan, list[str]]], dict[str, str]]:
    """Files grouped by shape, each group with its way of scanning some of them."""
    csv = [p for p in paths if p.lower().endswith(".csv")]
    parquet = [p for p in paths if not p.lower().endswith(".csv")]
    # integers may be written as decimals: the cast to the declared type comes later
    numbers = {c: "double" if t in ("int", "bigint") else t
               for c, t in spec.columns.items() if t != "timestamp_ntz"}

    def csv_scan(header: tuple[str, ...]) -> Scan:
        schema = ", ".join(f"`{c}` {numbers.get(c, 'string')}" for c in header)
        return lambda some: files.scan_csv(spark, some, schema, keep_corrupt)

    def parquet_scan(schema: T.StructType) -> Scan:
        return lambda some: files.scan_parquet(spark, some, schema)

    headers, bad_csv = files.csv_shapes(spark, csv)
    schemas, bad_parquet = files.parquet_shapes(spark, parquet)
    groups = [(csv_scan(h), members) for h, members in headers]
    groups += [(parquet_scan(s), members) for s, members in schemas]
    return groups, {**bad_csv, **bad_parquet}


def clean_files(
    spark: SparkSession, folder: str, output: str, manifest: str, run_id: str,
    incremental: bool = True, fmt: str = "parquet", report: bool = True,
    quarantine: str | None = None,
) -> CleanResult:
    """Clean the trip files of a folder into ``<output>/<taxi type>/source_file=<name>``.

    ``incremental`` leaves out files the manifest lists as done. A file that cannot
    be read or lacks required columns is recorded as failed and does not stop the
    others. Outputs are replaced per file, so a repeated run cannot duplicate rows.
    With ``quarantine`` the malformed CSV rows go there instead of counting as
    rejected. A folder without any trip file raises ``EmptyResult``; one without new
    files has nothing to do.
    """
    listing = staged(files.list_inputs(spark, folder, TRIP_FILES), "trip-files")
    if listing.isEmpty():
        raise EmptyResult(f"no trip files in {folder}")
    if incremental:
        listing = unprocessed(listing, log.finished(log.read_manifest(spark, manifest), DATASET))
    paths = files.paths_of(listing)
    result = CleanResult()
    details: dict[str, str] = {}

    def mark(members: list[str], status: str, detail: str | None = None) -> None:
        for path in members:
            name = _name(path)
            result.status[name] = status
            if detail:
                details[name] = detail

    for spec in TRIP_SPECS.values():
        mine = [p for p in paths if _name(p).startswith(f"{spec.taxi_type}_")]
        groups, unreadable = _shape_groups(spark, mine, spec, quarantine is not None)
        for path, error in unreadable.items():
            mark([path], "failed", error)
        target = f"{output}/{spec.taxi_type}"
        for scan, members in groups:
            made: list[DataFrame] = []

            def clean(some: list[str], scan: Scan = scan, made: list[DataFrame] = made) -> None:
                named = files.with_source_file(scan(some))
                if quarantine and files.CORRUPT in named.columns:
                    named, malformed = files.split_corrupt(named)
                    sinks.replace_sources(
                        malformed.select(files.CORRUPT, files.SOURCE_FILE),
                        f"{quarantine}/{spec.taxi_type}", "parquet",
                    )
                cleaned = clean_trips(named, spec, fmt == "csv", carry=(files.SOURCE_FILE,))
                sinks.replace_sources(cleaned, target, fmt)
                made[:] = [cleaned]

            try:
                failed = sinks.halving(clean, members)
            except ConformError as error:
                mark(members, "failed", str(error))
                continue
            for path, error in failed.items():
                mark([path], "failed", error)
            done = [p for p in members if p not in failed]
            mark(done, "done")
            if done and (report or not incremental):
                named = files.with_source_file(scan(done))
                if files.CORRUPT in named.columns:
                    named, _ = files.split_corrupt(named)
                counts = staged(quality.clean_report(named, spec, by=(files.SOURCE_FILE,)), "clean-counts")
                if report:
                    result.reports.append(
                        quality.as_report(counts, run_id, spec.taxi_type, files.SOURCE_FILE)
                    )
                if not incremental:  # an earlier output must not outlive its last valid row
                    kept = {r[0] for r in counts.filter("rows_kept > 0").select(files.SOURCE_FILE).toLocalIterator()}
                    gone = sorted({_name(p) for p in done} - kept)
                    sinks.clear_sources(spark, gone, target, made[0], fmt)
    log.record(spark, manifest, [
        {"run_id": run_id, "dataset": DATASET, "source_file": name, "status": status,
         "detail": details.get(name)}
        for name, status in result.status.items()
    ])
    return result


def cleaned_frames(spark: SparkSession, folder: str, spec: TripSpec, fmt: str = "parquet") -> list[DataFrame]:
    """Cleaned files of one type: declared columns, one frame per shape."""
    base = f"{folder}/{spec.taxi_type}"
    if fmt == "parquet":
        folders = files.folders_of(files.list_files(spark, base, "*.parquet", recursive=True))
        shapes, unreadable = files.parquet_shapes(spark, folders)
        if unreadable:
            raise OSError(f"{len(unreadable)} cleaned inputs cannot be read: {next(iter(unreadable.items()))}")
        # a time column without its partner was kept as it came; here it becomes a time
        return [conform(files.scan_parquet(spark, some, shape), spec.columns) for shape, some in shapes]
    folders = files.folders_of(files.list_files(spark, base, "*.csv", recursive=True))
    frames = files.scan_csv_sets(spark, folders)
    numbers = {c: t for c, t in spec.columns.items() if t != "timestamp_ntz"}
    return [
        f.select(*[F.col(c).cast(numbers.get(c, "string")).alias(c) for c in f.columns])
        for f in frames
    ]


def merge_files(
    spark: SparkSession, cleaned: str, output: str, first_day: str, last_day: str, run_id: str,
    fmt: str = "parquet", prefix: str = TRIP_PREFIX, date_range: tuple | None = None,
    dedup_keys: list[str] | None = None,
) -> dict[str, str]:
    """Merge the cleaned files of each taxi type in pickup order; paths by type.

    Each result is a directory whose files, in name order, are sorted by pickup. Nothing
    cleaned of any type raises ``EmptyResult``.
    """
    base = f"{output}/{dataset_name(prefix, first_day, last_day, run_id)}"
    written = {}
    for spec in TRIP_SPECS.values():
        try:
            frames = cleaned_frames(spark, cleaned, spec, fmt)
        except AnalysisException as error:
            if not files.path_missing(error):
                raise
            continue  # no file of this type was cleaned
        if not frames:
            continue
        merged = merge_trips(frames, spec, date_range, dedup_keys)
        path = f"{base}/{MERGED_TRIPS.format(taxi_type=spec.taxi_type)}"
        if fmt == "csv":
            sinks.write_csv(merged, path)
        else:
            sinks.write_parquet(merged, path)
        written[spec.taxi_type] = path
    if not written:
        raise EmptyResult(f"no cleaned trips in {cleaned}")
    return written
