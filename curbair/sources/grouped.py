"""Data sets of one directory per group, written and read by tasks through pyarrow.

Groups may be many and of few rows, so what counts is the work per file. Spark's writer
makes, commits and checks each file by several calls, on a machine's own disk by several
processes, and its committer moves every file from the driver; its scan lists every
directory by a task of its own.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from curbair.sources.shapes import _open

#: Directory of a missing or empty value, as Spark names it.
MISSING = "__HIVE_DEFAULT_PARTITION__"
#: Column with the bodies of the files.
BODY = "__body"
#: Bytes of a group that a task holds before it writes them.
HELD_BYTES = 16 << 20
#: Files of fewer rows take about one block of a disk however they are packed.
FEW_ROWS = 32
#: Rows of the batches that a reading task returns.
BATCH_ROWS = 10_000

# what Spark escapes in the name of a directory
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{[\]^]""")


def escaped(name: str) -> str:
    return _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", name)


def directory(columns: Sequence[str], values: Sequence[str | None]) -> str:
    """``name=value`` directories of a group, named as Spark names them."""
    return "/".join(f"{escaped(c)}={escaped(v) if v else MISSING}" for c, v in zip(columns, values, strict=True))


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path with its scheme."""
    context = spark.sparkContext
    given = context._jvm.org.apache.hadoop.fs.Path(path)
    store = given.getFileSystem(context._jsc.hadoopConfiguration())
    return store, store.makeQualified(given)


def opens(uri: str) -> bool:
    """Can tasks open this store by pyarrow?"""
    try:
        _open(uri)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


_COALESCING, _ONE = "spark.sql.adaptive.coalescePartitions.enabled", threading.Lock()


@contextmanager
def uncoalesced(spark: SparkSession) -> Iterator[None]:
    """Shuffles keep their number of partitions: AQE merges them by bytes, and here the
    work is that of the files. No file more is written, as a group lies in one partition
    unless it is large. Jobs that run meanwhile are not merged either."""
    with _ONE:
        before = spark.conf.get(_COALESCING)
        spark.conf.set(_COALESCING, "false")
        try:
            yield
        finally:
            spark.conf.set(_COALESCING, before)


class GroupFile:
    """One file of a group: written under a hidden name and moved to its place when whole.

    A task that runs again writes the same groups in the same order, so its files replace
    those of the attempt before.
    """

    def __init__(self, store, folder: str, name: str, attempt: int, header: str | None):
        self.store, self.header = store, header
        self.place, self.made = f"{folder}/{name}", f"{folder}/.{name}.{attempt}"
        self.held: list[pa.RecordBatch] = []
        self.bytes, self.out, self.writer = 0.0, None, None
        store.create_dir(folder, recursive=True)

    def add(self, batch: pa.RecordBatch, size: float) -> None:
        self.held.append(batch)
        self.bytes += size
        if self.bytes >= HELD_BYTES:
            self.flush()

    def flush(self) -> None:
        rows = pa.Table.from_batches(self.held)
        first = self.out is None
        if first:
            self.out = self.store.open_output_stream(self.made)
        if self.header is not None:
            lines = [*[self.header] * first, *rows.column(0).to_pylist(), ""]
            self.out.write("\n".join(lines).encode())
        else:
            import pyarrow.parquet as pq

            if first:
                few = len(rows) < FEW_ROWS
                self.writer = pq.ParquetWriter(
                    self.out, rows.schema, use_dictionary=not few, compression="none" if few else "snappy",
                    store_schema=False)
            self.writer.write_table(rows)
        self.held, self.bytes = [], 0.0

    def close(self) -> None:
        if self.held:
            self.flush()
        if self.writer:
            self.writer.close()
        self.out.close()
        try:
            self.store.move(self.made, self.place)
        except OSError:  # a store that does not replace files
            self.store.delete_file(self.place)
            self.store.move(self.made, self.place)


def write_groups(
    laid_out: DataFrame, path: str, copies: Sequence[str], fmt: str, overwrite: bool, header: str | None = None,
) -> None:
    """Write rows that lie sorted by ``copies``, which are text, to a directory per group.

    The struct ``BODY`` has what goes into the files: columns of Parquet, or a single one
    with lines of CSV below ``header``. Everything is written beside ``path`` and becomes visible by one rename.
    """
    spark = laid_out.sparkSession
    store, place = file_system(spark, path)
    if store.exists(place) and not overwrite:
        spark.range(0).write.parquet(path)  # raises what Spark's own writer raises
    job = uuid.uuid4().hex
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    beside = files.Path(place.getParent(), f"_{place.getName()}-{job}")
    base, columns = beside.toString(), list(copies)
    notes = {"org.apache.spark.version": spark.version,
             "org.apache.spark.sql.parquet.row.metadata": laid_out.schema[BODY].dataType.json()}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        target, root = _open(base)
        context = TaskContext.get()
        group, file, number, count = None, None, 0, 0
        for batch in batches:
            *keys, bodies = batch.columns
            rows = pa.RecordBatch.from_struct_array(bodies).replace_schema_metadata(notes)
            start, row_bytes = 0, rows.nbytes / max(1, len(rows))
            for end in sorted({e for k in keys for e in pc.run_end_encode(k).run_ends.to_pylist()}):
                found = [k[start].as_py() for k in keys]
                if found != group:
                    if file:
                        file.close()
                    group = found
                    name = f"part-{context.partitionId():05d}-{job}.c{number:06d}.{fmt}"
                    file = GroupFile(target, f"{root}/{directory(columns, group)}", name, context.taskAttemptId(), header)
                    number += 1
                file.add(rows.slice(start, end - start), row_bytes * (end - start))
                count, start = count + end - start, end
        if file:
            file.close()
        yield pa.record_batch([pa.array([count], pa.int64())], names=["rows"])

    try:
        store.mkdirs(beside)
        with uncoalesced(spark):
            laid_out.mapInArrow(write, "rows bigint").write.format("noop").mode("overwrite").save()
        store.create(files.Path(beside, "_SUCCESS")).close()
        if overwrite:
            store.delete(place, True)
        if not store.rename(beside, place):
            raise OSError(f"cannot move {base} to {place.toString()}")
    except BaseException:
        store.delete(beside, True)
        raise


def _first_file(store, folder):
    """The first data file below a folder, or None."""
    for status in sorted(store.listStatus(folder), key=lambda s: s.getPath().getName()):
        if status.getPath().getName().startswith(("_", ".")):
            continue
        found = _first_file(store, status.getPath()) if status.isDirectory() else status.getPath()
        if found is not None:
            return found
    return None


def read_groups(spark: SparkSession, path: str, copies: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """``columns`` of the Parquet bodies of a directory per group, all if not named, and
    ``copies`` as text from the names of the directories; a missing value is NULL.

    All bodies are alike. Directories of the first group are listed by tasks, each with
    all that lies below it.
    """
    store, place = file_system(spark, path)
    base, groups = place.toString(), list(copies)
    first = _first_file(store, place)
    if first is None or not opens(base):
        found = spark.read.option("basePath", path).parquet(path).withColumns({c: F.col(c).cast("string") for c in groups})
        return found if columns is None else found.select(*columns, *groups)
    body = spark.read.parquet(first.toString())
    wanted = (body if columns is None else body.select(*columns)).schema
    result = T.StructType([*wanted.fields, *[T.StructField(c, T.StringType()) for c in groups]])
    tops = sorted(s.getPath().getName() for s in store.listStatus(place) if s.isDirectory())
    tops = [(t,) for t in tops if not t.startswith(("_", "."))]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        source, root = _open(base)
        hidden = re.compile(r"/[_.][^/=]*(/|$)")
        for batch in batches:
            for top in batch.column(0).to_pylist():
                below = source.get_file_info(fs.FileSelector(f"{root}/{top}", recursive=True))
                found = [f.path[len(root):] for f in below if f.type == fs.FileType.File]
                yield pa.record_batch([pa.array([f for f in found if not hidden.search(f)], pa.string())], names=["file"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        source, root = _open(base)
        target = to_arrow_schema(result)
        names, held, texts, count = [f.name for f in wanted.fields], [], [[] for _ in groups], 0

        def whole() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).select(names).combine_chunks()
            found = [*rows.columns, *[pa.array(t, pa.string()) for t in texts]]
            cast = [c.cast(f.type) for c, f in zip(found, target, strict=True)]
            yield from pa.Table.from_arrays(cast, schema=target).to_batches(max_chunksize=BATCH_ROWS)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                parts = dict(p.split("=", 1) for p in name.strip("/").split("/")[:-1])
                values = [parts[escaped(c)] for c in groups]
                values = [None if v == MISSING else unquote(v) for v in values]
                with source.open_input_file(root + name) as file:
                    for rows in pq.ParquetFile(file).iter_batches(BATCH_ROWS, columns=names, use_threads=False):
                        held.append(rows.replace_schema_metadata(None))
                        count += len(rows)
                        for text, value in zip(texts, values, strict=True):
                            text.extend([value] * len(rows))
                        if count >= BATCH_ROWS:
                            yield from whole()
                            held, texts, count = [], [[] for _ in groups], 0
        if held:
            yield from whole()

    folders = spark.createDataFrame(tops, "top string").repartition(max(1, len(tops)), "top")
    # a number that is given is not merged by bytes
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return folders.mapInArrow(listed, "file string").repartition(tasks, "file").mapInArrow(read, result)
