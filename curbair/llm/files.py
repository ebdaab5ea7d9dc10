"""Binary files written and read by tasks, on any store that pyarrow can open.

A task names its files by partition and attempt and reports them in rows; the table
of those rows, written by Spark, is the manifest. Files of lost attempts are in no
manifest, so nothing reads them twice.
"""

from __future__ import annotations

import re

from pyspark import TaskContext


def _open(uri: str):
    from pyarrow import fs

    local = re.match(r"file:/+(.*)|(/.*)", uri)
    if local:
        return fs.LocalFileSystem(), "/" + (local[1] if local[1] is not None else local[2].lstrip("/"))
    return fs.FileSystem.from_uri(uri)


def put(uri: str, data: bytes) -> None:
    store, path = _open(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(path) as out:
        out.write(data)


def get(uri: str) -> bytes:
    store, path = _open(uri)
    with store.open_input_stream(path) as source:
        return source.read()


def remove(spark, folder: str) -> None:
    """Remove a folder that tasks have written to."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def task_name(prefix: str, number: int, suffix: str) -> str:
    """A file name no other attempt of any task uses."""
    context = TaskContext.get()
    return f"{prefix}-{context.partitionId():06d}-{context.taskAttemptId()}-{number:05d}{suffix}"
