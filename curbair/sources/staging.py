"""Tables written once and read back, in the folder the cluster shares.

A staged table cuts lineage, survives the loss of any executor and has a size
that can be read off before it is broadcast.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, or else its context's checkpoint folder.

    Neither being set is an error: a machine's own folder is not visible to the
    others, so the library never picks one itself.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and return a scan of it."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove the files of staged tables that nothing will read any more."""
    for table in tables:
        spark = table.sparkSession
        below = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
        root = below.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        inside = root.makeQualified(below).toUri().getPath().rstrip("/") + "/"
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            if not path.toUri().getPath().startswith(inside):
                raise ValueError(f"not a staged table: {folder}")
            root.delete(path, True)
