"""Writing what arrived since the last run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def write_once(
    stream: DataFrame, output: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append everything available to Parquet, exactly once, then stop.

    Progress is kept in ``checkpoint``, which belongs to ``output`` and must lie in
    a folder all executors share.
    """
    writer = stream.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (
        writer.option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
