"""Landing prepared data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def land(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite") -> None:
    """Write a prepared frame as parquet, one directory per value of ``partition_by``."""
    writer = df.write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def land_stream(df: DataFrame, path: str, checkpoint: str, partition_by: str | None = None) -> StreamingQuery:
    """Write what a stream holds now as parquet, each row exactly once; a restart goes on at the checkpoint."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return writer.trigger(availableNow=True).start(path)
