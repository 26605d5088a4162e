"""Starting streams: sources, event time and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def with_event_time(stream: DataFrame, ts_col: str, delay: str) -> DataFrame:
    """Event time as a timestamp with a watermark; rows later than ``delay`` are dropped."""
    return stream.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, delay)


def append_files(
    df: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append closed results to Parquet files, exactly once per micro-batch."""
    writer = df.writeStream.outputMode("append").format("parquet")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
