"""Rows behind the watermark, and results of windows that are still open."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vecspark.sources.workspace import path_exists


def split_late(stream: DataFrame, ts_col: str, delay_seconds: int, on_time: str, late: str, checkpoint: str) -> StreamingQuery:
    """Write each row to the table ``on_time``, or to ``late`` if it is behind the watermark.

    The watermark is the latest time of all earlier micro-batches less the delay, as Spark's own;
    rows without a time are late.  Both tables are partitioned by ``batch``.  A batch that is
    repeated after a failure replaces its files, so both should be read as tables, or as streams
    once the query has ended.
    """
    marks = f"{checkpoint}-marks"
    spark = stream.sparkSession

    def split(batch: DataFrame, number: int) -> None:
        watermark = F.lit(None).cast("timestamp")
        if path_exists(spark, marks):
            known = spark.read.schema("latest timestamp, batch long").parquet(marks)
            latest = known.filter(F.col("batch") < number).agg(F.max("latest")).first()[0]
            watermark = F.lit(latest).cast("timestamp") - F.expr(f"interval {delay_seconds} seconds")
        at = F.col(ts_col).cast("timestamp")
        is_late = at.isNull() | F.coalesce(at < watermark, F.lit(False))
        batch.filter(~is_late).write.mode("overwrite").parquet(f"{on_time}/batch={number}")
        batch.filter(is_late).write.mode("overwrite").parquet(f"{late}/batch={number}")
        # Last, so that a batch with a mark is whole.
        batch.agg(F.max(at).alias("latest")).write.mode("overwrite").parquet(f"{marks}/batch={number}")

    return stream.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def update_files(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write what changed in each micro-batch, open windows too, to a table partitioned by ``batch``."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def latest_updates(spark: SparkSession, path: str, updates: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """The newest row of each key of a table written by ``update_files`` from ``updates``."""
    written = spark.read.schema(updates.schema.add("batch", "long")).parquet(path)
    values = [c for c in updates.columns if c not in key_cols]
    newest = written.groupBy(*key_cols).agg(F.max_by(F.struct(*values), "batch").alias("_newest"))
    return newest.select(*[F.col(c) if c in key_cols else F.col(f"_newest.{c}").alias(c) for c in updates.columns])
