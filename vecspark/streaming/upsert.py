"""Continuous incremental ingest into a partitioned table."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from vecspark.operators.merge import upsert_table
from vecspark.sources.workspace import path_exists


def batch_upsert(
    table_path: str,
    checkpoint: str,
    keys: Sequence[str],
    partition_cols: Sequence[str],
    latest_by: Sequence[str] | None = None,
    change_log: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """What merges a micro-batch: once, however often the batch comes.

    First the log gets the batch's changes, then the table, and last a marker with the counts is
    written beside the checkpoint.  A batch with a marker is done.  One without is merged again,
    which changes nothing that is merged already, and finds its changes if they are in the log.
    Another checkpoint numbers other batches, so its name is part of theirs.
    """
    run = f"{zlib.crc32(checkpoint.encode()):08x}"

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        spark, marker = batch.sparkSession, f"{checkpoint}-merged/batch={batch_id}"
        if path_exists(spark, f"{marker}/_SUCCESS"):
            return
        counts = upsert_table(
            table_path, batch, keys, partition_cols, latest_by, change_log=change_log, batch=f"{run}-{batch_id}"
        )
        row = [tuple(counts[c] for c in ("inserted", "updated", "unchanged"))]
        done = spark.createDataFrame(row, "inserted long, updated long, unchanged long")
        done.coalesce(1).write.mode("overwrite").parquet(marker)

    return merge_batch


def stream_upsert(
    stream: DataFrame,
    table_path: str,
    checkpoint: str,
    keys: Sequence[str],
    partition_cols: Sequence[str],
    latest_by: Sequence[str] | None = None,
    available_now: bool = True,
    change_log: str | None = None,
) -> StreamingQuery:
    """Merge each micro-batch into the table, once (see ``batch_upsert``).

    ``latest_by`` picks one row when a batch holds a key more than once; ``change_log`` names a
    folder for the changes of all batches.
    """
    merge_batch = batch_upsert(table_path, checkpoint, keys, partition_cols, latest_by, change_log)
    writer = stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
