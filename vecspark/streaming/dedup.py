"""Suppression of repeated requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from vecspark.streaming.runs import with_event_time


def stream_dedup(stream: DataFrame, keys: Sequence[str], ts_col: str, delay: str) -> DataFrame:
    """The first row of each key; state is dropped once the watermark passes it."""
    return with_event_time(stream, ts_col, delay).dropDuplicatesWithinWatermark(list(keys))
