"""Time-to-live reuse of results on a live request stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class _TtlProcessor(StatefulProcessor):
    """Keeps one expiry per key and forgets it once event time has passed it."""

    def __init__(self, ts_col: str, id_col: str, ttl_ms: int):
        self.ts_col, self.id_col, self.ttl_ms = ts_col, id_col, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        state = T.StructType([T.StructField("expiry_us", T.LongType())])
        self.expiry = handle.getValueState("expiry", state)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = list(rows)
        pdf = pd.concat(parts) if len(parts) > 1 else parts[0]
        pdf = pdf.sort_values([self.ts_col, self.id_col])
        us = pdf[self.ts_col].astype("datetime64[us]").astype("int64").to_numpy()
        hits = np.ones(len(us), dtype=bool)
        expiry = self.expiry.get()[0] if self.expiry.exists() else int(us[0])
        at = int(np.searchsorted(us, expiry, side="left"))
        while at < len(us):
            hits[at] = False
            expiry = int(us[at]) + self.ttl_ms * 1000
            at = int(np.searchsorted(us, expiry, side="left"))
        self.expiry.update((expiry,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(expiry // 1000 + 1)
        yield pdf.assign(cache_hit=hits)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.expiry.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_ttl_reuse(
    stream: DataFrame, key_col: str, ts_col: str, id_col: str, ttl_seconds: int
) -> DataFrame:
    """Requests with ``cache_hit``; needs a watermark on ``ts_col`` and the RocksDB state store.

    Rows of a key must arrive in event-time order across micro-batches, as in a request log.
    The state of a key is one number; the trigger bounds the rows of a key per batch.
    """
    schema = T.StructType([*stream.schema.fields, T.StructField("cache_hit", T.BooleanType())])
    return stream.groupBy(key_col).transformWithStateInPandas(
        _TtlProcessor(ts_col, id_col, ttl_seconds * 1000),
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime",
    )
