"""Alerts that hold a breach for some windows before they fire, on a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: A row of this series only moves the watermark on, so that what is open can end.
FLUSH = "\x00flush"

_STATE = "begin long, last long, n long, seen long, starts array<long>, breaches array<boolean>"


def stream_alerts(
    windows: DataFrame, series_col: str, start_col: str, breach: Column, width_seconds: int, hold_windows: int, delay: str
) -> DataFrame:
    """``fired`` and ``ended`` rows of runs of breaching windows.

    ``windows`` has a row for each series and window, in any order within ``delay``.  A run fires
    as soon as ``hold_windows`` windows in a row breach, while the breach lasts, and ends with the
    first window that doesn't breach or is missing, which an event-time timer notices.  A run that
    never fired ends silently.  State is a few numbers a series and the windows that the watermark
    hasn't passed.
    """
    width = width_seconds * 1000
    events = windows.select(
        F.col(series_col).alias("series"), F.col(start_col).cast("timestamp").alias("start"), F.coalesce(breach, F.lit(False)).alias("breach")
    ).withWatermark("start", delay)

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        begin, last, n, seen, starts, breaches = state.get if state.exists else (0, 0, 0, -(2**62), [], [])
        pending = dict(zip(starts, breaches, strict=True))
        for frame in frames:
            at = frame["start"].astype("datetime64[ms]").astype("int64")
            # Windows up to the last that was judged are over.
            pending |= {s: bool(b) for s, b in zip(at, frame["breach"], strict=True) if s > seen}
        now, rows = state.getCurrentWatermarkMs(), []

        def tell(event: str) -> None:
            rows.append((key[0], event, begin, last, n, begin + width * hold_windows))

        def end() -> None:
            nonlocal n
            if n >= hold_windows:
                tell("ended")
            n = 0

        for s in sorted(pending):
            if s + width > now:
                break
            if n and s != last + width:
                end()
            if pending.pop(s):
                begin = begin if n else s
                last, n = s, n + 1
                if n == hold_windows:
                    tell("fired")
            else:
                end()
            seen = s
        if n and last + 2 * width <= now and last + width not in pending:
            end()
        if n or pending:
            due = min([*([last + 2 * width] if n else []), *(s + width for s in pending)])
            state.update((begin, last, n, seen, list(pending), list(pending.values())))
            state.setTimeoutTimestamp(max(due, now + 1))
        else:
            state.remove()
        if rows:
            found = pd.DataFrame(rows, columns=["series", "event", "breach_start", "last_window", "n_windows", "fired_at"])
            for c in ("breach_start", "last_window", "fired_at"):
                found[c] = pd.to_datetime(found[c], unit="ms")
            yield found

    output = "series string, event string, breach_start timestamp, last_window timestamp, n_windows long, fired_at timestamp"
    return events.groupBy("series").applyInPandasWithState(
        run, output, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
