"""Event times as numbers, independent of the session time zone for local timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DAY = 86_400_000_000


def micros(df: DataFrame, ts_col: str) -> Column:
    """Microseconds since 1970 of a timestamp column of either kind."""
    ts = F.col(ts_col)
    if isinstance(df.schema[ts_col].dataType, T.TimestampNTZType):
        seconds = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("bigint")
        fraction = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
        return F.unix_date(ts.cast("date")).cast("bigint") * _DAY + seconds * 1_000_000 + fraction
    return F.unix_micros(ts)
