"""Which shards a request has to look at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_shards(start: Column, end: Column, prefix: str = "") -> Column:
    """Month shards that cover a date range; none when the range is empty or open."""
    first, last = F.trunc(start, "MM"), F.trunc(end, "MM")
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    months = F.coalesce(months, F.array().cast("array<date>"))
    return F.transform(months, lambda m: F.concat(F.lit(prefix), F.date_format(m, "yyyy-MM")))


def route(requests: DataFrame, start_col: str, end_col: str, prefix: str = "") -> DataFrame:
    """Requests with the array ``shards``."""
    shards = month_shards(F.col(start_col), F.col(end_col), prefix)
    return requests.withColumn("shards", shards)


def tag_shards(routed: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """Request-shard pairs with ``known``: whether the catalogue has the shard."""
    pairs = routed.select(key, F.explode("shards").alias("shard_key"))
    names = catalog.select("shard_key").distinct().withColumn("known", F.lit(True))
    joined = pairs.join(names, "shard_key", "left")
    return joined.withColumn("known", F.coalesce("known", F.lit(False)))


def check_shards(routed: DataFrame, catalog: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Known request-shard pairs, and the unknown ones for an explicit error."""
    tagged = tag_shards(routed, catalog, key)
    return tagged.filter("known").drop("known"), tagged.filter("NOT known").drop("known")
