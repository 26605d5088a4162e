"""Shared pieces of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def in_micros(vec: Column | str) -> Column:
    """A vector as text of whole millionths, which compares exactly."""
    values = F.transform(F.col(vec) if isinstance(vec, str) else vec, _millionths)
    return F.array_join(values, ",")


def _millionths(x: Column) -> Column:
    return F.round(x.cast("double") * 1_000_000).cast("bigint").cast("string")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")
