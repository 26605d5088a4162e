"""Row filters and derived columns of the ingest path."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecspark.functions.vectors import has_direction, is_searchable


def trip_is_clean(fare: str, distance: str, max_distance: float = 100) -> Column:
    return (F.col(fare) > 0) & (F.col(distance) > 0) & (F.col(distance) < max_distance)


def trip_is_valid(
    fare: str, distance: str, passengers: str, min_fare: float = 2.5, min_distance: float = 0.1
) -> Column:
    return (
        (F.col(distance) > min_distance)
        & (F.col(fare) > min_fare)
        & F.col(passengers).between(1, 6)
    )


def clean_trips(
    df: DataFrame, fare: str, distance: str, columns: Sequence[str], max_distance: float = 100
) -> DataFrame:
    return df.filter(trip_is_clean(fare, distance, max_distance)).select(*columns)


def valid_trips(
    df: DataFrame,
    fare: str,
    distance: str,
    passengers: str,
    min_fare: float = 2.5,
    min_distance: float = 0.1,
) -> DataFrame:
    return df.filter(trip_is_valid(fare, distance, passengers, min_fare, min_distance))


def add_provenance(df: DataFrame, ingested_at: datetime, model_name: str, dim: int) -> DataFrame:
    """One constant time per run, so that a rerun with the same time gives the same rows."""
    return df.withColumns(
        {
            "ingestion_timestamp": F.lit(ingested_at.isoformat(sep=" ")).cast("timestamp_ntz"),
            "model_name": F.lit(model_name),
            "embedding_dimension": F.lit(dim),
        }
    )


def add_partition_keys(
    df: DataFrame, ts_col: str, year_col: str = "pickup_year", month_col: str = "pickup_month"
) -> DataFrame:
    ts = F.col(ts_col)
    return df.withColumns(
        {
            year_col: F.year(ts),
            month_col: F.month(ts),
            "year_month": F.date_format(ts, "yyyy-MM"),
        }
    )


def split_by_dimension(df: DataFrame, vec_col: str, dim: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose vector can be searched, and the rejected rest with the reason."""
    ok = is_searchable(vec_col, dim)
    reason = (
        F.when(F.col(vec_col).isNull(), "missing")
        .when(F.size(vec_col) != dim, "wrong_dimension")
        .otherwise("not_a_number")
    )
    return df.filter(ok), df.filter(~ok).withColumn("reason", reason)


def indexable(df: DataFrame, vec_col: str, dim: int) -> DataFrame:
    """Searchable vectors only; zero vectors (blank or failed texts) stay out of an index."""
    return df.filter(is_searchable(vec_col, dim) & has_direction(vec_col))
