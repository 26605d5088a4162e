"""Trips to an embedded, partitioned table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vecspark.functions.text import trip_phrase
from vecspark.operators.clean import add_partition_keys, add_provenance, trip_is_clean
from vecspark.operators.embed import Encoder, embed, hash_embed
from vecspark.operators.merge import upsert_table
from vecspark.sources.tables import row_audit, write_partitioned


def embed_trips(
    trips: DataFrame,
    ingested_at: datetime,
    dim: int,
    make_encoder: Callable[[], Encoder] | None = None,
    model_name: str = "hashing",
    origin: str = "PULocationID",
    destination: str = "DOLocationID",
    distance: str = "trip_distance",
    fare: str = "fare_amount",
    ts_col: str = "tpep_pickup_datetime",
) -> DataFrame:
    """Clean, render and embed trips; every column of the input is kept, the key included."""
    clean = trips.filter(trip_is_clean(fare, distance))
    texts = clean.withColumn("text_repr", trip_phrase(origin, destination, distance, fare))
    if make_encoder is None:
        embedded = hash_embed(texts, "text_repr", dim)
    else:
        embedded = embed(texts, "text_repr", make_encoder, dim)
    return add_partition_keys(add_provenance(embedded, ingested_at, model_name, dim), ts_col)


def ingest_trips(
    trips: DataFrame,
    path: str,
    ingested_at: datetime,
    dim: int,
    distance: str = "trip_distance",
    fare: str = "fare_amount",
    **names,
) -> dict[str, int]:
    """Replace the months present in ``trips``; other months of the table stay.

    Returns the rows loaded and kept, counted while they are written.
    """
    audit = Observation("rows")
    counted = trips.observe(
        audit,
        F.count(F.lit(1)).alias("loaded"),
        F.count_if(trip_is_clean(fare, distance)).alias("kept"),
    )
    embedded = embed_trips(counted, ingested_at, dim, distance=distance, fare=fare, **names)
    write_partitioned(embedded, path, ["pickup_year", "pickup_month"])
    return audit.get


def audit_trips(trips: DataFrame, distance: str = "trip_distance", fare: str = "fare_amount") -> DataFrame:
    return row_audit(trips, trip_is_clean(fare, distance))


def incremental_ingest(
    feed: DataFrame,
    path: str,
    updated_at: datetime,
    keys: tuple[str, ...] = ("record_id",),
    partition_cols: tuple[str, ...] = ("year_month",),
    skip_unchanged: bool = False,
    change_log: str | None = None,
) -> dict[str, int]:
    """Stamp a feed and merge it into the table, creating the table on the first run.

    Returns the rows inserted, updated and unchanged.
    """
    stamped = feed.withColumn("updated_at", F.lit(updated_at).cast("timestamp"))
    return upsert_table(
        path, stamped, keys, partition_cols, skip_unchanged=skip_unchanged, ignore=["updated_at"],
        change_log=change_log,
    )
