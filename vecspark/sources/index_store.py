"""Index versions on shared storage: centroids, codebooks and postings as Parquet tables.

A version is usable once its row in ``versions`` is written, which happens last; readers
pick the newest row, so replacing an index never disturbs a running search.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecspark.sources.tables import read_partitioned
from vecspark.sources.workspace import path_exists

_VERSIONS = (
    "version int, dim int, nlist int, m int, nbits int, normalized boolean, "
    "shards array<string>, created_at timestamp"
)


@dataclass(frozen=True)
class StoredIndex:
    version: int
    dim: int
    nlist: int
    m: int | None
    normalized: bool
    centroids: DataFrame
    postings: DataFrame
    codebooks: DataFrame | None
    shards: list[str]


class UnknownShardError(KeyError):
    """The requested shard is not in the index."""


def versions(spark: SparkSession, path: str) -> DataFrame:
    table = f"{path}/versions"
    if not path_exists(spark, table):
        return spark.createDataFrame([], _VERSIONS)
    return spark.read.schema(_VERSIONS).parquet(table)


def latest_version(spark: SparkSession, path: str) -> int | None:
    return versions(spark, path).agg(F.max("version")).first()[0]


def save_index(
    path: str,
    centroids: DataFrame,
    postings: DataFrame,
    codebooks: DataFrame | None = None,
    id_col: str = "id",
    nbits: int = 8,
    normalized: bool = False,
) -> int:
    """Publish a new version and return its number.

    Postings are partitioned by shard and sorted by cell, so Parquet statistics skip cells
    that are not probed.  The id hash in the range key splits a hot cell over several tasks.
    """
    spark = postings.sparkSession
    version = (latest_version(spark, path) or 0) + 1
    root = f"{path}/version={version}"
    if "shard_key" not in postings.columns:
        postings = postings.withColumn("shard_key", F.lit("all"))
    centroids.write.mode("overwrite").parquet(f"{root}/centroids")
    if codebooks is not None:
        codebooks.write.mode("overwrite").parquet(f"{root}/codebooks")
    (
        postings.repartitionByRange("shard_key", "cell", F.xxhash64(id_col))
        .sortWithinPartitions("shard_key", "cell")
        .write.mode("overwrite")
        .partitionBy("shard_key")
        .parquet(f"{root}/postings")
    )
    written = read_partitioned(spark, f"{root}/postings", ["shard_key"])
    shards = [row[0] for row in written.select("shard_key").distinct().collect()]
    size = centroids.agg(F.count(F.lit(1)), F.max(F.size("centroid"))).first()
    m = None if codebooks is None else codebooks.agg(F.max("sub")).first()[0] + 1
    row = (
        version, size[1], size[0], m, None if m is None else nbits, normalized, sorted(shards),
        datetime.now(timezone.utc).replace(tzinfo=None),
    )
    spark.createDataFrame([row], _VERSIONS).coalesce(1).write.mode("append").parquet(
        f"{path}/versions"
    )
    return version


def load_index(
    spark: SparkSession, path: str, version: int | None = None, shard: str | None = None
) -> StoredIndex:
    """Open the newest or a given version; ``shard`` None or ``ALL`` opens every shard."""
    table = versions(spark, path)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    found = table.filter(F.col("version") == version).head(1)
    if not found:
        raise FileNotFoundError(f"no index version {version} under {path}")
    info = found[0]
    root = f"{path}/version={version}"
    postings = read_partitioned(spark, f"{root}/postings", ["shard_key"])
    shards = list(info.shards)
    if shard not in (None, "", "ALL"):
        if shard not in shards:
            raise UnknownShardError(f"shard {shard!r} not found; available: {shards}")
        postings, shards = postings.filter(F.col("shard_key") == shard), [shard]
    codebooks = spark.read.parquet(f"{root}/codebooks") if info.m else None
    return StoredIndex(
        version, info.dim, info.nlist, info.m, info.normalized, spark.read.parquet(f"{root}/centroids"), postings,
        codebooks, shards,
    )


def describe_index(index: StoredIndex) -> DataFrame:
    """One row per shard: vectors, dimension, type, training state, folder and bytes on disk."""
    kind = f"IVF{index.nlist}," + ("Flat" if index.m is None else f"PQ{index.m}")
    files = index.postings.groupBy(
        "shard_key",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
    ).agg(F.count(F.lit(1)).alias("n"))
    return files.groupBy("shard_key").agg(
        F.sum("n").alias("total_vectors"),
        F.lit(index.dim).alias("dimension"),
        F.lit(kind).alias("index_type"),
        F.lit(True).alias("is_trained"),
        F.min(F.regexp_replace("file", "/[^/]*$", "")).alias("index_path"),
        F.sum("bytes").alias("index_size_bytes"),
    )
