"""Parquet scans, partitioned writes, row audits, samples and shard discovery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Hash prefix used to cut a sample; 16 ** 5 groups at most, whatever the table holds.
_SAMPLE_PREFIX_LENGTH = 5


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_partitioned(spark: SparkSession, path: str, partition_cols: Sequence[str]) -> DataFrame:
    """Read a partitioned table with its partition values as written, not as numbers or dates."""
    found = spark.read.parquet(path).schema
    fields = [
        T.StructField(f.name, T.StringType()) if f.name in partition_cols else f for f in found.fields
    ]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def row_audit(df: DataFrame, keep: Column) -> DataFrame:
    """Rows loaded, kept and dropped by a filter, in one scan. A null verdict drops the row."""
    kept = F.count_if(keep)
    return df.agg(F.count(F.lit(1)).alias("loaded"), kept.alias("kept")).withColumn(
        "dropped", F.col("loaded") - F.col("kept")
    )


def write_partitioned(
    df: DataFrame, path: str, partition_cols: Sequence[str], mode: str = "overwrite"
) -> None:
    """Write partitioned Parquet.

    ``overwrite`` replaces only the partitions present in ``df``; ``replace_all`` replaces
    the whole table; ``append`` adds files.  The rebalance hint gives each partition few
    files while AQE splits a hot one over several tasks.
    """
    laid_out = df.hint("rebalance", *partition_cols)
    writer = laid_out.write.partitionBy(*partition_cols)
    if mode == "overwrite":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    elif mode == "replace_all":
        writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    elif mode == "append":
        writer.mode("append").parquet(path)
    else:
        raise ValueError(f"unknown mode {mode!r}")


def seeded_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if fewer) with the smallest seeded hashes of their ids.

    The hash prefix histogram first finds how far the sample reaches, so that the final
    sort only sees about ``n`` rows instead of ``n`` from every task.
    """
    digest = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"_{seed}")))
    prefix = F.substring(digest, 1, _SAMPLE_PREFIX_LENGTH)
    histogram = df.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(
        Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    )
    reach = (
        histogram.withColumn("before", F.coalesce(before, F.lit(0)))
        .filter(F.col("before") < n)
        .agg(F.max("prefix").alias("prefix"))
    )
    candidates = df.withColumn("_digest", digest).filter(prefix <= reach.scalar())
    return candidates.orderBy("_digest", id_col).limit(n).drop("_digest")


def preview(df: DataFrame, columns: Sequence[str], order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows of a few columns; unused columns are never computed."""
    return df.select(*columns).orderBy(*order_by).limit(n)


def shard_catalog(spark: SparkSession, path: str, shard_col: str = "shard_key") -> DataFrame:
    """Shards found in a partitioned table, with their row counts."""
    return (
        read_partitioned(spark, path, [shard_col])
        .groupBy(F.col(shard_col).alias("shard_key"))
        .agg(F.count(F.lit(1)).alias("total_rows"))
    )
