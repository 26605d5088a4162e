"""Postings in balanced ranges of cells, so that a search reads the files of the ranges it probes.

A partition for each cell would give a large index too many folders.  Here neighbouring cells share
one, cut by the histogram of the cells; the directory names the range of each cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecspark.sources.tables import read_partitioned
from vecspark.sources.workspace import materialize

_DIRECTORY = "shard_key string, cell int, n long, cell_range long"


def cell_directory(postings: DataFrame, rows_per_range: int) -> DataFrame:
    """``shard_key, cell, n, cell_range``: a row for each cell of each shard that holds vectors.

    A range takes the cells that start within its ``rows_per_range`` rows of the shard, so it holds
    less than that and its last cell.  The histogram is no larger than shards times cells.
    """
    if rows_per_range < 1:
        raise ValueError("rows_per_range is at least 1")
    counts = postings.groupBy("shard_key", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard_key").orderBy("cell")) - F.col("n")
    return counts.withColumn("cell_range", F.floor(before / rows_per_range))


def write_cell_ranges(path: str, postings: DataFrame, rows_per_range: int, id_col: str = "id") -> None:
    """Write directory and postings, which carry ``cell`` and, unless there is one shard, ``shard_key``.

    The hash of the id lets a hot cell be written by several tasks.
    """
    spark = postings.sparkSession
    own = F.col("shard_key").cast("string") if "shard_key" in postings.columns else F.lit("all")
    postings = postings.withColumn("shard_key", own)
    directory = cell_directory(postings, rows_per_range)
    directory.coalesce(1).write.mode("overwrite").parquet(f"{path}/directory")
    known = read_directory(spark, path).drop("n")
    (
        postings.join(known, ["shard_key", "cell"])
        .repartitionByRange("shard_key", "cell_range", "cell", F.xxhash64(id_col))
        .sortWithinPartitions("shard_key", "cell_range", "cell")
        .write.mode("overwrite")
        .partitionBy("shard_key", "cell_range")
        .parquet(f"{path}/postings")
    )


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_DIRECTORY).parquet(f"{path}/directory")


def read_cells(path: str, wanted: DataFrame) -> DataFrame:
    """The postings of the wanted cells, each once, from the files of their ranges alone.

    ``wanted`` has ``cell``, and ``shard_key`` where only some shards are meant; rows may repeat.
    Cells too many to be broadcast are joined without pruning.
    """
    spark = wanted.sparkSession
    keys = [c for c in ("shard_key", "cell") if c in wanted.columns]
    known = read_directory(spark, path).drop("n")
    # Written, so that its size is known when Spark plans: it prunes partitions at run time for a
    # side that is broadcast and that a filter makes smaller.
    touched = materialize(known.join(wanted.select(*keys), keys, "left_semi"), "touched")
    touched = touched.filter(F.col("cell_range") >= 0)
    postings = read_partitioned(spark, f"{path}/postings", ["shard_key", "cell_range"])
    postings = postings.withColumn("cell_range", F.col("cell_range").cast("long"))
    return postings.join(touched, ["shard_key", "cell_range", "cell"])
