"""Index statistics, compression accounting, smoke test and refresh."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.operators.ivf import assign_cells, ivf_flat_search
from vecspark.operators.pq import pq_encode

_ID_BYTES = 8
_FLOAT_BYTES = 4


def index_info(
    postings: DataFrame, nlist: int, vec_col: str = "embedding", shard: str | None = None
) -> DataFrame:
    """Size, dimension and cell occupancy of each shard, or of one; None or ``ALL`` means all."""
    if shard not in (None, "", "ALL"):
        postings = postings.filter(F.col("shard_key") == shard)
    per_cell = postings.groupBy("shard_key", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size(vec_col)).alias("dim")
    )
    return per_cell.groupBy("shard_key").agg(
        F.sum("n").alias("total_vectors"),
        F.max("dim").alias("dimension"),
        F.min("n").alias("smallest_cell"),
        F.max("n").alias("largest_cell"),
        (F.sum("n") / F.count(F.lit(1))).alias("avg_cell"),
        (F.lit(nlist) - F.count(F.lit(1))).alias("empty_cells"),
    )


def index_compression(info: DataFrame, m: int, nbits: int, nlist: int) -> DataFrame:
    """Bytes of the raw vectors and of the coded index, model included, and the saving."""
    n, dim = F.col("total_vectors"), F.col("dimension")
    raw = n * dim * _FLOAT_BYTES
    model = F.lit(nlist) * dim * _FLOAT_BYTES + F.lit(1 << nbits) * dim * _FLOAT_BYTES
    coded = n * (m * nbits / 8 + _ID_BYTES) + model
    return info.select(
        "shard_key",
        raw.cast("bigint").alias("raw_bytes"),
        coded.cast("bigint").alias("index_bytes"),
        (1 - coded / raw).alias("saving"),
    )


def smoke_test(
    postings: DataFrame,
    centroids: DataFrame,
    n_queries: int = 5,
    k: int = 10,
    nprobe: int = 10,
    id_col: str = "id",
    vec_col: str = "embedding",
) -> DataFrame:
    """Search the first few indexed vectors; each should find itself at rank 1."""
    first = postings.orderBy(id_col).limit(n_queries)
    queries = first.select(F.col(id_col).alias("query_id"), F.col(vec_col).alias("query_vector"))
    hits = ivf_flat_search(postings, centroids, queries, k, nprobe, id_col=id_col, vec_col=vec_col)
    return hits.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.min("distance").alias("nearest_distance"),
        F.max(F.when(F.col("rank") == 1, F.col(id_col) == F.col("query_id"))).alias("found_itself"),
    )


def refresh_postings(
    postings: DataFrame,
    changed: DataFrame,
    centroids: DataFrame,
    id_col: str = "id",
    vec_col: str = "embedding",
    deleted: DataFrame | None = None,
    codebooks: DataFrame | None = None,
) -> DataFrame:
    """Postings after a merge: only changed rows are assigned again, with the same centroids.

    Postings with codes need the ``codebooks`` that the changed rows are encoded with.
    """
    coded = "codes" in postings.columns
    if coded and codebooks is None:
        raise ValueError("postings with codes need their codebooks")
    columns = [c for c in postings.columns if c not in ("cell", "cell_distance", "codes")]
    columns = [*columns, vec_col] if coded else columns
    assigned = assign_cells(changed.select(*columns), centroids, vec_col)
    if coded:
        assigned = pq_encode(assigned, centroids, codebooks, vec_col)
    gone = changed.select(id_col)
    if deleted is not None:
        gone = gone.unionByName(deleted.select(id_col))
    kept = postings.join(gone, id_col, "left_anti")
    return kept.unionByName(assigned.select(*postings.columns))


def drift(before: DataFrame, after: DataFrame, by: Sequence[str] = ("cell",)) -> DataFrame:
    """Rows and mean distance to the centroid per cell, before and after a refresh."""

    def stats(postings, name):
        return postings.groupBy(*by).agg(
            F.count(F.lit(1)).alias(f"n_{name}"), F.avg("cell_distance").alias(f"distance_{name}")
        )

    tagged = stats(before, "before").unionByName(stats(after, "after"), allowMissingColumns=True)
    return tagged.groupBy(*by).agg(
        F.coalesce(F.max("n_before"), F.lit(0)).alias("n_before"),
        F.coalesce(F.max("n_after"), F.lit(0)).alias("n_after"),
        F.max("distance_before").alias("distance_before"),
        F.max("distance_after").alias("distance_after"),
    )
