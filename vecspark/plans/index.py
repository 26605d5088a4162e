"""Embedded table to a published index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.functions.vectors import l2_normalize
from vecspark.operators.clean import indexable
from vecspark.operators.index_admin import refresh_postings
from vecspark.operators.ivf import assign_cells, train_centroids
from vecspark.operators.pq import check_parameters, pq_encode, train_codebooks
from vecspark.sources.index_store import load_index, save_index
from vecspark.sources.workspace import materialize


def build_index(
    vectors: DataFrame,
    path: str,
    dim: int,
    nlist: int = 100,
    m: int | None = 8,
    nbits: int = 8,
    id_col: str = "id",
    vec_col: str = "embedding",
    shard_col: str | None = None,
    normalize: bool = False,
    seed: int = 42,
) -> int:
    """Train, fill and publish an index; ``m=None`` keeps full vectors in the postings."""
    if m is not None:
        check_parameters(dim, m, nbits)
    shard = F.lit("all") if shard_col is None else F.col(shard_col).cast("string")
    usable = indexable(vectors, vec_col, dim).select(id_col, vec_col, shard.alias("shard_key"))
    if normalize:
        usable = usable.withColumn(vec_col, l2_normalize(vec_col))
    centroids = train_centroids(usable, nlist, id_col, vec_col, seed)
    # Every vector is assigned once; training, encoding and the layout read what is stored.
    postings = materialize(assign_cells(usable, centroids, vec_col), "postings")
    if m is None:
        return save_index(path, centroids, postings, None, id_col, nbits, normalize)
    codebooks = train_codebooks(postings, centroids, m, nbits, id_col, vec_col, seed=seed)
    codes = materialize(pq_encode(postings, centroids, codebooks, vec_col), "codes")
    return save_index(path, centroids, codes, codebooks, id_col, nbits, normalize)


def refresh_index(
    changed: DataFrame,
    path: str,
    id_col: str = "id",
    vec_col: str = "embedding",
    shard_col: str | None = None,
    deleted: DataFrame | None = None,
    nbits: int = 8,
) -> int:
    """Publish a new version of a stored index, flat or with codes, in which the changed rows
    are assigned and encoded again by the same model. Running searches keep their version."""
    index = load_index(changed.sparkSession, path)
    shard = F.lit("all") if shard_col is None else F.col(shard_col).cast("string")
    usable = indexable(changed, vec_col, index.dim).select(id_col, vec_col, shard.alias("shard_key"))
    if index.normalized:
        usable = usable.withColumn(vec_col, l2_normalize(vec_col))
    postings = refresh_postings(
        index.postings, usable, index.centroids, id_col, vec_col, deleted, index.codebooks
    )
    postings = materialize(postings, "postings")
    return save_index(
        path, index.centroids, postings, index.codebooks, id_col, nbits, index.normalized
    )
