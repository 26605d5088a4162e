"""Inverted-file index: training, cell assignment, probing and search."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.operators.scan import dense, rounding_slack, scan_topk, squared_distances
from vecspark.sources.workspace import materialize

# Training size rules.
MAX_TRAINING_VECTORS = 1_000_000
VECTORS_PER_CENTROID = 39
MAX_MODEL_BYTES = 1024 * 1024 * 1024


def training_sample(
    vectors: DataFrame, id_col: str, max_rows: int = MAX_TRAINING_VECTORS, seed: int = 42
) -> tuple[DataFrame, int]:
    """All vectors, or a hash sample of about ``max_rows`` chosen without a shuffle; and the count."""
    total = vectors.count()
    if total <= max_rows:
        return vectors, total
    buckets = 1 << 40
    hit = F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(buckets)) < int(buckets * max_rows / total)
    return vectors.filter(hit), total


def train_centroids(
    vectors: DataFrame,
    nlist: int,
    id_col: str = "id",
    vec_col: str = "embedding",
    seed: int = 42,
    max_iter: int = 20,
    max_training_vectors: int = MAX_TRAINING_VECTORS,
    max_per_centroid: int | None = None,
) -> DataFrame:
    """Coarse quantiser as a table ``cell, centroid`` of at most ``nlist`` rows.

    Tables of more than ``max_training_vectors`` are sampled by hash; ``max_per_centroid``
    lowers that to so many vectors per centroid.
    """
    max_rows = max_training_vectors
    if max_per_centroid:
        max_rows = min(max_rows, max_per_centroid * nlist)
    sample, total = training_sample(vectors, id_col, max_rows, seed)
    if total < nlist * VECTORS_PER_CENTROID:
        warnings.warn(
            f"{total} vectors for {nlist} centroids; {nlist * VECTORS_PER_CENTROID} are advised",
            stacklevel=2,
        )
    features = sample.select(array_to_vector(F.col(vec_col).cast("array<double>")).alias("features"))
    model = KMeans(k=nlist, seed=seed, maxIter=max_iter, solver="block").fit(features)
    centres = np.stack(model.clusterCenters())
    cells = np.arange(len(centres), dtype=np.int32)
    return model_table(vectors.sparkSession, {"cell": cells}, "centroid", centres)


def model_table(spark: SparkSession, keys: dict[str, np.ndarray], name: str, rows: np.ndarray):
    """A trained model as a written table: key columns and one vector per row."""
    offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    vectors = pa.ListArray.from_arrays(offsets, np.ascontiguousarray(rows).ravel())
    table = pa.table({**{k: pa.array(v) for k, v in keys.items()}, name: vectors})
    return materialize(spark.createDataFrame(table), name)


def model_matrix(centroids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Cells and centroids on the driver, ordered by cell; refuses a table too big for a model."""
    limit_rows = 1_000_000
    table = centroids.select("cell", F.col("centroid").cast("array<double>")).limit(limit_rows + 1)
    table = table.toArrow()
    if table.num_rows == 0:
        raise ValueError("no centroids")
    if table.num_rows > limit_rows or table.nbytes > MAX_MODEL_BYTES:
        raise ValueError("centroid table is too large to be a model")
    cells = table.column("cell").to_numpy()
    order = np.argsort(cells, kind="stable")
    return cells[order], dense(table.column("centroid"))[order]


def _nearest(x: np.ndarray, centroids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of the n nearest centroids per row, ties to the lower cell."""
    n = min(n, len(centroids))
    approx = squared_distances(x, centroids)
    slack = rounding_slack(centroids, x)[:, None]
    kth = np.partition(approx, n - 1, axis=1)[:, n - 1 : n]
    rows, cols = np.nonzero(approx <= kth + 2 * slack)
    exact = ((x[rows] - centroids[cols]) ** 2).sum(axis=1)
    # Vectors that compare with nothing (NaN) are given the first cells, infinitely far.
    lost = np.flatnonzero(np.bincount(rows, minlength=len(x)) < n)
    rows = np.append(rows, np.repeat(lost, n))
    cols = np.append(cols, np.tile(np.arange(n), len(lost)))
    exact = np.append(exact, np.full(n * len(lost), np.inf))
    # Only the few candidates of each row are sorted, not all centroids.
    order = np.lexsort((cols, exact, rows))
    first = np.searchsorted(rows[order], np.arange(len(x)))
    best = order[first[:, None] + np.arange(n)] if len(x) else np.zeros((0, n), int)
    return cols[best], exact[best]


def assign_cells(
    vectors: DataFrame, centroids: DataFrame, vec_col: str = "embedding"
) -> DataFrame:
    """Add ``cell`` and ``cell_distance`` of the nearest centroid. No shuffle."""
    cells, matrix = model_matrix(centroids)
    shared = vectors.sparkSession.sparkContext.broadcast((cells.astype(np.int32), matrix))
    schema = T.StructType(
        [
            *vectors.schema.fields,
            T.StructField("cell", T.IntegerType()),
            T.StructField("cell_distance", T.DoubleType()),
        ]
    )
    position = vectors.columns.index(vec_col)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, centres = shared.value
        step = max(1, 4_000_000 // len(known))
        for batch in batches:
            x = dense(batch.column(position))
            parts = [_nearest(x[i : i + step], centres, 1) for i in range(0, len(x), step)]
            nearest = np.concatenate([p[0][:, 0] for p in parts]) if parts else np.array([], int)
            distance = np.concatenate([p[1][:, 0] for p in parts]) if parts else np.array([])
            columns = [*batch.columns, pa.array(known[nearest]), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return vectors.filter(F.size(vec_col) == matrix.shape[1]).mapInArrow(assign, schema)


def probe_cells(
    queries: DataFrame,
    centroids: DataFrame,
    nprobe: int | str,
    query_vec_col: str = "query_vector",
    out_col: str = "cells",
) -> DataFrame:
    """Add the nearest cells of each query, nearest first; ``nprobe`` is a number or a column."""
    cells, matrix = model_matrix(centroids)
    shared = queries.sparkSession.sparkContext.broadcast((cells, matrix))
    schema = T.StructType([*queries.schema.fields, T.StructField(out_col, T.ArrayType(T.IntegerType()))])
    position = queries.columns.index(query_vec_col)
    nprobe_position = queries.columns.index(nprobe) if isinstance(nprobe, str) else None

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, centres = shared.value
        for batch in batches:
            x = dense(batch.column(position))
            if nprobe_position is None:
                wanted = np.full(len(x), nprobe)
            else:
                wanted = batch.column(nprobe_position).to_numpy(zero_copy_only=False)
            found = []
            step = max(1, 4_000_000 // len(known))
            for i in range(0, len(x), step):
                part = wanted[i : i + step].astype(int)
                order, _ = _nearest(x[i : i + step], centres, int(part.max()))
                found += [known[row[:n]].tolist() for row, n in zip(order, part)]
            column = pa.array(found, type=pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=schema.fieldNames())

    return queries.filter(F.size(query_vec_col) == matrix.shape[1]).mapInArrow(probe, schema)


def probe_groups(cells_col: str, shards: Column | None = None) -> Column:
    """Cells of a query as the groups to look in, for one index or for a list of shards."""
    if shards is None:
        return F.transform(cells_col, lambda c: F.struct(c.alias("cell")))
    return F.flatten(
        F.transform(
            shards,
            lambda s: F.transform(
                F.col(cells_col), lambda c: F.struct(s.alias("shard_key"), c.alias("cell"))
            ),
        )
    )


def ivf_flat_search(
    postings: DataFrame,
    centroids: DataFrame,
    queries: DataFrame,
    k: int,
    nprobe: int | str,
    id_col: str = "id",
    vec_col: str = "embedding",
    query_cols: Sequence[str] = ("query_id",),
    query_vec_col: str = "query_vector",
    shards_col: str | None = None,
    **limits,
) -> DataFrame:
    """Exact distances inside the nearest ``nprobe`` cells of each query.

    ``postings`` carry ``cell`` (and ``shard_key`` when ``shards_col`` names the list of
    shards of a query); only probed cells are read.
    """
    probed = probe_cells(queries, centroids, nprobe, query_vec_col)
    shards = None if shards_col is None else F.col(shards_col)
    probed = probed.withColumn("_groups", probe_groups("cells", shards))
    return scan_topk(
        postings, probed, k, id_col=id_col, payload_col=vec_col, query_cols=query_cols,
        query_vec_col=query_vec_col, probe_col="_groups",
        group_cols=["cell"] if shards is None else ["shard_key", "cell"], **limits,
    )
