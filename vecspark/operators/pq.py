"""Product quantisation of residuals: training, encoding and search on codes.

See Jegou, Douze, Schmid: Product quantization for nearest neighbor search, 2011.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.functions.vectors import squared_l2
from vecspark.operators.ivf import (
    MAX_TRAINING_VECTORS,
    model_matrix,
    model_table,
    probe_cells,
    probe_groups,
    training_sample,
)
from vecspark.operators.knn import best_per_query
from vecspark.operators.results import small_side
from vecspark.operators.scan import dense, scan_topk, squared_distances
from vecspark.sources.workspace import materialize


_ENCODE_ROWS = 2048


def check_parameters(dim: int, m: int, nbits: int) -> None:
    if dim % m:
        raise ValueError(f"dimension {dim} is not divisible by m={m}")
    if not 1 <= nbits <= 8:
        raise ValueError("nbits is 1 to 8: one code fits one byte")


def _residuals(batch, vec_at: int, cell_at: int, cells: np.ndarray, centroids: np.ndarray):
    vectors = dense(batch.column(vec_at))
    found = batch.column(cell_at).to_numpy(zero_copy_only=False)
    return vectors - centroids[np.searchsorted(cells, found)]


def _codes(residuals: np.ndarray, codebooks: np.ndarray) -> np.ndarray:
    """Nearest codeword per sub-space; a row's own length does not change which is nearest."""
    m, _, width = codebooks.shape
    parts = residuals.reshape(len(residuals), m, width)
    codes = np.empty((len(residuals), m), dtype=np.uint8)
    for s, book in enumerate(codebooks):
        lengths = (book * book).sum(axis=1)
        for i in range(0, len(parts), _ENCODE_ROWS):
            rows = parts[i : i + _ENCODE_ROWS, s]
            codes[i : i + _ENCODE_ROWS, s] = (lengths - 2.0 * (rows @ book.T)).argmin(axis=1)
    return codes


def train_codebooks(
    postings: DataFrame,
    centroids: DataFrame,
    m: int = 8,
    nbits: int = 8,
    id_col: str = "id",
    vec_col: str = "embedding",
    iterations: int = 10,
    seed: int = 42,
    max_training_vectors: int = MAX_TRAINING_VECTORS,
    max_per_codeword: int | None = None,
) -> DataFrame:
    """Codebooks as a table ``sub, code, codeword``.

    ``postings`` should be stored: they are counted and then sampled.

    Each Lloyd round is one job over the training sample for all sub-spaces together: tasks
    send one partial sum per codeword, and only the codebooks come back to the driver.
    """
    cells, matrix = model_matrix(centroids)
    dim, size = matrix.shape[1], 1 << nbits
    check_parameters(dim, m, nbits)
    context = postings.sparkSession.sparkContext
    model = context.broadcast((cells, matrix))
    columns = postings.select(id_col, "cell", vec_col).filter(F.size(vec_col) == dim)
    max_rows = max_training_vectors
    if max_per_codeword:
        max_rows = min(max_rows, max_per_codeword * size)
    sample, _ = training_sample(columns, id_col, max_rows, seed)
    # Written, so that a lost executor costs no second pass over the table.
    sample = materialize(sample, "pq-sample")
    start = sample.orderBy(F.xxhash64(id_col, F.lit(seed)), id_col).limit(size).toArrow()
    seeds = _residuals(start, 2, 1, cells, matrix)
    seeds = seeds[np.arange(size) % len(seeds)]
    codebooks = np.ascontiguousarray(seeds.reshape(size, m, dim // m).transpose(1, 0, 2))
    for _ in range(iterations):
        codebooks = _lloyd_round(sample, model, context.broadcast(codebooks), codebooks)
    sub, code = np.indices((m, size), dtype=np.int32)
    keys = {"sub": sub.ravel(), "code": code.ravel()}
    return model_table(postings.sparkSession, keys, "codeword", codebooks.reshape(m * size, -1))


def _lloyd_round(sample: DataFrame, model, shared, codebooks: np.ndarray) -> np.ndarray:
    m, size, width = codebooks.shape

    def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, centroids = model.value
        books = shared.value
        sums, counts = np.zeros(books.shape), np.zeros(books.shape[:2], dtype=np.int64)
        for batch in batches:
            residuals = _residuals(batch, 2, 1, cells, centroids)
            parts = residuals.reshape(len(residuals), m, width)
            codes = _codes(residuals, books)
            for s in range(m):
                counts[s] += np.bincount(codes[:, s], minlength=size)
                for j in range(width):
                    sums[s, :, j] += np.bincount(codes[:, s], parts[:, s, j], minlength=size)
        flat = pa.ListArray.from_arrays(
            np.arange(0, m * size * width + 1, width, dtype=np.int32), sums.ravel()
        )
        slot = pa.array(np.arange(m * size, dtype=np.int32))
        yield pa.RecordBatch.from_arrays(
            [slot, pa.array(counts.ravel()), flat], names=["slot", "n", "total"]
        )

    partial = sample.mapInArrow(partial_sums, "slot int, n bigint, total array<double>")
    rows = (
        partial.filter("n > 0")
        .select("slot", "n", F.posexplode("total").alias("pos", "x"))
        .groupBy("slot", "pos")
        .agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
        .toArrow()
    )
    flat = codebooks.reshape(m * size, width).copy()
    means = rows.column("x").to_numpy() / rows.column("n").to_numpy()
    flat[rows.column("slot").to_numpy(), rows.column("pos").to_numpy()] = means
    return flat.reshape(codebooks.shape)


def codebook_array(codebooks: DataFrame) -> np.ndarray:
    """Codebooks as an array (sub, code, width); at most 256 codes per sub-space."""
    table = codebooks.orderBy("sub", "code").toArrow()
    m = int(table.column("sub").to_numpy().max()) + 1
    words = dense(table.column("codeword"))
    return words.reshape(m, len(words) // m, -1)


def pq_encode(
    postings: DataFrame, centroids: DataFrame, codebooks: DataFrame, vec_col: str = "embedding"
) -> DataFrame:
    """Replace the vector by ``codes``, one byte per sub-space. No shuffle."""
    cells, matrix = model_matrix(centroids)
    shared = postings.sparkSession.sparkContext.broadcast((cells, matrix, codebook_array(codebooks)))
    kept = [c for c in postings.columns if c != vec_col]
    schema = T.StructType(
        [*[postings.schema[c] for c in kept], T.StructField("codes", T.BinaryType())]
    )
    vec_at, cell_at = postings.columns.index(vec_col), postings.columns.index("cell")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, centres, books = shared.value
        for batch in batches:
            codes = _codes(_residuals(batch, vec_at, cell_at, known, centres), books)
            rows = pa.array([row.tobytes() for row in codes], type=pa.binary())
            others = [c for i, c in enumerate(batch.columns) if i != vec_at]
            yield pa.RecordBatch.from_arrays([*others, rows], names=schema.fieldNames())

    return postings.filter(F.size(vec_col) == matrix.shape[1]).mapInArrow(encode, schema)


def _code_kernel(shared):
    """Distances by table look-up: one table per query and cell."""

    def make(codes_col: str, queries: np.ndarray):
        cells, centroids, books = shared.value
        m, _, width = books.shape
        tables: dict[tuple, np.ndarray] = {}

        def load(batch):
            column = batch.column(batch.schema.get_field_index(codes_col))
            joined = b"".join(column.to_pylist())
            return np.frombuffer(joined, dtype=np.uint8).reshape(batch.num_rows, m)

        def table(cell, positions):
            key = (cell, positions.tobytes())
            if key not in tables:
                if len(tables) > 256:
                    tables.clear()
                residuals = queries[positions] - centroids[np.searchsorted(cells, cell)]
                parts = residuals.reshape(len(positions), m, width)
                tables[key] = np.stack(
                    [squared_distances(parts[:, s], books[s]) for s in range(m)], axis=1
                )
            return tables[key]

        def score(codes, rows, key, positions):
            look_up = table(key[-1], positions)
            distances = np.zeros((len(rows), len(positions)))
            for s in range(m):
                distances += look_up[:, s, :].T[codes[rows, s]]
            return np.maximum(distances, 0.0), 0.0, None

        return load, score

    return make


def ivfpq_search(
    codes: DataFrame,
    centroids: DataFrame,
    codebooks: DataFrame,
    queries: DataFrame,
    k: int,
    nprobe: int | str,
    id_col: str = "id",
    query_cols: Sequence[str] = ("query_id",),
    query_vec_col: str = "query_vector",
    shards_col: str | None = None,
    **limits,
) -> DataFrame:
    """The k rows of smallest approximate distance inside the nearest cells of each query."""
    probed = probe_cells(queries, centroids, nprobe, query_vec_col)
    shards = None if shards_col is None else F.col(shards_col)
    probed = probed.withColumn("_groups", probe_groups("cells", shards))
    cells, matrix = model_matrix(centroids)
    shared = codes.sparkSession.sparkContext.broadcast((cells, matrix, codebook_array(codebooks)))
    return scan_topk(
        codes, probed, k, id_col=id_col, payload_col="codes", query_cols=query_cols,
        query_vec_col=query_vec_col, probe_col="_groups", make_kernel=_code_kernel(shared),
        group_cols=["cell"] if shards is None else ["shard_key", "cell"], **limits,
    )


def rerank(
    hits: DataFrame,
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "id",
    vec_col: str = "embedding",
    query_cols: Sequence[str] = ("query_id",),
    query_vec_col: str = "query_vector",
    max_hits: int | None = None,
) -> DataFrame:
    """Exact distances for approximate hits, then the k best.

    ``max_hits`` is the caller's bound on the hits; within the broadcast limit the vectors
    are then not shuffled.
    """
    exact = (
        vectors.select(id_col, vec_col)
        .join(small_side(hits.select(*query_cols, id_col), max_hits), id_col)
        .join(queries.select(*query_cols, query_vec_col), list(query_cols))
        .select(*query_cols, id_col, squared_l2(vec_col, query_vec_col).alias("distance"))
    )
    return best_per_query(exact, query_cols, id_col, k)
