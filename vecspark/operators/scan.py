"""Top-k search: query vectors against a table of vectors, exact for any table sizes.

Queries that fit into a bound of bytes, with the hits that a task keeps of them, are broadcast.
Vectors then stay where they are: every task keeps a running top-k per query over its own
vectors, and only those k rows per task and query are shuffled.  Groups that the queries look in
are pushed into the scan.

More queries meet the vectors in blocks, and pass neither the driver nor every task.  A group with
many vectors or queries is cut by hashes of the ids, and every block of vectors meets every block
of queries of its group in one task.  However small the blocks asked for, a row is copied
``MAX_COPIES`` times at most, or as often as blocks of ``BLOCK_BYTES`` need, hits of the queries
included, so that the rows shuffled grow with the tables and not with their product.

No pair of vector and query ever leaves a task unless it is in that task's top-k.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from vecspark.sources.workspace import materialize

#: Bytes of the queries that every task holds, and of their hits.
MAX_BROADCAST_BYTES = 32 * 1024 * 1024
_HIT_BYTES = 64
# Longer lists of groups would slow planning down more than they save; the rows are the same.
MAX_PUSHED_GROUPS = 10_000
_BATCH_ROWS = 8192
# Distances computed at a time, so that they stay in the processor's cache.
_SCORE_CELLS = 1 << 19

#: Vectors and queries of a block, on average.
BLOCK_VECTORS, BLOCK_QUERIES = 16_384, 1_024
#: Blocks that one side of a group is cut into, unless a block, with the hits that a task keeps of
#: its queries, then has more than so many bytes.
MAX_COPIES, BLOCK_BYTES = 8, 32 << 20
_BLOCK_BATCH_ROWS = 4_096
# Numbers of vectors whose distances are computed exactly at a time.
_EXACT_NUMBERS = 1 << 17

# A kernel reads what it needs from a batch and scores rows of one group against queries:
# score(data, rows, group_key, query_positions) -> (distances, exact or None), where
# exact(row_positions, j) recomputes the distances of some rows to the queries with numbers j, pair by pair.
Kernel = tuple[Callable[[pa.RecordBatch], object], Callable]


def dense(column: pa.Array, dtype=np.float64) -> np.ndarray:
    """A list column of equally long lists as a matrix; null entries become NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    n = len(column)
    return values.reshape(n, len(values) // n if n else 0).astype(dtype, copy=False)


def plain(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.to_numpy(zero_copy_only=False)
    return values.astype(str) if values.dtype == object else values


def squared_distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """All distances by one matrix product; accurate to a few units of rounding."""
    return (x * x).sum(axis=1)[:, None] - 2.0 * (x @ q.T) + (q * q).sum(axis=1)[None, :]


def rounding_slack(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Bound on the rounding error of ``squared_distances``, per query."""
    largest = np.nanmax((x * x).sum(axis=1), initial=0.0)
    return 8.0 * x.shape[1] * np.finfo(np.float64).eps * (largest + (q * q).sum(axis=1))


def flat_kernel(vec_col: str, query_vectors: np.ndarray) -> Kernel:
    def load(batch):
        return dense(batch.column(batch.schema.get_field_index(vec_col)))

    def score(matrix, rows, _key, positions):
        x, q = matrix[rows], query_vectors[positions]

        def exact(at, j):
            step = max(_EXACT_NUMBERS // max(x.shape[1], 1), 1)
            parts = [slice(i, i + step) for i in range(0, len(at), step)]
            return np.concatenate([((x[at[p]] - q[j[p]]) ** 2).sum(axis=1) for p in parts])

        return squared_distances(x, q), rounding_slack(x, q), exact

    return load, score


class RunningTopK:
    """The k nearest rows seen so far for each query, ordered by (distance, id).

    Rows farther from a query than ``within``, where it is given, may be left out.
    """

    def __init__(self, n_queries: int, k: int, within: np.ndarray | None = None):
        self.k = k
        self.worst = np.full(n_queries, np.inf) if within is None else within.copy()
        self.counts = np.zeros(n_queries, np.int64)
        # As wide as the longest list of hits.
        self.distances = np.empty((n_queries, 0))
        self.ids = np.empty((n_queries, 0), np.int64)

    def add(self, ids, distances, slack, exact, positions) -> None:
        limit = self.worst[positions]
        if not np.isfinite(limit).all():
            distances = np.where(np.isfinite(distances), distances, np.inf)
            if distances.shape[0] > self.k:
                kth = np.partition(distances, self.k - 1, axis=0)[self.k - 1]
                limit = np.minimum(limit, kth)
            limit = np.minimum(limit, np.finfo(np.float64).max)
        at, j = np.nonzero(distances <= limit + slack)
        if not len(at):
            return
        d = exact(at, j) if exact else distances[at, j]
        self._merge(positions[j], ids[at], d)

    def _merge(self, positions, ids, d) -> None:
        """All queries with new rows at once."""
        queries, at, added = np.unique(positions, return_inverse=True, return_counts=True)
        old = self.counts[queries]
        if not self.ids.shape[1]:
            self.ids = self.ids.astype(ids.dtype)
        held = np.arange(self.ids.shape[1]) < old[:, None]
        at = np.concatenate([np.repeat(np.arange(len(queries)), old), at])
        ids = np.concatenate([self.ids[queries][held], ids])
        d = np.concatenate([self.distances[queries][held], d])
        order = np.lexsort((ids, d, at))
        total = old + added
        rank = np.arange(len(at)) - np.repeat(np.cumsum(total) - total, total)
        order, rank = order[rank < self.k], rank[rank < self.k]
        counts = np.minimum(total, self.k)
        wider = int(counts.max()) - self.ids.shape[1]
        if wider > 0:
            self.ids, self.distances = (np.pad(x, ((0, 0), (0, wider))) for x in (self.ids, self.distances))
        self.ids = self.ids.astype(ids.dtype, copy=False)  # longer texts need more room
        self.ids[queries[at[order]], rank] = ids[order]
        self.distances[queries[at[order]], rank] = d[order]
        self.counts[queries] = counts
        full = queries[counts == self.k]
        self.worst[full] = np.minimum(self.worst[full], self.distances[full, self.counts[full] - 1])

    def rows(self):
        """Query positions, ids and distances of everything kept."""
        held = np.arange(self.ids.shape[1]) < self.counts[:, None]
        return np.repeat(np.arange(len(self.counts)), self.counts), self.ids[held], self.distances[held]


def rows_by_group(batch, group_cols: Sequence[str]) -> Iterator[tuple[tuple, np.ndarray]]:
    """Row positions of each distinct group key in a batch."""
    if not group_cols:
        yield (), np.arange(batch.num_rows)
        return
    code = np.zeros(batch.num_rows, dtype=np.int64)
    keys = []
    for name in group_cols:
        column = batch.column(batch.schema.get_field_index(name)).dictionary_encode()
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        values = column.dictionary.to_pylist()
        code = code * max(len(values), 1) + column.indices.to_numpy(zero_copy_only=False)
        keys.append(values)
    order = np.argsort(code, kind="stable")
    starts = np.flatnonzero(np.r_[True, code[order][1:] != code[order][:-1]])
    for rows in np.split(order, starts[1:]):
        rest, key = int(code[rows[0]]), []
        for values in reversed(keys):
            rest, at = divmod(rest, len(values))
            key.append(values[at])
        yield tuple(reversed(key)), rows


def scan_batch(batch, id_col, group_cols, positions_of, kernel: Kernel, best: RunningTopK) -> None:
    if batch.num_rows == 0:
        return
    load, score = kernel
    ids = plain(batch.column(batch.schema.get_field_index(id_col)))
    data = load(batch)
    for key, rows in rows_by_group(batch, group_cols):
        positions = positions_of(key)
        if positions is None or not len(positions):
            continue
        step = min(max(_SCORE_CELLS // len(positions), 256), _BATCH_ROWS)
        for start in range(0, len(rows), step):
            part = rows[start : start + step]
            distances, slack, exact = score(data, part, key, positions)
            best.add(ids[part], distances, slack, exact, positions)


def _output(schema: T.StructType, query_values: list[list], best: RunningTopK) -> list[pa.Array]:
    positions, ids, distances = best.rows()
    types = [to_arrow_type(f.dataType) for f in schema.fields]
    columns = [
        pa.array([values[p] for p in positions], type=t) for values, t in zip(query_values, types)
    ]
    columns.append(pa.array(ids.tolist(), type=types[-2]))
    columns.append(pa.array(distances, type=pa.float64()))
    return columns


def scan_topk(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    id_col: str,
    payload_col: str,
    query_cols: Sequence[str],
    query_vec_col: str,
    group_cols: Sequence[str] = (),
    probe_col: str | None = None,
    make_kernel: Callable[[str, np.ndarray], Kernel] = flat_kernel,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``query_cols``, ``id_col``, ``distance`` and ``rank`` of the k nearest rows per query.

    With ``group_cols`` a query only looks at the groups in its ``probe_col``, an array of
    structs with those columns.  Fewer than k candidates give fewer rows.  Vectors without an id
    can't be named as hits and are left out; query vectors that are null or of different lengths
    raise an error, however many there are.
    """
    group_cols, query_cols = list(group_cols), list(query_cols)
    schema = T.StructType(
        [queries.schema[c] for c in query_cols]
        + [
            T.StructField(id_col, vectors.schema[id_col].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    probes = [probe_col] if group_cols else []
    vector = F.col(query_vec_col).cast("array<double>").alias(query_vec_col)
    # Computed once, then read for the facts below and for each part.
    wanted = materialize(queries.select(*query_cols, vector, *probes), "queries")
    vectors = vectors.select(*group_cols, id_col, payload_col).filter(F.col(id_col).isNotNull())

    length = F.size(query_vec_col)
    size = F.octet_length(F.to_json(F.struct(*query_cols))) + 8 * length
    for probe in probes:
        size = size + F.greatest(F.size(probe), F.lit(0)) * 32 * len(group_cols)
    facts = wanted.agg(
        F.count(F.lit(1)).alias("queries"), F.min(length).alias("least"), F.max(length).alias("most"),
        F.sum((size + _HIT_BYTES * F.lit(k).cast("long")).cast("long")).alias("bytes"),
    ).first()
    if facts.queries and (facts.least != facts.most or facts.least < 0):
        raise ValueError("query vectors differ in length")
    if (facts.bytes or 0) > max_broadcast_bytes:
        # Rows of queries are told apart by their place, as the scan does.
        placed = wanted.withColumn("_place", F.monotonically_increasing_id())
        if group_cols:
            placed = placed.select("*", F.explode(F.array_distinct(probe_col)).alias("_group"))
            placed = placed.select("_place", *query_cols, query_vec_col, *[f"_group.{c}" for c in group_cols])
        found = block_hits(
            vectors, placed, k, group_cols=group_cols, id_col=id_col, payload_col=payload_col,
            query_cols=["_place", *query_cols], query_vec_col=query_vec_col, make_kernel=make_kernel,
        ).drop("_place")
    else:
        found = _broadcast_scan(
            vectors, wanted.toArrow(), k, id_col, payload_col, query_cols, query_vec_col, group_cols, probe_col,
            make_kernel, schema,
        )
    return merge_hits(found, k, query_cols, id_col)


def merge_hits(hits: DataFrame, k: int, query_cols: Sequence[str], id_col: str) -> DataFrame:
    """The k nearest of each query, with their ``rank``."""
    rank = F.row_number().over(Window.partitionBy(*query_cols).orderBy("distance", id_col))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k)


def _broadcast_scan(
    vectors, head, k, id_col, payload_col, query_cols, query_vec_col, group_cols, probe_col,
    make_kernel, schema,
):
    spark = vectors.sparkSession
    if head.num_rows == 0:
        return spark.createDataFrame([], schema)
    query_values = [head.column(c).to_pylist() for c in query_cols]
    matrix = dense(head.column(query_vec_col))
    groups: dict[tuple, list[int]] | None = None
    if group_cols:
        groups = {}
        for position, probes in enumerate(head.column(probe_col).to_pylist()):
            for key in {tuple(probe[c] for c in group_cols) for probe in probes or []}:
                groups.setdefault(key, []).append(position)
        for i, name in enumerate(group_cols):
            values = {key[i] for key in groups}
            if len(values) <= MAX_PUSHED_GROUPS:
                vectors = vectors.filter(F.col(name).isin(list(values)))
    shared = spark.sparkContext.broadcast((query_values, matrix, groups))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, queries, wanted = shared.value
        kernel = make_kernel(payload_col, queries)
        best = RunningTopK(len(queries), k)
        everyone = np.arange(len(queries))

        def positions_of(key):
            if wanted is None:
                return everyone
            return np.asarray(wanted.get(key, ()), dtype=np.int64)

        for batch in batches:
            scan_batch(batch, id_col, group_cols, positions_of, kernel, best)
        yield pa.RecordBatch.from_arrays(_output(schema, values, best), names=schema.fieldNames())

    return _matching_size(vectors, payload_col, matrix.shape[1]).mapInArrow(scan, schema)


def _matching_size(vectors: DataFrame, payload_col: str, dim: int) -> DataFrame:
    """Vectors of another length than the queries cannot be compared and drop out."""
    if isinstance(vectors.schema[payload_col].dataType, T.ArrayType):
        return vectors.filter(F.size(payload_col) == dim)
    return vectors.filter(F.col(payload_col).isNotNull())


def block_topk(
    vectors: DataFrame,
    probes: DataFrame,
    k: int,
    *,
    group_cols: Sequence[str],
    id_col: str = "id",
    vec_col: str = "embedding",
    query_cols: Sequence[str] = ("query_id",),
    query_vec_col: str = "query_vector",
    block_vectors: int = BLOCK_VECTORS,
    block_queries: int = BLOCK_QUERIES,
    within_col: str | None = None,
) -> DataFrame:
    """``query_cols``, ``id_col``, ``distance`` and ``rank`` of the k nearest vectors in the groups of
    each query, by squared L2, ties by id.

    ``probes`` has a row for each query and group that it looks in.  Vectors without an id, and
    those of another length than the query, are no candidates; a query that probes a group twice
    looks there once.  Vectors farther from a query than its ``within_col`` may be left out; null
    stands for no bound.
    """
    hits = block_hits(
        vectors, probes.dropDuplicates([*group_cols, *query_cols]), k, group_cols=group_cols, id_col=id_col,
        payload_col=vec_col, query_cols=query_cols, query_vec_col=query_vec_col, block_vectors=block_vectors,
        block_queries=block_queries, within_col=within_col,
    )
    return merge_hits(hits, k, query_cols, id_col)


def block_hits(
    vectors: DataFrame,
    probes: DataFrame,
    k: int,
    *,
    group_cols: Sequence[str],
    id_col: str,
    payload_col: str,
    query_cols: Sequence[str],
    query_vec_col: str,
    make_kernel: Callable[[str, np.ndarray], Kernel] = flat_kernel,
    block_vectors: int = BLOCK_VECTORS,
    block_queries: int = BLOCK_QUERIES,
    within_col: str | None = None,
) -> DataFrame:
    """The k nearest vectors of each block to each query that meets it, to be merged.

    Each row of ``probes`` is searched; without ``group_cols`` in all vectors.
    """
    group_cols, query_cols = list(group_cols), list(query_cols)
    grouped = bool(group_cols)
    if not grouped:
        group_cols = ["_all"]
        vectors, probes = vectors.withColumn("_all", F.lit(0)), probes.withColumn("_all", F.lit(0))
    vector = F.col(query_vec_col).cast("array<double>").alias("_query")
    within = F.lit(None) if within_col is None else F.col(within_col)
    within = F.coalesce(within.cast("double"), F.lit(float("inf"))).alias("_within")
    probes = probes.select(*group_cols, *query_cols, vector, within).filter("_query IS NOT NULL")
    probes = materialize(probes, "probes")
    candidates = vectors.select(*group_cols, F.col(id_col).alias("_id"), F.col(payload_col).alias("_vector"))
    candidates = candidates.filter("_id IS NOT NULL AND _vector IS NOT NULL")

    # A row for each group that is probed: into how many blocks its sides are cut.
    looked = probes.groupBy(*group_cols).agg(
        F.count("*").alias("n_queries"), (F.max(F.size("_query")) * 8).cast("long").alias("row_bytes")
    )

    def blocks(rows: Column, size: int, row_bytes: Column) -> Column:
        needed = F.ceil(rows * row_bytes / BLOCK_BYTES)
        return F.greatest(F.least(F.ceil(rows / size), F.lit(MAX_COPIES).cast("long")), needed).cast("int")

    known = vectors.filter(F.col(id_col).isNotNull())
    if grouped:
        # Counted before the join, which would deal a row a vector by group.
        counted = known.groupBy(*group_cols).agg(F.count("*").alias("n_vectors")).join(looked, group_cols)
    else:
        counted = looked.withColumn("n_vectors", F.lit(known.count()))
    n_vectors = blocks(F.col("n_vectors"), block_vectors, F.col("row_bytes"))
    # A task keeps no more hits of a query than a block has vectors.
    hits = F.least(F.lit(k).cast("long"), F.ceil(F.col("n_vectors") / F.greatest(n_vectors, F.lit(1))))
    sizes = counted.select(
        *group_cols,
        n_vectors.alias("_n_vectors"),
        blocks(F.col("n_queries"), block_queries, F.col("row_bytes") + _HIT_BYTES * hits).alias("_n_queries"),
    )
    sizes = materialize(sizes, "blocks").filter("_n_vectors > 0 AND _n_queries > 0")
    single = None if grouped else sizes.first() or {"_n_vectors": 1, "_n_queries": 1}

    def cut(rows: DataFrame) -> DataFrame:
        if grouped:
            return rows.join(sizes, group_cols)
        return rows.withColumns({n: F.lit(single[n]) for n in ("_n_vectors", "_n_queries")})

    def block(of: Column, n: str) -> Column:
        return F.pmod(F.xxhash64(of), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = cut(candidates).withColumn("_v", block(F.col("_id"), "_n_vectors"))
    left = left.withColumn("_q", every("_n_queries")).drop("_n_vectors", "_n_queries")
    right = cut(probes).withColumn("_q", block(F.struct(*query_cols), "_n_queries"))
    right = right.withColumn("_v", every("_n_vectors")).drop("_n_vectors", "_n_queries")

    id_type = vectors.schema[id_col].dataType
    fields = [probes.schema[c] for c in query_cols]
    schema = T.StructType([*fields, T.StructField(id_col, id_type), T.StructField("distance", T.DoubleType())])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])
    by_length = isinstance(vectors.schema[payload_col].dataType, T.ArrayType)
    at_once = _SCORE_CELLS // _BLOCK_BATCH_ROWS

    def search(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        load, score = make_kernel("_vector", dense(queries.column("_query")))
        best = RunningTopK(queries.num_rows, k, queries.column("_within").to_numpy())
        parts = [np.arange(i, min(i + at_once, queries.num_rows)) for i in range(0, queries.num_rows, at_once)]
        for batch in rows.combine_chunks().to_batches(_BLOCK_BATCH_ROWS):
            data, everything = load(batch), np.arange(batch.num_rows)
            ids = plain(batch.column(batch.schema.get_field_index("_id")))
            for part in parts:
                best.add(ids, *score(data, everything, key, part), part)
        at, ids, distance = best.rows()
        own = [queries.column(c).take(pa.array(at)) for c in query_cols]
        return pa.table([*own, pa.array(ids.tolist(), arrow.types[-2]), pa.array(distance)], schema=arrow)

    def nearest(keys: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        """The k nearest of a block of vectors to each of a block of queries, length by length."""
        key = tuple(v.as_py() for v in keys[: len(group_cols)])
        if not by_length:
            return search(key, rows, queries)
        found = []
        lengths = pc.list_value_length(queries.column("_query")).to_numpy()
        sizes = pc.list_value_length(rows.column("_vector")).to_numpy()
        for length in np.intersect1d(lengths, sizes[sizes > 0]).tolist():
            same = [t.take(pa.array(np.flatnonzero(n == length))) for t, n in ((rows, sizes), (queries, lengths))]
            found.append(search(key, *same))
        return pa.concat_tables(found) if found else arrow.empty_table()

    keys = [*group_cols, "_v", "_q"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(nearest, schema)
