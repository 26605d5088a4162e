"""Exact nearest neighbours: flat, filtered and over several shards."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vecspark.operators.scan import scan_topk


def exact_knn(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "id",
    vec_col: str = "embedding",
    query_cols: Sequence[str] = ("query_id",),
    query_vec_col: str = "query_vector",
    **limits,
) -> DataFrame:
    """The k nearest vectors of each query by squared L2, ties by id."""
    return scan_topk(
        vectors, queries, k, id_col=id_col, payload_col=vec_col, query_cols=query_cols,
        query_vec_col=query_vec_col, **limits,
    )


def filtered_knn(vectors: DataFrame, predicate: Column, queries: DataFrame, k: int, **names) -> DataFrame:
    """Metadata filter first, so it reaches the scan; then exact search over what is left."""
    return exact_knn(vectors.filter(predicate), queries, k, **names)


def fanout_knn(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    shard_col: str,
    shards_col: str = "shards",
    id_col: str = "id",
    vec_col: str = "embedding",
    query_cols: Sequence[str] = ("query_id",),
    query_vec_col: str = "query_vector",
    **limits,
) -> DataFrame:
    """Search only the shards listed by each query and merge their hits."""
    probes = F.transform(shards_col, lambda s: F.struct(s.alias(shard_col)))
    return scan_topk(
        vectors, queries.withColumn("_probes", probes), k, id_col=id_col, payload_col=vec_col,
        query_cols=query_cols, query_vec_col=query_vec_col, group_cols=[shard_col],
        probe_col="_probes", **limits,
    )


def limit_per_request(hits: DataFrame, requests: DataFrame, key: str, top_k_col: str) -> DataFrame:
    """Cut the hits of each request at its own top_k."""
    return (
        hits.join(requests.select(key, top_k_col), key)
        .filter(F.col("rank") <= F.col(top_k_col))
        .drop(top_k_col)
    )


def mean_vectors(df: DataFrame, group_col: str, vec_col: str, out_col: str = "mean_vector") -> DataFrame:
    """Element-wise mean of the vectors of each group.

    Every task sends one sum per group and length; entries are never taken apart into rows
    before that.  A null entry counts neither in the sum nor in the number of its place.
    """
    kind = df.schema[group_col].dataType
    schema = T.StructType(
        [
            T.StructField(group_col, kind),
            T.StructField("_sums", T.ArrayType(T.DoubleType())),
            T.StructField("_counts", T.ArrayType(T.LongType())),
        ]
    )

    def partial(batches):
        sums: dict = {}
        for batch in batches:
            groups = batch.column(0).to_pylist()
            lengths = pc.list_value_length(batch.column(1)).to_pylist()
            members: dict = {}
            for at, (group, length) in enumerate(zip(groups, lengths, strict=True)):
                if length is not None:
                    members.setdefault((group, length), []).append(at)
            for key, rows in members.items():
                values = batch.column(1).take(pa.array(rows)).flatten()
                x = values.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(len(rows), key[1])
                known = values.is_valid().to_numpy(zero_copy_only=False).reshape(x.shape)
                old = sums.get(key, (0.0, 0))
                sums[key] = (old[0] + x.sum(axis=0), old[1] + known.sum(axis=0))
        arrow = to_arrow_schema(schema)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([g for g, _ in sums], arrow.field(0).type),
                pa.array([s.tolist() for s, _ in sums.values()], arrow.field(1).type),
                pa.array([c.tolist() for _, c in sums.values()], arrow.field(2).type),
            ],
            schema=arrow,
        )

    vectors = df.select(group_col, F.col(vec_col).cast("array<double>"))
    place = F.posexplode(F.arrays_zip("_sums", "_counts")).alias("_pos", "_x")
    return (
        vectors.mapInArrow(partial, schema)
        .select(group_col, place)
        .groupBy(group_col, "_pos")
        .agg((F.sum("_x._sums") / F.nullif(F.sum("_x._counts"), F.lit(0))).alias("_x"))
        .groupBy(group_col)
        .agg(F.array_sort(F.collect_list(F.struct("_pos", "_x"))).alias("_means"))
        .select(group_col, F.col("_means._x").alias(out_col))
    )


def best_per_query(hits: DataFrame, query_cols: Sequence[str], id_col: str, k: int) -> DataFrame:
    """Rank hits that came from several searches and keep k per query."""
    rank = F.row_number().over(Window.partitionBy(*query_cols).orderBy("distance", id_col))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k)
