"""Top-k search as a join of blocks, for more queries than can be sent to every task.

Queries and vectors meet by the group that both look in: a cell of an index, a shard, or both, cut
into blocks (``scan.block_topk``).  A task holds one pair of blocks, keeps the k nearest of each
query, and only those rows are merged.  Vectors are read once, whatever the number of queries.

* ``ivf_block_search`` looks in the nearest cells of an index.
* ``routed_search`` looks in the shards that requests name; a layout partitioned by shard is only
  read where a request looks (dynamic partition pruning).
* ``filtered_ivf_search`` looks in cells until it has the k nearest vectors that fulfil a
  predicate.  A summary of what metadata each cell holds leaves out cells without a match, says
  how many cells hold k matches, and bounds from below how near the matches of a cell can be.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from vecspark.operators.ivf import model_matrix, probe_cells
from vecspark.operators.routing import check_shards
from vecspark.operators.scan import block_topk, dense, merge_hits
from vecspark.sources.workspace import materialize


def ivf_block_search(
    postings: DataFrame,
    centroids: DataFrame,
    queries: DataFrame,
    k: int,
    nprobe: int | str,
    shards_col: str | None = None,
    query_cols: Sequence[str] = ("query_id",),
    query_vec_col: str = "query_vector",
    **names,
) -> DataFrame:
    """Exact distances inside the nearest ``nprobe`` cells of each query, for any number of queries.

    The rows of ``ivf_flat_search``; ``postings`` carry ``cell``, and ``shard_key`` when
    ``shards_col`` names the list of shards of a query.
    """
    probed = probe_cells(queries, centroids, nprobe, query_vec_col)
    kept = [*query_cols, query_vec_col]
    groups = ["cell"]
    if shards_col is None:
        probed = probed.select(*kept, F.explode("cells").alias("cell"))
    else:
        groups = ["shard_key", "cell"]
        probed = probed.select(*kept, "cells", F.explode(shards_col).alias("shard_key"))
        probed = probed.select(*kept, "shard_key", F.explode("cells").alias("cell"))
    return block_topk(
        postings, probed, k, group_cols=groups, query_cols=query_cols, query_vec_col=query_vec_col, **names
    )


def routed_search(
    vectors: DataFrame,
    routed: DataFrame,
    catalog: DataFrame,
    k: int,
    key: str = "query_id",
    query_vec_col: str = "query_vector",
    **names,
) -> tuple[DataFrame, DataFrame]:
    """Hits of requests in the ``shards`` that ``route`` gave them, and the pairs of request and shard
    that the catalogue doesn't have.

    ``vectors`` carry ``shard_key``, best as a partition column.
    """
    known, unknown = check_shards(routed, catalog, key)
    probes = known.join(routed.select(key, query_vec_col), key)
    hits = block_topk(
        vectors, probes, k, group_cols=["shard_key"], query_cols=[key], query_vec_col=query_vec_col, **names
    )
    return hits, unknown


def cell_summary(postings: DataFrame, metadata_cols: Sequence[str]) -> DataFrame:
    """Per cell and metadata: number of vectors, and the greatest distance from the centroid."""
    return postings.groupBy("cell", *metadata_cols).agg(
        F.count("*").alias("n"), F.sqrt(F.max("cell_distance")).alias("radius")
    )


def filtered_ivf_search(
    postings: DataFrame,
    centroids: DataFrame,
    summary: DataFrame,
    predicate: Column,
    queries: DataFrame,
    k: int,
    exact: bool = True,
    id_col: str = "id",
    vec_col: str = "embedding",
    query_cols: Sequence[str] = ("query_id",),
    query_vec_col: str = "query_vector",
    **limits,
) -> tuple[DataFrame, DataFrame]:
    """The k nearest vectors that fulfil the predicate, and the cells looked in for each query.

    The predicate names columns that both ``postings`` and the ``cell_summary`` have.  First a
    query looks in its nearest cells until they hold k matches, or no cell is left.  With
    ``exact`` it then looks in every further cell whose matches may be nearer than its k-th hit,
    by the distance of the centroid less the radius of the matches.
    """
    query_cols = list(query_cols)
    names = dict(id_col=id_col, vec_col=vec_col, query_cols=query_cols, query_vec_col=query_vec_col, **limits)
    matches = summary.filter(predicate).groupBy("cell").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"))
    # As many rows as cells, at most: no larger than the model.
    known = {r.cell: (r.n, r.radius) for r in matches.collect()}
    cells, matrix = model_matrix(centroids)
    used = np.array([c in known for c in cells.tolist()], bool)
    cells, matrix = cells[used], matrix[used]
    held = np.array([known[c] for c in cells.tolist()], np.float64).reshape(-1, 2)
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast((cells, matrix, held))
    base = queries.select(*query_cols, F.col(query_vec_col).cast("array<double>").alias(query_vec_col))
    base = base.filter(F.size(query_vec_col) == matrix.shape[1]) if len(cells) else base.limit(0)
    bound = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("least", T.DoubleType())])
    schema = T.StructType([
        *base.schema.fields,
        T.StructField("first", T.ArrayType(T.IntegerType())),
        T.StructField("further", T.ArrayType(bound)),
    ])
    position = base.columns.index(query_vec_col)

    def plan(batches):
        numbers, centres, (counts, radius) = shared.value[0], shared.value[1], shared.value[2].T
        for batch in batches:
            first, rest = [], []
            for q in dense(batch.column(position)):
                off = np.sqrt(((centres - q) ** 2).sum(axis=1))
                order = np.lexsort((numbers, off))
                enough = int(np.searchsorted(np.cumsum(counts[order]), k)) + 1
                first.append(numbers[order[:enough]].tolist())
                # A little less than computed, for rounding.
                least = np.maximum(off - radius, 0.0) * (1 - 1e-9) - 1e-12
                rest.append([{"cell": int(numbers[i]), "least": float(max(least[i], 0.0) ** 2)} for i in order[enough:]])
            added = [pa.array(v, to_arrow_type(f.dataType)) for v, f in zip((first, rest), schema.fields[-2:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.fieldNames())

    planned = materialize(base.mapInArrow(plan, schema), "planned")
    kept = [*query_cols, query_vec_col]
    candidates = postings.filter(predicate)
    probes = planned.select(*kept, F.explode("first").alias("cell"))
    hits = materialize(block_topk(candidates, probes, k, group_cols=["cell"], **names), "hits")
    looked = planned.select(*query_cols, F.col("first").alias("cells"))
    if exact:
        reached = hits.groupBy(*query_cols).agg(F.max("distance").alias("_worst"), F.count("*").alias("_n"))
        more = planned.join(reached, query_cols, "left").select(
            *kept,
            "first",
            F.transform(
                F.filter("further", lambda c: (F.coalesce("_n", F.lit(0)) < k) | (c["least"] <= F.col("_worst"))),
                lambda c: c["cell"],
            ).alias("second"),
            # No row beyond the k-th hit can still be among the k nearest.
            F.when(F.col("_n") >= k, F.col("_worst")).alias("_reach"),
        )
        more = materialize(more, "widened")
        widened = more.select(*kept, "_reach", F.explode("second").alias("cell"))
        others = block_topk(candidates, widened, k, group_cols=["cell"], within_col="_reach", **names)
        hits = merge_hits(hits.drop("rank").unionByName(others.drop("rank")), k, query_cols, id_col)
        looked = more.select(*query_cols, F.concat("first", "second").alias("cells"))
    return hits, looked
