"""Searches by joined blocks: in cells, in routed shards, under a filter.

Queries are the vectors whose id is divisible by 50.  Blocks are far smaller than by default, so
that the supplied tables make several of each group.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vecspark.catalog.common import Query, r6, table
from vecspark.catalog.vectors import BASE_SQL, K, NPROBE, embeddings, label_means, ranked
from vecspark.operators.block_join import cell_summary, filtered_ivf_search, ivf_block_search, routed_search
from vecspark.operators.ivf import assign_cells
from vecspark.operators.routing import route
from vecspark.sources.tables import write_partitioned
from vecspark.sources.workspace import materialize, new_path

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BLOCKS = {"block_vectors": 40, "block_queries": 4}
LABELS = (1, 4, 7)

_QUERIES_SQL = BASE_SQL.replace(
    """SELECT label AS query_id, arg_min(embedding, vec_id)::DOUBLE[] AS query_vector
  FROM embeddings GROUP BY 1""",
    "SELECT vec_id AS query_id, embedding::DOUBLE[] AS query_vector FROM embeddings WHERE vec_id % 50 = 0",
)


def _queries(vectors):
    return vectors.filter(F.col("vec_id") % 50 == 0).select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector")
    )


def _index(vectors):
    centroids = label_means(vectors)
    return centroids, materialize(assign_cells(vectors, centroids), "postings")


def q_ivf_block_join(spark, sf):
    vectors = embeddings(spark, sf)
    centroids, postings = _index(vectors)
    return ranked(ivf_block_search(postings, centroids, _queries(vectors), K, NPROBE, id_col="vec_id", **BLOCKS))


QUERIES["ivf_block_join"] = q_ivf_block_join
ORACLES["ivf_block_join"] = f"""{_QUERIES_SQL}
SELECT query_id, vec_id, round(distance, 6) AS distance,
       (row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id))::INTEGER AS rank
FROM candidates WHERE probe_rank <= {NPROBE} QUALIFY rank <= {K}"""


def q_filtered_ivf(spark, sf):
    vectors = embeddings(spark, sf)
    centroids, postings = _index(vectors)
    hits, _ = filtered_ivf_search(
        postings, centroids, cell_summary(postings, ["label"]), F.col("label").isin(*LABELS), _queries(vectors), K,
        id_col="vec_id", **BLOCKS,
    )
    return ranked(hits)


QUERIES["filtered_ivf"] = q_filtered_ivf
ORACLES["filtered_ivf"] = f"""{_QUERIES_SQL}
SELECT query_id, vec_id, round(distance, 6) AS distance,
       (row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id))::INTEGER AS rank
FROM pairs WHERE label IN {LABELS} QUALIFY rank <= {K}"""


def _month(date):
    return F.date_format(date, "yyyy-MM")


def _routed(spark, sf):
    """Vectors in shards by the month of the order with their number, and requests from a month
    before their own order to two months after it."""
    vectors, orders = embeddings(spark, sf), table(spark, sf, "orders")
    dated = vectors.join(orders.select(F.col("o_orderkey").alias("vec_id"), "o_orderdate"), "vec_id")
    path = new_path(spark, "monthly")
    write_partitioned(dated.select("vec_id", "embedding", _month("o_orderdate").alias("shard_key")), path, ["shard_key"])
    stored = spark.read.parquet(path)
    requests = dated.filter(F.col("vec_id") % 50 == 0).select(
        F.col("vec_id").alias("query_id"),
        F.col("embedding").alias("query_vector"),
        F.add_months("o_orderdate", -1).alias("since"),
        F.add_months("o_orderdate", 2).alias("until"),
    )
    catalog = stored.select("shard_key").distinct()
    return routed_search(stored, route(requests, "since", "until"), catalog, K, id_col="vec_id", **BLOCKS)


def q_routed_search(spark, sf):
    return ranked(_routed(spark, sf)[0])


_ROUTED_SQL = """
WITH dated AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, date_trunc('month', o_orderdate)::DATE AS month
  FROM embeddings JOIN orders ON o_orderkey = vec_id),
wanted AS (
  SELECT vec_id AS query_id, v AS q,
         unnest(generate_series(month - INTERVAL 1 MONTH, month + INTERVAL 2 MONTH, INTERVAL 1 MONTH))::DATE AS month
  FROM dated WHERE vec_id % 50 = 0)"""

QUERIES["routed_search"] = q_routed_search
ORACLES["routed_search"] = f"""{_ROUTED_SQL}
SELECT query_id, vec_id, round(pow(list_distance(q, v), 2), 6) AS distance,
       (row_number() OVER (PARTITION BY query_id ORDER BY pow(list_distance(q, v), 2), vec_id))::INTEGER AS rank
FROM wanted JOIN dated USING (month) QUALIFY rank <= {K}"""


def q_routed_rejections(spark, sf):
    return _routed(spark, sf)[1].select("query_id", "shard_key")


QUERIES["routed_rejections"] = q_routed_rejections
ORACLES["routed_rejections"] = f"""{_ROUTED_SQL}
SELECT query_id, strftime(month, '%Y-%m') AS shard_key FROM wanted
WHERE month NOT IN (SELECT month FROM dated)"""
