"""Whole flows: requests to pages, and index builds with a refresh."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from vecspark.catalog.common import Query, r6, table
from vecspark.functions.vectors import zero_vector
from vecspark.operators.embed import embed
from vecspark.plans.index import build_index, refresh_index
from vecspark.plans.search import search
from vecspark.sources.index_store import describe_index, load_index
from vecspark.sources.workspace import new_path

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIM = 64
ASKED_AT = datetime(2024, 1, 1)


def _failing_encoder():
    def encode(texts):
        if any("$$$" in t for t in texts.to_pylist()):
            raise ValueError("price sign")
        return np.ones((len(texts), 4))

    return encode


def q_embed_failures(spark, sf):
    """One text that the encoder can't read costs one row, with the error kept."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = embed(docs, "text", _failing_encoder, 4, error_col="error")
    return found.select("doc_id", "embed_status", "error", F.get("embedding", F.lit(0)).cast("double").alias("x"))


QUERIES["embed_failures"] = q_embed_failures
ORACLES["embed_failures"] = """
WITH s AS (SELECT doc_id, CASE WHEN trim(text, E' \\t\\n\\r') = '' THEN 'blank' WHEN contains(text, '$$$') THEN 'failed'
                          ELSE 'ok' END AS embed_status FROM documents)
SELECT doc_id, embed_status, CASE embed_status WHEN 'failed' THEN 'ValueError: price sign' END AS error,
       CASE embed_status WHEN 'ok' THEN 1.0 ELSE 0.0 END::DOUBLE AS x FROM s"""


def _requests(spark, sf):
    """One request per vector for its own neighbours in its shard; every tenth is blank, every
    tenth asks for what has no vector and every tenth for a shard that isn't there."""
    v, kind = F.col("vec_id"), F.col("vec_id") % 10
    return table(spark, sf, "embeddings").select(
        v.alias("request_id"),
        F.when(kind == 7, " ").when(kind == 8, F.concat(F.lit("no "), v)).otherwise(v.cast("string")).alias("query"),
        (3 + v % 3).cast("int").alias("top_k"),
        F.when(kind == 9, "nowhere").otherwise(F.col("label").cast("string")).alias("shard_key"),
        F.lit(256).alias("nprobe"),
        (1 + v % 2).cast("int").alias("page"),
        F.lit(2).alias("page_size"),
    )


def _answers(spark, sf):
    vectors = table(spark, sf, "embeddings")
    path = new_path(spark, "index")
    build_index(vectors, path, DIM, nlist=4, m=None, id_col="vec_id", shard_col="label")
    index = load_index(spark, path)

    def embed_queries(df, column):
        known = vectors.select(F.col("vec_id").cast("string").alias(column), "embedding")
        status = F.when(F.col("embedding").isNull(), "missing").otherwise("ok")
        found = df.join(known, column, "left").withColumn("embed_status", status)
        return found.withColumn("embedding", F.coalesce("embedding", zero_vector(DIM)))

    def ask(requests, **reuse):
        return search(requests, index, embed_queries, "0", id_col="vec_id", **reuse)

    requests = _requests(spark, sf)
    earlier = ask(requests.filter("request_id % 4 = 0"), asked_at=ASKED_AT)
    return ask(requests, stored=earlier.hits, asked_at=ASKED_AT + timedelta(seconds=60))


def q_search_flow(spark, sf):
    """Requests to pages: valid ones answered from stored results or by a search."""
    answer = _answers(spark, sf)
    return answer.pages.join(answer.answered.drop("top_k", "nprobe"), "request_id").select(
        "request_id", "shard_key", "cache_hit", "rank", "vec_id", r6("distance").alias("distance"),
        "total_results", "has_next",
    )


_ASKED = """
WITH r AS (SELECT vec_id AS request_id, embedding, label, 3 + vec_id % 3 AS top_k, 1 + vec_id % 2 AS page
           FROM embeddings WHERE vec_id % 10 < 7),
d AS (SELECT r.*, e.vec_id, list_sum(list_transform(list_zip(r.embedding, e.embedding),
             lambda x: power(x[1]::DOUBLE - x[2]::DOUBLE, 2))) AS distance
      FROM r JOIN embeddings e ON e.label = r.label),
k AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY distance, vec_id) AS rank FROM d QUALIFY rank <= top_k),
t AS (SELECT *, count(*) OVER (PARTITION BY request_id) AS total_results FROM k)"""

QUERIES["search_flow"] = q_search_flow
ORACLES["search_flow"] = f"""{_ASKED}
SELECT request_id, label::VARCHAR AS shard_key, request_id % 4 = 0 AS cache_hit, rank::INTEGER AS rank, vec_id,
       round(distance, 6) AS distance, total_results, total_results > page * 2 AS has_next
FROM t WHERE rank > (page - 1) * 2 AND rank <= page * 2"""


def q_search_rejections(spark, sf):
    """Every request that got no answer, and why."""
    answer = _answers(spark, sf)
    rejected = answer.rejected.select("request_id", F.array_join("reasons", ",").alias("reason"))
    unknown = answer.unknown_shards.select("request_id", F.lit("unknown_shard").alias("reason"))
    return rejected.unionByName(unknown)


QUERIES["search_rejections"] = q_search_rejections
ORACLES["search_rejections"] = """
SELECT vec_id AS request_id, CASE vec_id % 10 WHEN 7 THEN 'query_required' WHEN 8 THEN 'embedding missing'
                             ELSE 'unknown_shard' END AS reason
FROM embeddings WHERE vec_id % 10 >= 7"""


def q_index_publish(spark, sf):
    """An index with codes is built, then published anew with changed and without deleted rows."""
    vectors = table(spark, sf, "embeddings")
    path = new_path(spark, "index")
    names = dict(id_col="vec_id", shard_col="label")
    build_index(vectors, path, DIM, nlist=4, m=8, nbits=4, **names)
    gone = vectors.filter("vec_id % 7 = 0")
    refresh_index(vectors.filter("vec_id % 5 = 0 AND vec_id % 7 <> 0"), path, deleted=gone, nbits=4, **names)
    found = None
    for version in (1, 2):
        shards = describe_index(load_index(spark, path, version))
        shards = shards.select(
            F.lit(version).alias("version"), "shard_key", "total_vectors", "dimension", "index_type", "is_trained",
            (F.col("index_size_bytes") > 0).alias("has_bytes"), F.col("index_path").contains(path).alias("in_place"),
        )
        found = shards if found is None else found.unionByName(shards)
    return found


QUERIES["index_publish"] = q_index_publish
ORACLES["index_publish"] = """
SELECT v::INTEGER AS version, label::VARCHAR AS shard_key, count(*) FILTER (v = 1 OR vec_id % 7 <> 0) AS total_vectors,
       64 AS dimension, 'IVF4,PQ8' AS index_type, true AS is_trained, true AS has_bytes, true AS in_place
FROM embeddings, (SELECT unnest([1, 2]) AS v) GROUP BY v, label"""
