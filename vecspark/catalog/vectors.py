"""Distances, exact and approximate search, index building and evaluation.

Queries are the first vector of each label, found over the whole table.  Where SQL has to
agree, the centroids are the mean vectors of the labels; trained models are checked by
properties that hold for any training.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vecspark.catalog.common import Query, in_micros, r6, table
from vecspark.functions.vectors import cosine_similarity, l2_normalize, squared_l2
from vecspark.operators.evaluate import recall_at_k, sweep_nprobe
from vecspark.operators.index_admin import (
    drift,
    index_compression,
    index_info,
    refresh_postings,
    smoke_test,
)
from vecspark.operators.ivf import assign_cells, ivf_flat_search, train_centroids
from vecspark.operators.knn import exact_knn, fanout_knn, filtered_knn, mean_vectors
from vecspark.operators.pq import ivfpq_search, pq_encode, rerank, train_codebooks
from vecspark.operators.results import attach_metadata, page_hits, results_json
from vecspark.sources.index_store import load_index, save_index
from vecspark.sources.workspace import materialize, new_path

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

K = 10
NLIST, M, NBITS = 16, 8, 4
NPROBE = 3
NPROBES = (1, 2, 5, 10)


def embeddings(spark, sf):
    return table(spark, sf, "embeddings")


def label_queries(vectors):
    first = F.min_by("embedding", "vec_id").alias("query_vector")
    return vectors.groupBy(F.col("label").alias("query_id")).agg(first)


def label_means(vectors):
    """Written once: every search and assignment reads this small model."""
    means = mean_vectors(vectors, "label", "embedding")
    return materialize(
        means.select(F.col("label").alias("cell"), F.col("mean_vector").alias("centroid")), "means"
    )


def ranked(hits, *extra):
    return hits.select("query_id", "vec_id", r6("distance").alias("distance"), "rank", *extra)


BASE_SQL = """
WITH queries AS (
  SELECT label AS query_id, arg_min(embedding, vec_id)::DOUBLE[] AS query_vector
  FROM embeddings GROUP BY 1),
vectors AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
means AS (
  SELECT cell, list(x ORDER BY pos) AS centroid FROM (
    SELECT label AS cell, pos, avg(x) AS x FROM (
      SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos
      FROM embeddings) GROUP BY 1, 2) GROUP BY 1),
pairs AS (SELECT query_id, vec_id, label, pow(list_distance(query_vector, v), 2) AS distance
          FROM queries, vectors),
exact AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id))::INTEGER AS rank
  FROM pairs),
postings AS (
  SELECT vec_id, label, cell, distance AS cell_distance FROM (
    SELECT vec_id, label, cell, pow(list_distance(centroid, v), 2) AS distance FROM vectors, means)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cell) = 1),
probes AS (
  SELECT query_id, cell,
         row_number() OVER (PARTITION BY query_id ORDER BY distance, cell) AS probe_rank
  FROM (SELECT query_id, cell, pow(list_distance(query_vector, centroid), 2) AS distance
        FROM queries, means)),
candidates AS (
  SELECT p.query_id, p.vec_id, p.distance, probe_rank
  FROM pairs p JOIN postings s USING (vec_id) JOIN probes r ON r.query_id = p.query_id AND r.cell = s.cell)
"""


def q_l2_normalize(spark, sf):
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 1))
    unit = l2_normalize(scaled)
    return embeddings(spark, sf).select("vec_id", in_micros(unit).alias("unit_micros"))


QUERIES["l2_normalize"] = q_l2_normalize
ORACLES["l2_normalize"] = """
WITH scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * (label + 1)) AS v
  FROM embeddings)
SELECT vec_id, array_to_string(list_transform(v, lambda x: round(
         x / sqrt(list_sum(list_transform(v, lambda y: y * y))) * 1000000)::BIGINT), ',') AS unit_micros
FROM scaled"""


def _with_own_mean(spark, sf):
    vectors = embeddings(spark, sf)
    means = label_means(vectors).withColumnRenamed("cell", "label")
    return vectors.join(means, "label")


def q_l2_distance(spark, sf):
    return _with_own_mean(spark, sf).select(
        "vec_id", r6(squared_l2("embedding", "centroid")).alias("distance")
    )


QUERIES["l2_distance"] = q_l2_distance
ORACLES["l2_distance"] = f"""{BASE_SQL}
SELECT vec_id, round(pow(list_distance(v, centroid), 2), 6) AS distance
FROM vectors JOIN means ON cell = label"""


def q_cosine_similarity(spark, sf):
    return _with_own_mean(spark, sf).select(
        "vec_id", r6(cosine_similarity("embedding", "centroid")).alias("similarity")
    )


QUERIES["cosine_similarity"] = q_cosine_similarity
ORACLES["cosine_similarity"] = f"""{BASE_SQL}
SELECT vec_id, round(list_cosine_similarity(v, centroid), 6) AS similarity
FROM vectors JOIN means ON cell = label"""


def _exact(spark, sf, k=K):
    vectors = embeddings(spark, sf)
    return exact_knn(vectors, label_queries(vectors), k, id_col="vec_id")


def q_exact_knn(spark, sf):
    return ranked(_exact(spark, sf))


EXACT_SQL = f"""{BASE_SQL}
SELECT query_id, vec_id, round(distance, 6) AS distance, rank FROM exact WHERE rank <= {K}"""

QUERIES["exact_knn"] = q_exact_knn
ORACLES["exact_knn"] = EXACT_SQL


def q_batch_knn(spark, sf):
    """Every vector is a query: more than are broadcast, so blocks of them meet blocks of vectors."""
    vectors = embeddings(spark, sf)
    requests = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    return ranked(exact_knn(vectors, requests, 3, id_col="vec_id", max_broadcast_bytes=1 << 18))


QUERIES["batch_knn"] = q_batch_knn
ORACLES["batch_knn"] = """
WITH d AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         list_sum(list_transform(list_zip(q.embedding, v.embedding),
                                 lambda x: power(x[1]::DOUBLE - x[2]::DOUBLE, 2))) AS distance
  FROM embeddings q, embeddings v)
SELECT query_id, vec_id, round(distance, 6) AS distance,
       (row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id))::INTEGER AS rank
FROM d QUALIFY rank <= 3"""


def q_hit_metadata_join(spark, sf):
    vectors = embeddings(spark, sf)
    hits = _exact(spark, sf)
    return ranked(attach_metadata(hits, vectors, "vec_id", ["label"]), "label")


QUERIES["hit_metadata_join"] = q_hit_metadata_join
ORACLES["hit_metadata_join"] = f"""{BASE_SQL}
SELECT query_id, vec_id, round(distance, 6) AS distance, rank, label FROM exact WHERE rank <= {K}"""


def q_filtered_knn(spark, sf):
    vectors = embeddings(spark, sf)
    wanted = F.col("label").isin(1, 3, 5)
    hits = filtered_knn(vectors, wanted, label_queries(vectors), K, id_col="vec_id")
    return ranked(hits)


QUERIES["filtered_knn"] = q_filtered_knn
ORACLES["filtered_knn"] = f"""{BASE_SQL}
SELECT query_id, vec_id, round(distance, 6) AS distance,
       (row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id))::INTEGER AS rank
FROM pairs WHERE label IN (1, 3, 5) QUALIFY rank <= {K}"""


def q_fanout_knn(spark, sf):
    """Labels are shards; each query looks at its own and the next one."""
    vectors = embeddings(spark, sf)
    own = F.col("query_id")
    queries = label_queries(vectors).withColumn("shards", F.array(own, (own + 1) % 10))
    return ranked(fanout_knn(vectors, queries, K, shard_col="label", id_col="vec_id"))


QUERIES["fanout_knn"] = q_fanout_knn
ORACLES["fanout_knn"] = f"""{BASE_SQL}
SELECT query_id, vec_id, round(distance, 6) AS distance,
       (row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id))::INTEGER AS rank
FROM pairs WHERE label IN (query_id, (query_id + 1) % 10) QUALIFY rank <= {K}"""


def q_paginate_results(spark, sf):
    """Pages of seven out of the 25 best hits; the page asked for differs by query."""
    hits = _exact(spark, sf, 25)
    requests = label_queries(embeddings(spark, sf)).select(
        "query_id", (F.col("query_id") % 5 + 1).alias("page"), F.lit(7).alias("page_size")
    )
    return ranked(
        page_hits(hits, requests, ["query_id"]), "page", "total_results", "has_next"
    )


QUERIES["paginate_results"] = q_paginate_results
ORACLES["paginate_results"] = f"""{BASE_SQL},
paged AS (
  SELECT *, query_id % 5 + 1 AS page, count(*) OVER (PARTITION BY query_id) AS total_results
  FROM exact WHERE rank <= 25)
SELECT query_id, vec_id, round(distance, 6) AS distance, rank, page, total_results,
       total_results > page * 7 AS has_next
FROM paged WHERE rank > (page - 1) * 7 AND rank <= page * 7"""


def q_search_result_json(spark, sf):
    """Serialised results, read back to compare ids and scores."""
    stored = results_json(_exact(spark, sf), ["query_id"], "vec_id")
    hits = F.from_json("results_json", "array<struct<id:bigint,score:double>>")
    ids = F.transform(hits, lambda h: h["id"].cast("string"))
    scores = F.transform(hits, lambda h: h["score"])
    return stored.select(
        "query_id", "total_results", F.array_join(ids, ",").alias("ids"),
        in_micros(scores).alias("score_micros"),
    )


QUERIES["search_result_json"] = q_search_result_json
ORACLES["search_result_json"] = f"""{BASE_SQL}
SELECT query_id, count(*) AS total_results, string_agg(vec_id::VARCHAR, ',' ORDER BY rank) AS ids,
       string_agg(round(distance * 1000000)::BIGINT::VARCHAR, ',' ORDER BY rank) AS score_micros
FROM exact WHERE rank <= {K} GROUP BY 1"""


def _mean_index(spark, sf):
    vectors = embeddings(spark, sf)
    centroids = label_means(vectors)
    return vectors, centroids, assign_cells(vectors, centroids)


def q_ivf_assign(spark, sf):
    _, _, postings = _mean_index(spark, sf)
    return postings.select("vec_id", "cell", r6("cell_distance").alias("cell_distance"))


QUERIES["ivf_assign"] = q_ivf_assign
ORACLES["ivf_assign"] = f"""{BASE_SQL}
SELECT vec_id, cell, round(cell_distance, 6) AS cell_distance FROM postings"""


def q_ivf_flat_search(spark, sf):
    vectors, centroids, postings = _mean_index(spark, sf)
    queries = label_queries(vectors)
    return ranked(ivf_flat_search(postings, centroids, queries, K, NPROBE, id_col="vec_id"))


QUERIES["ivf_flat_search"] = q_ivf_flat_search
ORACLES["ivf_flat_search"] = f"""{BASE_SQL}
SELECT query_id, vec_id, round(distance, 6) AS distance,
       (row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id))::INTEGER AS rank
FROM candidates WHERE probe_rank <= {NPROBE} QUALIFY rank <= {K}"""


def q_recall_at_k(spark, sf):
    vectors, centroids, postings = _mean_index(spark, sf)
    queries = label_queries(vectors)
    hits = ivf_flat_search(postings, centroids, queries, K, NPROBE, id_col="vec_id")
    recall = recall_at_k(_exact(spark, sf), hits, ["query_id"], "vec_id")
    return recall.withColumn("recall", r6("recall"))


FOUND_SQL = f"""
approximate AS (
  SELECT nprobe, query_id, vec_id FROM candidates, (SELECT unnest({list(NPROBES)}) AS nprobe
    UNION SELECT {NPROBE}) WHERE probe_rank <= nprobe
  QUALIFY row_number() OVER (PARTITION BY nprobe, query_id ORDER BY distance, vec_id) <= {K}),
recalls AS (
  SELECT nprobe, e.query_id, count(a.vec_id) AS matched, count(*) AS expected
  FROM exact e CROSS JOIN (SELECT DISTINCT nprobe FROM approximate) n
  LEFT JOIN approximate a USING (nprobe, query_id, vec_id) WHERE e.rank <= {K} GROUP BY 1, 2)"""

QUERIES["recall_at_k"] = q_recall_at_k
ORACLES["recall_at_k"] = f"""{BASE_SQL}, {FOUND_SQL}
SELECT query_id, matched, expected, round(matched / expected, 6) AS recall
FROM recalls WHERE nprobe = {NPROBE}"""


def q_nprobe_sweep(spark, sf):
    vectors, centroids, postings = _mean_index(spark, sf)
    sweep = sweep_nprobe(
        postings, centroids, label_queries(vectors), _exact(spark, sf), K, NPROBES, id_col="vec_id"
    )
    return sweep.select(
        "nprobe", "n_queries", r6("recall").alias("recall"),
        r6("scanned_fraction").alias("scanned_fraction"),
    )


QUERIES["nprobe_sweep"] = q_nprobe_sweep
ORACLES["nprobe_sweep"] = f"""{BASE_SQL}, {FOUND_SQL},
scanned AS (
  SELECT nprobe, count(*) AS n FROM candidates, (SELECT unnest({list(NPROBES)}) AS nprobe)
  WHERE probe_rank <= nprobe GROUP BY 1)
SELECT nprobe, count(*) AS n_queries, round(avg(matched / expected), 6) AS recall,
       round(any_value(n) / count(*) / (SELECT count(*) FROM vectors), 6) AS scanned_fraction
FROM recalls JOIN scanned USING (nprobe) GROUP BY 1"""


def _info(spark, sf):
    _, _, postings = _mean_index(spark, sf)
    return index_info(postings.withColumn("shard_key", F.col("label").cast("string")), nlist=10)


def q_index_info(spark, sf):
    return _info(spark, sf).withColumn("avg_cell", r6("avg_cell"))


QUERIES["index_info"] = q_index_info
ORACLES["index_info"] = f"""{BASE_SQL},
cells AS (SELECT label, cell, count(*) AS n FROM postings GROUP BY 1, 2)
SELECT label::VARCHAR AS shard_key, sum(n)::BIGINT AS total_vectors, 64 AS dimension,
       min(n) AS smallest_cell, max(n) AS largest_cell, round(sum(n) / count(*), 6) AS avg_cell,
       10 - count(*) AS empty_cells
FROM cells GROUP BY 1"""


def q_index_compression(spark, sf):
    saved = index_compression(_info(spark, sf), M, NBITS, nlist=10)
    return saved.withColumn("saving", r6("saving"))


QUERIES["index_compression"] = q_index_compression
ORACLES["index_compression"] = f"""
SELECT label::VARCHAR AS shard_key, count(*) * 64 * 4 AS raw_bytes,
       (count(*) * ({M} * {NBITS} / 8 + 8) + 10 * 64 * 4 + (1 << {NBITS}) * 64 * 4)::BIGINT AS index_bytes,
       round(1 - (count(*) * ({M} * {NBITS} / 8 + 8) + 10 * 64 * 4 + (1 << {NBITS}) * 64 * 4)
             / (count(*) * 64 * 4), 6) AS saving
FROM embeddings GROUP BY 1"""


def q_index_refresh(spark, sf):
    """The vectors of half of the labels change: their entries are reversed."""
    vectors, centroids, postings = _mean_index(spark, sf)
    changed = vectors.filter(F.col("label") < 5).withColumn("embedding", F.reverse("embedding"))
    after = refresh_postings(postings, changed, centroids, id_col="vec_id")
    moved = drift(postings, after)
    return moved.select(
        "cell", "n_before", "n_after", r6("distance_before").alias("distance_before"),
        r6("distance_after").alias("distance_after"),
    )


QUERIES["index_refresh"] = q_index_refresh
ORACLES["index_refresh"] = f"""{BASE_SQL},
changed AS (
  SELECT vec_id, cell, distance AS cell_distance FROM (
    SELECT vec_id, cell, pow(list_distance(centroid,
             CASE WHEN label < 5 THEN list_reverse(v) ELSE v END), 2) AS distance FROM vectors, means)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cell) = 1),
a AS (SELECT cell, count(*) AS n, avg(cell_distance) AS d FROM postings GROUP BY 1),
b AS (SELECT cell, count(*) AS n, avg(cell_distance) AS d FROM changed GROUP BY 1)
SELECT cell, coalesce(a.n, 0) AS n_before, coalesce(b.n, 0) AS n_after,
       round(a.d, 6) AS distance_before, round(b.d, 6) AS distance_after
FROM a FULL JOIN b USING (cell)"""


# Trained models: SQL cannot repeat the training, so these report properties.


def q_ivf_train_stats(spark, sf):
    vectors = embeddings(spark, sf)
    centroids = train_centroids(vectors, NLIST, "vec_id")
    postings = assign_cells(vectors, centroids)
    return postings.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n_vectors"), r6(F.avg("cell_distance")).alias("avg_distance")
    )


QUERIES["ivf_train_stats"] = q_ivf_train_stats


def _trained_codes(spark, sf):
    vectors = embeddings(spark, sf)
    centroids = train_centroids(vectors, NLIST, "vec_id")
    # Stored, as training asks: assigning, encoding and scanning each run in stages of their own.
    postings = materialize(assign_cells(vectors, centroids), "postings")
    codebooks = train_codebooks(postings, centroids, M, NBITS, id_col="vec_id")
    return vectors, centroids, codebooks, materialize(pq_encode(postings, centroids, codebooks), "codes")


def q_pq_train_stats(spark, sf):
    _, _, codebooks, _ = _trained_codes(spark, sf)
    return codebooks.groupBy("sub").agg(
        F.count(F.lit(1)).alias("n_codes"),
        F.countDistinct("codeword").alias("n_distinct"),
        F.max(F.size("codeword")).alias("width"),
    )


def q_pq_encode(spark, sf):
    _, _, _, codes = _trained_codes(spark, sf)
    return codes.select(
        "vec_id", "cell", F.hex("codes").alias("codes"), F.length("codes").alias("code_bytes")
    )


def q_ivfpq_search(spark, sf):
    vectors, centroids, codebooks, codes = _trained_codes(spark, sf)
    queries = label_queries(vectors)
    hits = ivfpq_search(codes, centroids, codebooks, queries, 5 * K, NLIST // 2, id_col="vec_id")
    return ranked(rerank(hits, vectors, queries, K, id_col="vec_id"))


def q_index_smoke(spark, sf):
    vectors = embeddings(spark, sf)
    centroids = train_centroids(vectors, NLIST, "vec_id")
    postings = assign_cells(vectors, centroids)
    smoke = smoke_test(postings, centroids, id_col="vec_id")
    return smoke.withColumn("nearest_distance", r6("nearest_distance"))


QUERIES["pq_train_stats"] = q_pq_train_stats
ORACLES["pq_train_stats"] = f"""
SELECT unnest(range({M}))::INTEGER AS sub, {1 << NBITS} AS n_codes, {1 << NBITS} AS n_distinct, width
FROM (SELECT max(len(embedding)) // {M} AS width FROM embeddings)"""
QUERIES["pq_encode"] = q_pq_encode
QUERIES["ivfpq_search"] = q_ivfpq_search
QUERIES["index_smoke"] = q_index_smoke
ORACLES["index_smoke"] = """
SELECT vec_id AS query_id, 10 AS n_hits, 0.0::DOUBLE AS nearest_distance, TRUE AS found_itself
FROM embeddings ORDER BY vec_id LIMIT 5"""


def q_index_roundtrip(spark, sf):
    """Train, save, load and search every cell: the same hits as exact search."""
    vectors = embeddings(spark, sf)
    centroids = train_centroids(vectors, NLIST, "vec_id")
    postings = assign_cells(vectors, centroids)
    path = new_path(spark, "index")
    save_index(path, centroids, postings, id_col="vec_id")
    index = load_index(spark, path)
    queries = label_queries(vectors)
    hits = ivf_flat_search(index.postings, index.centroids, queries, K, NLIST, id_col="vec_id")
    return ranked(hits)


QUERIES["index_roundtrip"] = q_index_roundtrip
ORACLES["index_roundtrip"] = EXACT_SQL
