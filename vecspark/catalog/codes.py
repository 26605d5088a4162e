"""Product-quantised codes under a fixed model that SQL can repeat, properties of trained ones,
and postings by ranges of cells.

The cells are the means of the labels, and the codewords the residuals of the first vectors.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vecspark.catalog.common import Query
from vecspark.catalog.vectors import (
    BASE_SQL,
    K,
    M,
    NBITS,
    NLIST,
    NPROBE,
    embeddings,
    label_means,
    label_queries,
    ranked,
)
from vecspark.functions.vectors import squared_l2
from vecspark.operators.ivf import assign_cells, ivf_flat_search, model_matrix, probe_cells, train_centroids
from vecspark.operators.pq import ivfpq_search, pq_encode
from vecspark.sources.cell_ranges import read_cells, write_cell_ranges
from vecspark.sources.workspace import materialize, new_path

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ROWS_PER_RANGE = 120


def fixed_codebooks(postings, centroids):
    """The residual of the vector with the c-th smallest id gives codeword c of every sub-space."""
    first = postings.orderBy("vec_id").limit(1 << NBITS).join(centroids, "cell")
    residual = F.zip_with("embedding", "centroid", lambda x, y: x.cast("double") - y)
    words = first.select(
        (F.row_number().over(Window.orderBy("vec_id")) - 1).alias("code"), residual.alias("r"),
        F.explode(F.sequence(F.lit(0), F.lit(M - 1))).alias("sub"),
    )
    width = (F.size("r") / M).cast("int")
    return materialize(words.select("sub", "code", F.slice("r", F.col("sub") * width + 1, width).alias("codeword")), "codewords")


def fixed_codes(spark, sf):
    vectors = embeddings(spark, sf)
    centroids = label_means(vectors)
    postings = materialize(assign_cells(vectors, centroids), "postings")
    codebooks = fixed_codebooks(postings, centroids)
    return vectors, centroids, codebooks, materialize(pq_encode(postings, centroids, codebooks), "codes")


CODES_SQL = f"""{BASE_SQL},
subs AS (SELECT unnest(range({M}))::INTEGER AS sub),
residuals AS (
  SELECT p.vec_id, p.cell, list_transform(list_zip(v.v, m.centroid), lambda x: x[1] - x[2]) AS r, len(v.v) // {M} AS w
  FROM postings p JOIN vectors v USING (vec_id) JOIN means m ON m.cell = p.cell),
books AS (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS code, r, w FROM residuals
  QUALIFY row_number() OVER (ORDER BY vec_id) <= {1 << NBITS}),
words AS (SELECT code, sub, r[sub * w + 1 : sub * w + w] AS word FROM books, subs),
parts AS (SELECT vec_id, cell, sub, r[sub * w + 1 : sub * w + w] AS part FROM residuals, subs),
coded AS (
  SELECT vec_id, cell, sub, code FROM parts JOIN words USING (sub)
  QUALIFY row_number() OVER (PARTITION BY vec_id, sub ORDER BY list_distance(part, word), code) = 1)
"""


def q_pq_fixed_encode(spark, sf):
    *_, codes = fixed_codes(spark, sf)
    return codes.select("vec_id", "cell", F.hex("codes").alias("codes"))


QUERIES["pq_fixed_encode"] = q_pq_fixed_encode
ORACLES["pq_fixed_encode"] = f"""{CODES_SQL}
SELECT vec_id, any_value(cell) AS cell, string_agg(printf('%02X', code), '' ORDER BY sub) AS codes
FROM coded GROUP BY 1"""


def q_ivfpq_fixed_search(spark, sf):
    """By distances to the codes alone; equal codes are told apart by id."""
    vectors, centroids, codebooks, codes = fixed_codes(spark, sf)
    return ranked(ivfpq_search(codes, centroids, codebooks, label_queries(vectors), K, NPROBE, id_col="vec_id"))


QUERIES["ivfpq_fixed_search"] = q_ivfpq_fixed_search
ORACLES["ivfpq_fixed_search"] = f"""{CODES_SQL},
asked AS (
  SELECT query_id, cell, list_transform(list_zip(query_vector, centroid), lambda x: x[1] - x[2]) AS r,
         len(query_vector) // {M} AS w
  FROM probes JOIN queries USING (query_id) JOIN means USING (cell) WHERE probe_rank <= {NPROBE}),
look_up AS (
  SELECT query_id, cell, sub, code, pow(list_distance(r[sub * w + 1 : sub * w + w], word), 2) AS d
  FROM asked CROSS JOIN words),
scored AS (
  SELECT query_id, vec_id, list_sum(list(d ORDER BY sub)) AS distance
  FROM coded JOIN look_up USING (cell, sub, code) GROUP BY 1, 2)
SELECT query_id, vec_id, round(distance, 6) AS distance,
       (row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 9), vec_id))::INTEGER AS rank
FROM scored QUALIFY rank <= {K}"""


def q_ivf_short_search(spark, sf):
    """One cell holds fewer vectors than are asked for: all of them come back, nothing is filled up."""
    vectors = embeddings(spark, sf)
    centroids = label_means(vectors)
    postings = assign_cells(vectors, centroids)
    everything = vectors.count()
    return ranked(ivf_flat_search(postings, centroids, label_queries(vectors), everything, 1, id_col="vec_id"))


QUERIES["ivf_short_search"] = q_ivf_short_search
ORACLES["ivf_short_search"] = f"""{BASE_SQL}
SELECT query_id, vec_id, round(distance, 6) AS distance,
       (row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id))::INTEGER AS rank
FROM candidates WHERE probe_rank = 1"""


def q_ivf_train_cells(spark, sf):
    """Trained cells: each vector is in the nearest one, found again by plain expressions."""
    vectors = embeddings(spark, sf)
    centroids = train_centroids(vectors, NLIST, "vec_id")
    cells, matrix = model_matrix(centroids)
    plain = [squared_l2("embedding", F.lit(row.tolist())) for row in matrix]
    own = F.element_at(F.array(*plain), F.array_position(F.lit(cells.tolist()), F.col("cell")).cast("int"))
    is_nearest = (own <= F.least(*plain) + 1e-9) & (F.abs(F.col("cell_distance") - own) <= 1e-9)
    return assign_cells(vectors, centroids).select("vec_id", is_nearest.alias("in_nearest_cell"))


QUERIES["ivf_train_cells"] = q_ivf_train_cells
ORACLES["ivf_train_cells"] = "SELECT vec_id, TRUE AS in_nearest_cell FROM embeddings"


def q_cell_range_read(spark, sf):
    """Vectors of the cells nearest to three queries, from the ranges that hold them."""
    vectors = embeddings(spark, sf)
    centroids = label_means(vectors)
    path = new_path(spark, "ranges")
    write_cell_ranges(path, assign_cells(vectors, centroids), ROWS_PER_RANGE, "vec_id")
    queries = label_queries(vectors).filter("query_id < 3")
    probed = probe_cells(queries, centroids, 1, "query_vector").select(F.explode("cells").alias("cell"))
    return read_cells(path, materialize(probed, "probed")).select("vec_id", "cell", "cell_range")


QUERIES["cell_range_read"] = q_cell_range_read
ORACLES["cell_range_read"] = f"""{BASE_SQL},
counts AS (SELECT cell, count(*) AS n FROM postings GROUP BY 1),
directory AS (SELECT cell, ((sum(n) OVER (ORDER BY cell) - n) // {ROWS_PER_RANGE})::BIGINT AS cell_range FROM counts)
SELECT vec_id, cell, cell_range FROM postings JOIN directory USING (cell)
WHERE cell IN (SELECT cell FROM probes WHERE probe_rank = 1 AND query_id < 3)"""
