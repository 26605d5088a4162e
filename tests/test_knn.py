"""Exact search against brute force, with the queries in one part and in several."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_support import brute_force, clustered, hits, plan_of, query_frame, vector_frame
from vecspark.operators import knn, scan

PARTS = dict(max_broadcast_bytes=600)


@pytest.fixture(scope="module")
def data(spark):
    x, label = clustered(n=1000)
    # A third of the vectors are copies of one.
    x[::3] = x[0]
    q = clustered(n=7, seed=1)[0]
    q[0] = x[0]
    vectors = vector_frame(spark, x, label=[int(v) for v in label]).repartition(4).cache()
    return x, label, q, vectors, query_frame(spark, q)


@pytest.mark.parametrize("limits", [{}, PARTS])
def test_exact_matches_brute_force(data, limits):
    x, _, q, vectors, queries = data
    assert hits(knn.exact_knn(vectors, queries, 10, **limits)) == brute_force(x, q, 10)


@pytest.mark.parametrize("limits", [{}, PARTS])
def test_fanout_over_shards(data, limits):
    x, label, q, vectors, queries = data
    wanted = queries.withColumn("shards", F.array(F.col("query_id"), F.col("query_id") + 1))
    found = hits(knn.fanout_knn(vectors, wanted, 5, shard_col="label", **limits))
    expected = []
    for i in range(len(q)):
        ids = np.flatnonzero(np.isin(label, [i, i + 1]))
        part = brute_force(x[ids], q[i : i + 1], 5)
        expected += [(i, int(ids[j]), d, r) for _, j, d, r in part]
    assert found == sorted(expected)


def test_ties_and_fewer_rows_than_k(spark):
    x = np.array([[1, 0], [0, 1], [1, 0], [2, 2]], dtype=np.float32)
    found = knn.exact_knn(vector_frame(spark, x), query_frame(spark, x[:1]), 10)
    assert [(r.id, r["rank"]) for r in found.orderBy("rank").collect()] == [(0, 1), (2, 2), (1, 3), (3, 4)]


def test_unusable_vectors_and_string_ids(spark):
    nan = float("nan")
    vectors = spark.createDataFrame(
        [("a", [1.0, 1.0]), ("b", [nan, 1.0]), ("c", None), ("d", [1.0]), ("e", [None, 1.0]), ("f", [0.0, 0.0])],
        "id string, embedding array<float>",
    )
    found = knn.exact_knn(vectors, query_frame(spark, np.ones((1, 2))), 5)
    assert [(r.id, r.distance) for r in found.orderBy("rank").collect()] == [("a", 0.0), ("f", 2.0)]


def test_query_lengths_must_agree(spark):
    queries = spark.createDataFrame(
        [(0, [1.0, 1.0]), (1, [1.0])], "query_id int, query_vector array<float>"
    )
    for limits in ({}, PARTS, {"max_broadcast_bytes": 1}):
        with pytest.raises(ValueError, match="length"):
            knn.exact_knn(vector_frame(spark, np.ones((3, 2))), queries, 5, **limits)


def test_large_ids_next_to_null_ones(spark):
    big = 2**53 + 1
    vectors = spark.createDataFrame(
        [(big, [1.0, 1.0]), (None, [1.0, 1.0]), (3, [0.0, 1.0])], "id long, embedding array<float>"
    )
    found = knn.exact_knn(vectors.coalesce(1), query_frame(spark, np.ones((1, 2))), 5)
    assert [r.id for r in found.orderBy("rank").collect()] == [big, 3]


def test_no_queries(spark):
    empty = spark.createDataFrame([], "query_id int, query_vector array<float>")
    vectors = vector_frame(spark, np.ones((3, 2)))
    assert knn.exact_knn(vectors, empty, 5).count() == 0


def test_filter_reaches_the_scan(spark, data, tmp_path):
    x, label, q, vectors, queries = data
    vectors.write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    found = knn.filtered_knn(stored, F.col("label") == 3, queries, 5)
    plan = plan_of(found)
    assert "EqualTo(label,3)" in plan and "WindowGroupLimit" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    ids = np.flatnonzero(label == 3)
    assert {r.id for r in found.collect()} <= set(ids.tolist())


def test_limit_per_request(spark):
    found = knn.exact_knn(
        vector_frame(spark, np.eye(6)), query_frame(spark, np.eye(6)[:2]), 5
    )
    requests = spark.createDataFrame([(0, 2), (1, 4)], "query_id int, top_k int")
    cut = knn.limit_per_request(found, requests, "query_id", "top_k")
    assert {r.query_id: r["count"] for r in cut.groupBy("query_id").count().collect()} == {0: 2, 1: 4}


def test_many_queries_move_no_vectors(spark, data):
    _, _, _, vectors, _ = data
    requests = vectors.select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector"))
    plan = plan_of(knn.exact_knn(vectors, requests, 2))
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("embedding" in line for line in exchanges)


def test_mean_vectors(spark):
    x = np.array([[1, 2], [3, 4], [5, 9]], dtype=np.float32)
    means = knn.mean_vectors(vector_frame(spark, x, g=[0, 0, 1]), "g", "embedding")
    assert {r.g: r.mean_vector for r in means.collect()} == {0: [2.0, 3.0], 1: [5.0, 9.0]}


def test_mean_vectors_of_odd_rows(spark):
    rows = [(0, None), (0, [1.0, None]), (0, [3.0, 4.0]), (None, [7.0, None]), (1, []), (2, [1.0]), (2, [float("nan")])]
    means = knn.mean_vectors(spark.createDataFrame(rows, "g int, embedding array<float>"), "g", "embedding")
    found = {r.g: r.mean_vector for r in means.collect()}
    assert found[0] == [2.0, 4.0] and found[None] == [7.0, None] and np.isnan(found[2]).all()


def test_more_queries_than_are_broadcast_stay_off_the_driver(data, monkeypatch):
    x, _, q, vectors, queries = data

    def refuse(*_):
        raise AssertionError("queries reached the driver")

    monkeypatch.setattr(scan, "_broadcast_scan", refuse)
    assert hits(knn.exact_knn(vectors, queries, 10, **PARTS)) == brute_force(x, q, 10)
    # Rows of queries are told apart by their place, as in the scan.
    twice = hits(knn.exact_knn(vectors, queries.unionByName(queries), 10, **PARTS))
    assert [h[:3] for h in twice] == sorted(h[:3] for h in brute_force(x, q, 5) for _ in range(2))


def test_the_broadcast_bound_counts_hits(data, monkeypatch):
    x, _, q, vectors, queries = data

    def refuse(*_):
        raise AssertionError("hits were left out of the bound")

    monkeypatch.setattr(scan, "_broadcast_scan", refuse)
    # Seven queries of some 270 bytes each, and 500 hits of each.
    assert hits(knn.exact_knn(vectors, queries, 500, max_broadcast_bytes=20_000)) == brute_force(x, q, 500)
