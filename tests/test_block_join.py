"""Searches by joined blocks against brute force, and what they read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_support import brute_force, clustered, hits, plan_of, query_frame, vector_frame
from vecspark.operators import scan
from vecspark.operators.block_join import block_topk, cell_summary, filtered_ivf_search, ivf_block_search, routed_search
from vecspark.operators.ivf import assign_cells, ivf_flat_search, train_centroids
from vecspark.operators.routing import route
from vecspark.sources.tables import write_partitioned
from vecspark.sources.workspace import materialize, new_path


@pytest.fixture(scope="module")
def index(spark):
    x, label = clustered(n=1500, dim=8, centres=12)
    vectors = vector_frame(spark, x, label=[int(v) for v in label])
    centroids = materialize(train_centroids(vectors, 12, "id"), "centroids")
    return x, label, centroids, materialize(assign_cells(vectors, centroids), "postings")


@pytest.mark.parametrize("blocks", [(10_000, 10_000), (37, 5), (1, 1_000), (1_000, 1)])
def test_any_blocks_give_the_rows_of_the_scan(spark, index, blocks):
    x, _, centroids, postings = index
    some = postings.filter("id < 200") if min(blocks) == 1 else postings
    queries = query_frame(spark, x[:40] + 0.01)
    sizes = {"block_vectors": blocks[0], "block_queries": blocks[1]}
    assert hits(ivf_block_search(some, centroids, queries, 5, 3, **sizes)) == hits(ivf_flat_search(some, centroids, queries, 5, 3))


def test_a_hot_cell_is_cut_into_blocks(spark):
    x = np.random.default_rng(1).normal(size=(600, 4)).astype(np.float32)
    vectors = vector_frame(spark, x).withColumn("cell", F.when(F.col("id") < 550, 0).otherwise(1))
    probes = query_frame(spark, x[:30]).withColumn("cell", F.explode(F.array(F.lit(0), F.lit(1), F.lit(9))))
    found = block_topk(vectors, probes, 7, group_cols=["cell"], block_vectors=50, block_queries=10)
    assert hits(found) == brute_force(x, x[:30], 7)
    # 11 by 3 blocks of the hot cell and 1 by 3 of the other: no task holds a cell whole.
    assert "FlatMapCoGroups" in plan_of(found) and "CartesianProduct" not in plan_of(found)


def test_odd_vectors_and_queries(spark):
    rows = [(1, [1.0, 2.0], 0), (2, None, 0), (None, [1.0, 2.0], 0), (3, [1.0], 0), (4, [1.0, 2.0], 0), (5, [9.0, 9.0], None)]
    vectors = spark.createDataFrame(rows, "id long, embedding array<float>, cell int")
    wanted = [(0, [1.0, 2.0], 0), (0, [1.0, 2.0], 0), (1, None, 0), (2, [5.0], 0), (3, [], 0), (4, [0.0, 0.0], 7)]
    probes = spark.createDataFrame(wanted, "query_id int, query_vector array<double>, cell int")
    found = block_topk(vectors, probes, 10, group_cols=["cell"])
    assert hits(found) == [(0, 1, 0.0, 1), (0, 4, 0.0, 2), (2, 3, 16.0, 1)]
    assert hits(block_topk(vectors, probes.limit(0), 10, group_cols=["cell"])) == []
    assert hits(block_topk(vectors.limit(0), probes, 10, group_cols=["cell"])) == []


def test_routed_search_reads_the_shards_that_requests_name(spark):
    x = np.random.default_rng(2).normal(size=(400, 4)).astype(np.float32)
    months = [f"2024-{1 + i % 12:02}" for i in range(len(x))]
    path = new_path(spark, "routed")
    write_partitioned(vector_frame(spark, x, shard_key=months), path, ["shard_key"])
    stored = spark.read.parquet(path)
    ranges = [(0, "2024-02-10", "2024-03-01"), (1, "2024-12-31", "2025-02-01"), (2, "2024-05-02", "2024-04-01")]
    requests = query_frame(spark, x[:3]).join(spark.createDataFrame(ranges, "query_id int, since string, until string"), "query_id")
    requests = route(requests.withColumns({c: F.to_date(c) for c in ("since", "until")}), "since", "until")
    catalog = stored.select("shard_key").distinct()
    found, unknown = routed_search(stored, requests, catalog, 4)
    want = []
    for q, wanted in ((0, ("2024-02", "2024-03")), (1, ("2024-12",))):
        ids = [i for i, m in enumerate(months) if m in wanted]
        near = sorted((round(float(((x[i].astype(float) - x[q]) ** 2).sum()), 9), i) for i in ids)[:4]
        want += [(q, i, d, r) for r, (d, i) in enumerate(near, 1)]
    assert hits(found) == sorted(want)
    assert sorted(map(tuple, unknown.select("query_id", "shard_key").collect())) == [(1, "2025-01"), (1, "2025-02")]
    assert "dynamicpruning" in plan_of(found)


@pytest.mark.parametrize("labels", [[3], [0, 5, 7], list(range(12)), [99]])
def test_filtered_search_is_exact_and_looks_in_few_cells(spark, index, labels):
    x, label, centroids, postings = index
    queries = query_frame(spark, x[:25] + 0.02)
    args = (postings, centroids, cell_summary(postings, ["label"]), F.col("label").isin(labels), queries, 6)
    found, looked = filtered_ivf_search(*args, block_vectors=64, block_queries=8)
    keep = np.flatnonzero(np.isin(label, labels))
    want = [(q, int(keep[i]), d, r) for q, i, d, r in brute_force(x[keep], (x[:25] + 0.02), 6)] if len(keep) else []
    assert [(q, i, r) for q, i, _, r in hits(found)] == [(q, i, r) for q, i, _, r in sorted(want)]
    cells = {r.query_id: r.cells for r in looked.collect()}
    assert all(len(set(c)) == len(c) for c in cells.values())
    holding = {r.cell for r in postings.filter(F.col("label").isin(labels)).select("cell").distinct().collect()}
    assert all(set(c) <= holding for c in cells.values())
    if len(labels) == 12:
        assert np.mean([len(c) for c in cells.values()]) < 6  # of 12; the clusters lie apart
    first, fewer = filtered_ivf_search(*args, exact=False)
    assert all(len(r.cells) <= len(cells[r.query_id]) for r in fewer.collect())
    assert first.count() == len(want)


def test_small_blocks_copy_no_row_more_than_a_few_times(spark):
    x = np.random.default_rng(3).normal(size=(300, 4)).astype(np.float32)
    names = dict(id_col="id", payload_col="embedding", query_cols=["query_id"], query_vec_col="query_vector")
    vectors, queries = vector_frame(spark, x), query_frame(spark, x[:40])
    found = scan.block_hits(vectors, queries, 1, group_cols=[], block_vectors=1, block_queries=1, **names)
    # A row for each query and block of vectors.
    assert found.count() == 40 * scan.MAX_COPIES


def test_filtered_search_cuts_a_cell_into_few_blocks(spark, monkeypatch):
    x = np.random.default_rng(4).normal(size=(400, 4)).astype(np.float32)
    centroids = spark.createDataFrame([(0, [0.0] * 4), (1, [1.0] * 4)], "cell int, centroid array<double>")
    postings = materialize(assign_cells(vector_frame(spark, x, label=[i % 2 for i in range(400)]), centroids), "postings")
    seen = []

    def record(df, label):
        seen.extend([materialize(df, label)] if label == "blocks" else [])
        return seen[-1] if label == "blocks" else materialize(df, label)

    monkeypatch.setattr(scan, "materialize", record)
    sizes = {"block_vectors": 1, "block_queries": 1}
    summary = cell_summary(postings, ["label"])
    found, _ = filtered_ivf_search(postings, centroids, summary, F.col("label") == 0, query_frame(spark, x[:30]), 3, **sizes)
    want = [(q, 2 * i, d, r) for q, i, d, r in brute_force(x[::2], x[:30], 3)]
    assert hits(found) == sorted(want)
    blocks = [(r["_n_vectors"], r["_n_queries"]) for df in seen for r in df.collect()]
    assert blocks and max(max(b) for b in blocks) <= scan.MAX_COPIES


def test_blocks_of_queries_leave_room_for_their_hits(spark, monkeypatch):
    x = np.random.default_rng(5).normal(size=(400, 4)).astype(np.float32)
    vectors = vector_frame(spark, x).withColumn("cell", F.lit(0))
    probes = query_frame(spark, x[:40]).withColumn("cell", F.lit(0))
    seen = []

    def record(df, label):
        seen.extend([df] if label == "blocks" else [])
        return materialize(df, label)

    monkeypatch.setattr(scan, "materialize", record)
    monkeypatch.setattr(scan, "BLOCK_BYTES", 10_000)
    # Hits of a query take 64 bytes each, and no task has more than its 200 vectors.
    for k, n_queries in ((1, 1), (50, 13), (1_000, 52)):
        found = block_topk(vectors, probes, k, group_cols=["cell"])
        assert hits(found) == brute_force(x, x[:40], k)
        assert tuple(seen.pop().select("_n_vectors", "_n_queries").first()) == (2, n_queries)


def test_vectors_are_counted_before_they_are_dealt_by_group(spark, monkeypatch):
    x = np.random.default_rng(6).normal(size=(300, 4)).astype(np.float32)
    vectors = materialize(vector_frame(spark, x, cell=[i % 2 for i in range(300)]), "vectors")
    probes = query_frame(spark, x[:5]).withColumn("cell", F.explode(F.array(F.lit(0), F.lit(1))))
    plans = []

    def record(df, label):
        plans.extend([plan_of(df)] if label == "blocks" else [])
        return materialize(df, label)

    monkeypatch.setattr(scan, "materialize", record)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert hits(block_topk(vectors, probes, 3, group_cols=["cell"])) == brute_force(x, x[:5], 3)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plans[0].splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert below and all("partial_count" in line for line in below)


def test_further_cells_give_no_rows_beyond_the_hits_of_the_first(spark, monkeypatch):
    x = np.random.default_rng(7).normal(size=(600, 4)).astype(np.float32)
    centroids = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(6)], "cell int, centroid array<double>")
    postings = materialize(assign_cells(vector_frame(spark, x, label=[i % 2 for i in range(600)]), centroids), "postings")
    seen, block_hits = [], scan.block_hits

    def record(*args, **names):
        seen.append(materialize(block_hits(*args, **names), "seen"))
        return seen[-1]

    monkeypatch.setattr(scan, "block_hits", record)
    args = (postings, centroids, cell_summary(postings, ["label"]), F.col("label") == 0, query_frame(spark, x[:30]), 3)
    found, _ = filtered_ivf_search(*args, block_vectors=20, block_queries=8)
    want = [(q, 2 * i, d, r) for q, i, d, r in brute_force(x[::2], x[:30], 3)]
    assert hits(found) == sorted(want)
    first, further = ([(r.query_id, r.distance) for r in df.collect()] for df in seen)
    reach = {q: sorted(d for p, d in first if p == q)[2] for q in range(30)}
    assert further and all(d <= reach[q] + 1e-9 for q, d in further)


def test_bounds_of_queries_keep_ties_and_all_rows_within(spark):
    vectors = spark.createDataFrame([(i, [float(i // 2)], 0) for i in range(40)], "id long, embedding array<float>, cell int")
    wanted = [(0, [0.0], 0, 4.0), (1, [0.0], 0, None), (2, [0.5], 0, 0.0)]
    probes = spark.createDataFrame(wanted, "query_id int, query_vector array<double>, cell int, reach double")
    found = block_topk(vectors, probes, 7, group_cols=["cell"], within_col="reach", block_vectors=5)
    near = [(0, i, float((i // 2) ** 2), i + 1) for i in range(6)]
    assert [h for h in hits(found) if h[0] != 1 and h[2] <= 4.0] == near
    assert [h[1] for h in hits(found) if h[0] == 1] == list(range(7))


@pytest.mark.parametrize("k", [1, 4, 100])
@pytest.mark.parametrize("texts", [False, True])
def test_running_top_k_merges_all_queries_of_a_batch(k, texts):
    rng = np.random.default_rng(8)
    d = rng.integers(0, 9, (50, 6)).astype(float)
    d[rng.random(d.shape) < 0.05] = np.nan
    ids = np.array([f"{'x' * (i // 7)}{i:02}" for i in range(50)]) if texts else np.arange(50)
    best = scan.RunningTopK(6, k)
    for at in np.array_split(rng.permutation(50), 7):
        for j in (np.array([0, 2, 5]), np.array([4, 1])):
            best.add(ids[at], d[np.ix_(at, j)], 0.0, None, j)
    want = []
    for j in (0, 1, 2, 4, 5):
        known = np.flatnonzero(np.isfinite(d[:, j]))
        want += [(j, ids[i], d[i, j]) for i in known[np.lexsort((ids[known], d[known, j]))][:k]]
    assert list(zip(*best.rows(), strict=True)) == want
