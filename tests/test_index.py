"""Inverted-file and product-quantised indexes on clustered vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_support import brute_force, clustered, hits, plan_of, query_frame, vector_frame
from vecspark.catalog import codes as codes_catalog
from vecspark.catalog import vectors as vectors_catalog
from vecspark.operators import evaluate, index_admin, ivf, knn, pq
from vecspark.plans.index import build_index
from vecspark.sources import index_store, workspace

NLIST = 20


@pytest.fixture(scope="module")
def index(spark):
    x, label = clustered()
    q = clustered(n=2010)[0][2000:]
    vectors = vector_frame(spark, x, label=[int(v) % 3 for v in label]).repartition(4).cache()
    queries = query_frame(spark, q).cache()
    centroids = ivf.train_centroids(vectors, NLIST)
    postings = ivf.assign_cells(vectors, centroids).cache()
    return x, q, vectors, queries, centroids, postings


def recall(exact, found):
    exact_ids = {(q, i) for q, i, *_ in exact}
    return len(exact_ids & {(q, i) for q, i, *_ in found}) / len(exact_ids)


def test_every_vector_is_in_its_nearest_cell_once(index):
    x, _, _, _, centroids, postings = index
    cells, matrix = ivf.model_matrix(centroids)
    rows = postings.select("id", "cell", "cell_distance").collect()
    assert sorted(r.id for r in rows) == list(range(len(x)))
    d = ((x[:, None, :].astype(float) - matrix[None]) ** 2).sum(axis=2)
    assert all(r.cell == cells[d[r.id].argmin()] for r in rows)
    assert all(abs(r.cell_distance - d[r.id].min()) < 1e-9 for r in rows)


def test_full_probe_is_exact_and_recall_grows(index):
    x, q, _, queries, centroids, postings = index
    exact = brute_force(x, q, 10)
    seen = [
        recall(exact, hits(ivf.ivf_flat_search(postings, centroids, queries, 10, n)))
        for n in (1, 4, NLIST)
    ]
    assert seen == sorted(seen) and seen[0] > 0.5
    assert hits(ivf.ivf_flat_search(postings, centroids, queries, 10, NLIST)) == exact
    parts = dict(max_broadcast_bytes=400)
    few = hits(ivf.ivf_flat_search(postings, centroids, queries, 10, 4))
    assert few == hits(ivf.ivf_flat_search(postings, centroids, queries, 10, 4, **parts))


def test_nprobe_per_query(index):
    x, q, _, queries, centroids, postings = index
    mixed = queries.withColumn("nprobe", F.when(F.col("query_id") == 0, NLIST).otherwise(1))
    found = hits(ivf.ivf_flat_search(postings, centroids, mixed, 10, "nprobe"))
    assert [h for h in found if h[0] == 0] == brute_force(x, q[:1], 10)
    probed = ivf.probe_cells(mixed, centroids, "nprobe").collect()
    assert {r.query_id: len(r.cells) for r in probed} == {i: NLIST if i == 0 else 1 for i in range(10)}


def test_pq_parameters():
    with pytest.raises(ValueError, match="divisible"):
        pq.check_parameters(64, 7, 8)
    with pytest.raises(ValueError, match="nbits"):
        pq.check_parameters(64, 8, 9)


def test_pq_distances_and_rerank(spark, index):
    x, q, vectors, queries, centroids, postings = index
    codebooks = pq.train_codebooks(postings, centroids, m=8, nbits=6, iterations=6)
    codes = pq.pq_encode(postings, centroids, codebooks)
    assert {r[0] for r in codes.select(F.length("codes")).collect()} == {8}

    # The looked-up distance is the distance to the decoded vector.
    cells, matrix = ivf.model_matrix(centroids)
    books = pq.codebook_array(codebooks)
    found = pq.ivfpq_search(codes, centroids, codebooks, queries, 10, NLIST)
    decoded = {}
    for r in codes.select("id", "cell", "codes").collect():
        residual = np.concatenate([books[s, c] for s, c in enumerate(r.codes)])
        decoded[r.id] = matrix[np.searchsorted(cells, r.cell)] + residual
    everything = np.stack([decoded[i] for i in range(len(x))])
    approximate = brute_force(everything, q, 10)
    assert [(a, b, r) for a, b, _, r in hits(found)] == [(a, b, r) for a, b, _, r in approximate]

    exact = brute_force(x, q, 10)
    wide = pq.ivfpq_search(codes, centroids, codebooks, queries, 100, NLIST)
    better = hits(pq.rerank(wide, vectors, queries, 10))
    assert recall(exact, hits(found)) <= recall(exact, better)
    assert recall(exact, better) > 0.9
    every = pq.ivfpq_search(codes, centroids, codebooks, queries, len(x), NLIST)
    assert hits(pq.rerank(every, vectors, queries, 10)) == exact


def test_training_sample_bounds(spark):
    vectors = spark.range(20_000)
    sample, total = ivf.training_sample(vectors, "id", 2_000)
    assert total == 20_000 and 1_700 < sample.count() < 2_300
    assert ivf.training_sample(vectors, "id", 20_000)[0].count() == 20_000


def test_few_training_vectors_warn(spark):
    with pytest.warns(UserWarning, match="advised"):
        ivf.train_centroids(vector_frame(spark, np.eye(8)), 4)


def test_smoke_finds_itself(index):
    *_, centroids, postings = index
    smoke = index_admin.smoke_test(postings, centroids).collect()
    assert len(smoke) == 5
    assert all(r.found_itself and r.n_hits == 10 and r.nearest_distance == 0 for r in smoke)


def test_recall_and_sweep(spark, index):
    x, q, vectors, queries, centroids, postings = index
    exact = knn.exact_knn(vectors, queries, 10)
    sweep = evaluate.sweep_nprobe(postings, centroids, queries, exact, 10, [1, 5, NLIST])
    rows = {r.nprobe: r for r in sweep.collect()}
    assert rows[NLIST].recall == 1.0 and rows[NLIST].scanned_fraction == 1.0
    assert rows[1].recall <= rows[5].recall <= 1.0 and rows[1].scanned_fraction < 0.5
    nothing = exact.filter(F.lit(False))
    assert {r.recall for r in evaluate.recall_at_k(exact, nothing, ["query_id"], "id").collect()} == {0.0}


def test_index_info_and_refresh(spark, index):
    x, _, vectors, _, centroids, postings = index
    sharded = postings.withColumn("shard_key", F.col("label").cast("string"))
    info = {r.shard_key: r for r in index_admin.index_info(sharded, NLIST).collect()}
    assert sum(r.total_vectors for r in info.values()) == len(x)
    assert {r.dimension for r in info.values()} == {32}
    one = index_admin.index_info(sharded, NLIST, shard="1").collect()
    assert [r.shard_key for r in one] == ["1"]
    assert index_admin.index_info(sharded, NLIST, shard="ALL").count() == 3

    changed = vectors.filter("id < 50").withColumn("embedding", F.reverse("embedding"))
    added = changed.withColumn("id", F.col("id") + 10_000)
    removed = vectors.filter("id between 60 and 69")
    after = index_admin.refresh_postings(
        postings, changed.unionByName(added), centroids, deleted=removed
    )
    rebuilt = ivf.assign_cells(
        vectors.filter("id >= 50 and id not between 60 and 69").unionByName(changed).unionByName(added),
        centroids,
    )
    key = ["id", "cell"]
    assert sorted(map(tuple, after.select(key).collect())) == sorted(map(tuple, rebuilt.select(key).collect()))
    moved = index_admin.drift(postings, after)
    assert moved.agg(F.sum("n_after")).first()[0] == len(x) + 50 - 10


def test_index_store_versions_and_shards(spark, index):
    x, q, vectors, queries, centroids, postings = index
    path = workspace.new_path(spark, "index")
    with pytest.raises(FileNotFoundError):
        index_store.load_index(spark, path)
    sharded = postings.withColumn("shard_key", F.format_string("%02d", "label"))
    assert index_store.save_index(path, centroids, sharded) == 1
    smaller = sharded.filter("id < 100")
    first = index_store.load_index(spark, path)
    assert index_store.save_index(path, centroids, smaller) == 2
    assert first.postings.count() == len(x)
    latest = index_store.load_index(spark, path)
    assert (latest.version, latest.dim, latest.shards) == (2, 32, ["00", "01", "02"])
    assert latest.postings.count() == 100
    assert index_store.load_index(spark, path, version=1).postings.count() == len(x)
    one = index_store.load_index(spark, path, version=1, shard="01")
    assert one.postings.count() == sum(1 for r in sharded.filter("shard_key = '01'").collect())
    described = {r.shard_key: r for r in index_store.describe_index(first).collect()}
    assert sorted(described) == ["00", "01", "02"]
    assert sum(r.total_vectors for r in described.values()) == len(x)
    assert {(r.index_type, r.dimension, r.is_trained) for r in described.values()} == {
        (f"IVF{NLIST},Flat", 32, True)
    }
    assert all(r.index_size_bytes > 0 and "shard_key=" in r.index_path for r in described.values())
    with pytest.raises(index_store.UnknownShardError, match="available"):
        index_store.load_index(spark, path, shard="nope")

    pruned = first.postings.filter((F.col("shard_key") == "01") & (F.col("cell") == 3))
    plan = plan_of(pruned)
    assert "shard_key" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "EqualTo(cell,3)" in plan
    wanted = queries.withColumn("shards", F.array(F.lit("00"), F.lit("02")))
    found = hits(
        ivf.ivf_flat_search(first.postings, centroids, wanted, 10, NLIST, shards_col="shards")
    )
    ids = np.array([r.id for r in vectors.filter("label <> 1").orderBy("id").collect()])
    expected = [(a, int(ids[b]), d, r) for a, b, d, r in brute_force(x[ids], q, 10)]
    assert found == sorted(expected)


def test_build_index_end_to_end(spark):
    x, _ = clustered(n=900)
    x[5] = 0
    path = workspace.new_path(spark, "built")
    build_index(vector_frame(spark, x), path, 32, nlist=8, m=4, nbits=4, normalize=True)
    stored = index_store.load_index(spark, path)
    assert stored.normalized and stored.codebooks is not None
    assert stored.postings.count() == 899
    with pytest.raises(ValueError, match="divisible"):
        build_index(vector_frame(spark, x), path, 32, nlist=8, m=5)


def test_each_stage_of_the_codes_runs_python_once(spark):
    """A step that is chained to others keeps a Python process of its own per running task."""
    folder = "/root/testdata/sf0.001"
    for build in (vectors_catalog._trained_codes, codes_catalog.fixed_codes):
        _, centroids, codebooks, codes = build(spark, folder)
        queries = vectors_catalog.label_queries(vectors_catalog.embeddings(spark, folder))
        found = pq.ivfpq_search(codes, centroids, codebooks, queries, 5, 2, id_col="vec_id")
        assert plan_of(found).count("MapInArrow") == 1
