"""Ingest, index and search composed."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vecspark.operators.embed import hash_embed
from vecspark.plans import ingest
from vecspark.plans.index import build_index, refresh_index
from vecspark.plans.search import search
from vecspark.sources.index_store import load_index
from vecspark.sources.workspace import new_path

DIM = 32


@pytest.fixture(scope="module")
def trips(spark):
    rows = [
        (i, 1 + i % 20, 1 + i % 13, 0.5 + i % 9, 3.0 + i % 17, datetime(2023, 1 + i % 2, 1 + i % 28))
        for i in range(400)
    ]
    rows += [(900, 1, 1, 0.0, 5.0, datetime(2023, 1, 1)), (901, 1, 1, 5.0, -1.0, datetime(2023, 1, 1))]
    return spark.createDataFrame(
        rows, "record_id bigint, PULocationID int, DOLocationID int, trip_distance double, "
        "fare_amount double, tpep_pickup_datetime timestamp_ntz",
    )


def test_ingest_replaces_only_its_months(spark, trips):
    path = new_path(spark, "trips")
    counts = ingest.ingest_trips(trips, path, datetime(2026, 1, 1), DIM)
    assert counts == {"loaded": 402, "kept": 400}
    table = spark.read.parquet(path)
    assert table.count() == 400
    assert tuple(ingest.audit_trips(trips).first()) == (402, 400, 2)
    assert {(r.pickup_year, r.pickup_month) for r in table.select("pickup_year", "pickup_month").collect()} == {
        (2023, 1), (2023, 2),
    }
    assert table.filter(F.size("embedding") != DIM).count() == 0
    january = trips.filter("record_id < 10 and month(tpep_pickup_datetime) = 1")
    ingest.ingest_trips(january, path, datetime(2026, 1, 2), DIM)
    again = spark.read.parquet(path)
    assert again.filter("pickup_month = 1").count() == 5
    assert again.filter("pickup_month = 2").count() == 200


def test_incremental_ingest_stamps_only_changes(spark):
    schema = "record_id int, v string, year_month string"
    path = new_path(spark, "table")
    first, second = datetime(2026, 1, 1), datetime(2026, 1, 2)
    rows = [(1, "a", "2023-01"), (2, "b", "2023-01")]
    ingest.incremental_ingest(spark.createDataFrame(rows, schema), path, first)
    feed = spark.createDataFrame([(1, "a", "2023-01"), (2, "B", "2023-01"), (3, "c", "2023-02")], schema)
    ingest.incremental_ingest(feed, path, second, skip_unchanged=True)
    table = spark.read.parquet(path)
    assert {r.record_id: (r.v, r.updated_at) for r in table.collect()} == {
        1: ("a", first), 2: ("B", second), 3: ("c", second),
    }


@pytest.mark.parametrize("m", [None, 4])
def test_search_answers_requests(spark, trips, m):
    embedded = ingest.embed_trips(trips, datetime(2026, 1, 1), DIM).cache()
    path = new_path(spark, "index")
    build_index(
        embedded, path, DIM, nlist=4, m=m, nbits=4, id_col="record_id", shard_col="year_month"
    )
    text = embedded.filter("record_id = 7").first()
    requests = spark.createDataFrame(
        [
            (1, text.text_repr, 5, text.year_month, 256, 1, 3),
            (2, f"  {text.text_repr.upper()} ", 5, text.year_month, 256, 2, 3),
            (3, "", 5, None, None, 1, 10),
            (4, text.text_repr, 5, "2031-01", None, 1, 10),
            (5, "far away", 20, " ", None, 1, 10),
        ],
        "request_id int, query string, top_k int, shard_key string, nprobe int, page int, page_size int",
    )
    index, asked_at = load_index(spark, path), datetime(2026, 1, 1)
    asked = []

    def embed_queries(df, column):
        asked.append(df.count())
        return hash_embed(df, column, DIM)

    def run(**reuse):
        return search(
            requests, index, embed_queries, default_shard="2023-01", source=embedded,
            metadata_cols=["PULocationID"], id_col="record_id", **reuse,
        )

    answer = run(asked_at=asked_at)
    assert [r.request_id for r in answer.rejected.collect()] == [3]
    assert [r.request_id for r in answer.unknown_shards.collect()] == [4]
    hits = answer.hits.collect()
    assert len({r.result_key for r in hits}) == 2 and len(hits) == 25
    best = min((r for r in hits if r.result_key.startswith(_key(answer, 1))), key=lambda r: r["rank"])
    if m is None:
        assert best.distance == pytest.approx(0, abs=1e-6)
    else:
        exact = run(asked_at=asked_at, rerank_factor=100).hits.filter(F.col("rank") == 1)
        first = exact.filter(F.col("result_key") == best.result_key).first()
        assert first.distance == pytest.approx(0, abs=1e-6)
        asked.pop()
    pages = {}
    for r in answer.pages.collect():
        pages.setdefault(r.request_id, []).append((r["rank"], r.total_results, r.has_next))
    assert sorted(pages[1]) == [(1, 5, True), (2, 5, True), (3, 5, True)]
    assert sorted(pages[2]) == [(4, 5, False), (5, 5, False)]
    assert len(pages[5]) == 10 and pages[5][0][1:] == (20, True)
    assert set(pages) == {1, 2, 5}

    # Within its lifetime a stored result is used again, afterwards it is not.
    stored = answer.hits
    again = run(stored=stored, asked_at=asked_at + timedelta(seconds=299))
    assert sorted(map(str, again.pages.collect())) == sorted(map(str, answer.pages.collect()))
    late = run(stored=stored, asked_at=asked_at + timedelta(seconds=300))
    assert late.hits.count() == 25 and asked == [2, 0, 2]


    # Of two stored fills the newer one is used, and only once.
    older = stored.withColumn("filled_at", F.col("filled_at") - F.expr("INTERVAL 10 SECONDS"))
    twice = run(stored=stored.unionByName(older), asked_at=asked_at + timedelta(seconds=100))
    assert sorted(map(str, twice.pages.collect())) == sorted(map(str, answer.pages.collect()))
    assert {(r.request_id, r.cache_hit) for r in twice.answered.collect()} == {(1, True), (2, True), (5, True)}
    assert {(r.request_id, r.cache_hit) for r in answer.answered.collect()} == {(1, False), (2, False), (5, False)}


def test_no_request_vanishes(spark, trips):
    embedded = ingest.embed_trips(trips, datetime(2026, 1, 1), DIM)
    path = new_path(spark, "index")
    build_index(embedded, path, DIM, nlist=4, m=None, id_col="record_id", shard_col="year_month")
    requests = spark.createDataFrame(
        [(1, "good", 3, None, None, 1, 3), (2, "short", 3, None, None, 1, 3), (3, "bad", 3, None, None, 1, 3)],
        "request_id int, query string, top_k int, shard_key string, nprobe int, page int, page_size int",
    )

    def embed_queries(df, column):
        found = hash_embed(df, column, DIM)
        short = F.when(F.col(column) == "short", F.slice("embedding", 1, 3)).otherwise(F.col("embedding"))
        status = F.when(F.col(column) == "bad", "failed").otherwise(F.col("embed_status"))
        return found.withColumns({"embedding": short, "embed_status": status})

    index = load_index(spark, path)
    answer = search(requests, index, embed_queries, default_shard="2023-01", id_col="record_id")
    assert {r.request_id: r.reasons for r in answer.rejected.collect()} == {
        2: [f"dimension 3 is not {DIM}"], 3: ["embedding failed"],
    }
    assert {r.request_id for r in answer.pages.collect()} == {1}


@pytest.mark.parametrize("m", [None, 4])
def test_refresh_publishes_a_new_version(spark, trips, m):
    embedded = ingest.embed_trips(trips, datetime(2026, 1, 1), DIM).cache()
    path = new_path(spark, "index")
    names = dict(id_col="record_id", shard_col="year_month")
    build_index(embedded, path, DIM, nlist=4, m=m, nbits=4, **names)
    old = load_index(spark, path)
    changed = embedded.filter("record_id < 5")
    assert refresh_index(changed, path, nbits=4, deleted=embedded.filter("record_id = 9"), **names) == 2
    new = load_index(spark, path)
    assert (old.version, new.version) == (1, 2) and old.postings.count() == 400
    assert new.postings.count() == 399 and new.postings.columns == old.postings.columns
    column = "embedding" if m is None else "codes"
    same = old.postings.join(new.postings, ["record_id", "cell", column, "shard_key"])
    assert same.count() == 399


def _key(answer, request_id):
    return answer.pages.filter(F.col("request_id") == request_id).first().result_key
