"""Result reuse with expiry: the cut-up time line agrees with a plain replay."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecspark.operators import reuse

START = datetime(2024, 1, 1)


def log(spark, rows):
    data = [(i, key, START + timedelta(seconds=float(t))) for i, (key, t) in enumerate(rows)]
    return spark.createDataFrame(data, "id bigint, key string, ts timestamp_ntz")


def plain_replay(rows, ttl):
    expiry, hit = {}, {}
    for i, (key, t) in sorted(enumerate(rows), key=lambda r: (r[1][1], r[0])):
        hit[i] = key is not None and t < expiry.get(key, -1)
        if not hit[i]:
            expiry[key] = t + ttl
    return hit


def replay(df, ttl, **options):
    found = reuse.replay_ttl(df, "key", "ts", "id", ttl, **options)
    return {r.id: r.cache_hit for r in found.collect()}


@pytest.mark.parametrize("hot", [100, 0])
def test_expiry_counts_from_the_fill(spark, hot):
    rows = [("a", t) for t in (0, 299, 300, 301, 599, 601)]
    hits = replay(log(spark, rows), 300, hot_instants=hot)
    assert [hits[i] for i in range(6)] == [False, True, False, True, True, False]


@pytest.mark.parametrize("density", [400, 6_000])
def test_chunks_agree_with_plain_replay(spark, density):
    rng = np.random.default_rng(density)
    rows = [("hot", int(t)) for t in rng.integers(0, density, 900)]
    rows += [(f"k{rng.integers(5)}", int(t)) for t in rng.integers(0, density, 300)]
    rows += [(None, 5), (None, 6), (None, 300)]
    df = log(spark, rows)
    expected = plain_replay(rows, 37)
    assert replay(df, 37) == expected
    for options in (
        dict(hot_instants=100, chunk_ttls=2, fan=4),
        dict(hot_instants=0, chunk_ttls=5, fan=64),
    ):
        assert replay(df, 37, **options) == expected, options


def test_both_timestamp_kinds_agree(spark):
    df = log(spark, [("a", 0.25), ("a", 10.1), ("a", 10.3)])
    expected = {0: False, 1: True, 2: False}
    assert replay(df, 10, hot_instants=0) == expected
    assert replay(df.withColumn("ts", F.col("ts").cast("timestamp")), 10) == expected


def test_lookup_uses_the_newest_live_result(spark):
    requests = log(spark, [("a", 100), ("a", 400), ("b", 100), ("c", 299), ("c", 300)])
    stored = spark.createDataFrame(
        [("a", START - timedelta(days=1)), ("a", START + timedelta(seconds=50)), ("c", START)],
        "key string, filled_at timestamp_ntz",
    )
    found = reuse.reuse_results(requests, stored, "key", "ts")
    assert {r.id: r.cache_hit for r in found.collect()} == {
        0: True, 1: False, 2: False, 3: True, 4: False,
    }
    waiting = {r.key: r.waiting_requests for r in reuse.to_compute(found, "key").collect()}
    assert waiting == {"a": 1, "b": 1, "c": 1}
