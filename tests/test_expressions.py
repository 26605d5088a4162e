"""Text, request and vector expressions, and the row filters."""

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vecspark.functions import requests as rq
from vecspark.functions import text as tx
from vecspark.functions import vectors as vc
from vecspark.operators import clean


def values(spark, cases, schema, column):
    return [r[0] for r in spark.createDataFrame(cases, schema).select(column).collect()]


def test_strip_and_blank(spark):
    cases = [(None,), ("",), ("\t\n ",), (" a b\t",), (" x　",)]
    assert values(spark, cases, "s string", tx.strip("s")) == [None, "", "", "a b", "x"]
    assert values(spark, cases, "s string", tx.is_blank("s")) == [True, True, True, False, False]


def test_truncate_counts_code_points(spark):
    cases = [("a" * 512,), ("b" * 513,), ("😀" * 600,)]
    lengths = values(spark, cases, "s string", F.length(tx.truncate("s")))
    assert lengths == [512, 512, 512]


def test_phrase_skips_null(spark):
    phrase = tx.trip_phrase("o", "d", "m", "f")
    cases = [(1, 2, 2.5, 15.0), (None, 2, 2.5, 15.0)]
    assert values(spark, cases, "o int, d int, m double, f double", phrase) == [
        "taxi ride manhattan 1 to 2 distance 2.5 miles fare 15.0 dollars",
        "taxi ride manhattan to 2 distance 2.5 miles fare 15.0 dollars",
    ]


def test_sentence_defaults_and_plural(spark):
    cases = [(4, 7, 1.5, 9.25, 2), (None, None, None, None, None)]
    schema = "o int, d int, m double, f double, n int"
    assert values(spark, cases, schema, tx.trip_sentence("o", "d", "m", "f", "n")) == [
        "Yellow taxi trip from zone 4 to zone 7, 1.5 miles, $9.25 fare, 2 passengers",
        "Yellow taxi trip from zone 0 to zone 0, 0.0 miles, $0.00 fare, 1 passenger",
    ]
    absent = tx.trip_sentence(None, None, None, None, None)
    assert "zone 0, 0.0 miles" in values(spark, cases[:1], schema, absent)[0]


@pytest.mark.parametrize(
    "request_, expected",
    [
        (("ok", 10, None, 10, 1), []),
        (("", 10, None, 10, 1), ["query_required"]),
        (("  \t", 10, None, 10, 1), ["query_required"]),
        ((None, 10, None, 10, 1), ["query_required"]),
        (("x" * 2000, 1, 1, 1, 1), []),
        (("x" * 2001, 10, None, 10, 1), ["query_too_long"]),
        (("ok", 0, None, 10, 1), ["top_k_range"]),
        (("ok", 100, 256, 100, 1), []),
        (("ok", 101, 257, 101, 0), ["top_k_range", "nprobe_range", "page_size_range", "page_range"]),
        (("ok", 10, 0, 10, 1), ["nprobe_range"]),
    ],
)
def test_request_limits(spark, request_, expected):
    schema = "q string, k int, n int, s int, p int"
    reasons = rq.rejection_reasons("q", "k", "n", "s", "p")
    assert values(spark, [request_], schema, reasons) == [expected]


def test_defaults(spark):
    cases = [(None, None), (" \t", 0), ("2023-01", 3), ("x", -1)]
    shard = rq.shard_or_default(F.col("s"), "base")
    assert values(spark, cases, "s string, n int", shard) == ["base", "base", "2023-01", "x"]
    nprobe = rq.positive_or_default(F.col("n"), 10)
    assert values(spark, cases, "s string, n int", nprobe) == [10, 10, 3, 10]


def test_adaptive_nprobe(spark):
    cases = [("exploratory", None), ("high_precision", None), ("other", None), ("exploratory", 7)]
    nprobe = rq.adaptive_nprobe(F.col("c"), F.col("n"))
    assert values(spark, cases, "c string, n int", nprobe) == [5, 20, 10, 7]


def test_fingerprint(spark):
    cases = [(" Hello World ", 10, "shard1"), ("hello world", 10, "shard1"), ("hello", 10, "shard1")]
    found = values(
        spark, cases, "q string, k int, s string",
        rq.fingerprint(F.col("q"), F.col("k"), F.col("s")),
    )
    expected = hashlib.sha256(b"hello world|10|shard1").hexdigest()[:16].upper()
    assert found[0] == found[1] == expected != found[2]


def test_metadata_map(spark):
    cases = [('{"a": 1, "b": "x"}',), (None,), ("",), ("nonsense",)]
    found = values(spark, cases, "j string", rq.parse_metadata(F.col("j")))
    assert found[:2] == [{"a": "1", "b": "x"}, {}]
    assert all(not (m or {}).get("a") for m in found[2:])


def test_vector_expressions(spark):
    df = spark.createDataFrame(
        [([3.0, 4.0], [0.0, 0.0]), ([1.0, 0.0], [0.0, 2.0])], "a array<float>, b array<float>"
    )
    row = df.select(
        vc.squared_l2("a", "b").alias("d"), vc.l2_norm("a").alias("n"),
        vc.cosine_similarity("a", "b").alias("c"), vc.l2_normalize("b").alias("u"),
    ).collect()
    assert (row[0].d, row[0].n, row[0].c, row[0].u) == (25.0, 5.0, None, [0.0, 0.0])
    assert (row[1].d, row[1].c, row[1].u) == (5.0, 0.0, [0.0, 1.0])


def test_dimension_split(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(1, [1.0, 2.0]), (2, None), (3, []), (4, [1.0]), (5, [nan, 1.0]), (6, [0.0, 0.0]), (7, [None, 1.0])],
        "id int, v array<float>",
    )
    good, bad = clean.split_by_dimension(df, "v", 2)
    assert sorted(r.id for r in good.collect()) == [1, 6]
    assert {r.id: r.reason for r in bad.collect()} == {
        2: "missing", 3: "wrong_dimension", 4: "wrong_dimension", 5: "not_a_number", 7: "not_a_number",
    }
    assert [r.id for r in clean.indexable(df, "v", 2).collect()] == [1]


def test_trip_filters(spark):
    df = spark.createDataFrame(
        [(1, 5.0, 1.0, 1), (2, 0.0, 1.0, 1), (3, 5.0, 100.0, 1), (4, None, 1.0, 1), (5, 2.5, 0.1, 6),
         (6, 3.0, 0.2, 6), (7, 3.0, 0.2, 7)],
        "id int, fare double, miles double, riders int",
    )
    clean_ids = [r.id for r in clean.clean_trips(df, "fare", "miles", ["id"]).collect()]
    assert clean_ids == [1, 5, 6, 7]
    assert [r.id for r in clean.valid_trips(df, "fare", "miles", "riders").collect()] == [1, 3, 6]


def test_provenance_is_constant(spark):
    df = clean.add_provenance(spark.range(3), datetime(2026, 1, 2, 3, 4, 5), "m", 8)
    assert {tuple(r[1:]) for r in df.collect()} == {(datetime(2026, 1, 2, 3, 4, 5), "m", 8)}
