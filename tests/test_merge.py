"""Upserts, change logs and reads as of a version."""

import os

import pytest
from pyspark.sql import functions as F

from vecspark.operators import merge as mg
from vecspark.sources.workspace import new_path

SCHEMA = "id int, v string, m string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def test_merge_cases(spark, rows_of):
    target = frame(spark, [(1, "a", "x"), (2, "b", "x"), (None, "n", "x")])
    feed = frame(spark, [(2, "B", "y"), (3, "c", "x"), (None, "N", "x")])
    merged = sorted(map(str, map(tuple, mg.merge(target, feed, ["id"]).collect())))
    assert merged == sorted(
        map(str, [(1, "a", "x"), (2, "B", "y"), (3, "c", "x"), (None, "n", "x"), (None, "N", "x")])
    )
    empty = frame(spark, [])
    good = target.filter("id is not null")
    assert rows_of(mg.merge(good, empty, ["id"])) == rows_of(good)
    assert rows_of(mg.merge(empty, good, ["id"])) == rows_of(good)
    assert rows_of(mg.merge(good, good, ["id"])) == rows_of(good)


def test_extra_columns(spark):
    target = frame(spark, [(1, "a", "x")])
    feed = frame(spark, [(2, "b", "x", 5)], SCHEMA + ", extra int")
    assert mg.merge(target, feed, ["id"]).columns == ["id", "v", "m"]
    evolved = mg.merge(target, feed, ["id"], evolve_schema=True)
    assert {r.id: r.extra for r in evolved.collect()} == {1: None, 2: 5}


def test_skip_unchanged_and_classify(spark):
    target = frame(spark, [(1, "a", "old"), (2, None, "old"), (3, "c", "old")])
    feed = frame(spark, [(1, "a", "new"), (2, None, "new"), (3, "C", "new"), (4, "d", "new")])
    merged = mg.merge(target, feed, ["id"], skip_unchanged=True, ignore=["m"])
    assert {r.id: r.m for r in merged.collect()} == {1: "old", 2: "old", 3: "new", 4: "new"}
    ops = mg.classify_changes(target, feed, ["id"], ignore=["m"])
    assert {r.id: r.op for r in ops.collect()} == {
        1: "unchanged", 2: "unchanged", 3: "update", 4: "insert",
    }


def test_duplicate_keys(spark):
    feed = frame(spark, [(1, "a", "x"), (1, "b", "x"), (None, "n", "x"), (None, "n", "x")])
    assert [tuple(r) for r in mg.duplicate_keys(feed, ["id"]).collect()] == [(1, 2)]
    with pytest.raises(mg.DuplicateKeyError):
        mg.upsert_table(new_path(spark, "dup"), feed, ["id"], ["m"])
    mg.require_unique_keys(feed.filter("v <> 'b'"), ["id"])


def test_upsert_table_moves_rows_between_partitions(spark, rows_of):
    path = new_path(spark, "table")

    def read():
        return rows_of(spark.read.schema(SCHEMA).parquet(path))

    first = frame(spark, [(1, "a", "2023-01"), (2, "b", "2023-02"), (3, "c", "2023-03")])
    mg.upsert_table(path, first, ["id"], ["m"])
    assert read() == rows_of(first)
    feed = frame(spark, [(2, "B", "2023-03"), (4, "d", "2023-04")])
    expected = [(1, "a", "2023-01"), (2, "B", "2023-03"), (3, "c", "2023-03"), (4, "d", "2023-04")]
    for _ in range(2):
        mg.upsert_table(path, feed, ["id"], ["m"])
        assert read() == expected
    mg.upsert_table(path, frame(spark, []), ["id"], ["m"])
    assert read() == expected
    copies = frame(spark, [(4, "e", "2023-04"), (4, "f", "2023-04")])
    mg.upsert_table(path, copies, ["id"], ["m"], latest_by=["v"])
    assert read()[-1] == (4, "f", "2023-04")


def test_upsert_leaves_untouched_partitions_alone(spark):
    path = new_path(spark, "table")
    mg.upsert_table(path, frame(spark, [(1, "a", "01"), (2, "b", "02")]), ["id"], ["m"])
    table = spark.read.schema(SCHEMA).parquet(path)

    def file_of(month):
        return table.filter(F.col("m") == month).select("_metadata.file_path").first()[0]

    before = file_of("01")
    mg.upsert_table(path, frame(spark, [(2, "z", "02")]), ["id"], ["m"])
    table = spark.read.schema(SCHEMA).parquet(path)
    assert file_of("01") == before


def test_latest_per_key_keeps_null_values(spark, rows_of):
    df = frame(spark, [(1, "a", "1"), (1, None, "2"), (2, "b", "1")])
    assert rows_of(mg.latest_per_key(df, ["id"], ["m"])) == [(1, None, "2"), (2, "b", "1")]


def test_versions(spark, rows_of):
    log = spark.createDataFrame(
        [(1, "a", "insert", 1, "t1"), (2, "b", "insert", 1, "t1"), (1, "A", "update", 2, "t2"),
         (2, "b", "delete", 2, "t2"), (2, "bb", "insert", 3, "t3"), (3, "c", "insert", 3, "t3")],
        "id int, v string, op string, version int, committed_at string",
    )

    def state(version):
        return rows_of(mg.as_of_version(log, ["id"], version).select("id", "v"))

    assert state(1) == [(1, "a"), (2, "b")]
    assert state(2) == [(1, "A")]
    assert state(3) == [(1, "A"), (2, "bb"), (3, "c")]
    history = [tuple(r) for r in mg.version_history(log).collect()]
    assert history == [(3, "t3", 2, 0, 0, "WRITE"), (2, "t2", 0, 1, 1, "MERGE")]


def test_upsert_keeps_the_tables_own_columns(spark):
    path = new_path(spark, "table")
    wide = "id int, v string, keep int, m string"
    mg.upsert_table(path, frame(spark, [(1, "a", 7, "01"), (2, "b", 8, "01")], wide), ["id"], ["m"])
    counts = mg.upsert_table(path, frame(spark, [(2, "B", "01"), (3, "c", "01")]), ["id"], ["m"])
    assert counts == {"inserted": 1, "updated": 1, "unchanged": 0}

    def rows():
        found = mg.stored_table(spark, path, ["m"], frame(spark, []))
        return found.columns, {r.id: tuple(r) for r in found.collect()}

    assert rows() == (
        ["id", "v", "keep", "m"], {1: (1, "a", 7, "01"), 2: (2, "B", 8, "01"), 3: (3, "c", None, "01")},
    )
    more = frame(spark, [(3, "C", 5, "01")], "id int, v string, extra int, m string")
    mg.upsert_table(path, more, ["id"], ["m"])
    assert rows()[0] == ["id", "v", "keep", "m"]
    mg.upsert_table(path, more, ["id"], ["m"], evolve_schema=True)
    columns, found = rows()
    assert set(columns) == {"id", "v", "keep", "extra", "m"} and len(found) == 3
    with pytest.raises(ValueError):
        mg.upsert_table(path, frame(spark, [(1, "x")], "id int, v string"), ["id"], ["m"])


def test_upsert_of_thousands_of_partitions(spark):
    path = new_path(spark, "table")
    rows = [(i, f"v{i}", 2000 + i // 336, i // 28 % 12 + 1, i % 28 + 1) for i in range(600)]
    schema = "id int, v string, y int, mon int, d int"
    mg.upsert_table(path, frame(spark, rows, schema), ["id"], ["y", "mon", "d"])
    counts = mg.upsert_table(path, frame(spark, rows, schema), ["id"], ["y", "mon", "d"], fixed_partitions=True)
    assert counts == {"inserted": 0, "updated": 0, "unchanged": 600}
    many = mg._partition_key(["y", "mon", "d"]).isin([f"{i}" for i in range(5_000)])
    assert spark.read.parquet(path).filter(many).isEmpty()


def test_upsert_leaves_no_copies_and_writes_a_log(spark):
    path, log = new_path(spark, "table"), new_path(spark, "log")
    folder = path.rsplit("/", 1)[0]
    before = set(os.listdir(folder))
    for rows in ([(1, "a", "x"), (2, "b", "x")], [(2, "B", "x"), (3, "c", "y")], [(3, "c", "y")]):
        mg.upsert_table(path, frame(spark, rows), ["id"], ["m"], change_log=log)
    assert {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before} == {"table", "log"}
    changes = mg.read_change_log(spark, log)
    history = [tuple(r)[0:1] + tuple(r)[2:] for r in mg.version_history(changes).collect()]
    assert history == [(2, 1, 1, 0, "MERGE"), (1, 2, 0, 0, "WRITE")]
    assert {r.id: r.v for r in mg.as_of_version(changes, ["id"], 1).collect()} == {1: "a", 2: "b"}
