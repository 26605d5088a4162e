"""Postings by balanced ranges of cells: whole, balanced, and read no further than probed."""

import random

import pytest
from pyspark.sql import functions as F

from vecspark.sources.cell_ranges import cell_directory, read_cells, read_directory, write_cell_ranges
from vecspark.sources.workspace import new_path

SCHEMA = "id long, cell int, shard_key string, embedding array<double>"


@pytest.fixture(scope="module")
def rows():
    """Twenty cells in two shards, one cell with a third of all rows."""
    rng = random.Random(2)
    cells = [7 if rng.random() < 1 / 3 else rng.randrange(20) for _ in range(1_200)]
    return [(i, c, rng.choice("ab"), [float(i)]) for i, c in enumerate(cells)]


@pytest.fixture(scope="module")
def path(spark, rows):
    path = new_path(spark, "ranges")
    write_cell_ranges(path, spark.createDataFrame(rows, SCHEMA), 100)
    return path


def files_read(df):
    df.collect()
    last_stage = df._jdf.queryExecution().executedPlan().executedPlan()
    leaves = last_stage.plan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return sum(s.metrics().apply("numFiles").value() for s in scans if "cell_range" in s.simpleString(1_000))


def test_ranges_are_balanced(spark, path, rows):
    found = read_directory(spark, path).collect()
    assert sum(r.n for r in found) == len(rows)
    for shard in "ab":
        before = 0
        for r in sorted((r for r in found if r.shard_key == shard), key=lambda r: r.cell):
            assert r.n == sum(1 for _, c, s, _ in rows if (c, s) == (r.cell, shard)) and r.cell_range == before // 100
            before += r.n


@pytest.mark.parametrize("wanted", [[3], [7, 7, 12], list(range(20)), [99], []])
def test_wanted_cells_come_once_and_whole(spark, path, rows, wanted):
    cells = spark.createDataFrame([(c,) for c in wanted], "cell int")
    found = read_cells(path, cells).collect()
    assert sorted((r.id, r.cell, r.shard_key) for r in found) == [(i, c, s) for i, c, s, _ in rows if c in wanted]


def test_files_read_grow_with_the_ranges_probed(spark, path):
    def files(*keys):
        return files_read(read_cells(path, spark.createDataFrame(keys, "cell int, shard_key string")))

    one, more, everything = files((3, "a")), files((3, "a"), (15, "b")), files(*[(c, s) for c in range(20) for s in "ab"])
    assert 0 < one < more < everything


def test_one_shard_and_no_rows(spark):
    path = new_path(spark, "ranges")
    frame = spark.createDataFrame([(1, 5, [0.0])], "id long, cell int, embedding array<double>")
    write_cell_ranges(path, frame, 1)
    assert [tuple(r) for r in read_cells(path, frame.select("cell")).select("id", "shard_key", "cell_range").collect()] == [(1, "all", 0)]
    assert not cell_directory(frame.withColumn("shard_key", F.lit("x")).limit(0), 5).collect()
    with pytest.raises(ValueError, match="at least"):
        cell_directory(frame, 0)
