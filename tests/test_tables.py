"""Scans, samples, layouts and plan shapes."""

from pyspark.sql import functions as F

from tests_support import plan_of
from vecspark.sources import tables, workspace


def test_seeded_sample_is_exact_and_repeatable(spark):
    df = spark.range(5000).withColumn("x", F.col("id") * 2)
    first = tables.seeded_sample(df, "id", 100, 7)
    again = tables.seeded_sample(df.repartition(5), "id", 100, 7)
    ids = sorted(r.id for r in first.collect())
    assert len(ids) == 100 and ids == sorted(r.id for r in again.collect())
    assert tables.seeded_sample(df, "id", 9999, 7).count() == 5000
    other = tables.seeded_sample(df, "id", 100, 8)
    assert ids != sorted(r.id for r in other.collect())


def test_row_audit_counts_null_as_dropped(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    assert tuple(tables.row_audit(df, F.col("x") > 0).first()) == (3, 1, 2)


def test_partitioned_overwrite_keeps_other_months(spark):
    path = workspace.new_path(spark, "months")
    df = spark.createDataFrame([(1, "01"), (2, "02")], "id int, m string")
    tables.write_partitioned(df, path, ["m"])
    tables.write_partitioned(df.filter("m = '02'").withColumn("id", F.lit(9)), path, ["m"])
    found = tables.read_partitioned(spark, path, ["m"])
    assert sorted(map(tuple, found.collect())) == [(1, "01"), (9, "02")]
    tables.write_partitioned(df.filter("m = '02'"), path, ["m"], mode="append")
    assert found.sparkSession.read.parquet(path).count() == 3
    assert "PartitionFilters: [isnotnull(m" in plan_of(found.filter("m = '01'"))
    catalog = tables.shard_catalog(spark, path, "m")
    assert sorted(map(tuple, catalog.collect())) == [("01", 1), ("02", 2)]


def test_clear_workspace_removes_only_own_files(spark, tmp_path):
    other = str(tmp_path / "other")
    spark.range(3).write.parquet(other)
    path = workspace.new_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert workspace.path_exists(spark, path)
    workspace.clear_workspace(spark)
    assert not workspace.path_exists(spark, path) and workspace.path_exists(spark, other)


def test_preview_reads_only_its_columns(spark):
    path = workspace.new_path(spark, "wide")
    spark.range(20).selectExpr("id", "id * 2 AS a", "id * 3 AS b").write.parquet(path)
    plan = plan_of(tables.preview(spark.read.parquet(path), ["id", "a"], ["id"]))
    assert "TakeOrderedAndProject" in plan and "b#" not in plan.split("ReadSchema")[-1]
