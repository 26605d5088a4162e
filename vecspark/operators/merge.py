"""Keyed upserts, change classification, change logs and reads as of a version."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.sources.tables import write_partitioned
from vecspark.sources.workspace import delete_path, new_path, path_exists


class DuplicateKeyError(ValueError):
    """Several feed rows carry the same key."""


def duplicate_keys(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-null keys that occur more than once, with the number of copies."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (
        feed.filter(present)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def require_unique_keys(feed: DataFrame, keys: Sequence[str]) -> None:
    examples = duplicate_keys(feed, keys).limit(5).collect()
    if examples:
        raise DuplicateKeyError(f"feed has duplicate keys, for example {examples}")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of each key. An aggregate, so a hot key shrinks before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    latest = F.max_by(F.struct(*rest), F.struct(*order_by))
    return df.groupBy(*keys).agg(latest.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def merge(
    target: DataFrame,
    feed: DataFrame,
    keys: Sequence[str],
    skip_unchanged: bool = False,
    evolve_schema: bool = False,
    ignore: Sequence[str] = (),
) -> DataFrame:
    """Matched rows take the feed's values, new rows are added, the rest stays.

    A null key matches nothing.  ``skip_unchanged`` keeps the target's row where only the
    ``ignore`` columns differ.  Extra feed columns are left out unless ``evolve_schema``.
    Columns that the feed lacks keep the matched row's value and are null in new rows.
    """
    feed = complete_feed(target, feed, keys, evolve_schema)
    if skip_unchanged:
        feed = changed_rows(target, feed, keys, ignore)
    kept = target.join(feed.select(*keys), list(keys), "left_anti")
    return kept.unionByName(feed, allowMissingColumns=evolve_schema)


def complete_feed(
    target: DataFrame, feed: DataFrame, keys: Sequence[str], evolve_schema: bool = False
) -> DataFrame:
    """The feed with the target's columns and types, in the target's order."""
    missing = [c for c in target.columns if c not in feed.columns]
    if lost := [k for k in keys if k in missing or k not in target.columns]:
        raise ValueError(f"keys {lost} are missing")
    if missing:
        feed = feed.join(target.select(*keys, *missing), list(keys), "left")
    own = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.schema]
    more = [F.col(f"`{c}`") for c in feed.columns if evolve_schema and c not in target.columns]
    return feed.select(*own, *more)


def _compared(target: DataFrame, feed: DataFrame, keys: Sequence[str], ignore: Sequence[str]):
    return [c for c in feed.columns if c in target.columns and c not in (*keys, *ignore)]


def changed_rows(
    target: DataFrame, feed: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()
) -> DataFrame:
    """Feed rows that are new or differ from the target outside the ``ignore`` columns."""
    compared = _compared(target, feed, keys, ignore)
    t, f = target.alias("t"), feed.alias("f")
    same = [F.col(f"t.{k}") == F.col(f"f.{k}") for k in keys]
    same += [F.col(f"t.{c}").eqNullSafe(F.col(f"f.{c}")) for c in compared]
    return f.join(t, reduce(lambda a, b: a & b, same), "left_anti")


def tag_changes(
    target: DataFrame, feed: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()
) -> DataFrame:
    """The feed with ``op``: ``insert``, ``update`` or ``unchanged``."""
    compared = _compared(target, feed, keys, ignore)
    t = target.select(*keys, *compared, F.lit(True).alias("_found")).alias("t")
    f = feed.alias("f")
    matched = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"f.{k}") for k in keys])
    differs = reduce(
        lambda a, b: a | b,
        [~F.col(f"t.{c}").eqNullSafe(F.col(f"f.{c}")) for c in compared],
        F.lit(False),
    )
    op = F.when(F.col("_found").isNull(), "insert").when(differs, "update").otherwise("unchanged")
    return f.join(t, matched, "left").select(*[F.col(f"f.`{c}`") for c in feed.columns], op.alias("op"))


def classify_changes(
    target: DataFrame, feed: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()
) -> DataFrame:
    """Each feed key with ``insert``, ``update`` or ``unchanged``."""
    return tag_changes(target, feed, keys, ignore).select(*keys, "op")


def _partition_key(partition_cols: Sequence[str]) -> Column:
    """A partition as one text, so that any number of them makes one flat list."""
    return F.to_json(F.struct(*[F.col(c) for c in partition_cols]))


def stored_table(spark: SparkSession, path: str, partition_cols: Sequence[str], feed: DataFrame) -> DataFrame:
    """The table with all columns that any of its files has; partition values have the types
    of the feed, since folder names don't tell them."""
    found = spark.read.option("mergeSchema", True).parquet(path).schema
    fields = [
        T.StructField(f.name, feed.schema[f.name].dataType) if f.name in partition_cols else f
        for f in found.fields
    ]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def upsert_table(
    path: str,
    feed: DataFrame,
    keys: Sequence[str],
    partition_cols: Sequence[str],
    latest_by: Sequence[str] | None = None,
    skip_unchanged: bool = False,
    ignore: Sequence[str] = (),
    evolve_schema: bool = False,
    fixed_partitions: bool = False,
    change_log: str | None = None,
    batch: str | None = None,
) -> dict[str, int]:
    """Create the partitioned table on the first run, merge into it afterwards.

    The table keeps its own columns: those that the feed lacks keep their values, and those that
    only the feed has are left out unless ``evolve_schema``.  Returns the rows ``inserted``,
    ``updated`` and ``unchanged``; with ``change_log`` the inserted and updated rows are also
    appended there, with ``op``, ``version`` and ``committed_at``, before the table changes.  With
    ``batch``, a name for the feed, they go to the log once: a feed that is merged again, for
    instance after a failure between log and table, finds its changes there and returns their
    counts.  A log is written either with such names or without.

    Only partitions that hold a matched key or receive a feed row are rewritten; with
    ``fixed_partitions``, for keys that never move, the others aren't even looked at.  New content
    is written to the shared folder first, so the table never overwrites what it is reading, and
    running the same feed again gives the same table.  Copies are deleted at the end.
    """
    spark = feed.sparkSession
    if lost := [c for c in (*keys, *partition_cols) if c not in feed.columns]:
        raise ValueError(f"the feed lacks {lost}")
    if latest_by:
        feed = latest_per_key(feed, keys, latest_by)
    copies: list[str] = []

    def stored(df: DataFrame, label: str) -> DataFrame:
        copies.append(new_path(spark, label))
        df.write.parquet(copies[-1])
        return spark.read.schema(df.schema).parquet(copies[-1])

    try:
        # Read several times below, and its size then decides whether joins broadcast it.
        feed = stored(feed, "feed")
        if not latest_by:
            require_unique_keys(feed, keys)
        if not path_exists(spark, path):
            if change_log:
                _append_changes(feed.withColumn("op", F.lit("insert")), change_log, batch)
            write_partitioned(feed, path, partition_cols, mode="replace_all")
            return {"inserted": feed.count(), "updated": 0, "unchanged": 0}

        target = stored_table(spark, path, partition_cols, feed)
        key = _partition_key(partition_cols).alias("_partition")
        receiving = feed.select(key, F.lit(True).alias("_received"))
        touched = receiving
        if not fixed_partitions:
            matched = target.join(feed.select(*keys), list(keys), "left_semi")
            touched = receiving.unionByName(matched.select(key, F.lit(False).alias("_received")))
        # One row per touched partition folder.
        touched = touched.groupBy("_partition").agg(F.max("_received").alias("_received")).collect()
        if not touched:
            return {"inserted": 0, "updated": 0, "unchanged": 0}
        old = target.filter(_partition_key(partition_cols).isin([r._partition for r in touched]))
        complete = complete_feed(old, feed, keys, evolve_schema)
        # A merge that broke off can leave a row that moved in two partitions: it is one change.
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("op")))
        once = reduce(lambda a, k: a | F.col(k).isNull(), keys, F.col("_nth") == 1)
        tagged = tag_changes(old, complete, keys, ignore).withColumn("_nth", nth).filter(once).drop("_nth")
        tagged = stored(tagged, "changes")
        counts = {r.op: r["count"] for r in tagged.groupBy("op").count().collect()}
        if change_log and (batch or counts.keys() - {"unchanged"}):
            logged = _append_changes(tagged.filter("op <> 'unchanged'"), change_log, batch)
            if logged is not None:
                counts = logged | {"unchanged": sum(counts.values()) - sum(logged.values())}
        news = (tagged.filter("op <> 'unchanged'") if skip_unchanged else tagged).drop("op")
        kept = old.join(news.select(*keys), list(keys), "left_anti")
        merged = stored(kept.unionByName(news, allowMissingColumns=evolve_schema), "merge")
        write_partitioned(merged, path, partition_cols)
        left = [r._partition for r in touched if not r._received]
        _drop_emptied(path, merged, left, partition_cols)
        return {
            "inserted": counts.get("insert", 0),
            "updated": counts.get("update", 0),
            "unchanged": counts.get("unchanged", 0),
        }
    finally:
        for copy in copies:
            delete_path(spark, copy)


def _append_changes(changes: DataFrame, change_log: str, batch: str | None) -> dict[str, int] | None:
    """Log the changes; of a batch that the log has already, the counts by operation instead."""
    spark = changes.sparkSession
    path = change_log if batch is None else f"{change_log}/batch={batch}"
    # Spark leaves this file when all others are in place.
    if batch is not None and path_exists(spark, f"{path}/_SUCCESS"):
        return {r.op: r["count"] for r in spark.read.parquet(path).groupBy("op").count().collect()}
    version = 1
    if path_exists(spark, change_log):
        version += read_change_log(spark, change_log).agg(F.max("version")).first()[0] or 0
    stamped = changes.withColumns(
        {"version": F.lit(version), "committed_at": F.current_timestamp()}
    )
    stamped.write.mode("append" if batch is None else "overwrite").parquet(path)
    return None


def read_change_log(spark: SparkSession, change_log: str) -> DataFrame:
    """What upserts have changed, version by version."""
    return spark.read.option("mergeSchema", True).parquet(change_log)


def _drop_emptied(path: str, merged: DataFrame, left: list, partition_cols: Sequence[str]) -> None:
    """Remove partitions whose rows all moved elsewhere; overwriting others leaves them behind."""
    if not left:
        return
    spark, key = merged.sparkSession, _partition_key(partition_cols)
    filled = merged.filter(key.isin(left)).select(key.alias("_partition")).distinct()
    emptied = sorted(set(left) - {r._partition for r in filled.collect()})
    if not emptied:
        return
    old = spark.read.schema(merged.schema).parquet(path)
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder")
    for row in old.filter(key.isin(emptied)).select(folder).distinct().collect():
        delete_path(spark, spark.sparkContext._jvm.java.net.URI(row.folder))


def version_history(
    log: DataFrame, version_col: str = "version", ts_col: str = "committed_at", n: int = 2
) -> DataFrame:
    """The last ``n`` versions of a change log with their row counts per operation."""
    op = F.col("op")
    return (
        log.groupBy(version_col)
        .agg(
            F.max(ts_col).alias(ts_col),
            F.count_if(op == "insert").alias("inserted"),
            F.count_if(op == "update").alias("updated"),
            F.count_if(op == "delete").alias("deleted"),
        )
        .withColumn(
            "operation",
            F.when((F.col("updated") == 0) & (F.col("deleted") == 0), "WRITE").otherwise("MERGE"),
        )
        .orderBy(F.col(version_col).desc())
        .limit(n)
    )


def as_of_version(
    log: DataFrame, keys: Sequence[str], version: int, version_col: str = "version"
) -> DataFrame:
    """The table as it was after ``version``: last change of each key, deleted keys dropped."""
    visible = log.filter(F.col(version_col) <= version)
    return latest_per_key(visible, keys, [version_col]).filter(F.col("op") != "delete").drop("op")
