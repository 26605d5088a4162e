"""Streams end in the state that the batch operators give."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from vecspark.catalog.streams import deduplicated_feed
from vecspark.operators import merge
from vecspark.operators.merge import upsert_table
from vecspark.operators.telemetry import admission_windows, failure_breach
from vecspark.sources.workspace import new_path
from vecspark.streaming.dedup import stream_dedup
from vecspark.streaming.reuse import stream_ttl_reuse
from vecspark.streaming.late import latest_updates, split_late, update_files
from vecspark.streaming.runs import append_files, read_files, with_event_time
from vecspark.streaming.upsert import stream_upsert

START = datetime(2024, 1, 1)
LOG = "id bigint, key string, ts timestamp_ntz, failed boolean"


def deliver(spark, inbox, rows, schema=LOG):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)


def at(i, seconds, key="a", failed=False):
    return (i, key, START + timedelta(seconds=seconds), failed)


def run(df, out, checkpoint):
    append_files(df, out, checkpoint).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out)


def test_upsert_stream_is_idempotent_and_equals_batch(spark, rows_of):
    schema = "id int, v string, m string"
    inbox, path, batch_path = (new_path(spark, n) for n in ("inbox", "table", "batch"))
    feeds = [[(1, "a", "01"), (2, "b", "02")], [(2, "B", "01"), (3, "c", "03")], [(3, "C", "03")]]
    for feed in feeds:
        deliver(spark, inbox, feed, schema)
        upsert_table(batch_path, spark.createDataFrame(feed, schema), ["id"], ["m"])
    stream = read_files(spark, inbox, spark.createDataFrame([], schema).schema, max_files=1)

    def drain(checkpoint):
        stream_upsert(stream, path, checkpoint, ["id"], ["m"]).awaitTermination()
        return rows_of(spark.read.schema(schema).parquet(path))

    checkpoint = new_path(spark, "checkpoint")
    expected = rows_of(spark.read.schema(schema).parquet(batch_path))
    assert drain(checkpoint) == expected == [(1, "a", "01"), (2, "B", "01"), (3, "C", "03")]
    assert drain(checkpoint) == expected
    # The same files once more, as after a lost checkpoint.
    assert drain(new_path(spark, "checkpoint")) == expected


@pytest.mark.parametrize("fails_after", ["log", "table"])
def test_a_batch_that_broke_off_counts_and_logs_once(spark, rows_of, monkeypatch, fails_after):
    schema = "id int, v string, m string"
    inbox, path, log, checkpoint = (new_path(spark, n) for n in ("inbox", "table", "log", "checkpoint"))
    for feed in ([(1, "a", "01"), (2, "b", "02")], [(2, "B", "01"), (3, "c", "03"), (1, "a", "01")]):
        deliver(spark, inbox, feed, schema)
    wrote = merge.write_partitioned
    left = [1]

    def breaks_once(df, target, cols, mode="overwrite"):
        if mode == "overwrite" and left:
            left.pop()
            if fails_after == "table":
                wrote(df, target, cols, mode)
            raise RuntimeError("lost")
        wrote(df, target, cols, mode)

    def drain():
        stream = read_files(spark, inbox, spark.createDataFrame([], schema).schema, max_files=1)
        stream_upsert(stream, path, checkpoint, ["id"], ["m"], change_log=log).awaitTermination()

    monkeypatch.setattr(merge, "write_partitioned", breaks_once)
    with pytest.raises(StreamingQueryException):
        drain()
    drain()
    assert not left
    assert rows_of(spark.read.schema(schema).parquet(path)) == [(1, "a", "01"), (2, "B", "01"), (3, "c", "03")]
    logged = merge.read_change_log(spark, log)
    assert rows_of(logged.select("id", "v", "op", "version")) == [(1, "a", "insert", 1), (2, "B", "update", 2), (2, "b", "insert", 1), (3, "c", "insert", 2)]
    counts = spark.read.parquet(f"{checkpoint}-merged")
    assert rows_of(counts.select("batch", "inserted", "updated", "unchanged")) == [(0, 2, 0, 0), (1, 1, 1, 1)]
    drain()
    assert logged.count() == 4


def test_late_row_is_dropped_and_on_time_row_kept(spark):
    inbox, out, checkpoint = (new_path(spark, n) for n in ("inbox", "out", "checkpoint"))
    schema = spark.createDataFrame([], LOG).schema
    deliver(spark, inbox, [at(1, 5), at(2, 200)])
    stream = with_event_time(read_files(spark, inbox, schema, max_files=1), "ts", "60 seconds")
    windows = admission_windows(stream, "ts", "10 seconds", permits=1, queue=1)
    run(windows, out, checkpoint)
    deliver(spark, inbox, [at(3, 6), at(4, 195), at(5, 196), at(6, 400)])
    result = run(windows, out, checkpoint)
    found = {
        int((r.window_start.replace(tzinfo=None) - START).total_seconds()): (r.requests, r.admitted, r.queued, r.rejected)
        for r in result.collect()
    }
    assert found == {0: (1, 1, 0, 0), 190: (2, 1, 1, 0), 200: (1, 1, 0, 0)}


def test_failure_breach_stream(spark):
    inbox, out, checkpoint = (new_path(spark, n) for n in ("inbox", "out", "checkpoint"))
    deliver(spark, inbox, [at(i, i, failed=i < 3) for i in range(5)] + [at(9, 500)])
    schema = spark.createDataFrame([], LOG).schema
    stream = with_event_time(read_files(spark, inbox, schema), "ts", "10 seconds")
    result = run(failure_breach(stream, "ts", F.col("failed")), out, checkpoint)
    assert [tuple(r)[1:] for r in result.collect()] == [(5, 3)]


def test_dedup_across_batches(spark):
    inbox, out, checkpoint = (new_path(spark, n) for n in ("inbox", "out", "checkpoint"))
    schema = spark.createDataFrame([], LOG).schema
    deliver(spark, inbox, [at(1, 0, "a"), at(2, 1, "b")])
    deliver(spark, inbox, [at(3, 5, "a"), at(4, 6, "c")])
    unique = stream_dedup(read_files(spark, inbox, schema, max_files=1), ["key"], "ts", "1 hour")
    result = run(unique, out, checkpoint)
    assert sorted(r.key for r in result.collect()) == ["a", "b", "c"]


def test_dedup_of_a_long_feed_with_gaps_and_missing_times(spark):
    days = [0, 3, 6, 7, 29, 34, 35, 36, 80, 81, 400, None, None]
    rows = [(i, d if d is None else START + timedelta(days=d, hours=1), "view", float(i)) for i, d in enumerate(days)]
    schema = "event_id long, ts timestamp_ntz, event_type string, value double"
    found = deduplicated_feed(spark.createDataFrame(rows, schema).repartition(3))
    assert sorted(map(tuple, found.collect())) == rows
    assert not deduplicated_feed(spark.createDataFrame([], schema)).collect()


def test_ttl_stream_equals_plain_replay(spark):
    inbox, out, checkpoint = (new_path(spark, n) for n in ("inbox", "out", "checkpoint"))
    schema = spark.createDataFrame([], LOG).schema
    times = [0, 299, 300, 301, 599, 601, 2000]
    deliver(spark, inbox, [at(i, t) for i, t in enumerate(times[:3])] + [at(50, 1, "b")])
    stream = with_event_time(read_files(spark, inbox, schema, max_files=1), "ts", "10 seconds")
    replayed = stream_ttl_reuse(stream, "key", "ts", "id", 300)
    run(replayed, out, checkpoint)
    deliver(spark, inbox, [at(i, t) for i, t in enumerate(times) if i >= 3] + [at(51, 310, "b")])
    result = run(replayed, out, checkpoint)
    assert {r.id: r.cache_hit for r in result.collect()} == {
        0: False, 1: True, 2: False, 3: True, 4: True, 5: False, 6: False, 50: False, 51: False,
    }


def test_late_rows_go_to_their_table(spark):
    """Deliveries against a plain replay of the watermark; a repeated batch changes nothing."""
    inbox, on_time, late, checkpoint = (new_path(spark, n) for n in ("inbox", "on-time", "late", "checkpoint"))
    deliver(spark, inbox, [])
    stream = read_files(spark, inbox, spark.createDataFrame([], LOG).schema)
    deliveries = [[100, 0, None], [39, 40, 300], [239, 240, 100], []]
    expected, latest, number = {}, None, 0
    for times in deliveries:
        rows = [(number + i, "a", None if t is None else START + timedelta(seconds=t), False) for i, t in enumerate(times)]
        deliver(spark, inbox, rows)
        split_late(stream, "ts", 60, on_time, late, checkpoint).awaitTermination()
        expected |= {number + i: t is None or (latest is not None and t < latest - 60) for i, t in enumerate(times)}
        latest = max([latest or 0, *[t for t in times if t is not None]])
        number += len(times)
    schema = spark.createDataFrame([], LOG).schema
    found = {r.id: name == "late" for name, p in (("late", late), ("on time", on_time)) for r in spark.read.schema(schema).parquet(p).collect()}
    assert found == expected


def test_updates_hold_open_windows(spark):
    inbox, out, checkpoint = (new_path(spark, n) for n in ("inbox", "updates", "checkpoint"))
    deliver(spark, inbox, [])
    stream = with_event_time(read_files(spark, inbox, spark.createDataFrame([], LOG).schema), "ts", "10 seconds")
    counts = stream.groupBy(F.window("ts", "10 seconds").start.alias("w"), "key").agg(F.count(F.lit(1)).alias("n"))
    for rows in ([at(1, 0), at(2, 5), at(3, 12, "b")], [at(4, 6), at(5, 13, "b"), at(6, 21)]):
        deliver(spark, inbox, rows)
        update_files(counts, out, checkpoint).awaitTermination()
    found = latest_updates(spark, out, counts, ["w", "key"]).select("w", "key", "n").collect()
    assert {(int((r.w.replace(tzinfo=None) - START).total_seconds()), r.key): r.n for r in found} == {
        (0, "a"): 3, (10, "b"): 2, (20, "a"): 1,
    }
