"""Structured Streaming over files that Spark writes from the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecspark.catalog.changes import FEED_FROM, LOADED_UNTIL, MERGED_SQL, merged_orders, orders_loaded
from vecspark.catalog.common import Query, r6, table
from vecspark.catalog.logs import ORACLES as LOG_ORACLES
from vecspark.operators.merge import read_change_log, upsert_table
from vecspark.operators.telemetry import sliding_rate
from vecspark.sources.workspace import delete_path, materialize, new_path
from vecspark.streaming.alerts import FLUSH, stream_alerts
from vecspark.streaming.dedup import stream_dedup
from vecspark.streaming.late import latest_updates, split_late, update_files
from vecspark.streaming.runs import append_files, read_files, with_event_time
from vecspark.streaming.upsert import batch_upsert, stream_upsert

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def q_stream_upsert(spark, sf):
    """The feed arrives in micro-batches; the final table equals one batch merge."""
    loaded, feed = orders_loaded(spark, sf)
    inbox, path = new_path(spark, "inbox"), new_path(spark, "orders")
    feed.repartitionByRange(2, "year_month").write.parquet(inbox)
    upsert_table(path, loaded, ["o_orderkey"], ["year_month"])
    stream = read_files(spark, inbox, feed.schema, max_files=1)
    query = stream_upsert(
        stream, path, new_path(spark, "checkpoint"), ["o_orderkey"], ["year_month"]
    )
    query.awaitTermination()
    return merged_orders(spark.read.schema(feed.schema).parquet(path))


QUERIES["stream_upsert"] = q_stream_upsert
ORACLES["stream_upsert"] = MERGED_SQL


def q_stream_upsert_repeated(spark, sf):
    """Every batch is merged twice, as after a failure before its commit; the log has it once."""
    loaded, feed = orders_loaded(spark, sf)
    path, log, checkpoint = new_path(spark, "orders"), new_path(spark, "log"), new_path(spark, "checkpoint")
    merge_batch = batch_upsert(path, checkpoint, ["o_orderkey"], ["year_month"], change_log=log)
    forgetful = batch_upsert(path, checkpoint, ["o_orderkey"], ["year_month"], change_log=log)
    for number, batch in enumerate((loaded, feed)):
        merge_batch(batch, number)
        delete_path(spark, f"{checkpoint}-merged/batch={number}")  # the marker got lost
        forgetful(batch, number)
        forgetful(batch, number)
    counts = spark.read.parquet(f"{checkpoint}-merged")
    logged = read_change_log(spark, log).groupBy(F.substring_index("batch", "-", -1).cast("int").alias("batch")).agg(
        F.count_if(F.col("op") == "insert").alias("logged_inserted"), F.count_if(F.col("op") == "update").alias("logged_updated")
    )
    return counts.join(logged, "batch")


QUERIES["stream_upsert_repeated"] = q_stream_upsert_repeated
ORACLES["stream_upsert_repeated"] = f"""
WITH c AS (
  SELECT 0 AS batch, count(*) AS inserted, 0 AS updated, 0 AS unchanged
  FROM orders WHERE o_orderdate < TIMESTAMP '{LOADED_UNTIL}'
  UNION ALL
  SELECT 1, count(*) FILTER (o_orderdate >= TIMESTAMP '{LOADED_UNTIL}'),
         count(*) FILTER (o_orderdate < TIMESTAMP '{LOADED_UNTIL}' AND o_orderstatus = 'F'),
         count(*) FILTER (o_orderdate < TIMESTAMP '{LOADED_UNTIL}' AND o_orderstatus <> 'F')
  FROM orders WHERE o_orderdate >= TIMESTAMP '{FEED_FROM}')
SELECT batch, inserted, updated, unchanged, inserted AS logged_inserted, updated AS logged_updated FROM c"""


def q_stream_dedup(spark, sf):
    """Every event is delivered twice, a week after the other at most; each comes out once."""
    return deduplicated_feed(table(spark, sf, "events").select("event_id", "ts", "event_type", "value"))


def deduplicated_feed(events):
    """The events through the stream, week by week, each week again with the one after it.

    All weeks of the table are delivered, and events without a time first, both times at once.
    No week is longer than the delay, whatever the data, and a longer table lets the keys of its
    old weeks leave the state.
    """
    spark = events.sparkSession
    feed, inbox, out, checkpoint = (new_path(spark, n) for n in ("feed", "inbox", "unique", "checkpoint"))
    start = events.select(F.date_trunc("day", F.min("ts"))).scalar()
    week = F.coalesce(F.floor(F.date_diff("ts", start) / 7), F.lit(-1))
    events.withColumn("week", week).write.partitionBy("week").parquet(feed)
    weeks = [r.week for r in events.select(week.alias("week")).distinct().collect()]
    dated = sorted(w for w in weeks if w >= 0)
    rounds = [[-1, -1]] if -1 in weeks else []
    rounds += [[old, new] for old, new in zip([None, *dated], [*dated, None], strict=True)]
    events.limit(0).write.parquet(inbox)
    stream = read_files(spark, inbox, events.schema)
    unique = stream_dedup(stream, ["event_id"], "ts", "8 days")
    for delivered in rounds:
        for number in delivered:
            if number is not None:
                part = spark.read.schema(events.schema).parquet(f"{feed}/week={number}")
                part.write.mode("append").parquet(inbox)
        append_files(unique, out, checkpoint).awaitTermination()
    result = spark.read.schema(unique.schema).parquet(out)
    return result.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type", "value")


QUERIES["stream_dedup"] = q_stream_dedup
ORACLES["stream_dedup"] = "SELECT event_id, ts, event_type, value FROM events"


def q_stream_alerts(spark, sf):
    """The rows of ``sustained_alerts``, once the last windows are over: two streams, one that closes
    windows and one that keeps the runs."""
    return ended_alerts(table(spark, sf, "events").select("ts", "event_type", "value"))


def ended_alerts(events):
    spark = events.sparkSession
    inbox, closed, ends, out = (new_path(spark, n) for n in ("inbox", "windows", "ends", "alerts"))
    # A row after the end lets the watermark pass all windows.
    after = events.agg((F.max("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts"))
    flush = after.select("ts", F.lit(FLUSH).alias("event_type"), F.lit(0.0).alias("value"))
    events.unionByName(flush).repartitionByRange(2, "ts").write.parquet(inbox)
    stream = with_event_time(read_files(spark, inbox, events.schema), "ts", "2 hours")
    hours = stream.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.avg("value").alias("mean"))
    hours = hours.select("event_type", F.col("w.start").alias("window_start"), "mean")
    append_files(hours, closed, new_path(spark, "checkpoint")).awaitTermination()
    flush.select(F.col("ts").cast("timestamp").alias("window_start"), "event_type", F.col("value").alias("mean")).write.parquet(ends)
    windows = read_files(spark, closed, hours.schema).unionByName(read_files(spark, ends, hours.schema))
    alerts = stream_alerts(windows, "event_type", "window_start", F.col("mean") > 45, 3600, 3, "2 hours")
    append_files(alerts, out, new_path(spark, "checkpoint")).awaitTermination()
    ended = spark.read.schema(alerts.schema).parquet(out).filter("event = 'ended'")
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("breach_start", "last_window", "fired_at")}
    return ended.withColumns(times).select(
        F.col("series").alias("event_type"), "breach_start", "last_window", "n_windows", "fired_at"
    )


QUERIES["stream_alerts"] = q_stream_alerts
ORACLES["stream_alerts"] = LOG_ORACLES["sustained_alerts"]


def q_stream_sliding_rate(spark, sf):
    """Closed windows and those still open after the last row: the rows of ``sliding_rate``."""
    events = table(spark, sf, "events").select("ts", "event_type")
    inbox, out = new_path(spark, "inbox"), new_path(spark, "rates")
    events.repartitionByRange(2, "ts").write.parquet(inbox)
    stream = with_event_time(read_files(spark, inbox, events.schema), "ts", "2 hours")
    rates = sliding_rate(stream, "ts", "event_type", "1 hour", "15 minutes", 3600)
    update_files(rates, out, new_path(spark, "checkpoint")).awaitTermination()
    result = latest_updates(spark, out, rates, ["window_start", "event_type"])
    return result.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        "event_type",
        "requests",
        r6("rate").alias("rate"),
    )


QUERIES["stream_sliding_rate"] = q_stream_sliding_rate
ORACLES["stream_sliding_rate"] = LOG_ORACLES["sliding_rate"]


def q_stream_late_rows(spark, sf):
    """Five deliveries by time; every tenth event comes one or two deliveries later than the others.
    With six days of delay, some of these are late."""
    return on_time_and_late(table(spark, sf, "events").select("event_id", "ts", "event_type"))


def on_time_and_late(events):
    spark = events.sparkSession
    inbox, on_time, late, checkpoint = (new_path(spark, n) for n in ("inbox", "on-time", "late", "checkpoint"))
    behind = F.when(F.col("event_id") % 10 == 0, 1 + F.col("event_id") % 20 / 10).otherwise(0)
    due = F.floor((F.day("ts") - 1) / 6) + behind.cast("long")
    feed = materialize(events.withColumn("delivery", F.least(due, F.lit(4))), "feed")
    events.limit(0).write.parquet(inbox)
    stream = read_files(spark, inbox, events.schema)
    for number in range(5):
        feed.filter(F.col("delivery") == number).drop("delivery").write.mode("append").parquet(inbox)
        split_late(stream, "ts", 6 * 86400, on_time, late, checkpoint).awaitTermination()
    parts = [spark.read.schema(events.schema).parquet(p).withColumn("late", F.lit(p == late)) for p in (on_time, late)]
    return parts[0].unionByName(parts[1]).select("event_id", "event_type", "late")


QUERIES["stream_late_rows"] = q_stream_late_rows
ORACLES["stream_late_rows"] = """
WITH feed AS (
  SELECT event_id, ts, event_type,
         least((day(ts) - 1) // 6 + CASE WHEN event_id % 20 = 0 THEN 1 WHEN event_id % 20 = 10 THEN 2 ELSE 0 END, 4) AS d
  FROM events),
latest AS (SELECT d, max(max(ts)) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
           FROM feed GROUP BY d)
SELECT event_id, event_type, ts IS NULL OR coalesce(ts < seen - INTERVAL 6 DAY, FALSE) AS late FROM feed JOIN latest USING (d)"""
