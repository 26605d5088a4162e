"""Upserts, change logs, result reuse and shard routing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from vecspark.catalog.common import Query, ntz, table
from vecspark.operators.clean import add_partition_keys
from vecspark.operators.merge import (
    as_of_version,
    classify_changes,
    duplicate_keys,
    latest_per_key,
    read_change_log,
    stored_table,
    upsert_table,
    version_history,
)
from vecspark.operators.reuse import reuse_results, to_compute
from vecspark.operators.routing import route, tag_shards
from vecspark.plans.ingest import incremental_ingest
from vecspark.sources.workspace import new_path

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Orders before 2000 are in the table; the feed brings those from 1998 on, finished ones
# with a new price.
LOADED_UNTIL = "2000-01-01"
FEED_FROM = "1998-01-01"


def orders_loaded(spark, sf):
    orders = add_partition_keys(table(spark, sf, "orders"), "o_orderdate")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice", "year_month"]
    loaded = orders.filter(F.col("o_orderdate") < ntz(LOADED_UNTIL)).select(*columns)
    price = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") * 1.1)
    feed = (
        orders.filter(F.col("o_orderdate") >= ntz(FEED_FROM))
        .withColumn("o_totalprice", F.coalesce(price, "o_totalprice"))
        .select(*columns)
    )
    return loaded, feed


def merged_orders(df):
    return df.select(
        "o_orderkey", "o_orderstatus", F.round("o_totalprice", 4).alias("price"), "year_month"
    )


MERGED_SQL = f"""
SELECT o_orderkey, o_orderstatus,
       round(CASE WHEN o_orderdate >= TIMESTAMP '{FEED_FROM}' AND o_orderstatus = 'F'
                  THEN o_totalprice * 1.1 ELSE o_totalprice END, 4) AS price,
       strftime(o_orderdate, '%Y-%m') AS year_month
FROM orders"""


STAMPS = (datetime(2000, 1, 1), datetime(2001, 9, 1))


def _ingested(spark, sf, change_log=None):
    """The table after both runs, with their counts."""
    path = new_path(spark, "orders")
    counts = [
        incremental_ingest(rows, path, at, ("o_orderkey",), ("year_month",), change_log=change_log)
        for rows, at in zip(orders_loaded(spark, sf), STAMPS, strict=True)
    ]
    return path, counts


def q_upsert_merge(spark, sf):
    loaded, _ = orders_loaded(spark, sf)
    path, _ = _ingested(spark, sf)
    schema = loaded.withColumn("updated_at", F.lit(STAMPS[0])).schema
    table_ = spark.read.schema(schema).parquet(path)
    stamp = F.col("updated_at").cast("timestamp_ntz").alias("updated_at")
    return merged_orders(table_.select("*")).join(table_.select("o_orderkey", stamp), "o_orderkey")


QUERIES["upsert_merge"] = q_upsert_merge
ORACLES["upsert_merge"] = f"""
SELECT m.*, CASE WHEN o_orderdate >= TIMESTAMP '{FEED_FROM}' THEN TIMESTAMP '{STAMPS[1]}'
                 ELSE TIMESTAMP '{STAMPS[0]}' END AS updated_at
FROM ({MERGED_SQL}) m JOIN orders USING (o_orderkey)"""


def q_upsert_missing_column(spark, sf):
    """A feed without the status and with a column of its own; the table keeps its columns."""
    loaded, feed = orders_loaded(spark, sf)
    path = new_path(spark, "orders")
    upsert_table(path, loaded, ["o_orderkey"], ["year_month"])
    narrow = feed.drop("o_orderstatus").withColumn("note", F.lit("new"))
    upsert_table(path, narrow, ["o_orderkey"], ["year_month"])
    return merged_orders(stored_table(spark, path, ["year_month"], feed))


QUERIES["upsert_missing_column"] = q_upsert_missing_column
ORACLES["upsert_missing_column"] = f"""
SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '{LOADED_UNTIL}' THEN m.o_orderstatus END AS o_orderstatus,
       price, year_month
FROM ({MERGED_SQL}) m JOIN orders USING (o_orderkey)"""


def q_merge_metrics(spark, sf):
    """Counts that the upserts returned beside those of the log that they wrote."""
    log_path = new_path(spark, "changes")
    _, counts = _ingested(spark, sf, log_path)
    history = version_history(read_change_log(spark, log_path), n=2)
    returned = spark.createDataFrame(
        [(i + 1, c["inserted"], c["updated"], c["unchanged"]) for i, c in enumerate(counts)],
        "version int, returned_inserted long, returned_updated long, unchanged long",
    )
    return history.drop("committed_at").join(returned, "version")


QUERIES["merge_metrics"] = q_merge_metrics
ORACLES["merge_metrics"] = f"""
WITH c AS (
  SELECT 1 AS version, count(*) AS inserted, 0 AS updated, 0 AS unchanged
  FROM orders WHERE o_orderdate < TIMESTAMP '{LOADED_UNTIL}'
  UNION ALL
  SELECT 2, count(*) FILTER (o_orderdate >= TIMESTAMP '{LOADED_UNTIL}'),
         count(*) FILTER (o_orderdate < TIMESTAMP '{LOADED_UNTIL}' AND o_orderstatus = 'F'),
         count(*) FILTER (o_orderdate < TIMESTAMP '{LOADED_UNTIL}' AND o_orderstatus <> 'F')
  FROM orders WHERE o_orderdate >= TIMESTAMP '{FEED_FROM}')
SELECT version, inserted, updated, 0::BIGINT AS deleted, CASE WHEN updated = 0 THEN 'WRITE' ELSE 'MERGE' END AS operation,
       inserted AS returned_inserted, updated AS returned_updated, unchanged FROM c"""


def q_merge_as_of(spark, sf):
    """The table as it was before the second upsert, from the log of both."""
    log_path = new_path(spark, "changes")
    _ingested(spark, sf, log_path)
    rows = as_of_version(read_change_log(spark, log_path), ["o_orderkey"], version=1)
    return rows.select("o_orderkey", F.round("o_totalprice", 4).alias("price"), "year_month")


QUERIES["merge_as_of"] = q_merge_as_of
ORACLES["merge_as_of"] = f"""
SELECT o_orderkey, round(o_totalprice, 4) AS price, strftime(o_orderdate, '%Y-%m') AS year_month
FROM orders WHERE o_orderdate < TIMESTAMP '{LOADED_UNTIL}'"""


def q_upsert_dup_guard(spark, sf):
    return duplicate_keys(table(spark, sf, "events"), ["user_id", "event_type"])


QUERIES["upsert_dup_guard"] = q_upsert_dup_guard
ORACLES["upsert_dup_guard"] = """
SELECT user_id, event_type, count(*) AS copies FROM events GROUP BY 1, 2 HAVING count(*) > 1"""


def q_upsert_change_classify(spark, sf):
    loaded, feed = orders_loaded(spark, sf)
    return classify_changes(loaded, feed, ["o_orderkey"])


QUERIES["upsert_change_classify"] = q_upsert_change_classify
ORACLES["upsert_change_classify"] = f"""
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '{LOADED_UNTIL}' THEN 'insert'
                        WHEN o_orderstatus = 'F' THEN 'update' ELSE 'unchanged' END AS op
FROM orders WHERE o_orderdate >= TIMESTAMP '{FEED_FROM}'"""


def _change_log(spark, sf):
    """One insert per order in the version of its year; then price changes and cancellations."""
    orders = table(spark, sf, "orders")
    year = F.year("o_orderdate") - 1994
    finished = F.col("o_orderstatus") == "F"
    cancelled = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")

    def change(op, version, factor):
        return F.struct(
            F.lit(op).alias("op"), version.alias("version"), F.lit(factor).alias("factor")
        )

    steps = F.array_compact(
        F.array(
            change("insert", year, 1.0),
            F.when(finished, change("update", year + 1, 1.1)),
            F.when(cancelled, change("delete", year + 2, 1.0)),
        )
    )
    log = orders.select("o_orderkey", "o_totalprice", F.explode(steps).alias("s"))
    return log.select(
        "o_orderkey",
        (F.col("o_totalprice") * F.col("s.factor")).alias("price"),
        F.col("s.op").alias("op"),
        F.col("s.version").alias("version"),
        F.concat((F.col("s.version") + 1994).cast("string"), F.lit("-12-31")).alias("committed_at"),
    )


LOG_SQL = """
WITH log AS (
  SELECT o_orderkey, o_totalprice AS price, 'insert' AS op, (year(o_orderdate) - 1994)::INTEGER AS version
  FROM orders
  UNION ALL
  SELECT o_orderkey, o_totalprice * 1.1, 'update', (year(o_orderdate) - 1993)::INTEGER
  FROM orders WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT o_orderkey, o_totalprice, 'delete', (year(o_orderdate) - 1992)::INTEGER
  FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW')"""


def q_version_history(spark, sf):
    return version_history(_change_log(spark, sf), n=2)


QUERIES["version_history"] = q_version_history
ORACLES["version_history"] = f"""{LOG_SQL}
SELECT version, (version + 1994) || '-12-31' AS committed_at,
       count(*) FILTER (op = 'insert') AS inserted, count(*) FILTER (op = 'update') AS updated,
       count(*) FILTER (op = 'delete') AS deleted,
       CASE WHEN count(*) FILTER (op <> 'insert') = 0 THEN 'WRITE' ELSE 'MERGE' END AS operation
FROM log GROUP BY version ORDER BY version DESC LIMIT 2"""


def q_as_of_version(spark, sf):
    rows = as_of_version(_change_log(spark, sf), ["o_orderkey"], version=4)
    return rows.select("o_orderkey", F.round("price", 4).alias("price"), "version")


QUERIES["as_of_version"] = q_as_of_version
ORACLES["as_of_version"] = f"""{LOG_SQL}
SELECT o_orderkey, round(price, 4) AS price, version FROM log WHERE version <= 4
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) = 1 AND op <> 'delete'"""


def q_latest_per_key(spark, sf):
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return latest_per_key(events, ["user_id"], ["ts", "event_id"])


QUERIES["latest_per_key"] = q_latest_per_key
ORACLES["latest_per_key"] = """
SELECT user_id, ts, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


def _reused(spark, sf):
    """Each result was stored once, at the first request of its fingerprint."""
    requests = table(spark, sf, "events").withColumn(
        "query_hash", F.concat_ws("|", "event_type", F.col("user_id").cast("string"))
    )
    stored = requests.groupBy("query_hash").agg(F.min("ts").alias("filled_at"))
    return reuse_results(requests, stored, "query_hash", "ts", ttl_seconds=6 * 86_400)


def q_result_reuse_join(spark, sf):
    return _reused(spark, sf).select("event_id", "cache_hit")


def q_result_misses(spark, sf):
    return to_compute(_reused(spark, sf), "query_hash")


REUSE_SQL = """
WITH requests AS (SELECT *, event_type || '|' || user_id AS query_hash FROM events),
stored AS (SELECT query_hash, min(ts) AS filled_at FROM requests GROUP BY 1),
reused AS (SELECT event_id, query_hash, ts < filled_at + INTERVAL 6 DAY AS cache_hit
           FROM requests JOIN stored USING (query_hash))"""

QUERIES["result_reuse_join"] = q_result_reuse_join
ORACLES["result_reuse_join"] = f"{REUSE_SQL} SELECT event_id, cache_hit FROM reused"
QUERIES["result_misses"] = q_result_misses
ORACLES["result_misses"] = f"""{REUSE_SQL}
SELECT query_hash, count(*) AS waiting_requests FROM reused WHERE NOT cache_hit GROUP BY 1"""


def q_shard_routing(spark, sf):
    """Each customer asks for the months from the first to three after the last order."""
    orders = table(spark, sf, "orders")
    requests = orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("first_day"),
        F.add_months(F.max("o_orderdate").cast("date"), 3).alias("last_day"),
    )
    catalog = orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("shard_key"))
    tagged = tag_shards(route(requests, "first_day", "last_day"), catalog, "o_custkey")
    return tagged.groupBy("o_custkey").agg(
        F.count_if("known").alias("known_shards"),
        F.count_if(~F.col("known")).alias("unknown_shards"),
        F.min("shard_key").alias("first_shard"),
        F.max("shard_key").alias("last_shard"),
    )


QUERIES["shard_routing"] = q_shard_routing
ORACLES["shard_routing"] = """
WITH requests AS (
  SELECT o_custkey, min(o_orderdate)::DATE AS first_day,
         (max(o_orderdate)::DATE + INTERVAL 3 MONTH)::DATE AS last_day
  FROM orders GROUP BY 1),
pairs AS (
  SELECT o_custkey, strftime(unnest(generate_series(date_trunc('month', first_day)::TIMESTAMP,
           date_trunc('month', last_day)::TIMESTAMP, INTERVAL 1 MONTH)), '%Y-%m') AS shard_key
  FROM requests),
catalog AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS shard_key, true AS found FROM orders)
SELECT o_custkey, count(*) FILTER (found) AS known_shards,
       count(*) FILTER (found IS NULL) AS unknown_shards,
       min(shard_key) AS first_shard, max(shard_key) AS last_shard
FROM pairs LEFT JOIN catalog USING (shard_key) GROUP BY 1"""
