"""Scans, filters, renderings, requests and layouts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from vecspark.catalog.common import Query, in_micros, table
from vecspark.functions.requests import (
    adaptive_nprobe,
    fingerprint,
    log_attributes,
    parse_metadata,
    positive_or_default,
    rejection_reasons,
    shard_or_default,
)
from vecspark.functions.text import is_blank, strip, trip_phrase, trip_sentence, truncate
from vecspark.operators.clean import (
    add_partition_keys,
    add_provenance,
    clean_trips,
    split_by_dimension,
    trip_is_clean,
    valid_trips,
)
from vecspark.operators.embed import hash_embed, zero_fallback
from vecspark.operators.telemetry import dataset_stats
from vecspark.sources.tables import (
    preview,
    row_audit,
    seeded_sample,
    shard_catalog,
    write_partitioned,
)
from vecspark.sources.workspace import new_path

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MAX_DISTANCE = 40
TRIP_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_suppkey", "l_partkey",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
]


def q_row_audit(spark, sf):
    lines = table(spark, sf, "lineitem")
    return row_audit(lines, trip_is_clean("l_extendedprice", "l_quantity", MAX_DISTANCE))


QUERIES["row_audit"] = q_row_audit
ORACLES["row_audit"] = f"""
SELECT count(*) AS loaded,
       count(*) FILTER (l_extendedprice > 0 AND l_quantity > 0 AND l_quantity < {MAX_DISTANCE}) AS kept,
       count(*) - count(*) FILTER (l_extendedprice > 0 AND l_quantity > 0
                                   AND l_quantity < {MAX_DISTANCE}) AS dropped
FROM lineitem"""


def _write_by_month(spark, sf):
    lines = table(spark, sf, "lineitem")
    path = new_path(spark, "lineitem")
    keyed = add_partition_keys(lines, "l_shipdate", "y", "m").drop("year_month")
    write_partitioned(keyed, path, ["y", "m"])
    return spark.read.parquet(path)


def q_partitioned_write_scan(spark, sf):
    return _write_by_month(spark, sf).groupBy("y", "m").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("revenue")
    )


QUERIES["partitioned_write_scan"] = q_partitioned_write_scan
ORACLES["partitioned_write_scan"] = """
SELECT year(l_shipdate)::INTEGER AS y, month(l_shipdate)::INTEGER AS m, count(*) AS n,
       round(sum(l_extendedprice), 2) AS revenue
FROM lineitem GROUP BY 1, 2"""


def q_partition_pruned_scan(spark, sf):
    march = (F.col("y") == 1998) & (F.col("m") == 3)
    return _write_by_month(spark, sf).filter(march).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("revenue")
    )


QUERIES["partition_pruned_scan"] = q_partition_pruned_scan
ORACLES["partition_pruned_scan"] = """
SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue
FROM lineitem WHERE year(l_shipdate) = 1998 AND month(l_shipdate) = 3 GROUP BY 1"""


def q_seeded_sample(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return seeded_sample(orders, "o_orderkey", n=10_000, seed=42)


QUERIES["seeded_sample"] = q_seeded_sample
ORACLES["seeded_sample"] = """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
ORDER BY md5(o_orderkey::VARCHAR || '_42'), o_orderkey LIMIT 10000"""


def q_shard_catalog(spark, sf):
    orders = add_partition_keys(table(spark, sf, "orders"), "o_orderdate")
    path = new_path(spark, "shards")
    sharded = orders.withColumnRenamed("year_month", "shard_key")
    write_partitioned(sharded, path, ["shard_key"])
    return shard_catalog(spark, path)


QUERIES["shard_catalog"] = q_shard_catalog
ORACLES["shard_catalog"] = """
SELECT strftime(o_orderdate, '%Y-%m') AS shard_key, count(*) AS total_rows FROM orders GROUP BY 1"""


def q_preview_topn(spark, sf):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    return preview(table(spark, sf, "lineitem"), columns, order_by=columns, n=5)


QUERIES["preview_topn"] = q_preview_topn
ORACLES["preview_topn"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
FROM lineitem ORDER BY ALL LIMIT 5"""


def q_clean_trips(spark, sf):
    lines = table(spark, sf, "lineitem")
    return clean_trips(lines, "l_extendedprice", "l_quantity", TRIP_COLUMNS, MAX_DISTANCE)


QUERIES["clean_trips"] = q_clean_trips
ORACLES["clean_trips"] = f"""
SELECT {", ".join(TRIP_COLUMNS)} FROM lineitem
WHERE l_extendedprice > 0 AND l_quantity > 0 AND l_quantity < {MAX_DISTANCE}"""


def q_valid_trips(spark, sf):
    lines = table(spark, sf, "lineitem").select(*TRIP_COLUMNS)
    return valid_trips(
        lines, "l_extendedprice", "l_quantity", "l_linenumber", min_fare=20000, min_distance=2.5
    )


QUERIES["valid_trips"] = q_valid_trips
ORACLES["valid_trips"] = f"""
SELECT {", ".join(TRIP_COLUMNS)} FROM lineitem
WHERE l_quantity > 2.5 AND l_extendedprice > 20000 AND l_linenumber BETWEEN 1 AND 6"""


def q_text_repr(spark, sf):
    text = trip_phrase("l_suppkey", "l_partkey", "l_quantity", "l_extendedprice")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", text.alias("text_repr")
    )


QUERIES["text_repr"] = q_text_repr
ORACLES["text_repr"] = """
SELECT l_orderkey, l_linenumber,
       concat_ws(' ', 'taxi ride manhattan', l_suppkey::VARCHAR, 'to', l_partkey::VARCHAR, 'distance',
                 l_quantity::VARCHAR, 'miles fare', l_extendedprice::VARCHAR, 'dollars') AS text_repr
FROM lineitem"""


def q_text_repr_sentence(spark, sf):
    text = trip_sentence(
        "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice", "l_linenumber"
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", text.alias("text_repr")
    )


QUERIES["text_repr_sentence"] = q_text_repr_sentence
ORACLES["text_repr_sentence"] = """
SELECT l_orderkey, l_linenumber,
       'Yellow taxi trip from zone ' || l_suppkey || ' to zone ' || l_partkey || ', '
       || l_quantity::DECIMAL(18,1) || ' miles, $' || l_extendedprice::DECIMAL(18,2) || ' fare, '
       || l_linenumber || CASE WHEN l_linenumber > 1 THEN ' passengers' ELSE ' passenger' END
       AS text_repr
FROM lineitem"""


def q_provenance_cols(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return add_provenance(documents, datetime(2026, 1, 1, 12), "hashing", 64)


QUERIES["provenance_cols"] = q_provenance_cols
ORACLES["provenance_cols"] = """
SELECT doc_id, lang, source, TIMESTAMP '2026-01-01 12:00:00' AS ingestion_timestamp,
       'hashing' AS model_name, 64 AS embedding_dimension
FROM documents"""


def q_partition_keys(spark, sf):
    keyed = add_partition_keys(table(spark, sf, "orders"), "o_orderdate")
    return keyed.select("o_orderkey", "pickup_year", "pickup_month", "year_month")


QUERIES["partition_keys"] = q_partition_keys
ORACLES["partition_keys"] = """
SELECT o_orderkey, year(o_orderdate)::INTEGER AS pickup_year,
       month(o_orderdate)::INTEGER AS pickup_month, strftime(o_orderdate, '%Y-%m') AS year_month
FROM orders"""


# The encoder's input limit is the operator itself: what is cut off is reported next to it.
def q_embed_input_prep(spark, sf):
    prepared = strip(truncate("text"))
    return table(spark, sf, "documents").select(
        "doc_id",
        is_blank("text").alias("blank"),
        F.md5(prepared).alias("input_md5"),
        F.length(prepared).cast("bigint").alias("input_chars"),
        F.length("text").cast("bigint").alias("text_chars"),
        F.md5(strip("text")).alias("text_md5"),
    )


QUERIES["embed_input_prep"] = q_embed_input_prep
ORACLES["embed_input_prep"] = r"""
WITH prepared AS (
  SELECT doc_id, text, regexp_replace(text, '^\s+|\s+$', '', 'g') AS whole,
         regexp_replace(substring(text, 1, 512), '^\s+|\s+$', '', 'g') AS input
  FROM documents)
SELECT doc_id, length(whole) = 0 AS blank, md5(input) AS input_md5, length(input) AS input_chars,
       length(text) AS text_chars, md5(whole) AS text_md5
FROM prepared"""


def q_embed_zero_fallback(spark, sf):
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    joined = table(spark, sf, "documents").select("doc_id").join(vectors, "doc_id", "left")
    filled = zero_fallback(joined, "embedding", 64)
    return filled.select("doc_id", "embed_status", in_micros("embedding").alias("embedding_micros"))


QUERIES["embed_zero_fallback"] = q_embed_zero_fallback
ORACLES["embed_zero_fallback"] = """
SELECT doc_id, CASE WHEN embedding IS NULL THEN 'missing' ELSE 'ok' END AS embed_status,
       array_to_string(list_transform(coalesce(embedding::DOUBLE[], [0.0 FOR i IN range(64)]),
                                      lambda x: round(x * 1000000)::BIGINT), ',') AS embedding_micros
FROM documents LEFT JOIN embeddings ON vec_id = doc_id"""


def _requests(spark, sf):
    n, key = F.col("n_chars"), F.col("doc_id")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.col("text").alias("query"),
        (key % 120).alias("top_k"),
        F.when(F.col("lang") != "en", key % 300).alias("nprobe"),
        (n % 110).alias("page_size"),
        (key % 40).alias("page"),
    )


def q_validate_requests(spark, sf):
    reasons = rejection_reasons("query", "top_k", "nprobe", "page_size", "page")
    return _requests(spark, sf).select(
        "doc_id",
        (F.size(reasons) == 0).alias("valid"),
        F.array_join(reasons, ",").alias("reasons"),
    )


QUERIES["validate_requests"] = q_validate_requests
ORACLES["validate_requests"] = r"""
WITH requests AS (
  SELECT doc_id, text AS query, doc_id % 120 AS top_k,
         CASE WHEN lang <> 'en' THEN doc_id % 300 END AS nprobe,
         n_chars % 110 AS page_size, doc_id % 40 AS page
  FROM documents),
checked AS (
  SELECT doc_id, concat_ws(',',
    CASE WHEN length(regexp_replace(query, '^\s+|\s+$', '', 'g')) = 0 THEN 'query_required' END,
    CASE WHEN length(query) > 2000 THEN 'query_too_long' END,
    CASE WHEN top_k NOT BETWEEN 1 AND 100 THEN 'top_k_range' END,
    CASE WHEN nprobe NOT BETWEEN 1 AND 256 THEN 'nprobe_range' END,
    CASE WHEN page_size NOT BETWEEN 1 AND 100 THEN 'page_size_range' END,
    CASE WHEN page < 1 THEN 'page_range' END) AS reasons
  FROM requests)
SELECT doc_id, reasons = '' AS valid, reasons FROM checked"""


def q_request_defaults(spark, sf):
    kind = F.col("event_type")
    shard = F.when(kind == "click", F.lit(" \t ")).when(kind != "view", kind)
    return table(spark, sf, "events").select(
        "event_id",
        shard_or_default(shard).alias("shard_key"),
        positive_or_default(F.floor("value") - 20, 10).cast("bigint").alias("top_k"),
        positive_or_default(F.col("user_id") % 7 - 1, 10).cast("bigint").alias("nprobe"),
    )


QUERIES["request_defaults"] = q_request_defaults
ORACLES["request_defaults"] = """
SELECT event_id,
       CASE WHEN event_type IN ('click', 'view') THEN 'nyc_taxi_2023' ELSE event_type END AS shard_key,
       CASE WHEN floor(value) - 20 > 0 THEN floor(value) - 20 ELSE 10 END::BIGINT AS top_k,
       CASE WHEN user_id % 7 - 1 > 0 THEN user_id % 7 - 1 ELSE 10 END::BIGINT AS nprobe
FROM events"""


def q_query_fingerprint(spark, sf):
    print_ = fingerprint(F.col("text"), F.lit(10), F.col("source"))
    return table(spark, sf, "documents").select("doc_id", print_.alias("query_hash"))


QUERIES["query_fingerprint"] = q_query_fingerprint
ORACLES["query_fingerprint"] = r"""
SELECT doc_id, upper(substring(sha256(
         regexp_replace(lower(text), '^\s+|\s+$', '', 'g') || '|10|' || source), 1, 16)) AS query_hash
FROM documents"""


def q_dimension_check(spark, sf):
    """The vectors of one label are shortened, so that something is rejected."""
    short = F.when(F.col("label") == 9, F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    vectors = table(spark, sf, "embeddings").withColumn("embedding", short)
    good, bad = split_by_dimension(vectors, "embedding", 64)
    divisible = F.lit(64 % 8 == 0)
    checked = good.select("label", F.lit("ok").alias("status")).unionByName(
        bad.select("label", F.col("reason").alias("status"))
    )
    return checked.groupBy("label", "status").agg(
        F.count(F.lit(1)).alias("n"), F.first(divisible).alias("divisible")
    )


QUERIES["dimension_check"] = q_dimension_check
ORACLES["dimension_check"] = """
WITH vectors AS (
  SELECT label, CASE WHEN label = 9 THEN embedding[1:63] ELSE embedding END AS embedding FROM embeddings)
SELECT label, CASE WHEN len(embedding) = 64 THEN 'ok' ELSE 'wrong_dimension' END AS status,
       count(*) AS n, true AS divisible
FROM vectors GROUP BY 1, 2"""


def q_metadata_parse(spark, sf):
    events = table(spark, sf, "events")
    parsed = events.select("event_id", parse_metadata(F.col("props")).alias("metadata"))
    return parsed.select(
        "event_id",
        F.col("metadata")["k"].alias("k"),
        F.size("metadata").cast("bigint").alias("n_entries"),
    )


QUERIES["metadata_parse"] = q_metadata_parse
ORACLES["metadata_parse"] = """
SELECT event_id, props ->> '$.k' AS k, len(json_keys(props))::BIGINT AS n_entries FROM events"""


def q_request_log_projection(spark, sf):
    n = F.col("n_chars")
    hits = F.when(n % 11 > 0, F.sequence(F.lit(1), (n % 11).cast("int")))
    columns = log_attributes(
        F.col("text"),
        (n % 100 + 1),
        F.when(F.col("lang") != "en", F.col("lang")),
        F.when(F.col("source") != "src0", n % 256 + 1),
        F.col("source") == "src1",
        hits,
    )
    return table(spark, sf, "documents").select("doc_id", *columns)


QUERIES["request_log_projection"] = q_request_log_projection
ORACLES["request_log_projection"] = """
SELECT doc_id, length(text)::INTEGER AS query_length, n_chars % 100 + 1 AS top_k,
       CASE WHEN lang <> 'en' THEN lang ELSE 'default' END AS shard_key,
       CASE WHEN source <> 'src0' THEN n_chars % 256 + 1 ELSE 0 END AS nprobe,
       source = 'src1' AS cache_hit, (n_chars % 11)::INTEGER AS result_count
FROM documents"""


def q_adaptive_nprobe(spark, sf):
    kind = F.col("event_type")
    query_class = (
        F.when(kind == "view", "exploratory")
        .when(kind == "click", "standard")
        .when(kind == "purchase", "high_precision")
    )
    requested = F.when(kind == "signup", F.col("user_id") % 50)
    return table(spark, sf, "events").select(
        "event_id", adaptive_nprobe(query_class, requested).cast("bigint").alias("nprobe")
    )


QUERIES["adaptive_nprobe"] = q_adaptive_nprobe
ORACLES["adaptive_nprobe"] = """
SELECT event_id,
       CASE WHEN event_type = 'signup' AND user_id % 50 > 0 THEN user_id % 50
            WHEN event_type = 'view' THEN 5 WHEN event_type = 'purchase' THEN 20 ELSE 10 END::BIGINT
       AS nprobe
FROM events"""


def q_dataset_stats(spark, sf):
    month = F.date_format("l_shipdate", "yyyy-MM")
    stats = dataset_stats(table(spark, sf, "lineitem"), month, "l_quantity")
    return stats.withColumn("avg_distance", F.round("avg_distance", 6))


QUERIES["dataset_stats"] = q_dataset_stats
ORACLES["dataset_stats"] = """
SELECT strftime(l_shipdate, '%Y-%m') AS shard_key, count(*) AS row_count,
       round(avg(l_quantity), 6) AS avg_distance
FROM lineitem GROUP BY 1"""


def q_hash_embed(spark, sf):
    embedded = hash_embed(table(spark, sf, "documents").select("doc_id", "text"), "text", 64)
    return embedded.select(
        "doc_id", "embed_status", in_micros("embedding").alias("embedding_micros")
    )


QUERIES["hash_embed"] = q_hash_embed
ORACLES["hash_embed"] = r"""
WITH tokens AS (
  SELECT doc_id, md5(token) AS h FROM (
    SELECT doc_id, unnest(string_split_regex(lower(text), '\s+')) AS token FROM documents)
  WHERE token <> ''),
slots AS (
  SELECT doc_id, (('0x' || substring(h, 1, 8))::BIGINT % 64) AS bucket,
         sum(CASE WHEN substring(h, 9, 1) < '8' THEN 1 ELSE -1 END)::DOUBLE AS weight
  FROM tokens GROUP BY 1, 2),
norms AS (SELECT doc_id, sqrt(sum(weight * weight)) AS norm FROM slots GROUP BY 1),
full_grid AS (
  SELECT doc_id, bucket, norm FROM (SELECT doc_id FROM documents) LEFT JOIN norms USING (doc_id),
         (SELECT unnest(range(64)) AS bucket)),
vectors AS (
  SELECT g.doc_id, g.norm, list(
    round(CASE WHEN g.norm > 0 THEN coalesce(weight, 0) / g.norm ELSE 0 END::FLOAT::DOUBLE
          * 1000000)::BIGINT ORDER BY g.bucket) AS micros
  FROM full_grid g LEFT JOIN slots s ON s.doc_id = g.doc_id AND s.bucket = g.bucket
  GROUP BY 1, 2)
SELECT doc_id, CASE WHEN norm IS NULL THEN 'blank' ELSE 'ok' END AS embed_status,
       array_to_string(micros, ',') AS embedding_micros
FROM vectors"""
