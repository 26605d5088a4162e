"""Search requests: limits, defaults, fingerprint and log attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vecspark.functions.text import is_blank, strip

# Request limits and defaults.
MAX_QUERY_CHARS = 2000
MAX_TOP_K = 100
MAX_NPROBE = 256
MAX_PAGE_SIZE = 100
DEFAULT_TOP_K = 10
DEFAULT_NPROBE = 10
DEFAULT_SHARD = "nyc_taxi_2023"
FINGERPRINT_LENGTH = 16
NPROBE_BY_CLASS = {"exploratory": 5, "standard": 10, "high_precision": 20}


def _out_of(c: Column, low: int, high: int | None) -> Column:
    bad = c < low
    return bad if high is None else bad | (c > high)


def rejection_reasons(
    query: str, top_k: str, nprobe: str, page_size: str, page: str
) -> Column:
    """Array of the limits a request breaks; empty when it is valid. nprobe may be null."""
    checks = [
        (is_blank(query), "query_required"),
        (F.length(query) > MAX_QUERY_CHARS, "query_too_long"),
        (_out_of(F.col(top_k), 1, MAX_TOP_K), "top_k_range"),
        (_out_of(F.col(nprobe), 1, MAX_NPROBE), "nprobe_range"),
        (_out_of(F.col(page_size), 1, MAX_PAGE_SIZE), "page_size_range"),
        (_out_of(F.col(page), 1, None), "page_range"),
    ]
    return F.array_compact(F.array(*[F.when(bad, F.lit(reason)) for bad, reason in checks]))


def shard_or_default(shard: Column, default: str = DEFAULT_SHARD) -> Column:
    return F.when(is_blank(shard), F.lit(default)).otherwise(shard)


def positive_or_default(value: Column, default: int) -> Column:
    return F.when(value > 0, value).otherwise(F.lit(default))


def fingerprint(query: Column, top_k: Column, shard: Column) -> Column:
    """First hex digits of SHA-256 over the normalised query, its top_k and its shard."""
    normal = F.concat_ws("|", strip(F.lower(query)), top_k.cast("string"), shard)
    return F.upper(F.substring(F.sha2(normal, 256), 1, FINGERPRINT_LENGTH))


def adaptive_nprobe(query_class: Column, requested: Column | None = None) -> Column:
    """nprobe by query class; an explicit positive request wins, unknown classes get the default."""
    by_class = F.lit(DEFAULT_NPROBE)
    for name, value in NPROBE_BY_CLASS.items():
        by_class = F.when(query_class == name, F.lit(value)).otherwise(by_class)
    if requested is None:
        return by_class
    return F.when(requested > 0, requested).otherwise(by_class)


def parse_metadata(json_text: Column) -> Column:
    """JSON object to map; null, blank and broken text give an empty map."""
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    return F.coalesce(F.from_json(json_text, "map<string,string>"), empty)


def log_attributes(
    query: Column, top_k: Column, shard: Column, nprobe: Column, cache_hit: Column, hits: Column
) -> list[Column]:
    """Columns of a request-log row; ``hits`` is the result array of the request."""
    return [
        F.length(query).alias("query_length"),
        top_k.alias("top_k"),
        F.coalesce(shard, F.lit("default")).alias("shard_key"),
        F.coalesce(nprobe, F.lit(0)).alias("nprobe"),
        cache_hit.alias("cache_hit"),
        F.when(hits.isNull(), F.lit(0)).otherwise(F.size(hits)).alias("result_count"),
    ]
