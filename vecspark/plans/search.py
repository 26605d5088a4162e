"""Batch of search requests to ranked pages."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.functions.requests import (
    DEFAULT_NPROBE,
    DEFAULT_TOP_K,
    fingerprint,
    positive_or_default,
    rejection_reasons,
    shard_or_default,
)
from vecspark.functions.vectors import l2_normalize
from vecspark.operators.ivf import ivf_flat_search
from vecspark.operators.knn import limit_per_request
from vecspark.operators.pq import ivfpq_search, rerank
from vecspark.operators.results import attach_metadata, page_hits
from vecspark.operators.reuse import DEFAULT_TTL_SECONDS
from vecspark.sources.index_store import StoredIndex
from vecspark.sources.workspace import materialize


@dataclass(frozen=True)
class SearchAnswer:
    """Every request is in one of the parts.

    ``rejected`` have reasons, those of failed encoding included; ``hits`` are the full results
    and ``pages`` the requested parts; ``answered`` tells of each answered request its
    ``query_hash``, ``shard_key`` and whether a stored result was used (``cache_hit``).
    """

    rejected: DataFrame
    unknown_shards: DataFrame
    hits: DataFrame
    pages: DataFrame
    answered: DataFrame


def prepare_requests(requests: DataFrame, default_shard: str) -> tuple[DataFrame, DataFrame]:
    """Valid requests with defaults and result key, and the rejected ones with reasons.

    The result key adds nprobe to the fingerprint, since nprobe changes the result.
    """
    checked = requests.withColumn(
        "reasons", rejection_reasons("query", "top_k", "nprobe", "page_size", "page")
    )
    rejected = checked.filter(F.size("reasons") > 0)
    valid = checked.filter(F.size("reasons") == 0).drop("reasons")
    valid = valid.withColumns(
        {
            "top_k": positive_or_default(F.col("top_k"), DEFAULT_TOP_K),
            "nprobe": positive_or_default(F.col("nprobe"), DEFAULT_NPROBE),
            "shard_key": shard_or_default(F.col("shard_key"), default_shard),
        }
    )
    print_ = fingerprint(F.col("query"), F.col("top_k"), F.col("shard_key"))
    valid = valid.withColumn("query_hash", print_)
    return valid.withColumn("result_key", F.concat_ws("|", "query_hash", "nprobe")), rejected


def search(
    requests: DataFrame,
    index: StoredIndex,
    embed_queries: Callable[[DataFrame, str], DataFrame],
    default_shard: str,
    source: DataFrame | None = None,
    metadata_cols: Sequence[str] = (),
    id_col: str = "id",
    vec_col: str = "embedding",
    stored: DataFrame | None = None,
    asked_at: datetime | None = None,
    ttl_seconds: int = DEFAULT_TTL_SECONDS,
    rerank_factor: int = 1,
) -> SearchAnswer:
    """Answer ``request_id, query, top_k, shard_key, nprobe, page, page_size`` rows.

    Equal requests are searched once, and not at all when ``stored`` (the hits of earlier
    runs) has a result that is still alive at ``asked_at``.  ``embed_queries(df, column)``
    adds ``embedding`` and ``embed_status``.  With ``rerank_factor`` above 1 a quantised index
    yields that many times k candidates, which the vectors of ``source`` then put in order.
    """
    asked_at = asked_at or datetime.now(timezone.utc).replace(tzinfo=None)
    asked = F.lit(asked_at.isoformat(sep=" ")).cast("timestamp_ntz")
    valid, rejected = prepare_requests(requests, default_shard)
    known = F.col("shard_key").isin(index.shards)
    unknown, valid = valid.filter(~known), valid.filter(known)
    first = F.min_by(F.struct("query", "top_k", "nprobe", "shard_key"), "request_id")
    wanted = valid.groupBy("result_key").agg(first.alias("r")).select("result_key", "r.*")
    reused = None
    if stored is not None:
        oldest = F.lit((asked_at - timedelta(seconds=ttl_seconds)).isoformat(sep=" "))
        alive = (F.col("filled_at") > oldest.cast("timestamp_ntz")) & (F.col("filled_at") <= asked)
        reused = stored.filter(alive).join(wanted.select("result_key"), "result_key", "left_semi")
        # Of several fills that are alive the newest counts.
        newest = reused.groupBy("result_key").agg(F.max("filled_at").alias("_newest"))
        reused = materialize(
            reused.join(newest, "result_key").filter(F.col("filled_at") == F.col("_newest")).drop("_newest"),
            "reused",
        )
        wanted = wanted.join(reused.select("result_key"), "result_key", "left_anti")

    embedded = embed_queries(wanted, "query").withColumn("shards", F.array("shard_key"))
    vector = l2_normalize("embedding") if index.normalized else F.col("embedding")
    reason = F.when(F.col("embed_status") != "ok", F.concat(F.lit("embedding "), "embed_status")).when(
        ~F.coalesce(F.size("query_vector") == index.dim, F.lit(False)),
        F.concat(F.lit("dimension "), F.coalesce(F.size("query_vector"), F.lit(0)), F.lit(f" is not {index.dim}")),
    )
    # Encoded once, then read by both probing and scanning.
    queries = embedded.withColumn("query_vector", vector).withColumn("reason", reason)
    queries = queries.select("result_key", "top_k", "nprobe", "shards", "query_vector", "reason")
    queries = materialize(queries, "queries")
    unusable = queries.filter("reason IS NOT NULL").select("result_key", F.array("reason").alias("reasons"))
    failed = valid.select("request_id", "result_key").join(unusable, "result_key").drop("result_key")
    rejected = rejected.unionByName(requests.join(failed, "request_id"))
    queries = queries.filter("reason IS NULL").drop("reason")
    n_queries, k = queries.agg(F.count(F.lit(1)), F.max("top_k")).first()
    k = k or DEFAULT_TOP_K
    names = dict(id_col=id_col, query_cols=["result_key"], shards_col="shards")
    if index.codebooks is None:
        found = ivf_flat_search(
            index.postings, index.centroids, queries, k, "nprobe", vec_col=vec_col, **names
        )
    else:
        wide = k * rerank_factor if source is not None else k
        found = ivfpq_search(
            index.postings, index.centroids, index.codebooks, queries, wide, "nprobe", **names
        )
        if wide > k:
            vector = l2_normalize(vec_col) if index.normalized else F.col(vec_col)
            found = rerank(
                found, source.select(id_col, vector.alias(vec_col)), queries, k, id_col, vec_col,
                ["result_key"], max_hits=n_queries * wide,
            )
    hits = limit_per_request(found, queries, "result_key", "top_k")
    if source is not None and metadata_cols:
        hits = attach_metadata(hits, source, id_col, metadata_cols, max_hits=n_queries * k)
    # Searched once: pages and later runs read the written result.
    hits = materialize(hits.withColumn("filled_at", asked), "hits")
    used = queries.select("result_key", F.lit(False).alias("cache_hit"))
    if reused is not None:
        hits = hits.unionByName(reused)
        kept = reused.select("result_key").distinct().withColumn("cache_hit", F.lit(True))
        used = used.unionByName(kept)
    pages = page_hits(hits, valid, ["result_key"], ["request_id"])
    answered = valid.join(used, "result_key").select(
        "request_id", "query_hash", "shard_key", "top_k", "nprobe", "cache_hit"
    )
    return SearchAnswer(rejected, unknown, hits, pages, answered)
