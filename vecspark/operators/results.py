"""Hits to answers: metadata, pages and stored JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Hits up to this size may be broadcast to the source they are looked up in.
MAX_BROADCAST_BYTES = 64 << 20


def small_side(hits: DataFrame, max_hits: int | None) -> DataFrame:
    """``hits``, with a broadcast hint if their number and their columns bound their size.

    Texts and lists have no such bound; then Spark decides by the size that it finds.
    """
    kinds = [f.dataType for f in hits.schema.fields]
    fixed = all(isinstance(k, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)) for k in kinds)
    # Sixteen bytes hold the widest of these types; a row and its place in the hash table take 64 more.
    if max_hits is not None and fixed and max_hits * (64 + 16 * len(kinds)) <= MAX_BROADCAST_BYTES:
        return F.broadcast(hits)
    return hits


def attach_metadata(
    hits: DataFrame,
    source: DataFrame,
    id_col: str,
    columns: Sequence[str],
    max_hits: int | None = None,
) -> DataFrame:
    """Add source columns to each hit by its id.

    ``max_hits`` is the caller's bound (queries times k); within the broadcast limit the
    source is then not shuffled.
    """
    return source.select(id_col, *columns).join(small_side(hits, max_hits), id_col)


def with_metadata_map(df: DataFrame, columns: Sequence[str], out_col: str = "metadata") -> DataFrame:
    """Columns as one map of strings."""
    pairs = [part for c in columns for part in (F.lit(c), F.col(c).cast("string"))]
    return df.withColumn(out_col, F.create_map(*pairs) if pairs else F.create_map())


def page_hits(
    hits: DataFrame,
    requests: DataFrame,
    query_cols: Sequence[str],
    request_cols: Sequence[str] = (),
) -> DataFrame:
    """The hits on the requested page of each request (columns ``page``, ``page_size``).

    Adds ``total_results`` and ``has_next``.  ``hits`` hold the full top-k with ``rank``
    from 1, so every page comes from the same result.  Several requests may share a result;
    ``request_cols`` tell them apart.
    """
    total = F.count(F.lit(1)).over(Window.partitionBy(*query_cols))
    skip = (F.col("page") - 1) * F.col("page_size")
    return (
        hits.withColumn("total_results", total)
        .join(requests.select(*query_cols, *request_cols, "page", "page_size"), list(query_cols))
        .filter((F.col("rank") > skip) & (F.col("rank") <= skip + F.col("page_size")))
        .withColumn("has_next", F.col("total_results") > skip + F.col("page_size"))
    )


def results_json(
    hits: DataFrame, query_cols: Sequence[str], id_col: str, score_col: str = "distance"
) -> DataFrame:
    """One row per request with its hits, best first, as a JSON array; k bounds its length."""
    hit = F.struct("rank", F.col(id_col).alias("id"), F.col(score_col).alias("score"))
    ordered = F.transform(
        F.array_sort(F.collect_list(hit)), lambda h: F.struct(h["id"].alias("id"), h["score"].alias("score"))
    )
    return hits.groupBy(*query_cols).agg(
        F.count(F.lit(1)).alias("total_results"), F.to_json(ordered).alias("results_json")
    )
