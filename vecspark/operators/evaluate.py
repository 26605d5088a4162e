"""Recall, parameter sweeps and comparison of variants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.functions.statistics import two_sided_p

from vecspark.operators.ivf import ivf_flat_search, probe_cells


def recall_at_k(
    exact: DataFrame, approximate: DataFrame, query_cols: Sequence[str], id_col: str
) -> DataFrame:
    """Share of the exact hits of each query that the approximate search also found."""
    found = approximate.select(*query_cols, id_col, F.lit(1).alias("_found"))
    return (
        exact.join(found, [*query_cols, id_col], "left")
        .groupBy(*query_cols)
        .agg(F.count("_found").alias("matched"), F.count(F.lit(1)).alias("expected"))
        .withColumn("recall", F.col("matched") / F.col("expected"))
    )


def sweep_nprobe(
    postings: DataFrame,
    centroids: DataFrame,
    queries: DataFrame,
    exact: DataFrame,
    k: int,
    nprobes: Sequence[int],
    id_col: str = "id",
    vec_col: str = "embedding",
    query_col: str = "query_id",
    query_vec_col: str = "query_vector",
) -> DataFrame:
    """Mean recall and scanned fraction per nprobe; all variants share one pass over the index."""
    variants = queries.select(
        query_col, query_vec_col, F.explode(F.array(*[F.lit(n) for n in nprobes])).alias("nprobe")
    )
    hits = ivf_flat_search(
        postings, centroids, variants, k, "nprobe", id_col=id_col, vec_col=vec_col,
        query_cols=["nprobe", query_col], query_vec_col=query_vec_col,
    )
    expected = exact.select(
        query_col, id_col, F.explode(F.array(*[F.lit(n) for n in nprobes])).alias("nprobe")
    )
    recall = recall_at_k(expected, hits, ["nprobe", query_col], id_col)
    recall = recall.groupBy("nprobe").agg(
        F.avg("recall").alias("recall"), F.count(F.lit(1)).alias("n_queries")
    )
    sizes = postings.groupBy("cell").agg(F.count(F.lit(1)).alias("_rows"))
    probed = probe_cells(variants, centroids, "nprobe", query_vec_col)
    scanned = (
        probed.select("nprobe", F.explode("cells").alias("cell"))
        .join(sizes, "cell")
        .groupBy("nprobe")
        .agg(F.sum("_rows").alias("_scanned"))
    )
    total = sizes.agg(F.sum("_rows"))
    return recall.join(scanned, "nprobe").select(
        "nprobe",
        "n_queries",
        "recall",
        (F.col("_scanned") / F.col("n_queries") / total.scalar()).alias("scanned_fraction"),
    )


def variant_stats(df: DataFrame, variant_col: str, value_col: str) -> DataFrame:
    return df.groupBy(F.col(variant_col).alias("variant")).agg(
        F.count(value_col).alias("n"),
        F.avg(value_col).alias("mean"),
        F.var_samp(value_col).alias("variance"),
    )


def _against_baseline(df: DataFrame, variant_col: str, value_col: str, baseline: str) -> DataFrame:
    stats = variant_stats(df, variant_col, value_col)
    base = stats.filter(F.col("variant") == baseline).select(
        F.struct("n", "mean", "variance").alias("base")
    )
    return stats.filter(F.col("variant") != baseline).withColumn("base", base.scalar())


def welch_t(df: DataFrame, variant_col: str, value_col: str, baseline: str) -> DataFrame:
    """Welch's t and its degrees of freedom of each variant against the baseline."""
    a, b = F.col("variance") / F.col("n"), F.col("base.variance") / F.col("base.n")
    spread = a * a / (F.col("n") - 1) + b * b / (F.col("base.n") - 1)
    difference = F.col("mean") - F.col("base.mean")
    return _against_baseline(df, variant_col, value_col, baseline).select(
        "variant",
        F.when(a + b > 0, difference / F.sqrt(a + b)).alias("t"),
        F.when(spread > 0, (a + b) * (a + b) / spread).alias("degrees_of_freedom"),
    )


def ab_significance(
    df: DataFrame, variant_col: str, value_col: str, baseline: str, level: float = 0.01
) -> DataFrame:
    """Welch's test with ``p_value``, two-sided, and ``significant``, whether it is below the level."""
    p = two_sided_p(F.col("t"), F.col("degrees_of_freedom"))
    tests = welch_t(df, variant_col, value_col, baseline).withColumn("p_value", p)
    return tests.withColumn("significant", F.col("p_value") < level)


def variant_delta(df: DataFrame, variant_col: str, value_col: str, baseline: str) -> DataFrame:
    """Relative change of the mean of each variant against the baseline."""
    base = F.col("base.mean")
    return _against_baseline(df, variant_col, value_col, baseline).select(
        "variant",
        "mean",
        base.alias("baseline_mean"),
        F.when(base != 0, (F.col("mean") - base) / base).alias("relative_change"),
    )
