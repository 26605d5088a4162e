"""Request-log measurement: percentiles, rates, objectives and alerts.

The windowed functions also run on a stream that carries a watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecspark.sources.workspace import materialize

# Bounds of latency histograms and bands (ms), and service objectives.
HISTOGRAM_BOUNDS = (5, 10, 25, 50, 75, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10000)
BAND_BOUNDS = (250, 2500, 5000)
AVAILABILITY_TARGET = 0.999
BURN_RATES = {"P0": 36.0, "P1": 14.4, "P2": 5.0}
INCIDENT_LIMITS = {
    "breaker_minutes": 5.0,
    "p99_critical": 1000.0,
    "error_rate": 0.05,
    "hit_rate": 0.70,
    "p99_high": 500.0,
    "p99_minutes": 10.0,
}
PERMIT_LIMIT = 100
QUEUE_LIMIT = 50


def _cut(values: DataFrame, bins: int, out_col: str) -> DataFrame:
    """Number the values by bins of about equal size; equal values share a bin."""
    cuts = [i / bins for i in range(1, bins)]
    edges = values.approxQuantile("v", cuts, 0.5 / bins) if cuts else []
    splits = [-float("inf"), *sorted(set(edges)), float("inf")]
    if len(splits) == 2:
        return values.withColumn(out_col, F.lit(0.0))
    return Bucketizer(splits=splits, inputCol="v", outputCol=out_col).transform(values)


def _ranks(counts: DataFrame, probs: Sequence[float]) -> DataFrame:
    """The two neighbouring ranks (side 0 and 1) of each percentile of each group."""
    position = (F.col("total") - 1) * F.col("p")
    return (
        counts.groupBy("g")
        .agg(F.sum("n").alias("total"), (F.sum("s") / F.sum("n")).alias("mean"))
        .withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("share", position - F.floor(position))
        .select(
            "g", "mean", "p", "share",
            F.posexplode(F.array(F.floor(position), F.ceil(position))).alias("side", "rank"),
        )
    )


def exact_percentiles(
    df: DataFrame,
    group_col: str,
    value_col: str,
    probs: Sequence[float],
    bins: int = 1024,
    max_ranked_rows: int = 5_000_000,
    max_levels: int = 4,
) -> DataFrame:
    """Linear-interpolation percentiles ``p50``... and ``mean`` per group, exact at any size.

    Approximate quantiles only choose bin edges.  Exact bin counts then say in which bins the
    wanted ranks lie, and only those bins are cut again until they are small.  The values left
    are counted before they are ranked, so copies of one value are one row.  Neither a hot
    group nor the number of values is held in one task.  The null group is a group like
    others, and a group without any value has null results.
    """
    # Within a struct a null equals a null, also in joins.
    group = F.struct(F.col(group_col).alias("k")).alias("g")
    # Two columns, written once and read at every level; a constant group is a column like others.
    pairs = materialize(df.select(group, F.col(value_col).cast("double").alias("v")), "values")
    values = pairs.filter(F.col("v").isNotNull() & ~F.isnan("v"))
    keys, wanted = ["g"], None
    for level in range(max_levels):
        bin_col = f"b{level}"
        binned = _cut(values, bins, bin_col)
        earlier = (
            Window.partitionBy(*keys).orderBy(bin_col).rowsBetween(Window.unboundedPreceding, -1)
        )
        counts = (
            binned.groupBy(*keys, bin_col)
            .agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
            .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        )
        if wanted is None:
            wanted = _ranks(counts, probs)
        located = (
            wanted.join(counts.drop("s"), keys)
            .filter(F.col("rank").between(F.col("before"), F.col("before") + F.col("n") - 1))
            .withColumn("rank", F.col("rank") - F.col("before"))
            .drop("before")
        )
        # Two rows per group and percentile; written so that Catalyst knows its size.
        wanted = materialize(located, "ranks")
        keys.append(bin_col)
        values = binned.join(wanted.select(*keys).distinct(), keys, "left_semi")
        largest = wanted.agg(F.max("n")).first()[0] or 0
        wanted = wanted.drop("n")
        if largest <= max_ranked_rows:
            break

    running = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        values.groupBy(*keys, "v")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("upto", F.sum("copies").over(running))
    )
    here = (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("copies"))
    low = F.max(F.when(F.col("side") == 0, F.col("v")))
    high = F.max(F.when(F.col("side") == 1, F.col("v")))
    found = (
        ranked.join(wanted, keys)
        .filter(here)
        .groupBy("g", "p")
        .agg(F.max("mean").alias("mean"), (low + (high - low) * F.max("share")).alias("q"))
    )
    columns = [F.max(F.when(F.col("p") == p, F.col("q"))).alias(percentile_name(p)) for p in probs]
    found = found.groupBy("g").agg(F.max("mean").alias("mean"), *columns)
    groups = pairs.select("g").distinct()
    return groups.join(found, "g", "left").select(
        F.col("g.k").alias(group_col), *[c for c in found.columns if c != "g"]
    )


def percentile_name(p: float) -> str:
    return "p" + f"{p * 100:g}".replace(".", "_")


def dataset_stats(df: DataFrame, shard: Column, distance_col: str) -> DataFrame:
    return df.groupBy(shard.alias("shard_key")).agg(
        F.count(F.lit(1)).alias("row_count"), F.avg(distance_col).alias("avg_distance")
    )


def throughput(df: DataFrame, group_col: str, seconds: Column) -> DataFrame:
    """Requests per second between the first and the last request of each group."""
    elapsed = F.max(seconds) - F.min(seconds)
    requests = F.count(F.lit(1))
    return df.groupBy(group_col).agg(
        requests.alias("requests"),
        elapsed.alias("elapsed_seconds"),
        F.when(elapsed > 0, requests / elapsed).alias("requests_per_second"),
    )


def hit_rate(df: DataFrame, group_col: str, hit: Column) -> DataFrame:
    hits, misses = F.count_if(hit), F.count_if(~hit)
    return df.groupBy(group_col).agg(
        hits.alias("hits"),
        misses.alias("misses"),
        F.when(hits + misses > 0, hits / (hits + misses)).alias("hit_rate"),
    )


def error_ratio(
    df: DataFrame, ts_col: str, is_error: Column, width: str = "5 minutes", slide: str | None = None
) -> DataFrame:
    """Requests, errors and their ratio per window; windows overlap when ``slide`` is shorter."""
    requests, errors = F.count(F.lit(1)), F.count_if(is_error)
    return (
        df.groupBy(F.window(ts_col, width, slide).alias("w"))
        .agg(
            requests.alias("requests"),
            errors.alias("errors"),
            (errors / requests).alias("error_ratio"),
        )
        .select(F.col("w.start").alias("window_start"), "requests", "errors", "error_ratio")
    )


def histogram_quantile(
    df: DataFrame,
    group_col: str,
    value_col: str,
    q: float,
    bounds: Sequence[float] = HISTOGRAM_BOUNDS,
) -> DataFrame:
    """Quantile read from bucket counts, linear inside a bucket.

    A bucket holds values up to and including its bound.  Ranks beyond the last bound return
    that bound.
    """
    bucket = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        bucket = F.when(F.col(value_col) <= bounds[i], F.lit(i)).otherwise(bucket)
    uppers = F.array(*[F.lit(float(b)) for b in bounds])
    by_group = Window.partitionBy(group_col)
    running = by_group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    counts = (
        df.filter(F.col(value_col).isNotNull())
        .groupBy(group_col, bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(running))
        .withColumn("rank", F.sum("n").over(by_group) * F.lit(q))
        .filter(F.col("upto") >= F.col("rank"))
    )
    first = counts.groupBy(group_col).agg(F.min(F.struct("bucket", "n", "upto", "rank")).alias("b"))
    at = F.col("b.bucket")
    upper = F.get(uppers, at)
    lower = F.when(at == 0, F.lit(0.0)).otherwise(F.get(uppers, at - 1))
    inside = lower + (upper - lower) * (F.col("b.rank") - (F.col("b.upto") - F.col("b.n"))) / F.col("b.n")
    value = F.when(at == len(bounds), F.lit(float(bounds[-1]))).otherwise(
        F.when((at == 0) & (upper <= 0), upper).otherwise(inside)
    )
    return first.select(group_col, value.alias("quantile"))


def latency_bands(df: DataFrame, value_col: str, bounds: Sequence[float] = BAND_BOUNDS) -> DataFrame:
    """Requests per latency band and their share of all requests."""
    band = F.lit(f"above_{bounds[-1]:g}")
    for bound in reversed(bounds):
        band = F.when(F.col(value_col) <= bound, F.lit(f"upto_{bound:g}")).otherwise(band)
    counts = df.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("requests"))
    everything = F.sum("requests").over(Window.partitionBy())
    return counts.withColumn("share", F.col("requests") / everything)


def threshold_verdicts(metrics: DataFrame, limits: dict[str, tuple[str, float]]) -> DataFrame:
    """One row per metric of a one-row table: value, limit and whether it passes.

    ``limits`` maps a column to ``("<", limit)`` or ``(">", limit)``.
    """
    rows = []
    for name, (sign, limit) in limits.items():
        value = F.col(name).cast("double")
        passes = value < limit if sign == "<" else value > limit
        rows.append(
            F.struct(
                F.lit(name).alias("metric"),
                value.alias("value"),
                F.lit(float(limit)).alias("threshold"),
                F.coalesce(passes, F.lit(False)).alias("passed"),
            )
        )
    return metrics.select(F.explode(F.array(*rows)).alias("v")).select("v.*")


def slo_burn_rate(
    df: DataFrame,
    ts_col: str,
    is_error: Column,
    width: str,
    window_minutes: float,
    target: float = AVAILABILITY_TARGET,
) -> DataFrame:
    """Availability, error budget in minutes, burn rate and its alert level per window."""
    burn = F.col("error_ratio") / F.lit(1 - target)
    level = F.lit("none")
    for name, rate in sorted(BURN_RATES.items(), key=lambda item: item[1]):
        level = F.when(F.col("burn_rate") >= rate, F.lit(name)).otherwise(level)
    return (
        error_ratio(df, ts_col, is_error, width)
        .withColumn("availability", 1 - F.col("error_ratio"))
        .withColumn("budget_minutes", F.lit((1 - target) * window_minutes))
        .withColumn("burn_rate", burn)
        .withColumn("burn_level", level)
        .drop("error_ratio")
    )


def every_window(windows: DataFrame, start_col: str, width: str) -> DataFrame:
    """The windows with a row for each that is missing between the first and the last, its other
    columns null."""
    span = windows.agg(F.min(start_col).alias("a"), F.max(start_col).alias("b"))
    starts = span.select(F.explode(F.sequence("a", "b", F.expr(f"interval {width}"))).alias(start_col))
    return starts.join(windows, start_col, "left")


def breach_minutes(start_col: str, breach: Column, window_minutes: float, series_cols: Sequence[str] = ()) -> Column:
    """How long a breach has lasted at the end of each window: 0 where it doesn't breach.

    For tables with a row for every window (``every_window``), one time line a series.  A breach
    that is null counts as none.
    """
    breaching = F.coalesce(breach, F.lit(False)).cast("int")
    by_time = Window.partitionBy(*series_cols).orderBy(start_col)
    place = F.row_number().over(by_time)
    calm = F.max(F.when(breaching == 0, place)).over(by_time)
    return breaching * (place - F.coalesce(calm, F.lit(0))) * window_minutes


def incident_severity(
    windows: DataFrame,
    available: Column,
    breaker_minutes: Column,
    p99: Column,
    p99_minutes: Column,
    error_rate: Column,
    hit_rate_: Column,
    limits: dict[str, float] | None = None,
) -> DataFrame:
    """Severity of each window: the first of the rules P0 to P3 that applies.

    A rule over a null doesn't apply.  ``limits`` replaces single values of ``INCIDENT_LIMITS``.
    """
    at = {**INCIDENT_LIMITS, **(limits or {})}
    if len(at) > len(INCIDENT_LIMITS):
        raise ValueError(f"unknown limits: {sorted(at.keys() - INCIDENT_LIMITS.keys())}")
    p0 = ~available | (breaker_minutes > at["breaker_minutes"])
    p1 = (p99 > at["p99_critical"]) | (error_rate > at["error_rate"])
    p2 = (hit_rate_ < at["hit_rate"]) | ((p99 > at["p99_high"]) & (p99_minutes > at["p99_minutes"]))
    p3 = error_rate > 0
    severity = (
        F.when(p0, "P0").when(p1, "P1").when(p2, "P2").when(p3, "P3").otherwise("none")
    )
    return windows.withColumn("severity", severity)


def sliding_rate(
    df: DataFrame, ts_col: str, group_col: str, width: str, slide: str, width_seconds: int
) -> DataFrame:
    """Requests per second in overlapping windows."""
    requests = F.count(F.lit(1))
    return (
        df.groupBy(F.window(ts_col, width, slide).alias("w"), group_col)
        .agg(requests.alias("requests"), (requests / F.lit(width_seconds)).alias("rate"))
        .select(F.col("w.start").alias("window_start"), group_col, "requests", "rate")
    )


def admission_windows(
    df: DataFrame,
    ts_col: str,
    width: str = "10 seconds",
    permits: int = PERMIT_LIMIT,
    queue: int = QUEUE_LIMIT,
) -> DataFrame:
    """Requests admitted, queued and rejected per fixed window.

    Each window stands alone: its queue is not carried into the next one.
    """
    n, zero = F.col("requests"), F.lit(0)
    return (
        df.groupBy(F.window(ts_col, width).alias("w"))
        .agg(F.count(F.lit(1)).alias("requests"))
        .select(
            F.col("w.start").alias("window_start"),
            "requests",
            F.least(n, F.lit(permits)).alias("admitted"),
            F.least(F.greatest(n - permits, zero), F.lit(queue)).alias("queued"),
            F.greatest(n - permits - queue, zero).alias("rejected"),
        )
    )


def failure_breach(
    df: DataFrame,
    ts_col: str,
    is_failure: Column,
    width: str = "10 seconds",
    min_calls: int = 5,
    min_ratio: float = 0.5,
) -> DataFrame:
    """Windows with enough calls of which at least the given share failed."""
    calls, failures = F.count(F.lit(1)), F.count_if(is_failure)
    return (
        df.groupBy(F.window(ts_col, width).alias("w"))
        .agg(calls.alias("calls"), failures.alias("failures"))
        .filter((F.col("calls") >= min_calls) & (F.col("failures") / F.col("calls") >= min_ratio))
        .select(F.col("w.start").alias("window_start"), "calls", "failures")
    )


def sustained_alerts(
    windows: DataFrame,
    series_col: str,
    start_col: str,
    breach: Column,
    width: str,
    hold_windows: int,
) -> DataFrame:
    """Runs of consecutive breaching windows long enough to fire.

    ``windows`` hold one row per series and window; a missing window ends a run.
    """
    by_time = Window.partitionBy(series_col).orderBy(start_col)
    width_interval = F.expr(f"interval {width}")
    previous = F.lag(start_col).over(by_time)
    starts_run = previous.isNull() | (previous + width_interval != F.col(start_col))
    return (
        windows.filter(breach)
        .withColumn("_starts", starts_run.cast("int"))
        .withColumn(
            "_run", F.sum("_starts").over(by_time.rowsBetween(Window.unboundedPreceding, 0))
        )
        .groupBy(series_col, "_run")
        .agg(
            F.min(start_col).alias("breach_start"),
            F.max(start_col).alias("last_window"),
            F.count(F.lit(1)).alias("n_windows"),
        )
        .filter(F.col("n_windows") >= hold_windows)
        .withColumn(
            "fired_at", F.col("breach_start") + width_interval * hold_windows
        )
        .drop("_run")
    )
