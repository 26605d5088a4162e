"""Request-log measurement over ``events``: value is the latency, errors are failed requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecspark.catalog.common import Query, r6, table
from vecspark.functions.times import micros
from vecspark.operators.evaluate import ab_significance, variant_delta, welch_t
from vecspark.operators.reuse import replay_ttl
from vecspark.operators.sketches import merge_sketches, rank_errors, sketch_quantiles, window_sketches
from vecspark.operators.telemetry import (
    admission_windows,
    breach_minutes,
    error_ratio,
    every_window,
    exact_percentiles,
    failure_breach,
    histogram_quantile,
    hit_rate,
    incident_severity,
    latency_bands,
    sliding_rate,
    slo_burn_rate,
    sustained_alerts,
    threshold_verdicts,
    throughput,
)
from vecspark.sources.workspace import materialize

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TTL_HOURS = 6


def is_error():
    return F.col("event_type") == "error"


def slow_error():
    return is_error() & (F.col("value") > 150)


def events(spark, sf):
    return table(spark, sf, "events")


def q_latency_percentiles(spark, sf):
    found = exact_percentiles(events(spark, sf), "event_type", "value", [0.5, 0.95, 0.99])
    return found.select("event_type", *[r6(c).alias(c) for c in ("mean", "p50", "p95", "p99")])


QUERIES["latency_percentiles"] = q_latency_percentiles
ORACLES["latency_percentiles"] = """
SELECT event_type, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99
FROM events GROUP BY 1"""


def q_throughput(spark, sf):
    log = events(spark, sf)
    rates = throughput(log, "event_type", micros(log, "ts") / 1_000_000)
    return rates.select(
        "event_type", "requests", r6("elapsed_seconds").alias("elapsed_seconds"),
        F.round("requests_per_second", 9).alias("requests_per_second"),
    )


QUERIES["throughput"] = q_throughput
ORACLES["throughput"] = """
SELECT event_type, count(*) AS requests,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000, 6) AS elapsed_seconds,
       round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000), 9) AS requests_per_second
FROM events GROUP BY 1"""


def replayed(spark, sf):
    keyed = events(spark, sf).withColumn(
        "query_hash", F.concat_ws("|", "event_type", F.col("user_id").cast("string"))
    )
    return replay_ttl(keyed, "query_hash", "ts", "event_id", TTL_HOURS * 3600)


TTL_SQL = f"""
WITH RECURSIVE requests AS (SELECT *, event_type || '|' || user_id AS query_hash FROM events),
fills AS (
  SELECT query_hash, min(ts) AS ts FROM requests GROUP BY 1
  UNION ALL
  SELECT f.query_hash, min(r.ts) FROM fills f JOIN requests r
    ON r.query_hash = f.query_hash AND r.ts >= f.ts + INTERVAL {TTL_HOURS} HOUR
  GROUP BY f.query_hash),
misses AS (SELECT min(event_id) AS event_id FROM fills JOIN requests USING (query_hash, ts)
           GROUP BY query_hash, ts),
reused AS (SELECT r.*, m.event_id IS NULL AS cache_hit
           FROM requests r LEFT JOIN misses m USING (event_id))"""


def q_ttl_reuse(spark, sf):
    return replayed(spark, sf).select("event_id", "cache_hit")


QUERIES["ttl_reuse"] = q_ttl_reuse
ORACLES["ttl_reuse"] = f"{TTL_SQL} SELECT event_id, cache_hit FROM reused"


def q_hit_rate(spark, sf):
    rates = hit_rate(replayed(spark, sf), "event_type", F.col("cache_hit"))
    return rates.withColumn("hit_rate", r6("hit_rate"))


QUERIES["hit_rate"] = q_hit_rate
ORACLES["hit_rate"] = f"""{TTL_SQL}
SELECT event_type, count(*) FILTER (cache_hit) AS hits, count(*) FILTER (NOT cache_hit) AS misses,
       round(count(*) FILTER (cache_hit) / count(*), 6) AS hit_rate
FROM reused GROUP BY 1"""


def q_error_ratio(spark, sf):
    return error_ratio(events(spark, sf), "ts", is_error(), "1 hour").withColumn(
        "error_ratio", r6("error_ratio")
    )


QUERIES["error_ratio"] = q_error_ratio
ORACLES["error_ratio"] = """
SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start, count(*) AS requests,
       count(*) FILTER (event_type = 'error') AS errors,
       round(count(*) FILTER (event_type = 'error') / count(*), 6) AS error_ratio
FROM events GROUP BY 1"""


BOUNDS = (5, 10, 25, 50, 100, 150, 250)


def q_histogram_quantile(spark, sf):
    found = histogram_quantile(events(spark, sf), "event_type", "value", 0.99, BOUNDS)
    return found.withColumn("quantile", r6("quantile"))


QUERIES["histogram_quantile"] = q_histogram_quantile
ORACLES["histogram_quantile"] = f"""
WITH bounds AS (SELECT unnest({list(BOUNDS)}) AS upper_bound),
edges AS (SELECT upper_bound, lag(upper_bound, 1, 0) OVER (ORDER BY upper_bound) AS lower_bound FROM bounds),
totals AS (SELECT event_type, count(*) * 0.99::DOUBLE AS rank FROM events GROUP BY 1),
upto AS (
  SELECT event_type, upper_bound, lower_bound, count(*) FILTER (value <= upper_bound) AS n_upper,
         count(*) FILTER (value <= lower_bound) AS n_lower
  FROM events, edges GROUP BY 1, 2, 3),
first AS (
  SELECT u.*, rank FROM upto u JOIN totals USING (event_type) WHERE n_upper >= rank
  QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY upper_bound) = 1)
SELECT event_type, round(CASE WHEN upper_bound IS NULL THEN {BOUNDS[-1]}
         ELSE lower_bound + (upper_bound - lower_bound) * (f.rank - n_lower) / (n_upper - n_lower)
         END, 6) AS quantile
FROM totals LEFT JOIN first f USING (event_type)"""


def q_latency_bands(spark, sf):
    bands = latency_bands(events(spark, sf), "value", (25, 100, 250))
    return bands.withColumn("share", r6("share"))


QUERIES["latency_bands"] = q_latency_bands
ORACLES["latency_bands"] = """
SELECT CASE WHEN value <= 25 THEN 'upto_25' WHEN value <= 100 THEN 'upto_100'
            WHEN value <= 250 THEN 'upto_250' ELSE 'above_250' END AS band,
       count(*) AS requests, round(count(*) / (SELECT count(*) FROM events), 6) AS share
FROM events GROUP BY 1"""


def q_threshold_verdicts(spark, sf):
    everything = events(spark, sf).withColumn("everything", F.lit("all"))
    latency = exact_percentiles(everything, "everything", "value", [0.95, 0.99])
    rates = replayed(spark, sf).agg(
        F.struct(
            F.avg(is_error().cast("int")).alias("error_rate"),
            F.avg(F.col("cache_hit").cast("int")).alias("hit_rate"),
        )
    )
    metrics = latency.withColumn("rates", rates.scalar()).select("*", "rates.*")
    limits = {
        "p95": ("<", 500), "p99": ("<", 1000), "error_rate": ("<", 0.01), "hit_rate": (">", 0.7),
    }
    verdicts = threshold_verdicts(metrics, limits)
    return verdicts.withColumn("value", r6("value"))


QUERIES["threshold_verdicts"] = q_threshold_verdicts
ORACLES["threshold_verdicts"] = f"""{TTL_SQL},
metrics AS (
  SELECT quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99,
         count(*) FILTER (event_type = 'error') / count(*) AS error_rate,
         count(*) FILTER (cache_hit) / count(*) AS hit_rate FROM reused)
SELECT 'p95' AS metric, round(p95, 6) AS value, 500.0::DOUBLE AS threshold, p95 < 500 AS passed FROM metrics
UNION ALL SELECT 'p99', round(p99, 6), 1000.0, p99 < 1000 FROM metrics
UNION ALL SELECT 'error_rate', round(error_rate, 6), 0.01, error_rate < 0.01 FROM metrics
UNION ALL SELECT 'hit_rate', round(hit_rate, 6), 0.7, hit_rate > 0.7 FROM metrics"""


def hour_of(ts_col):
    return F.date_trunc("hour", ts_col).cast("timestamp_ntz")


def q_windowed_hit_rate(spark, sf):
    """Hit rate per hour, as alerts read it."""
    log = replayed(spark, sf).withColumn("window_start", hour_of("ts"))
    return hit_rate(log, "window_start", F.col("cache_hit")).withColumn("hit_rate", r6("hit_rate"))


QUERIES["windowed_hit_rate"] = q_windowed_hit_rate
ORACLES["windowed_hit_rate"] = f"""{TTL_SQL}
SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start, count(*) FILTER (cache_hit) AS hits,
       count(*) FILTER (NOT cache_hit) AS misses, round(count(*) FILTER (cache_hit) / count(*), 6) AS hit_rate
FROM reused GROUP BY 1"""


def q_sliding_error_ratio(spark, sf):
    """Error ratio over the last hour, every quarter of an hour."""
    found = error_ratio(events(spark, sf), "ts", is_error(), "1 hour", "15 minutes")
    return found.withColumn("error_ratio", r6("error_ratio"))


QUERIES["sliding_error_ratio"] = q_sliding_error_ratio
ORACLES["sliding_error_ratio"] = """
SELECT time_bucket(INTERVAL 15 MINUTE, ts) - i * INTERVAL 15 MINUTE AS window_start, count(*) AS requests,
       count(*) FILTER (event_type = 'error') AS errors,
       round(count(*) FILTER (event_type = 'error') / count(*), 6) AS error_ratio
FROM events, (SELECT unnest(range(4)) AS i) GROUP BY 1"""


def q_windowed_quantile(spark, sf):
    """Histogram quantile of the latency per day."""
    log = events(spark, sf).withColumn("window_start", day_of("ts"))
    found = histogram_quantile(log, "window_start", "value", 0.95, BOUNDS)
    return found.withColumn("quantile", r6("quantile"))


QUERIES["windowed_quantile"] = q_windowed_quantile
ORACLES["windowed_quantile"] = (
    ORACLES["histogram_quantile"]
    .replace("FROM events", "FROM (SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, value FROM events) e")
    .replace("event_type", "window_start")
    .replace("0.99", "0.95")
)


def q_slo_burn_rate(spark, sf):
    burn = slo_burn_rate(events(spark, sf), "ts", slow_error(), "1 day", 1440)
    rounded = {c: r6(c) for c in ("availability", "budget_minutes", "burn_rate")}
    return burn.withColumns(rounded)


QUERIES["slo_burn_rate"] = q_slo_burn_rate
ORACLES["slo_burn_rate"] = """
WITH days AS (
  SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, count(*) AS requests,
         count(*) FILTER (event_type = 'error' AND value > 150) AS errors FROM events GROUP BY 1),
rates AS (SELECT *, errors / requests AS ratio, errors / requests / (1 - 0.999::DOUBLE) AS burn FROM days)
SELECT window_start, requests, errors, round(1 - ratio, 6) AS availability,
       round((1 - 0.999::DOUBLE) * 1440, 6) AS budget_minutes, round(burn, 6) AS burn_rate,
       CASE WHEN burn >= 36 THEN 'P0' WHEN burn >= 14.4 THEN 'P1' WHEN burn >= 5 THEN 'P2'
            ELSE 'none' END AS burn_level
FROM rates"""


def day_of(ts_col):
    return F.date_trunc("day", ts_col).cast("timestamp_ntz")


def hour_of(ts_col):
    return F.date_trunc("hour", ts_col).cast("timestamp_ntz")


#: What counts as an incident in this log, whose hours hold few requests and few repeated ones.
LOG_LIMITS = {
    "p99_critical": 250, "error_rate": 0.15, "hit_rate": 0.02, "p99_high": 150, "p99_minutes": 60,
}


def q_incident_severity(spark, sf):
    """Per hour, hours without a request included; breaches last from their first hour on."""
    log = materialize(replayed(spark, sf).withColumn("hour", hour_of("ts")), "replayed")
    counts = log.groupBy("hour").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(is_error()).alias("failures"),
        F.avg(slow_error().cast("int")).alias("error_rate"),
        F.avg(F.col("cache_hit").cast("int")).alias("hit_rate"),
    )
    latency = exact_percentiles(log, "hour", "value", [0.99]).drop("mean")
    hours = every_window(materialize(counts.join(latency, "hour", "left"), "hours"), "hour", "1 hour")
    opened = (F.col("requests") >= 5) & (F.col("failures") / F.col("requests") >= 0.5)
    slow = F.col("p99") > LOG_LIMITS["p99_high"]
    lasting = hours.withColumns(
        {"open_minutes": breach_minutes("hour", opened, 60), "slow_minutes": breach_minutes("hour", slow, 60)}
    )
    rated = incident_severity(
        lasting,
        available=F.coalesce("requests", F.lit(0)) > 0,
        breaker_minutes=F.col("open_minutes"),
        p99=F.col("p99"),
        p99_minutes=F.col("slow_minutes"),
        error_rate=F.col("error_rate"),
        hit_rate_=F.col("hit_rate"),
        limits=LOG_LIMITS,
    )
    return rated.select(
        "hour", *[r6(c).alias(c) for c in ("error_rate", "hit_rate", "p99")], "open_minutes", "slow_minutes", "severity"
    )


QUERIES["incident_severity"] = q_incident_severity
ORACLES["incident_severity"] = f"""{TTL_SQL},
found AS (
  SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, count(*) AS n, count(*) FILTER (event_type = 'error') AS failures,
         count(*) FILTER (event_type = 'error' AND value > 150) / count(*) AS error_rate,
         count(*) FILTER (cache_hit) / count(*) AS hit_rate, quantile_cont(value, 0.99) AS p99
  FROM reused GROUP BY 1),
spine AS (SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM found),
marked AS (
  SELECT *, coalesce(n >= 5 AND failures / n >= 0.5, FALSE)::INT AS opened, coalesce(p99 > 150, FALSE)::INT AS slow
  FROM spine LEFT JOIN found USING (hour)),
runs AS (SELECT *, sum(1 - opened) OVER (ORDER BY hour) AS a, sum(1 - slow) OVER (ORDER BY hour) AS b FROM marked),
lasting AS (
  SELECT *, (60 * sum(opened) OVER (PARTITION BY a ORDER BY hour))::INT AS open_minutes,
         (60 * sum(slow) OVER (PARTITION BY b ORDER BY hour))::INT AS slow_minutes
  FROM runs)
SELECT hour, round(error_rate, 6) AS error_rate, round(hit_rate, 6) AS hit_rate, round(p99, 6) AS p99,
       open_minutes, slow_minutes,
       CASE WHEN n IS NULL OR open_minutes > 5 THEN 'P0' WHEN p99 > 250 OR error_rate > 0.15 THEN 'P1'
            WHEN hit_rate < 0.02 OR (p99 > 150 AND slow_minutes > 60) THEN 'P2' WHEN error_rate > 0 THEN 'P3'
            ELSE 'none' END AS severity
FROM lasting"""


def q_ab_welch_t(spark, sf):
    tests = welch_t(events(spark, sf), "event_type", "value", baseline="click")
    return tests.select(
        "variant", r6("t").alias("t"), F.round("degrees_of_freedom", 4).alias("degrees_of_freedom")
    )


STATS_SQL = """
WITH stats AS (SELECT event_type AS variant, count(*) AS n, avg(value) AS mean,
                      var_samp(value) / count(*) AS v FROM events GROUP BY 1),
base AS (SELECT n AS n0, mean AS mean0, v AS v0 FROM stats WHERE variant = 'click')"""

QUERIES["ab_welch_t"] = q_ab_welch_t
ORACLES["ab_welch_t"] = f"""{STATS_SQL}
SELECT variant, round((mean - mean0) / sqrt(v + v0), 6) AS t,
       round((v + v0) * (v + v0) / (v * v / (n - 1) + v0 * v0 / (n0 - 1)), 4) AS degrees_of_freedom
FROM stats, base WHERE variant <> 'click'"""


def q_ab_significance(spark, sf):
    tests = ab_significance(events(spark, sf), "event_type", "value", baseline="click")
    return tests.select("variant", r6("p_value").alias("p_value"), "significant")


# The area of the t density beyond |t|, as t = sqrt(v) tan(w), by Simpson's rule.
QUERIES["ab_significance"] = q_ab_significance
ORACLES["ab_significance"] = f"""{STATS_SQL},
tests AS (
  SELECT variant, abs(mean - mean0) / sqrt(v + v0) AS t,
         (v + v0) * (v + v0) / (v * v / (n - 1) + v0 * v0 / (n0 - 1)) AS df
  FROM stats, base WHERE variant <> 'click'),
areas AS (
  SELECT variant, any_value(df) AS df, any_value(pi() / 2 - atan(t / sqrt(df))) / 60000 AS h,
         sum(CASE WHEN i IN (0, 60000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
             * pow(greatest(cos(atan(t / sqrt(df)) + i * (pi() / 2 - atan(t / sqrt(df))) / 60000), 0), df - 1)) AS s
  FROM tests, range(60001) AS u(i) GROUP BY 1),
p AS (SELECT variant, 2 * h / 3 * s * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(pi()) AS p FROM areas)
SELECT variant, round(p, 6) AS p_value, p < 0.01 AS significant FROM p"""


def q_sketch_percentiles(spark, sf):
    """Hourly sketches, stored, then merged by type; held to the ranks in the log."""
    log = events(spark, sf)
    hours = materialize(window_sketches(log, "ts", ["event_type"], "value", "1 hour"), "sketches")
    quantiles = sketch_quantiles(merge_sketches(hours, ["event_type"]), [0.5, 0.95, 0.99])
    errors = rank_errors(log, "event_type", "value", materialize(quantiles, "quantiles"))
    return errors.select("event_type", "p", "n", (F.col("rank_error") <= 0.02).alias("accurate"))


QUERIES["sketch_percentiles"] = q_sketch_percentiles
ORACLES["sketch_percentiles"] = """
SELECT event_type, p, count(value) AS n, TRUE AS accurate
FROM events, (SELECT unnest([0.5, 0.95, 0.99])::DOUBLE AS p) GROUP BY 1, 2"""


def q_variant_delta(spark, sf):
    deltas = variant_delta(events(spark, sf), "event_type", "value", baseline="click")
    rounded = {c: r6(c) for c in ("mean", "baseline_mean", "relative_change")}
    return deltas.withColumns(rounded)


QUERIES["variant_delta"] = q_variant_delta
ORACLES["variant_delta"] = f"""{STATS_SQL}
SELECT variant, round(mean, 6) AS mean, round(mean0, 6) AS baseline_mean,
       round((mean - mean0) / mean0, 6) AS relative_change
FROM stats, base WHERE variant <> 'click'"""


def q_sliding_rate(spark, sf):
    rates = sliding_rate(events(spark, sf), "ts", "event_type", "1 hour", "15 minutes", 3600)
    return rates.withColumn("rate", r6("rate"))


QUERIES["sliding_rate"] = q_sliding_rate
ORACLES["sliding_rate"] = """
SELECT time_bucket(INTERVAL 15 MINUTE, ts) - i * INTERVAL 15 MINUTE AS window_start, event_type,
       count(*) AS requests, round(count(*) / 3600, 6) AS rate
FROM events, (SELECT unnest(range(4)) AS i) GROUP BY 1, 2"""


def q_admission_windows(spark, sf):
    return admission_windows(events(spark, sf), "ts", "1 hour", permits=10, queue=5)


QUERIES["admission_windows"] = q_admission_windows
ORACLES["admission_windows"] = """
WITH hours AS (SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start, count(*) AS requests
               FROM events GROUP BY 1)
SELECT window_start, requests, least(requests, 10) AS admitted,
       least(greatest(requests - 10, 0), 5) AS queued, greatest(requests - 15, 0) AS rejected
FROM hours"""


def q_failure_breach(spark, sf):
    return failure_breach(events(spark, sf), "ts", is_error(), "10 minutes", 2, 0.5)


QUERIES["failure_breach"] = q_failure_breach
ORACLES["failure_breach"] = """
SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS window_start, count(*) AS calls,
       count(*) FILTER (event_type = 'error') AS failures
FROM events GROUP BY 1
HAVING count(*) >= 2 AND count(*) FILTER (event_type = 'error') / count(*) >= 0.5"""


def q_sustained_alerts(spark, sf):
    """Latency alerts per event type: the mean of an hour stays above 45 for three hours."""
    hours = events(spark, sf).groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(
        F.avg("value").alias("mean")
    )
    hours = hours.select("event_type", F.col("w.start").alias("window_start"), "mean")
    return sustained_alerts(hours, "event_type", "window_start", F.col("mean") > 45, "1 hour", 3)


QUERIES["sustained_alerts"] = q_sustained_alerts
ORACLES["sustained_alerts"] = """
WITH hours AS (SELECT event_type, date_trunc('hour', ts)::TIMESTAMP AS h, avg(value) AS mean
               FROM events GROUP BY 1, 2),
runs AS (
  SELECT event_type, h, h - row_number() OVER (PARTITION BY event_type ORDER BY h) * INTERVAL 1 HOUR AS run
  FROM hours WHERE mean > 45)
SELECT event_type, min(h) AS breach_start, max(h) AS last_window, count(*) AS n_windows,
       min(h) + INTERVAL 3 HOUR AS fired_at
FROM runs GROUP BY event_type, run HAVING count(*) >= 3"""
