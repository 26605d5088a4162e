"""Percentiles, rates, objectives, alerts and variant statistics on small frames."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecspark.operators import evaluate, routing
from vecspark.operators import results as rs
from vecspark.operators import telemetry as tm

START = datetime(2024, 1, 1)


def calls(spark, rows):
    data = [(START + timedelta(seconds=s), failed) for s, failed in rows]
    return spark.createDataFrame(data, "ts timestamp_ntz, failed boolean")


@pytest.mark.parametrize("bins, max_ranked_rows", [(1, 10_000), (7, 20), (256, 10_000)])
def test_percentiles_match_numpy(spark, bins, max_ranked_rows):
    rng = np.random.default_rng(3)
    groups = {
        "hot": np.r_[np.full(1500, 4.5), rng.exponential(50, 1500)],
        "wide": rng.normal(0, 1e6, 200),
        "pair": np.array([1.0, 2.0]),
        "one": np.array([7.0]),
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    rows += [("hot", None), ("hot", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    probs = [0.0, 0.5, 0.95, 0.99, 0.999, 1.0]
    found = {r.g: r for r in tm.exact_percentiles(df, "g", "v", probs, bins, max_ranked_rows).collect()}
    assert set(found) == set(groups)
    for g, values in groups.items():
        assert found[g]["mean"] == pytest.approx(values.mean())
        for p in probs:
            expected = np.percentile(values, p * 100)
            assert found[g][tm.percentile_name(p)] == pytest.approx(expected, rel=1e-12, abs=1e-9)


def test_histogram_quantile_edges(spark):
    rows = [("a", 1.0)] * 5 + [("a", 15.0)] * 5 + [("b", 99.0)] * 4 + [("c", 20.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = {r.g: r.quantile for r in tm.histogram_quantile(df, "g", "v", 0.75, (10, 20, 50)).collect()}
    assert found["a"] == pytest.approx(15.0)
    assert found["b"] == 50.0
    assert found["c"] == pytest.approx(17.5)
    low = tm.histogram_quantile(df.filter("g = 'a'"), "g", "v", 0.25, (10, 20)).first()
    assert low.quantile == pytest.approx(5.0)


def test_bands_and_verdicts(spark):
    df = spark.createDataFrame([(250.0,), (251.0,), (2500.0,), (6000.0,)], "v double")
    shares = {r.band: (r.requests, r.share) for r in tm.latency_bands(df, "v").collect()}
    assert shares == {"upto_250": (1, 0.25), "upto_2500": (2, 0.5), "above_5000": (1, 0.25)}
    metrics = spark.createDataFrame([(499.0, 0.01, None)], "p95 double, err double, hit double")
    limits = {"p95": ("<", 500), "err": ("<", 0.01), "hit": (">", 0.7)}
    verdicts = {r.metric: r.passed for r in tm.threshold_verdicts(metrics, limits).collect()}
    assert verdicts == {"p95": True, "err": False, "hit": False}


def test_rates_guard_against_empty_denominators(spark):
    df = spark.createDataFrame([("a", 5.0, True), ("b", 1.0, None)], "g string, s double, hit boolean")
    assert {r.g: r.requests_per_second for r in tm.throughput(df, "g", F.col("s")).collect()} == {
        "a": None, "b": None,
    }
    assert {r.g: r.hit_rate for r in tm.hit_rate(df, "g", F.col("hit")).collect()} == {"a": 1.0, "b": None}


def test_failure_windows(spark):
    few = [(s, True) for s in range(4)]
    calm = [(10 + s, s < 2) for s in range(5)]
    bad = [(20 + s, s < 3) for s in range(5)]
    found = tm.failure_breach(calls(spark, few + calm + bad), "ts", F.col("failed"))
    assert [tuple(r) for r in found.collect()] == [(START + timedelta(seconds=20), 5, 3)]


def test_admission(spark):
    found = tm.admission_windows(calls(spark, [(1, False)] * 9 + [(11, False)]), "ts", permits=4, queue=3)
    rows = sorted(tuple(r)[1:] for r in found.collect())
    assert rows == [(1, 1, 0, 0), (9, 4, 3, 2)]


def test_alert_hold(spark):
    breaching = [0, 1, 3, 4, 5, 7, 8, 9, 10]
    rows = [("s", START + timedelta(minutes=m), m in breaching) for m in range(12) if m != 6]
    rows += [("t", START + timedelta(minutes=m), True) for m in (0, 1, 3, 4)]
    df = spark.createDataFrame(rows, "s string, w timestamp_ntz, bad boolean")
    found = tm.sustained_alerts(df, "s", "w", F.col("bad"), "1 minute", 3).orderBy("breach_start")
    minute = [(r.s, r.breach_start.minute, r.n_windows, r.fired_at.minute) for r in found.collect()]
    assert minute == [("s", 3, 3, 6), ("s", 7, 4, 10)]


def test_burn_rate_levels(spark):
    rows = [(s, s < 4) for s in range(100)] + [(3600 + s, False) for s in range(10)]
    found = tm.slo_burn_rate(calls(spark, rows), "ts", F.col("failed"), "1 hour", 60).orderBy("window_start")
    first, second = found.collect()
    assert (first.burn_level, second.burn_level) == ("P0", "none")
    assert first.burn_rate == pytest.approx(40) and first.budget_minutes == pytest.approx(0.06)
    assert second.availability == 1.0


@pytest.mark.parametrize(
    "row, severity",
    [
        ((True, 0, 100.0, 0, 0.0, 0.9), "none"),
        ((False, 0, 100.0, 0, 0.0, 0.9), "P0"),
        ((True, 6, 100.0, 0, 0.0, 0.9), "P0"),
        ((True, 0, 1001.0, 0, 0.0, 0.9), "P1"),
        ((True, 0, 100.0, 0, 0.06, 0.9), "P1"),
        ((True, 0, 600.0, 11, 0.0, 0.9), "P2"),
        ((True, 0, 600.0, 10, 0.0, 0.9), "none"),
        ((True, 0, 100.0, 0, 0.0, 0.6), "P2"),
        ((True, 0, 100.0, 0, 0.001, 0.9), "P3"),
    ],
)
def test_severity(spark, row, severity):
    names = ["up", "breaker", "p99", "minutes", "err", "hit"]
    df = spark.createDataFrame(
        [row], "up boolean, breaker int, p99 double, minutes int, err double, hit double"
    )
    rated = tm.incident_severity(df, *[F.col(n) for n in names])
    assert rated.first().severity == severity


def test_variants(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(10, 2, 50), rng.normal(12, 3, 40)
    rows = [("a", float(v)) for v in a] + [("b", float(v)) for v in b] + [("c", 1.0), ("c", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    va, vb = a.var(ddof=1) / 50, b.var(ddof=1) / 40
    row = evaluate.welch_t(df, "g", "v", "a").filter("variant = 'b'").first()
    assert row.t == pytest.approx((b.mean() - a.mean()) / np.sqrt(va + vb))
    assert row.degrees_of_freedom == pytest.approx((va + vb) ** 2 / (va**2 / 49 + vb**2 / 39))
    delta = evaluate.variant_delta(df, "g", "v", "a").filter("variant = 'b'").first()
    assert delta.relative_change == pytest.approx(b.mean() / a.mean() - 1)


def test_month_routing(spark):
    df = spark.createDataFrame(
        [(1, "2022-12-15", "2023-02-01"), (2, "2023-01-01", "2023-01-31"), (3, "2023-02-01", "2023-01-01"),
         (4, None, "2023-01-01")],
        "id int, a string, b string",
    ).selectExpr("id", "cast(a AS date) a", "cast(b AS date) b")
    routed = routing.route(df, "a", "b", prefix="trips_")
    shards = {r.id: r.shards for r in routed.collect()}
    assert shards == {
        1: ["trips_2022-12", "trips_2023-01", "trips_2023-02"], 2: ["trips_2023-01"], 3: [], 4: [],
    }
    catalog = spark.createDataFrame([("trips_2023-01",), ("trips_2023-02",)], "shard_key string")
    known, unknown = routing.check_shards(routed, catalog, "id")
    assert known.count() == 3
    assert [tuple(r) for r in unknown.collect()] == [("trips_2022-12", 1)]


def test_pages_concatenate_to_the_whole(spark):
    hits = spark.createDataFrame([(1, i, float(i), i + 1) for i in range(25)], "q int, id int, distance double, rank int")
    seen = []
    for page in (1, 2, 3, 4):
        requests = spark.createDataFrame([(1, page, 10)], "q int, page int, page_size int")
        rows = rs.page_hits(hits, requests, ["q"]).orderBy("rank").collect()
        seen += [r.id for r in rows]
        assert {(r.total_results, r.has_next) for r in rows} <= {(25, page < 3)}
    assert seen == list(range(25))


def test_metadata_and_json(spark):
    hits = spark.createDataFrame([(1, 7, 0.5, 2), (1, 9, 0.25, 1)], "q int, id int, distance double, rank int")
    source = spark.createDataFrame([(7, "x"), (8, "y"), (9, None)], "id int, zone string")
    for bound in (None, 2):
        joined = rs.attach_metadata(hits, source, "id", ["zone"], max_hits=bound)
        mapped = rs.with_metadata_map(joined, ["zone"])
        assert {r.id: r.metadata for r in mapped.collect()} == {7: {"zone": "x"}, 9: {"zone": None}}
    row = rs.results_json(hits, ["q"], "id").first()
    assert row.results_json == '[{"id":9,"score":0.25},{"id":7,"score":0.5}]'


def test_percentiles_keep_null_and_empty_groups(spark):
    rows = [(None, 1.0), (None, 3.0), ("a", 2.0), ("b", None), ("b", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    found = {r.g: (r["mean"], r.p50) for r in tm.exact_percentiles(df, "g", "v", [0.5]).collect()}
    assert found == {None: (2.0, 2.0), "a": (2.0, 2.0), "b": (None, None)}


def test_breaches_last_over_every_window(spark):
    """Runs of hours, one of them missing, against a plain count."""
    bad = [True, True, None, True, False, True, True, True]
    hours = [(START + timedelta(hours=i), b) for i, b in enumerate(bad) if i != 6]
    df = spark.createDataFrame(hours, "w timestamp_ntz, bad boolean").repartition(3)
    whole = tm.every_window(df, "w", "1 hour")
    rows = whole.select("w", "bad", tm.breach_minutes("w", F.col("bad"), 60).alias("m")).orderBy("w").collect()
    assert [r.w for r in rows] == [START + timedelta(hours=i) for i in range(8)]
    assert [r.m for r in rows] == [60, 120, 0, 60, 0, 60, 0, 60]
    assert not tm.every_window(df.limit(0), "w", "1 hour").collect()


def test_breaches_last_within_their_series(spark):
    rows = [("a", i, True) for i in range(3)] + [("b", i, i != 1) for i in range(3)]
    df = spark.createDataFrame(rows, "s string, w int, bad boolean")
    found = df.select("s", "w", tm.breach_minutes("w", F.col("bad"), 5, ["s"]).alias("m")).orderBy("s", "w").collect()
    assert [r.m for r in found] == [5, 10, 15, 5, 0, 5]


def test_severity_takes_own_limits(spark):
    df = spark.createDataFrame([(True, 0.0, 600.0, 15.0, 0.0, 0.9)], "a boolean, b double, p double, m double, e double, h double")
    columns = [F.col(c) for c in "abpmeh"]
    assert tm.incident_severity(df, *columns).first().severity == "P2"
    assert tm.incident_severity(df, *columns, limits={"p99_critical": 599.0}).first().severity == "P1"
    with pytest.raises(ValueError, match="unknown"):
        tm.incident_severity(df, *columns, limits={"p98": 1.0})


def test_only_hits_of_bounded_size_are_broadcast(spark):
    hits = spark.createDataFrame([(1, 2, 0.5)], "query_id long, id long, distance double")

    def hinted(df, bound):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString() if (df := rs.small_side(df, bound)) else None

    assert hinted(hits, 1_000) and not hinted(hits, 1_000_000) and not hinted(hits, None)
    assert not hinted(hits.withColumn("note", F.lit("x")), 1_000)
