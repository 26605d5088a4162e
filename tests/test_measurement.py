"""Sketches, tail probabilities and alerts on a stream."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from vecspark.functions.statistics import incomplete_beta, log_gamma, two_sided_p
from vecspark.operators.evaluate import ab_significance
from vecspark.operators.sketches import merge_sketches, rank_errors, sketch_quantiles, window_sketches
from vecspark.operators.telemetry import sustained_alerts
from vecspark.sources.workspace import new_path
from vecspark.streaming.alerts import FLUSH, stream_alerts
from vecspark.streaming.runs import append_files, read_files

START = dt.datetime(2024, 1, 1)


def test_sketches_merge_over_windows(spark):
    rng = random.Random(1)
    rows = [(START + dt.timedelta(minutes=i), "ab"[i % 2], rng.lognormvariate(3, 1)) for i in range(20_000)]
    rows += [(START, "a", None), (START, "a", float("nan")), (None, "a", 1.0), (START, "c", 5.0)]
    log = spark.createDataFrame(rows, "ts timestamp, g string, v double")
    hours = window_sketches(log, "ts", ["g"], "v", "1 hour")
    merged = merge_sketches(hours, ["g"])
    assert {r.g: r.n for r in merged.collect()} == {"a": 10_000, "b": 10_000, "c": 1}
    found = rank_errors(log.filter("ts IS NOT NULL"), "g", "v", sketch_quantiles(merged, [0.1, 0.5, 0.99])).collect()
    assert len(found) == 9 and all(r.rank_error < 0.02 for r in found)
    assert {r.quantile for r in found if r.g == "c"} == {5.0}
    assert sketch_quantiles(merge_sketches(hours.limit(0), ["g"]), [0.5]).count() == 0


# Two-sided probabilities of Student's t, as printed in statistical tables.
TABLE = [(1, 12.7062047, 0.05), (2, 4.30265273, 0.05), (10, 2.22813885, 0.05), (10, 3.16927267, 0.01), (30, 2.75, 0.01), (120, 2.6174, 0.01)]


def test_p_values(spark):
    rows = [(t, float(v), p) for v, t, p in TABLE] + [(-t, float(v), p) for v, t, p in TABLE]
    frame = spark.createDataFrame(rows, "t double, v double, p double")
    for r in frame.withColumn("found", two_sided_p(F.col("t"), F.col("v"))).collect():
        assert r.found == pytest.approx(r.p, abs=1e-6 if r.v <= 10 else 2e-5)
    # Closed forms for one and two degrees, the normal distribution for many.
    closed = [(x, 1.0, 1 - 2 * math.atan(x) / math.pi) for x in (0.01, 0.5, 3.0, 40.0)]
    closed += [(x, 2.0, 1 - x / math.sqrt(x * x + 2)) for x in (0.01, 0.5, 3.0, 40.0)]
    closed += [(x, v, math.erfc(x / math.sqrt(2))) for x in (0.1, 1.0, 2.5, 5.0) for v in (3e6, 1e12)]
    frame = spark.createDataFrame(closed, "t double, v double, p double")
    for r in frame.withColumn("found", two_sided_p(F.col("t"), F.col("v"))).collect():
        assert r.found == pytest.approx(r.p, abs=1e-6)
    odd = spark.createDataFrame([(0.0, 5.0), (None, 5.0), (1.0, None), (1.0, 0.0)], "t double, v double")
    assert [r[0] for r in odd.select(two_sided_p(F.col("t"), F.col("v"))).collect()] == [1.0, None, None, None]


def test_special_functions(spark):
    xs = [0.1, 0.5, 1.0, 2.5, 30.0, 4e5]
    frame = spark.createDataFrame([(x,) for x in xs], "x double")
    for x, r in zip(xs, frame.select(log_gamma(F.col("x"))).collect(), strict=True):
        assert r[0] == pytest.approx(math.lgamma(x), rel=1e-10, abs=1e-10)
    one = frame.limit(1).select(*[incomplete_beta(F.lit(2.0), F.lit(3.0), F.lit(x)) for x in (0.0, 0.3, 1.0)]).first()
    assert list(one) == pytest.approx([0, 1 - 0.7**4 - 4 * 0.3 * 0.7**3, 1])  # binomial tail


def test_significance_of_variants(spark):
    rng = random.Random(3)
    rows = [(g, rng.gauss(m, 1)) for g, m in (("base", 0), ("same", 0), ("other", 1)) for _ in range(200)]
    found = {r.variant: r for r in ab_significance(spark.createDataFrame(rows, "g string, v double"), "g", "v", "base").collect()}
    assert found["other"].significant and found["other"].p_value < 1e-10 and not found["same"].significant


def windows_of(breaches):
    return [(s, START + dt.timedelta(hours=h), b) for s, hours in breaches.items() for h, b in hours]


BREACHES = {
    "held": [(h, 2 <= h < 7) for h in range(10)],
    "short": [(h, h in (1, 2, 5, 6)) for h in range(10)],
    "gap": [(h, True) for h in (0, 1, 3, 4, 5, 9)],
    "last": [(h, h >= 6) for h in range(10)],
    "exact": [(h, h in (4, 5, 6)) for h in range(10)],
}


def stream_of(spark, inbox):
    schema = spark.createDataFrame([], "s string, w timestamp, b boolean").schema
    return stream_alerts(read_files(spark, inbox, schema), "s", "w", F.col("b"), 3600, 3, "2 hours")


def deliver(spark, inbox, rows):
    spark.createDataFrame(rows, "s string, w timestamp, b boolean").coalesce(1).write.mode("append").parquet(inbox)


def test_alerts_fire_while_the_breach_lasts_and_end(spark):
    rows = windows_of(BREACHES)
    inbox, out, checkpoint = (new_path(spark, n) for n in ("inbox", "out", "checkpoint"))
    rng, fired_early = random.Random(4), None
    for begin in range(0, 10, 2):  # two hours a delivery, in any order within it
        part = [r for r in rows if begin <= (r[1] - START).total_seconds() / 3600 < begin + 2]
        deliver(spark, inbox, rng.sample(part, len(part)))
        if begin == 6:
            append_files(stream_of(spark, inbox), out, checkpoint).awaitTermination()
            fired_early = {(r.series, r.event) for r in spark.read.parquet(out).collect()}
    deliver(spark, inbox, [(FLUSH, START + dt.timedelta(days=2), False)])
    append_files(stream_of(spark, inbox), out, checkpoint).awaitTermination()
    found = spark.read.parquet(out).collect()
    assert ("held", "fired") in fired_early and ("held", "ended") not in fired_early
    frame = spark.createDataFrame(rows, "s string, w timestamp, b boolean")
    want = sustained_alerts(frame, "s", "w", F.col("b"), "1 hour", 3).collect()
    ended = sorted((r.series, r.breach_start, r.last_window, r.n_windows, r.fired_at) for r in found if r.event == "ended")
    assert ended == sorted((r.s, r.breach_start, r.last_window, r.n_windows, r.fired_at) for r in want)
    assert sorted((r.series, r.breach_start) for r in found if r.event == "fired") == [x[:2] for x in ended]
    assert {x[0] for x in ended} == {"held", "gap", "last", "exact"}
