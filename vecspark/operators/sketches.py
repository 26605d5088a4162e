"""Quantiles from sketches that are stored once and merged upwards without reading the log.

A sketch (KLL) of a window holds a few hundred values, however many requests it saw.  Sketches of
windows merge into those of days or of everything, in any order and also across runs, so that a
dashboard reads a small table.  ``exact_percentiles`` gives the exact values at the price of the log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch; its rank error is about 2.3 / size ** 0.9.
SKETCH_SIZE = 400


def window_sketches(
    df: DataFrame, ts_col: str, group_cols: Sequence[str], value_col: str, width: str, size: int = SKETCH_SIZE
) -> DataFrame:
    """``window_start``, the groups, ``n`` values and their ``sketch``, a row a window and group.

    Rows without a time belong to no window; null and NaN values are left out.
    """
    value = F.col(value_col).cast("double")
    found = df.filter(F.col(ts_col).isNotNull() & value.isNotNull() & ~F.isnan(value))
    windows = found.groupBy(F.window(ts_col, width).alias("w"), *group_cols).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double(value, F.lit(size)).alias("sketch")
    )
    return windows.select(F.col("w.start").alias("window_start"), *group_cols, "n", "sketch")


def merge_sketches(sketches: DataFrame, by: Sequence[str | Column], size: int = SKETCH_SIZE) -> DataFrame:
    """Sketches of wider groups, from those of their parts."""
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch")
    )


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """The sketches' groups with a row for each of ``probs``: ``p`` and ``quantile``."""
    kept = [c for c in sketches.columns if c != "sketch"]
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    found = F.arrays_zip(wanted.alias("p"), F.kll_sketch_get_quantile_double("sketch", wanted).alias("quantile"))
    return sketches.select(*kept, F.inline(found).alias("p", "quantile"))


def rank_errors(df: DataFrame, group_col: str, value_col: str, quantiles: DataFrame) -> DataFrame:
    """``quantiles`` with ``rank_error``, how far their ranks in the data are from ``p``.

    A value that is there several times has all the ranks of its copies.
    """
    value = F.col("_value")
    wanted = quantiles.groupBy(group_col).agg(F.sort_array(F.collect_list(F.struct("p", "quantile"))).alias("_wanted"))
    rows = df.select(group_col, F.col(value_col).cast("double").alias("_value")).filter(value.isNotNull() & ~F.isnan(value))
    # As many numbers a group as quantiles; the log is read once and summed by its own tasks.
    most = quantiles.groupBy(group_col).count().agg(F.max("count")).first()[0] or 0
    counts = [
        F.struct(
            F.count_if(value < F.col("_wanted")[i]["quantile"]).alias("under"),
            F.count_if(value <= F.col("_wanted")[i]["quantile"]).alias("upto"),
        )
        for i in range(most)
    ]
    found = rows.join(wanted, group_col).groupBy(group_col).agg(
        F.count("*").alias("_n"), F.first("_wanted").alias("_wanted"), F.array(*counts).alias("_counts")
    )
    pairs = found.select(group_col, "_n", F.explode(F.arrays_zip("_wanted", "_counts")).alias("x"))
    low, high, p = F.col("x._counts.under") / F.col("_n"), F.col("x._counts.upto") / F.col("_n"), F.col("x._wanted.p")
    error = F.greatest(low - p, p - high, F.lit(0.0))
    errors = pairs.filter(p.isNotNull()).select(group_col, p.alias("p"), error.alias("rank_error"))
    return quantiles.join(errors, [group_col, "p"], "left")
