"""Helpers shared by the tests."""

import numpy as np


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def vector_frame(spark, matrix, **columns):
    rows = [
        (i, [float(x) for x in row], *[values[i] for values in columns.values()])
        for i, row in enumerate(matrix)
    ]
    extra = "".join(f", {name} {_type(values[0])}" for name, values in columns.items())
    return spark.createDataFrame(rows, f"id bigint, embedding array<float>{extra}")


def _type(value) -> str:
    return "string" if isinstance(value, str) else "int"


def query_frame(spark, matrix):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "query_id int, query_vector array<float>")


def clustered(n=2000, dim=32, centres=20, spread=0.15, seed=42):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(centres, dim))
    label = rng.integers(0, centres, n)
    points = centre[label] + spread * rng.normal(size=(n, dim))
    return points.astype(np.float32), label


def brute_force(x, q, k):
    x, q = x.astype(np.float64), q.astype(np.float64)
    found = []
    for i, v in enumerate(q):
        d = ((x - v) ** 2).sum(axis=1)
        order = np.lexsort((np.arange(len(x)), d))[:k]
        found += [(i, int(j), round(float(d[j]), 9), r + 1) for r, j in enumerate(order)]
    return sorted(found)


def hits(df):
    return sorted((r.query_id, r.id, round(r.distance, 9), r["rank"]) for r in df.collect())
