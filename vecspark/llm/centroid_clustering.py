"""Centroid clustering on whole numbers, with nearest centroids found by a tournament of bisectors.

The points that are as near to one centroid as to another lie on a plane, their bisector.  With
its integer normal and threshold, one product tells which of the two centroids a vector is nearer
to.  All pairs of centroids get theirs beforehand; a vector then needs k - 1 signs: the winner so
far meets the centroids in order of number, and the loser drops out.  A sign of zero favours the
smaller number, which is the one that holds the place.  Only the last winner's distance is
computed, exactly.

Vectors are never shuffled.  In a round each task sums its vectors by cluster, Spark adds up what
the tasks found, and the driver sees k sums of as many components: bounded by the parameters.

Everything is exact: 64-bit integers where no product can overflow them, Python's integers for
batches with larger components.

Defined cases: null vectors, vectors of another length and those with a null, infinite or NaN
component are left out, as are those with a component beyond ``MAX_COMPONENT``; a vector without an id is kept and assigned, and comes last in the draw
of first centroids; rows that share an id or repeat count each, and among them the draw takes the
smaller vector first; fewer vectors than clusters give as many clusters as vectors; an empty
cluster keeps its centroid; an empty table gives an empty result; a distance or sum that 64 bits
can't hold is null; other columns of the input are not part of the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.llm.batches import record_batch
from vecspark.sources.workspace import materialize

CLUSTERS = 40
ROUNDS = 5
SCALE = 256
SEED = 2
#: Far beyond what a 32-bit component can be.
MAX_COMPONENT = 1e50

_LONG_MAX = 2**63 - 1
_BASE = 2**62
_SUMS = pa.schema(
    [("cluster", pa.int32()), ("place", pa.int32()), ("n", pa.int64()), ("high", pa.string()), ("low", pa.int64())]
)
_ASSIGNED = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])


def kept_vectors(vectors: DataFrame, dim: int, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id`` and ``x``, the vectors of ``dim`` finite components as doubles."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    # NaN is larger than any number.
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) <= MAX_COMPONENT))
    kept = vectors.filter((F.size(x) == dim) & finite)
    return kept.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), x.alias("x"))


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * value)``; Python's integers if products of them may pass 64 bits."""
    scaled = np.floor(scale * values)
    limit = 2.0**30 / max(values.shape[-1], 1) ** 0.5
    if np.abs(scaled).max(initial=0) < limit:
        return scaled.astype(np.int64)
    return np.array([int(v) for v in scaled.flat], object).reshape(values.shape)


class Bisectors:
    """Normals and thresholds of all pairs of centroids, and the tournament over them."""

    def __init__(self, centroids: list[list[int]], dim: int):
        fits = all(abs(c) < 2**30 / max(dim, 1) ** 0.5 for row in centroids for c in row)
        self.centroids = np.array(centroids, np.int64 if fits else object).reshape(-1, dim)
        c = self.centroids
        norms = (c * c).sum(axis=1)
        # At [j, i]: x is nearer to j than to i < j if x . normal > threshold.
        self.normals = 2 * (c[:, None, :] - c[None, :, :])
        self.thresholds = norms[:, None] - norms[None, :]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of every row."""
        winner = np.zeros(len(x), np.int64)
        for rival in range(1, len(self.centroids)):
            product = _dots(x, self.normals[rival][winner])
            winner[product > self.thresholds[rival][winner]] = rival
        return winner

    def distances(self, x: np.ndarray, winner: np.ndarray) -> np.ndarray:
        off = x - self.centroids[winner]
        return _dots(off, off)


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.dtype == object or b.dtype == object:
        return (a.astype(object) * b.astype(object)).sum(axis=1)
    return np.einsum("ij,ij->i", a, b)


def _rows(batches: Iterable[pa.RecordBatch], dim: int, scale: int):
    for batch in batches:
        if batch.num_rows:
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            yield batch, whole_numbers(flat.reshape(batch.num_rows, dim), scale)


def first_centroids(kept: DataFrame, clusters: int, dim: int, scale: int, seed: int) -> list[list[int]]:
    """The vectors whose ids hash lowest."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(drawn.asc_nulls_last(), "x").limit(clusters).select("x").collect()
    values = np.array([r.x for r in rows], np.float64).reshape(-1, dim)
    return [[int(v) for v in row] for row in whole_numbers(values, scale)]


def _cluster_sums(kept: DataFrame, centroids: list[list[int]], dim: int, scale: int) -> dict[int, tuple[int, list[int]]]:
    """Count and sums of every cluster that has vectors, by one tournament a vector."""
    bisectors = Bisectors(centroids, dim)

    def run(batches):
        count = np.zeros(len(centroids), np.int64)
        sums = np.zeros((len(centroids), dim), object)
        for _, x in _rows(batches, dim, scale):
            winner = bisectors.nearest(x)
            order = np.argsort(winner, kind="stable")
            found, first = np.unique(winner[order], return_index=True)
            sums[found] += np.add.reduceat(x[order], first, axis=0)
            count += np.bincount(winner, minlength=len(centroids))
        for number in np.flatnonzero(count).tolist():
            high, low = zip(*(divmod(int(v), _BASE) for v in sums[number]), strict=True)
            yield record_batch(
                _SUMS,
                cluster=[number] * dim,
                place=range(dim),
                n=[int(count[number])] * dim,
                high=[str(v) for v in high],
                low=list(low),
            )

    # Two halves, as a sum of many large components can pass 38 digits.
    found = kept.select("x").mapInArrow(run, "cluster int, place int, n long, high string, low long")
    found = found.groupBy("cluster", "place").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
        F.sum(F.col("low").cast("decimal(38,0)")).alias("low"),
    )
    result: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(found.collect(), key=lambda r: (r.cluster, r.place)):
        result.setdefault(r.cluster, (r.n, []))[1].append(int(r.high) * _BASE + int(r.low))
    return result


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dim: int = 64,
    scale: int = SCALE,
    seed: int = SEED,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id``, ``cluster`` and squared ``distance`` of every kept vector, and the centroids."""
    kept = kept_vectors(vectors, dim, id_col, vector_col)
    centroids = first_centroids(kept, clusters, dim, scale, seed)
    for _ in range(rounds if centroids else 0):
        for number, (n, total) in _cluster_sums(kept, centroids, dim, scale).items():
            centroids[number] = [t // n for t in total]
    bisectors = Bisectors(centroids, dim)

    def run(batches):
        for batch, x in _rows(batches, dim, scale):
            winner = bisectors.nearest(x)
            distance = bisectors.distances(x, winner)
            if distance.dtype == object:
                distance = [int(d) if d <= _LONG_MAX else None for d in distance]
            yield record_batch(_ASSIGNED, vec_id=batch.column("vec_id"), cluster=winner, distance=distance)

    return kept.mapInArrow(run, "vec_id long, cluster int, distance long"), centroids


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster_report(vectors: DataFrame, **parameters) -> DataFrame:
    """The rows of ``cluster`` with the inertia of the cluster and of all, and the centroid's digest."""
    assigned, centroids = cluster(vectors, **parameters)
    assigned = materialize(assigned, "clusters")
    spark = assigned.sparkSession
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    # A row a cluster: as many as the parameter says.
    inertia = {
        r.cluster: r.total if r.known == r.n else None
        for r in assigned.groupBy("cluster")
        .agg(total.alias("total"), F.count("distance").alias("known"), F.count("*").alias("n"))
        .collect()
    }

    def long_or_null(values) -> int | None:
        if any(v is None for v in values) or sum(values) > _LONG_MAX:
            return None
        return int(sum(values))

    everything = long_or_null(inertia.values())
    rows = [
        (number, long_or_null([inertia[number]]), everything, centroid_digest(c))
        for number, c in enumerate(centroids)
        if number in inertia
    ]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
