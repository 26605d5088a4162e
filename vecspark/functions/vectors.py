"""Distances and norms over array columns, accumulated in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(v: Column | str) -> Column:
    return _col(v).cast("array<double>")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return _sum(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y))


def squared_l2(a: Column | str, b: Column | str) -> Column:
    """Squared Euclidean distance: lower is nearer."""
    return _sum(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y)))


def l2_norm(v: Column | str) -> Column:
    return F.sqrt(_sum(F.transform(as_double(v), lambda x: x * x)))


def cosine_similarity(a: Column | str, b: Column | str) -> Column:
    """Null when either vector has no length."""
    norms = l2_norm(a) * l2_norm(b)
    return F.when(norms > 0, dot(a, b) / norms)


def l2_normalize(v: Column | str) -> Column:
    """Unit vector; a zero vector stays zero."""
    norm = l2_norm(v)
    return F.when(norm > 0, F.transform(as_double(v), lambda x: x / norm)).otherwise(as_double(v))


def zero_vector(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), dim)


def is_searchable(v: Column | str, dim: int) -> Column:
    """True for a vector of the right length without null or NaN entries."""
    bad = F.exists(_col(v), lambda x: x.isNull() | F.isnan(x))
    return F.coalesce((F.size(_col(v)) == dim) & ~bad, F.lit(False))


def has_direction(v: Column | str) -> Column:
    """True for a vector with at least one non-zero entry."""
    return F.exists(_col(v), lambda x: x != 0)
