"""Vector expressions on ``array<double>`` columns (JVM side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_vector(c) -> Column:
    """Cast any numeric array (e.g. ``array<float>``) to ``array<double>``."""
    return F.col(c).cast("array<double>") if isinstance(c, str) else c.cast("array<double>")


def squared_euclidean(a, b) -> Column:
    """Σ (a_i - b_i)^2 of two equally long arrays."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    diffs = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x)


def euclidean(a, b) -> Column:
    return F.sqrt(squared_euclidean(a, b))


def dot(a, b) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def exp_similarity(distance: Column, sigma: float = 1.0) -> Column:
    """exp(-0.5 * d / sigma^2); ``d`` is the plain (not squared) distance as in
    the reference notebook, pass a squared distance for the Gaussian kernel."""
    return F.exp(F.lit(-0.5) * distance / F.lit(float(sigma) ** 2))


def first_coordinates(c, n: int) -> Column:
    """The first ``n`` coordinates of a vector column."""
    c = F.col(c) if isinstance(c, str) else c
    return F.slice(c, 1, n)
