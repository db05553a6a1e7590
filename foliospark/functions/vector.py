"""Scores of dense vectors, accumulated in double precision inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("cosine", "dot", "euclid")


def vector(values: Sequence[float] | Column | str) -> Column:
    if isinstance(values, (Column, str)):
        return (F.col(values) if isinstance(values, str) else values).cast("array<double>")
    return F.array(*[F.lit(float(v)) for v in values])


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return _sum(F.zip_with(vector(a), vector(b), lambda x, y: x * y))


def norm(a) -> Column:
    return F.sqrt(_sum(F.transform(vector(a), lambda x: x * x)))


def cosine(a, b) -> Column:
    """Null for a zero vector."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def euclid(a, b) -> Column:
    return F.sqrt(_sum(F.zip_with(vector(a), vector(b), lambda x, y: (x - y) * (x - y))))


def score(metric: str, a, b) -> Column:
    try:
        return {"cosine": cosine, "dot": dot, "euclid": euclid}[metric](a, b)
    except KeyError:
        raise ValueError(f"unknown metric {metric!r}; one of {METRICS}") from None


def descending(metric: str) -> bool:
    """Whether a larger score is nearer."""
    return metric != "euclid"
