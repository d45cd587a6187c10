"""Column expressions on array vectors; everything is computed in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(_total(F.transform(doubles(a), lambda x: x * x)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when either vector is all zero."""
    scale = norm(a) * norm(b)
    return F.when(scale > 0, dot(a, b) / scale)


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def softmax(logits: Column) -> Column:
    def shares(exps: Column) -> Column:
        return _let(_total(exps), lambda total: F.transform(exps, lambda x: x / total))

    def exps(top: Column) -> Column:
        return F.transform(doubles(logits), lambda x: F.exp(x - top))

    return _let(_let(F.array_max(doubles(logits)), exps), shares)


def argmax(values: Column) -> Column:
    """Zero-based position of the first maximum."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def reshape(v: Column, steps: int, step_dim: int) -> Column:
    """Flat vector to ``steps`` rows of ``step_dim`` values; any other length is an error."""
    rows = F.transform(
        F.sequence(F.lit(0), F.lit(steps - 1)), lambda i: F.slice(v, i * step_dim + 1, F.lit(step_dim))
    )
    bad = F.raise_error(F.format_string(f"expected {steps * step_dim} values, got %d", F.size(v)))
    return F.when(F.size(v) == steps * step_dim, rows).otherwise(bad)


def mean_probability(members: Column) -> Column:
    """Element-wise mean of an array of equally long probability vectors."""
    total = F.aggregate(
        members,
        F.transform(F.element_at(members, 1), lambda _: F.lit(0.0)),
        lambda acc, v: F.zip_with(acc, doubles(v), lambda x, y: x + y),
    )
    return F.transform(total, lambda x: x / F.size(members))
