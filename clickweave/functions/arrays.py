"""Array helpers: padding, vector arithmetic, masks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F


def pad_post(arr: Column, length: int, value: int = 0) -> Column:
    """Cut at the end to ``length``, or fill up at the end with ``value``."""
    missing = F.lit(length) - F.least(F.size(arr), F.lit(length))
    return F.concat(F.slice(arr, 1, length), F.array_repeat(F.lit(value), missing))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once.

    An expression named inside a higher-order function is otherwise worked out
    again for every element.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def rounded(value: Column, digits: int = 6) -> Column:
    """Rounded and free of negative zero."""
    return F.round(value, digits) + F.lit(0.0)


def rounded_vector(vec: Column, digits: int = 6) -> Column:
    return F.transform(vec, lambda x: rounded(x.cast("double"), digits))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def scale(vec: Column, factor: Column) -> Column:
    return F.transform(vec, lambda x: x * factor)


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def elementwise(vectors: Sequence[Column], mode: str = "mean") -> Column:
    """Mean, max or sum of several vectors, position by position."""
    if mode not in ("mean", "max", "sum"):
        raise ValueError("mode must be mean, max or sum")
    out = vectors[0]
    if len(vectors) == 1:
        return out
    join = (lambda x, y: F.greatest(x, y)) if mode == "max" else (lambda x, y: x + y)
    for vec in vectors[1:]:
        out = F.zip_with(out, vec, join)
    if mode == "mean":
        out = F.transform(out, lambda x: x / F.lit(float(len(vectors))))
    return out


def prefix_mask(length: Column, width: int) -> Column:
    """Array of ``width`` booleans, true in the first ``length`` places."""
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: i < length)


def log2_floor_1p(n: Column) -> Column:
    """floor(log2(1 + n)) in integer arithmetic."""
    return F.length(F.bin(n.cast("bigint") + F.lit(1))) - F.lit(1)
