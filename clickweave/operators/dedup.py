"""Union, de-duplication and set overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def union_all(first: DataFrame, second: DataFrame) -> DataFrame:
    """UNION ALL of two tables with the same columns, second cast to the first's types."""
    aligned = second.select(*[F.col(f.name).cast(f.dataType) for f in first.schema])
    return first.unionByName(aligned)


def latest_per_key(df: DataFrame, keys: Sequence[str] = ("uid", "id"),
                   time: str = "ctime") -> DataFrame:
    """One row per key with the latest time; copies meet before the shuffle."""
    return df.groupBy(*keys).agg(F.max(time).alias(time))


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def overlap(a: Column, b: Column) -> Column:
    """Number of distinct values two arrays share."""
    return F.size(F.array_intersect(a, b))
