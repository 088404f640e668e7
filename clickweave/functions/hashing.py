"""Hashes that any SQL engine can repeat, and values drawn from them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def portable_hash(value: Column) -> Column:
    """First 32 bits of the MD5 of the text form, as a non-negative BIGINT."""
    digest = F.md5(value.cast("string").cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def bucket(value: Column, buckets: int, mask_zero: bool = False) -> Column:
    """Hash bucket in [0, buckets).

    With ``mask_zero`` the id 0 is kept as 0 and every other id falls into
    [1, buckets - 1].
    """
    if not mask_zero:
        return F.pmod(portable_hash(value), F.lit(buckets))
    shifted = F.pmod(portable_hash(value), F.lit(buckets - 1)) + F.lit(1)
    return F.when(value.cast("string") == "0", F.lit(0).cast("bigint")).otherwise(shifted)


def auto_dim(vocabulary: Column) -> Column:
    """Embedding width six times the fourth root of the vocabulary size."""
    return (F.lit(6) * F.floor(F.pow(vocabulary.cast("double"), F.lit(0.25)))).cast("int")


def uniform01(*parts: Column | str) -> Column:
    """Value in [0, 1) fixed by the parts, independent of partitioning."""
    text = F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return portable_hash(text).cast("double") / F.lit(4294967296.0)


def standard_normal(*parts: Column | str) -> Column:
    """Box-Muller draw fixed by the parts."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    u1 = uniform01(*cols, F.lit("a"))
    u2 = uniform01(*cols, F.lit("b"))
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1))
    return radius * F.cos(F.lit(6.283185307179586) * u2)
