"""Building blocks that stay balanced when one key holds a large share of the rows.

``HOT_ROWS`` is the number of rows one task may be handed for a single key.
Keys above it are "hot"; there are at most ``total rows / HOT_ROWS`` of them,
which is the bound behind every broadcast of a hot-key table below.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickweave.session import materialize

HOT_ROWS = 5_000_000
COPY_CHUNK = 100_000
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20


def key_sizes(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per key, combined on the map side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def _value_bytes(field: T.StructField) -> Column | None:
    """Bytes of a value of varying length, None for a fixed one."""
    col = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(col)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        size = F.size(col) * 8
    elif isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        size = F.octet_length(F.to_json(col))
    else:
        return None
    return F.coalesce(size, F.lit(0)).cast("bigint")


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS,
                   size: int = BROADCAST_BYTES) -> bool:
    """Counts the rows and, if there are few of varying length, measures their bytes."""
    n = df.count()
    fixed = n * 16 * len(df.columns)
    if n > rows or fixed > size:
        return False
    varying = [b for b in map(_value_bytes, df.schema) if b is not None]
    if not varying:
        return True
    total = varying[0]
    for b in varying[1:]:
        total = total + b
    return fixed + (df.agg(F.sum(total).alias("b")).first()["b"] or 0) <= size


def hot_keys(sizes: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The hot keys, ready to be broadcast, or None when there is none."""
    hot = sizes.where(F.col("n") > hot_rows).select(*keys)
    if hot.isEmpty():
        return None
    return F.broadcast(materialize(hot, "hot"))


def skew_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
              hot_rows: int = HOT_ROWS, sizes: DataFrame | None = None,
              small_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Equi-join of a table with hot keys to a table that is unique per key.

    A ``right`` that was measured to be small is broadcast: then ``left`` is
    not shuffled and its hot keys do not matter. Beyond that size hot keys are
    looked for. Without any, this is the plain join. Otherwise rows of hot keys
    meet the few matching rows of ``right`` by broadcast, so even identical rows
    stay where they were read, and only the others are shuffled.

    ``sizes`` is a table (keys, n) with n at least the rows per key, when the
    caller has one already.
    """
    keys = list(keys)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    if fits_broadcast(right, small_rows):
        return left.join(F.broadcast(right), keys, how)
    hot = hot_keys(key_sizes(left, keys) if sizes is None else sizes, keys, hot_rows)
    if hot is None:
        return left.join(right, keys, how)
    few = F.broadcast(right.join(hot, keys, "left_semi"))
    heavy = left.join(hot, keys, "left_semi").join(few, keys, how)
    light = left.join(hot, keys, "left_anti")
    if how in ("inner", "left_semi"):
        return light.join(right, keys, how).unionByName(heavy)
    # A missing key matches nothing: such rows need not travel to one task.
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    out = light.where(~missing).join(right, keys, how).unionByName(heavy)
    return out.unionByName(light.where(missing), allowMissingColumns=True)


def number_copies(df: DataFrame, name: str = "copy_no", chunk: int = COPY_CHUNK) -> DataFrame:
    """Make identical rows distinct by numbering them 0, 1, 2, ...

    Copies are counted before the shuffle. A row with very many copies is
    spread over tasks in chunks before it is written out again.
    """
    cols = df.columns
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
    few = counted.where(F.col("_copies") <= chunk).withColumn("_chunk", F.lit(0).cast("bigint"))
    last = F.floor((F.col("_copies") - 1) / chunk)
    many = (counted.where(F.col("_copies") > chunk)
            .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
            .repartition(*cols, "_chunk"))
    first = F.col("_chunk") * chunk
    stop = F.least(F.col("_copies"), first + chunk) - 1
    return (few.unionByName(many)
            .select(*cols, F.explode(F.sequence(first, stop)).alias(name)))


def with_row_index(df: DataFrame, order: Sequence[str | Column], name: str = "row_index",
                   partitions: int | None = None) -> DataFrame:
    """Number rows 0, 1, 2, ... in the given total order.

    Range partitioning gives every task an equal slice of the order; the sorted
    slices are written once with the row's place in its slice, and only one
    count per slice reaches the driver. Rows must be distinct under ``order``
    for the slices to be equal, see :func:`number_copies`.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_place", F.monotonically_increasing_id()))
    stored = materialize(placed, "sorted")
    slice_no = F.shiftright("_place", 33)
    counts = stored.groupBy(slice_no.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, total = [], 0
    for row in sorted(counts, key=lambda r: r["s"]):
        offsets.append((row["s"], total))
        total += row["n"]
    frame = pd.DataFrame(offsets, columns=["_slice", "_offset"], dtype="int64")
    table = spark.createDataFrame(frame, "_slice bigint, _offset bigint")
    in_slice = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (stored.withColumn("_slice", slice_no)
            .join(F.broadcast(table), "_slice")
            .select(*df.columns, (F.col("_offset") + in_slice).alias(name)))


def split_hot(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS,
              sizes: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys or None when there is none)."""
    keys = list(keys)
    hot = hot_keys(key_sizes(df, keys) if sizes is None else sizes, keys, hot_rows)
    if hot is None:
        return df, None
    return same_keys_join(df, hot, keys, "left_anti"), same_keys_join(df, hot, keys, "left_semi")


def same_keys_join(left: DataFrame, small: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join to a small table by broadcast, where a missing key equals a missing key."""
    names = {k: f"_same_{k}" for k in keys}
    small = F.broadcast(small.withColumnsRenamed(names))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return left.join(small, same, how).drop(*names.values())
