"""Sorts, top-k, positions and bounded histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickweave.functions.hashing import portable_hash
from clickweave.operators.skew import (
    HOT_ROWS, hot_keys, key_sizes, number_copies, same_keys_join, split_hot, with_row_index,
)
from clickweave.session import materialize

TOP_K_BOUND = 10_000
LIST_ROWS = 1_000_000


def _distinct_order(df: DataFrame, order: Sequence[str],
                    hot_rows: int) -> tuple[DataFrame, list[str]]:
    """The table and a full sort order under which no row fills a task.

    While no value of the first sort column has very many rows, no row can have
    very many copies and range partitioning is balanced. That is checked by a
    count per value. Otherwise identical rows are counted before they travel
    and numbered in ``_copy``, so that the slices stay equal even when one row
    fills the table.
    """
    full = [*order, *[c for c in df.columns if c not in order]]
    first = [order[0]]
    if hot_keys(key_sizes(df, first), first, hot_rows) is None:
        return df, full
    return number_copies(df, "_copy"), [*full, "_copy"]


def sort_rows(df: DataFrame, order: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Global ascending sort; the remaining columns break ties."""
    rows, full = _distinct_order(df, order, hot_rows)
    return rows.orderBy(*full).drop("_copy")


def first_rows(df: DataFrame, order: Sequence[str], n: int,
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """The first ``n`` rows; the remaining columns break ties, for every ``n``."""
    if n <= TOP_K_BOUND:
        return df.orderBy(*order, *[c for c in df.columns if c not in order]).limit(n)
    rows, full = _distinct_order(df, order, hot_rows)
    return with_row_index(rows, full, "_idx").where(F.col("_idx") < n).drop("_idx", "_copy")


def in_order_read(df: DataFrame, name: str = "place") -> DataFrame:
    """Adds the place (from 0) in which a reader of all partitions in turn meets each row."""
    met = F.monotonically_increasing_id()
    stored = materialize(df.withColumn("_met", met), "ordered")
    return with_row_index(stored, ["_met"], name).drop("_met")


def shuffled(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    """Rows in an order that looks random and depends only on keys and seed.

    The keys must tell the rows apart.
    """
    text = F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return df.withColumn("sort_key", portable_hash(text)).orderBy("sort_key", *keys)


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], k: int,
          rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group. Spark prunes to k per group before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def first_in_group(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    return top_k(df, group, order, 1, "_first").drop("_first")


def _positions_of_hot(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """pos and n for the rows of hot keys, by one balanced sort of all of them."""
    rest = [c for c in df.columns if c != key and c not in order]
    unique = number_copies(df, "_copy")
    indexed = with_row_index(unique, [key, *order, *rest, "_copy"], "_idx")
    starts = indexed.groupBy(key).agg(F.min("_idx").alias("_start"), F.count(F.lit(1)).alias("_n"))
    return (same_keys_join(indexed, starts, [key], "inner")
            .withColumn("pos", F.col("_idx") - F.col("_start"))
            .drop("_idx", "_start", "_copy"))


def with_position(df: DataFrame, key: str, order: Sequence[str],
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds ``pos`` (0-based place in the key's order) and ``is_last``."""
    light, heavy = split_hot(df, [key], hot_rows)
    w = Window.partitionBy(key).orderBy(*order)
    out = (light.withColumn("pos", (F.row_number().over(w) - 1).cast("bigint"))
           .withColumn("is_last", F.lead(F.lit(1)).over(w).isNull()))
    if heavy is not None:
        placed = (_positions_of_hot(heavy, key, order)
                  .withColumn("is_last", F.col("pos") == F.col("_n") - 1).drop("_n"))
        out = out.unionByName(placed)
    return out


def with_history(df: DataFrame, key: str, order: Sequence[str], value: str, length: int,
                 hot_rows: int = HOT_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """Adds ``pos``, ``is_last`` and ``hist``: the ``length`` values before the row, newest first.

    Ordinary keys need one shuffle for all three. A hot key is cut into blocks
    of ``hot_rows`` consecutive rows; each block also receives the last
    ``length`` rows of the block before it, so every window sees what it needs.
    """
    light, heavy = split_hot(df, [key], hot_rows, sizes)
    w = Window.partitionBy(key).orderBy(*order)
    before = F.reverse(F.collect_list(value).over(w.rowsBetween(-length, -1)))
    out = (light.withColumn("pos", (F.row_number().over(w) - 1).cast("bigint"))
           .withColumn("is_last", F.lead(F.lit(1)).over(w).isNull())
           .withColumn("hist", before))
    if heavy is None:
        return out
    block_rows = max(hot_rows, length)
    block = F.floor(F.col("pos") / block_rows)
    in_tail = F.col("pos") % block_rows >= block_rows - length
    homes = F.when(in_tail, F.array(block, block + 1)).otherwise(F.array(block))
    spread = (_positions_of_hot(heavy, key, order)
              .withColumn("_home", block)
              .withColumn("_block", F.explode(homes)))
    wb = Window.partitionBy(key, "_block").orderBy("pos")
    placed = (spread
              .withColumn("hist", F.reverse(F.collect_list(value).over(wb.rowsBetween(-length, -1))))
              .where(F.col("_block") == F.col("_home"))
              .withColumn("is_last", F.col("pos") == F.col("_n") - 1)
              .drop("_n", "_home", "_block"))
    return out.unionByName(placed)


def history_lists(df: DataFrame, key: str, order: Sequence[str], items: Sequence[str],
                  list_rows: int = LIST_ROWS) -> DataFrame:
    """Time-ordered list of ``items`` per key: (key, part, history).

    A history of up to ``list_rows`` entries is one row with ``part`` 0; a longer
    one goes on in part 1, 2, ... so that no task holds an unbounded list.
    """
    def listing(place: list[Column]) -> Column:
        entry = F.struct(*[p.alias(f"_o{i}") for i, p in enumerate(place)],
                         *[F.col(c).alias(f"_v{i}") for i, c in enumerate(items)])
        ordered = F.array_sort(F.collect_list(entry))
        if len(items) == 1:
            return F.transform(ordered, lambda e: e["_v0"])
        return F.transform(ordered, lambda e: F.struct(
            *[e[f"_v{i}"].alias(c) for i, c in enumerate(items)]))

    needed = df.select(key, *dict.fromkeys([*order, *items]))
    light, heavy = split_hot(needed, [key], list_rows)
    out = (light.groupBy(key).agg(listing([F.col(c) for c in order]).alias("history"))
           .select(key, F.lit(0).cast("bigint").alias("part"), "history"))
    if heavy is not None:
        parts = (_positions_of_hot(heavy, key, order)
                 .withColumn("part", F.floor(F.col("pos") / list_rows)))
        out = out.unionByName(parts.groupBy(key, "part")
                              .agg(listing([F.col("pos")]).alias("history")))
    return out
