"""Counts, key-wise aggregates and funnels."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickweave.operators.skew import key_sizes, skew_join
from clickweave.session import materialize


def row_count(df: DataFrame, where: Column | None = None, name: str = "n") -> DataFrame:
    kept = df if where is None else df.where(where)
    return kept.agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, col: str, approximate: bool = False,
                   name: str = "n") -> DataFrame:
    how = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(how(col).alias(name))


def count_per_key(df: DataFrame, key: str) -> DataFrame:
    return key_sizes(df, [key])


def frequent_keys(df: DataFrame, key: str, more_than: int) -> DataFrame:
    return count_per_key(df, key).where(F.col("n") > more_than)


def sum_per_key(df: DataFrame, key: str, value: str, name: str = "total") -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(name))


def slice_of(row_no: Column, total: int, slices: int) -> Column:
    """Which of ``slices`` equal runs of ``total`` rows the row belongs to."""
    return F.floor(((row_no + 1) * slices - 1) / total)


def two_phase(df: DataFrame, key: str, part: str, seq: Callable[[], Column],
              comb: Callable[[Column], Column], name: str = "result") -> DataFrame:
    """Aggregate per (key, part), then combine the parts of each key.

    ``part`` is a column, so the result does not depend on how Spark happens to
    partition the rows.
    """
    partial = df.groupBy(key, part).agg(seq().alias("_partial"))
    return partial.groupBy(key).agg(comb(F.col("_partial")).alias(name))


def max_then_sum(df: DataFrame, key: str, value: str, part: str, zero: int) -> DataFrame:
    return two_phase(df, key, part, lambda: F.greatest(F.max(value), F.lit(zero)), F.sum)


def sum_with_zero(df: DataFrame, key: str, value: str, part: str, zero: int) -> DataFrame:
    return two_phase(df, key, part, lambda: F.sum(value) + F.lit(zero), F.sum)


def pairs_as_map(pairs: DataFrame, key: str, value: str, max_entries: int = 10_000) -> DataFrame:
    """One row holding all pairs as a map.

    A map is one value on one machine, so the number of entries is checked first;
    ``pairs_as_maps`` takes any number.
    """
    entries = pairs.limit(max_entries + 1).count()
    if entries > max_entries:
        raise ValueError(f"more than {max_entries} entries do not fit one map value")
    return pairs.agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("m"))


def pairs_as_maps(pairs: DataFrame, key: str, value: str, max_entries: int = 10_000) -> DataFrame:
    """(part, piece, parts, m): all pairs as maps of at most ``max_entries`` entries each.

    For maps beyond one value. The part of a key is ``map_part`` of it, so a look-up meets
    the pieces of one part; a part of more than ``max_entries`` keys goes on in further
    pieces. Keys are distinct, as in any map. A missing key can't stand in a map and ends
    the job.
    """
    pairs = materialize(pairs.select(key, value), "pairs")
    parts = max(1, -(-2 * pairs.count() // max_entries))
    placed = (pairs.withColumn("part", map_part(F.col(key), F.lit(parts)))
              .withColumn("_n", F.row_number().over(Window.partitionBy("part").orderBy(key)))
              .withColumn("piece", F.floor((F.col("_n") - 1) / max_entries)))
    return (placed.groupBy("part", "piece")
            .agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("m"))
            .select("part", "piece", F.lit(parts).cast("bigint").alias("parts"), "m"))


def map_part(key: Column, parts: Column) -> Column:
    return F.pmod(F.xxhash64(key), parts.cast("bigint"))


def look_up_maps(df: DataFrame, maps: DataFrame, key: str, name: str = "value") -> DataFrame:
    """``df`` with the value of ``key`` in ``maps`` of ``pairs_as_maps``; null if there is none.

    The pieces are opened again and meet the rows by key: nothing is sent whole.
    """
    entries = maps.select(F.explode("m").alias(key, name))
    return skew_join(df, materialize(entries, "entries"), [key], "left")


def partition_profile(df: DataFrame, value: str) -> DataFrame:
    """Rows and value range of every Spark partition."""
    return (df.groupBy(F.spark_partition_id().alias("part"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")))


def funnel(df: DataFrame, stages: Sequence[tuple[str, Column]], item: str = "id",
           user: str = "uid") -> DataFrame:
    """Rows, distinct items and distinct users of each stage, given as a condition.

    Built from per-key counts of all stages at once: one pass over the rows for the
    items and one for the users, however many stages there are.
    """
    marks = [F.when(c, 1).otherwise(0) for _, c in stages]

    def counts(key: str) -> DataFrame:
        per_key = df.groupBy(key).agg(*[F.sum(m).alias(f"s{i}") for i, m in enumerate(marks)])
        known = [F.count(F.when(F.col(f"s{i}") > 0, F.col(key))) for i in range(len(stages))]
        return per_key.agg(F.array(*[F.struct(
            F.lit(name).alias("stage"), F.coalesce(F.sum(f"s{i}"), F.lit(0)).alias("n_rows"),
            known[i].alias("n_keys")) for i, (name, _) in enumerate(stages)]).alias("a")
        ).select(F.inline("a"))

    items = counts(item).withColumnRenamed("n_keys", "n_items")
    users = counts(user).select("stage", F.col("n_keys").alias("n_users"))
    return items.join(users, "stage").select("stage", "n_rows", "n_items", "n_users")
