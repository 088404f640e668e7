"""Support filters, id encoding and training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickweave.functions.arrays import pad_post
from clickweave.functions.hashing import portable_hash
from clickweave.operators.ordering import sort_rows, with_history
from clickweave.operators.skew import HOT_ROWS, key_sizes, skew_join, with_row_index
from clickweave.session import materialize

SEQUENCE_LENGTH = 64


def supported(df: DataFrame, key: str, at_least: int,
              hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Rows whose key occurs often enough, and the written table (key, n) of all keys.

    The counts are written once: they tell the hot keys and, with a known size
    on disk, let Spark broadcast the key list where it is small.
    """
    sizes = materialize(key_sizes(df, [key]), "sizes")
    keys = sizes.where(F.col("n") >= at_least).select(key)
    return skew_join(df, keys, [key], "left_semi", hot_rows, sizes), sizes


def min_support(df: DataFrame, key: str, at_least: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows whose key occurs at least ``at_least`` times."""
    return supported(df, key, at_least, hot_rows)[0]


def support_filter(clicks: DataFrame, inum: int = 3, unum: int = 6, item: str = "id",
                   user: str = "uid", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Items first, then users counted on what is left. One pass, not a fixed point."""
    return min_support(min_support(clicks, item, inum, hot_rows), user, unum, hot_rows)


def preprocess(clicks: DataFrame, inum: int = 3, unum: int = 6) -> DataFrame:
    """Support filter, then the time order.

    A sort reads its input more than once (hot keys, range bounds, rows), so
    the filtered clicks are written in between.
    """
    kept = materialize(support_filter(clicks, inum, unum), "kept")
    return sort_rows(kept, ["ctime", "id"])


def dictionary(df: DataFrame, col: str, partitions: int | None = None) -> DataFrame:
    """(col, code): place of each distinct value in sorted order, from 1. 0 is padding."""
    distinct = df.select(col).where(F.col(col).isNotNull()).distinct()
    indexed = with_row_index(distinct, [col], "_idx", partitions)
    return indexed.select(col, (F.col("_idx") + 1).alias("code"))


def encode(df: DataFrame, col: str, codes: DataFrame, out: str, hot_rows: int = HOT_ROWS,
           sizes: DataFrame | None = None) -> DataFrame:
    """Adds the code of ``col`` as ``out``."""
    return skew_join(df, codes.withColumnRenamed("code", out), [col], "inner", hot_rows, sizes)


def vocabulary_size(codes: DataFrame) -> DataFrame:
    """Largest code plus one, so that index 0 has a place too."""
    return codes.agg((F.max("code") + 1).alias("vocabulary_size"))


def prefix_samples(clicks: DataFrame, length: int = SEQUENCE_LENGTH, user: str = "user_id",
                   item: str = "item_id", time: str = "ctime",
                   hot_rows: int = HOT_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """One sample per click after a user's first.

    Columns: user, target item, label, hist (newest first, at most ``length``),
    hist_len (uncapped), pos, is_test (the user's last click).
    """
    placed = with_history(clicks.select(user, item, time), user, [time, item], item, length,
                          hot_rows, sizes)
    return (placed.where(F.col("pos") >= 1)
            .select(user, item, F.lit(1).alias("label"), "hist",
                    F.col("pos").alias("hist_len"), "pos", F.col("is_last").alias("is_test")))


def train_rows(samples: DataFrame) -> DataFrame:
    return samples.where(~F.col("is_test"))


def test_rows(samples: DataFrame) -> DataFrame:
    return samples.where(F.col("is_test"))


def model_input(samples: DataFrame, length: int = SEQUENCE_LENGTH, user: str = "user_id",
                item: str = "item_id") -> DataFrame:
    """Padded history next to ids, uncapped length and label."""
    return samples.select(user, item, pad_post(F.col("hist"), length).alias("hist_item_id"),
                          "hist_len", "label", "is_test")


def in_validation(fraction: float, user: str = "user_id", pos: str = "pos") -> Column:
    """True for a fixed ``fraction`` of the samples, whatever their order."""
    text = F.concat_ws(":", F.col(user).cast("string"), F.col(pos).cast("string"))
    return F.pmod(portable_hash(text), F.lit(1000)) < int(round(fraction * 1000))


def truth(samples: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """The item each user went on to click: one row per user."""
    return test_rows(samples).select(user, F.col(item).alias("true_item"))
