"""Row filters of the click log and of the profile tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the click log.
BLOCKED_CHANNELS = ("relateDocOrig", "relateVideoOrig")
CLICK_ITEM_TYPES = ("docpic", "video", "minivideo")
MIN_ENGAGEMENT = 10.0

CLICK_COLUMNS = ("uid", "id", "ctime")


def not_null(cols: Sequence[str] = CLICK_COLUMNS) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def channel_allowed(blocked: Sequence[str] = BLOCKED_CHANNELS, col: str = "sch") -> Column:
    """True outside the blocklist; a missing channel does not pass."""
    return ~F.col(col).isin(*blocked)


def item_type_allowed(types: Sequence[str] = CLICK_ITEM_TYPES, col: str = "itemtype") -> Column:
    return F.col(col).isin(*types)


def engaged(threshold: float = MIN_ENGAGEMENT) -> Column:
    return (F.col("dur_sec") >= threshold) | (F.col("readrate") >= threshold)


def valid_time(col: str = "ctime") -> Column:
    return F.col(col) > 0


def hour_range(first: str, last: str, day: str = "pdate", hour: str = "phour") -> Column:
    """yyyyMMddHH between both ends, inclusive.

    Written on the partition columns themselves: the day bounds prune
    partitions, the hour only matters on the first and on the last day.
    """
    d0, h0, d1, h1 = first[:8], first[8:], last[:8], last[8:]
    day_c, hour_c = F.col(day), F.col(hour)
    inside = day_c.between(d0, d1)
    return inside & ((day_c > d0) | (hour_c >= h0)) & ((day_c < d1) | (hour_c <= h1))


def partition_is(day: str | int, hour: str | int, day_col: str = "pdate",
                 hour_col: str = "phour") -> Column:
    """One partition; numbers are written as zero-padded text first."""
    return (F.col(day_col) == f"{int(day):08d}") & (F.col(hour_col) == f"{int(hour):02d}")


def newer_than(cutoff: int | Column, col: str = "ctime") -> Column:
    return F.col(col) > (cutoff if isinstance(cutoff, Column) else F.lit(cutoff))


def hourly_clicks(table: DataFrame, blocked: Sequence[str] = BLOCKED_CHANNELS,
                  types: Sequence[str] = CLICK_ITEM_TYPES,
                  threshold: float = MIN_ENGAGEMENT) -> DataFrame:
    """All quality filters of a new hour; adds nothing, keeps every column."""
    return table.where(not_null() & valid_time() & channel_allowed(blocked)
                       & engaged(threshold) & item_type_allowed(types))


def keyed_pairs(clicks: DataFrame, key: str = "uid",
                cols: Sequence[str] = ("id", "ctime")) -> DataFrame:
    return clicks.select(key, F.struct(*cols).alias("v"))


def attribute_rows(profile: DataFrame, attrs: Sequence[str], day: str, hour: str,
                   must_have: str, day_col: str = "pday") -> DataFrame:
    """Attributes of one profile partition where one of them is present."""
    return (profile.where(partition_is(day, hour, day_col) & F.col(must_have).isNotNull())
            .select(*attrs))
