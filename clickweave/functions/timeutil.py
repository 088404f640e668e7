"""Partition-time arithmetic on yyyyMMdd / HH strings.

All expressions work on TIMESTAMP_NTZ, so no result depends on the session
time zone. Where an epoch is taken, the zone of the wall clock is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY_FORMAT = "yyyyMMdd"
HOUR_FORMAT = "yyyyMMddHH"


def wall_clock(day: Column, hour: Column) -> Column:
    """(yyyyMMdd, HH) as a zone-free timestamp."""
    return F.to_timestamp_ntz(F.concat(day, hour), F.lit(HOUR_FORMAT))


def shift_hours(day: Column, hour: Column, hours: int | Column) -> tuple[Column, Column]:
    """(yyyyMMdd, HH) moved by a positive or negative number of hours."""
    step = F.make_dt_interval(hours=hours if isinstance(hours, Column) else F.lit(hours))
    moved = wall_clock(day, hour) + step
    return F.date_format(moved, DAY_FORMAT), F.date_format(moved, "HH")


def next_hour(day: Column, hour: Column) -> tuple[Column, Column]:
    return shift_hours(day, hour, 1)


def next_day(day: Column) -> Column:
    return F.date_format(F.date_add(F.to_date(day, DAY_FORMAT), 1), DAY_FORMAT)


def epoch_of_ntz(ts: Column, zone: str = "UTC") -> Column:
    """Whole epoch seconds of a zone-free timestamp read as wall clock of ``zone``."""
    utc = ts if zone == "UTC" else F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", start, utc)


def epoch_of_hour(day_hour: Column, zone: str) -> Column:
    """yyyyMMddHH, wall clock of ``zone``, as epoch seconds."""
    return epoch_of_ntz(F.to_timestamp_ntz(day_hour, F.lit(HOUR_FORMAT)), zone)


def click_partition(day: Column, hour: Column) -> Column:
    return F.concat(F.lit("pdate="), day, F.lit("/phour="), hour)


def profile_partition(click_part: Column) -> Column:
    """Same hour in the profile tables, whose day column is called pday."""
    return F.replace(click_part, F.lit("pdate"), F.lit("pday"))


def day_in_path(path: Column) -> Column:
    return F.regexp_extract(path, "/([0-9]{8})", 1)
