"""The rolling window of clicks, one hour at a time or many hours at once."""

from __future__ import annotations

from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickweave.operators.dedup import latest_per_key, union_all
from clickweave.operators.filters import newer_than
from clickweave.sources.clicklog import read_snapshot, write_snapshot
from clickweave.sources.snapshots import delete_folder, expired_days, list_snapshots

WINDOW_HOURS = 7 * 24
KEEP_DAYS = 7


def cutoff_epoch(day: str, hour: str, hours: int = WINDOW_HOURS, zone: str = "UTC") -> int:
    """Epoch seconds of the run hour minus the window, as wall clock of ``zone``."""
    start = datetime.strptime(day + hour, "%Y%m%d%H") - timedelta(hours=hours)
    return int(start.replace(tzinfo=ZoneInfo(zone)).timestamp())


def merge_window(previous: DataFrame, new_hour: DataFrame, day: str, hour: str,
                 hours: int = WINDOW_HOURS, zone: str = "UTC") -> DataFrame:
    """Next snapshot of (uid, id, ctime).

    The cutoff applies to the previous snapshot only; the new hour enters
    whole. Per (uid, id) the latest click stays.
    """
    cols = ["uid", "id", "ctime"]
    kept = previous.select(*cols).where(newer_than(cutoff_epoch(day, hour, hours, zone)))
    return latest_per_key(union_all(kept, new_hour.select(*cols)))


def backfill(start: DataFrame, clicks: DataFrame, last_day: str, last_hour: str,
             hours: int = WINDOW_HOURS, zone: str = "UTC") -> DataFrame:
    """State after running ``merge_window`` for every hour of ``clicks`` in order.

    Folding "latest wins" over hours equals one aggregate: rows of the start
    snapshot and of all hours but the last must pass the last hour's cutoff,
    the last hour enters whole. One shuffle for any number of hours.
    """
    is_last = (F.col("pdate") == last_day) & (F.col("phour") == last_hour)
    fresh = newer_than(cutoff_epoch(last_day, last_hour, hours, zone))
    cols = ["uid", "id", "ctime"]
    return latest_per_key(union_all(start.select(*cols).where(fresh),
                                    clicks.where(is_last | fresh).select(*cols)))


def run_hour(spark: SparkSession, base: str, previous: tuple[str, str] | None,
             new_hour: DataFrame, day: str, hour: str, hours: int = WINDOW_HOURS,
             zone: str = "UTC", files: int | None = None, mode: str = "errorifexists") -> DataFrame:
    """Write the snapshot of one hour and return it as read back from the output."""
    if previous is None:
        old = new_hour.select("uid", "id", "ctime").limit(0)
    else:
        kinds = {f.name: f.dataType.simpleString() for f in new_hour.schema}
        schema = ", ".join(f"{c} {kinds[c]}" for c in ("uid", "id", "ctime"))
        old = read_snapshot(spark, f"{base}/{previous[0]}/{previous[1]}", schema)
    path = f"{base}/{day}/{hour}"
    write_snapshot(merge_window(old, new_hour, day, hour, hours, zone), path, files, mode)
    return read_snapshot(spark, path)


def clean(spark: SparkSession, base: str, max_keep: int = KEEP_DAYS) -> list[str]:
    """Delete all snapshot days but the newest ``max_keep``; returns the deleted days."""
    days = [r["day"] for r in expired_days(list_snapshots(spark, base), max_keep).collect()]
    for day in sorted(days):
        delete_folder(spark, f"{base}/{day}")
    return sorted(days)
