"""The tree of hourly snapshots: <base>/<yyyyMMdd>/<HH>/_SUCCESS."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickweave.functions import timeutil as tu

LISTING_SCHEMA = "day string, hour string, is_complete boolean"


def _folders(fs, path):
    return [s.getPath() for s in fs.listStatus(path) if s.isDirectory()]


def list_snapshots(spark: SparkSession, base: str) -> DataFrame:
    """(day, hour, is_complete) of every snapshot folder below ``base``.

    Folder names only: the number of rows is kept days times 24.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    rows = []
    if fs.exists(root):
        for day in _folders(fs, root):
            for hour in _folders(fs, day):
                done = fs.exists(spark._jvm.org.apache.hadoop.fs.Path(hour, "_SUCCESS"))
                rows.append((day.getName(), hour.getName(), done))
    rows = [r for r in rows if len(r[0]) == 8 and r[0].isdigit()
            and len(r[1]) == 2 and r[1].isdigit()]
    return spark.createDataFrame(rows, LISTING_SCHEMA)


def delete_folder(spark: SparkSession, path: str) -> None:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def latest_snapshot(listing: DataFrame) -> DataFrame:
    """One row (day, hour): the newest snapshot. Fails if that one is not complete.

    There is no fall-back to an older complete one.
    """
    newest = listing.agg(F.max(F.struct("day", "hour", "is_complete")).alias("s"))
    checked = F.when(F.col("s.is_complete"), F.col("s.day")).otherwise(
        F.raise_error(F.concat(F.lit("latest snapshot is not complete: "),
                               F.col("s.day"), F.lit("/"), F.col("s.hour"))))
    return newest.where(F.col("s").isNotNull()).select(checked.alias("day"),
                                                       F.col("s.hour").alias("hour"))


def next_run(listing: DataFrame) -> DataFrame:
    """(day, hour, next_day, next_hour): newest snapshot and the hour to run."""
    last = latest_snapshot(listing)
    day, hour = tu.next_hour(F.col("day"), F.col("hour"))
    return last.select("day", "hour", day.alias("next_day"), hour.alias("next_hour"))


def required_partitions(hours: DataFrame) -> DataFrame:
    """Partitions that must exist before each (day, hour) can run.

    The click partition of the hour, the profile partition of the hour and the
    profile partition of the hour after it.
    """
    day, hour = tu.next_hour(F.col("day"), F.col("hour"))
    now = tu.click_partition(F.col("day"), F.col("hour"))
    then = tu.click_partition(day, hour)
    needed = F.array(
        F.struct(F.lit("click").alias("source"), now.alias("part")),
        F.struct(F.lit("profile").alias("source"), tu.profile_partition(now).alias("part")),
        F.struct(F.lit("profile").alias("source"), tu.profile_partition(then).alias("part")))
    return hours.select("day", "hour", F.inline(needed))


def missing_partitions(required: DataFrame, present: DataFrame) -> DataFrame:
    """Required (source, part) rows without a present one. Ready means: no row."""
    return required.join(present, ["source", "part"], "left_anti")


def ready_hours(hours: DataFrame, present: DataFrame) -> DataFrame:
    """The (day, hour) rows for which every required partition is present."""
    waiting = missing_partitions(required_partitions(hours), present).select("day", "hour")
    return hours.join(waiting.distinct(), ["day", "hour"], "left_anti")


def partitions_of(spark: SparkSession, table: str, source: str) -> DataFrame:
    """Present partitions of a catalog table as (source, part)."""
    return (spark.sql(f"SHOW PARTITIONS {table}")
            .select(F.lit(source).alias("source"), F.col("partition").alias("part")))


def expired_days(days: DataFrame, max_keep: int, day: str = "day") -> DataFrame:
    """All but the newest ``max_keep`` days."""
    distinct = days.select(day).distinct()
    keep = distinct.orderBy(F.desc(day)).limit(max_keep)
    return distinct.join(keep, day, "left_anti")
