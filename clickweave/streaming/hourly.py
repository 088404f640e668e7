"""The hourly loop as a stream of "hour is ready" markers, and continuous de-duplication."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickweave.operators.filters import hour_range
from clickweave.plans.window_job import KEEP_DAYS, WINDOW_HOURS, backfill, clean
from clickweave.sources.clicklog import read_snapshot, write_snapshot
from clickweave.sources.snapshots import list_snapshots, ready_hours

MARKER_SCHEMA = "pdate string, phour string"


def announce_hours(hours: DataFrame, path: str) -> None:
    """Append ready markers, a folder a day. The producer of a click partition does this
    once it is whole."""
    (hours.select("pdate", "phour").coalesce(1)
     .write.mode("append").partitionBy("pdate").json(path))


def read_markers(spark: SparkSession, path: str) -> DataFrame:
    """(pdate, phour) of every marker; the day is the folder's name."""
    return spark.read.schema(MARKER_SCHEMA).json(path)


def announced_hours(markers: DataFrame, done: tuple[str, str] | None) -> DataFrame:
    """(day, hour) of the markers (pdate, phour) that come after the hour ``done``.

    Earlier days are left out by their folders, so a trigger opens the markers of the
    days from the newest snapshot on, however long the loop has been running.
    """
    if done is not None:
        day, hour = done
        markers = markers.where((F.col("pdate") >= day)
                                & ((F.col("pdate") > day) | (F.col("phour") > hour)))
    return markers.select(F.col("pdate").alias("day"), F.col("phour").alias("hour")).distinct()


def latest_complete(spark: SparkSession, base: str) -> tuple[str, str] | None:
    """The newest complete snapshot; the loop goes on from it.

    A newer folder without its success mark is what a failed run left: its hour
    has not been processed, and the loop writes that folder again. A reader that
    has no loop behind it uses ``latest_snapshot``, which refuses instead.
    """
    row = (list_snapshots(spark, base).where("is_complete")
           .agg(F.max(F.struct("day", "hour")).alias("s")).first()["s"])
    return None if row is None else (row["day"], row["hour"])


def hour_after(day: str, hour: str) -> tuple[str, str]:
    later = datetime.strptime(day + hour, "%Y%m%d%H") + timedelta(hours=1)
    return later.strftime("%Y%m%d"), later.strftime("%H")


def unbroken_run(ready: list[tuple[str, str]], start: tuple[str, str]) -> list[tuple[str, str]]:
    """``start`` and the hours that follow it without a gap, as far as they are ready."""
    known, run = set(ready), []
    while start in known:
        run.append(start)
        start = hour_after(*start)
    return run


def snapshot_step(spark: SparkSession, base: str, clicks: Callable[[], DataFrame],
                  announced: Callable[[], DataFrame],
                  present: Callable[[], DataFrame] | None = None,
                  first: tuple[str, str] | None = None,
                  hours: int = WINDOW_HOURS, zone: str = "UTC", files: int | None = None,
                  max_keep: int = KEEP_DAYS) -> Callable[[DataFrame, int], None]:
    """What a trigger of the loop does to the snapshot tree.

    A marker is a wake-up call. Of all hours announced so far that come after the
    newest complete snapshot, those are ready whose partitions are ``present``
    (click partition, profile partition of the hour and of the next; without
    ``present`` an announced hour is ready). The unbroken run that begins one hour
    after the newest snapshot, or at ``first`` while there is none, is merged in one
    job and written as the snapshot of its last hour; running every hour on its own
    ends in the same state. Hours behind a gap wait for the trigger that fills it,
    whatever the order of the markers. A repeated batch changes nothing, and rows
    that come later for a processed hour are lost.

    Without ``first`` and without a snapshot the loop starts at the smallest hour
    that is ready then.
    """

    def step(_markers: DataFrame, batch_id: int) -> None:
        done = latest_complete(spark, base)
        waiting = announced_hours(announced(), done)
        if present is not None:
            waiting = ready_hours(waiting, present())
        ready = sorted((r["day"], r["hour"]) for r in waiting.collect())  # hours of some days
        if not ready:
            return
        names = unbroken_run(ready, hour_after(*done) if done else first or ready[0])
        if not names:
            return
        table = clicks()
        day, hour = names[-1]
        span = table.where(hour_range("".join(names[0]), day + hour))
        if done is None:
            start = table.select("uid", "id", "ctime").limit(0)
        else:
            kinds = {f.name: f.dataType.simpleString() for f in table.schema}
            schema = ", ".join(f"{c} {kinds[c]}" for c in ("uid", "id", "ctime"))
            start = read_snapshot(spark, f"{base}/{done[0]}/{done[1]}", schema)
        state = backfill(start, span, day, hour, hours, zone)
        write_snapshot(state, f"{base}/{day}/{hour}", files, mode="overwrite")
        clean(spark, base, max_keep)

    return step


def run_hourly(spark: SparkSession, markers: str, base: str, clicks: Callable[[], DataFrame],
               checkpoint: str, interval: str | None = None, **options):
    """Start the loop. Without ``interval`` it takes what is there and ends."""
    stream = spark.readStream.schema(MARKER_SCHEMA).json(markers)

    def announced() -> DataFrame:
        return read_markers(spark, markers)

    writer = (stream.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(snapshot_step(spark, base, clicks, announced, **options)))
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def continuous_dedup(stream: DataFrame, delay: str = f"{WINDOW_HOURS} hours",
                     time: str = "ctime") -> DataFrame:
    """First click per (uid, id) within the delay.

    Unlike the hourly merge this keeps the first row, not the latest: a
    streaming de-duplication cannot take back what it has sent.
    """
    return (stream.withColumn("event_time", F.timestamp_seconds(time))
            .withWatermark("event_time", delay)
            .dropDuplicatesWithinWatermark(["uid", "id"]))
