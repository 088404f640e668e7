"""The rolling window, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweave.catalog import fixtures as fx
from clickweave.catalog.registry import query, sql
from clickweave.operators.dedup import latest_per_key
from clickweave.operators.filters import hour_range
from clickweave.plans.window_job import backfill, merge_window
from clickweave.session import materialize, scratch_path
from clickweave.sources.clicklog import read_click_table, read_snapshot, write_clustered_clicks
from clickweave.sources.snapshots import required_partitions
from clickweave.streaming.hourly import announce_hours, continuous_dedup, latest_complete, run_hourly

RUN = ("20240116", "09")
START_END = "2024010723"
HOLE = "2024010607"
COLS = ["uid", "id", "ctime"]


@query("st1_merge_window", sql("""
  SELECT uid, id, max(ctime) AS ctime FROM (
    SELECT uid, id, ctime FROM (
      SELECT uid, id, max(ctime) AS ctime FROM good_clicks
      WHERE pdate || phour < '2024011609' GROUP BY uid, id) p
    WHERE ctime > CAST(epoch(TIMESTAMP '2024-01-16 09:00:00' - INTERVAL 168 HOUR) AS BIGINT)
    UNION ALL
    SELECT uid, id, ctime FROM good_clicks WHERE pdate = '20240116' AND phour = '09') t
  GROUP BY uid, id""", "good_clicks"))
def st1(spark, sf):
    rows = fx.good_clicks(spark, sf)
    before = latest_per_key(rows.where(hour_range("2024010100", "2024011608")))
    now = rows.where((F.col("pdate") == RUN[0]) & (F.col("phour") == RUN[1]))
    return merge_window(before, now, *RUN)


STATE = """
  SELECT uid, id, max(ctime) AS ctime FROM good_clicks
  WHERE (pdate || phour = (SELECT max(pdate || phour) FROM clicks_a))
    OR ctime > (SELECT CAST(epoch(max(strptime(pdate || phour, '%Y%m%d%H'))
        - INTERVAL 168 HOUR) AS BIGINT) FROM clicks_a)
  GROUP BY uid, id"""


def _last_hour(rows):
    last = rows.agg(F.max(F.struct("pdate", "phour")).alias("s")).first()["s"]
    return last["pdate"], last["phour"]


@query("st4_backfill", sql(STATE, "good_clicks"))
def st4(spark, sf):
    day, hour = _last_hour(fx.clicks_a(spark, sf))
    rows = fx.good_clicks(spark, sf)
    start = latest_per_key(rows.where(hour_range("2024010100", START_END)))
    later = rows.where(~hour_range("2024010100", START_END))
    return backfill(start, later, day, hour)


@query("st2_hourly_stream", sql(STATE, "good_clicks"))
def st2(spark, sf):
    """The loop on one checkpoint, started again after each announcement.

    Hours are announced out of order and with a hole that is filled last, and the
    partitions of every hour are there but for the last start.
    """
    rows = fx.good_clicks(spark, sf).select(*COLS, "pdate", "phour")
    source, base = scratch_path(spark, "clicks"), scratch_path(spark, "snapshots")
    markers, checkpoint = scratch_path(spark, "markers"), scratch_path(spark, "loop")
    write_clustered_clicks(rows, source)
    name = F.concat("pdate", "phour")
    ends = fx.clicks_a(spark, sf).agg(F.min(name).alias("low"), F.max(name).alias("high"))
    time = [F.to_timestamp_ntz(c, F.lit("yyyyMMddHH")) for c in ("low", "high")]
    every = F.explode(F.sequence(*time, F.expr("interval 1 hour"))).alias("h")
    hours = materialize(ends.select(every).select(
        F.date_format("h", "yyyyMMdd").alias("pdate"), F.date_format("h", "HH").alias("phour")),
        "hours")
    begin = hours.agg(F.min(F.struct("pdate", "phour")).alias("s")).first()["s"]

    def partitions():
        now = hours.select(F.col("pdate").alias("day"), F.col("phour").alias("hour"))
        return required_partitions(now).select("source", "part").distinct()

    hole = F.concat("pdate", "phour") == HOLE
    for part in (~hole & hour_range("2024011012", "2024012023"),
                 ~hole & hour_range("2024010100", "2024011011"),
                 hour_range("2024012100", "2024013123"), hole):
        announce_hours(hours.where(part), markers)
        run_hourly(spark, markers, base, lambda: read_click_table(spark, source, rows.schema),
                   checkpoint, present=partitions, first=tuple(begin)).awaitTermination()
    day, hour = latest_complete(spark, base)
    return read_snapshot(spark, f"{base}/{day}/{hour}", "uid bigint, id bigint, ctime bigint")


@query("st3_stream_dedup", sql("SELECT DISTINCT uid, id FROM good_clicks", "good_clicks"))
def st3(spark, sf):
    source, sink = scratch_path(spark, "rows"), scratch_path(spark, "seen")
    rows = fx.good_clicks(spark, sf).select(*COLS)
    rows.write.parquet(source)
    stream = continuous_dedup(spark.readStream.schema(rows.schema).parquet(source))
    (stream.writeStream.format("parquet").option("path", sink)
     .option("checkpointLocation", scratch_path(spark, "dedup"))
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(sink).select("uid", "id").distinct()
