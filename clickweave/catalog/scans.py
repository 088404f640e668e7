"""Sources, sinks and snapshot management."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweave.catalog import fixtures as fx
from clickweave.catalog.registry import query, sql, view
from clickweave.operators.filters import not_null
from clickweave.operators.ordering import history_lists
from clickweave.functions.arrays import rounded
from clickweave.session import scratch_path
from clickweave.sources import clicklog, snapshots

NOT_NULL = "uid IS NOT NULL AND id IS NOT NULL AND ctime IS NOT NULL"
NUMBERS = "uid bigint, id bigint, ctime bigint"


def _usable(spark, sf):
    return fx.clicks_a(spark, sf).where(not_null()).select("uid", "id", "ctime")


@query("s01_partition_scan", sql("""
  SELECT uid, id, ctime FROM clicks_a WHERE pdate = '20240115' AND phour = '07'""", "clicks_a"))
def s01(spark, sf):
    return clicklog.scan_hour(fx.click_table(spark, sf), "20240115", "07")


@query("s02_tsv_scan", sql(f"SELECT uid, id, ctime FROM clicks_a WHERE {NOT_NULL}", "clicks_a"))
def s02(spark, sf):
    path = scratch_path(spark, "tsv")
    clicklog.write_snapshot(_usable(spark, sf), path)
    return clicklog.read_snapshot(spark, path, NUMBERS)


@query("s03_folder_scan", sql(f"""
  SELECT uid, count(*) AS n_rows, CAST(sum(ctime) AS BIGINT) AS sum_ctime
  FROM clicks_a WHERE {NOT_NULL} GROUP BY uid""", "clicks_a"))
def s03(spark, sf):
    path = scratch_path(spark, "parts")
    clicklog.write_snapshot(_usable(spark, sf), path, files=7)
    return (clicklog.read_snapshot(spark, path, NUMBERS).groupBy("uid")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("ctime").alias("sum_ctime")))


@query("s04_tsv_sink", sql(f"""
  SELECT CAST(10 AS BIGINT) AS n_files, count(*) AS n_rows, count(DISTINCT uid) AS n_users,
    CAST(sum(id) AS BIGINT) AS sum_id, CAST(sum(ctime) AS BIGINT) AS sum_ctime
  FROM clicks_a WHERE {NOT_NULL}""", "clicks_a"))
def s04(spark, sf):
    path = scratch_path(spark, "sink")
    clicklog.write_snapshot(_usable(spark, sf), path, files=10)
    back = clicklog.read_snapshot(spark, path, NUMBERS)
    return back.withColumn("f", F.input_file_name()).agg(
        F.countDistinct("f").alias("n_files"), F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("uid").alias("n_users"), F.sum("id").alias("sum_id"),
        F.sum("ctime").alias("sum_ctime"))


@query("s05_history_text_sink", sql(f"""
  SELECT uid, CAST(0 AS BIGINT) AS part, string_agg(CAST(id AS VARCHAR) || ':' ||
    CAST(ctime AS VARCHAR), ',' ORDER BY ctime, id) AS history
  FROM clicks_a WHERE {NOT_NULL} GROUP BY uid""", "clicks_a"))
def s05(spark, sf):
    lists = history_lists(_usable(spark, sf), "uid", ["ctime", "id"], ["id", "ctime"])
    path = scratch_path(spark, "lists")
    clicklog.write_histories(lists, path, files=10)
    back = clicklog.read_histories(spark, path, lists.schema)
    entry = F.transform("history", lambda e: F.concat_ws(":", e["id"], e["ctime"]))
    return back.select("uid", "part", F.array_join(entry, ",").alias("history"))


@query("s06_tab_lines", sql(f"""
  SELECT concat_ws(chr(9), uid, id, ctime) AS line FROM clicks_a WHERE {NOT_NULL}""", "clicks_a"))
def s06(spark, sf):
    return clicklog.tab_lines(fx.clicks_a(spark, sf))


@query("s07_memory_table", sql("""
  SELECT c.sch, count(*) AS n FROM clicks_a c JOIN (VALUES ('error'), ('signup')) b(sch)
    ON c.sch = b.sch GROUP BY c.sch""", "clicks_a"))
def s07(spark, sf):
    blocked = clicklog.memory_table(spark, [(c,) for c in fx.BLOCKED], "sch string")
    return (fx.clicks_a(spark, sf).join(F.broadcast(blocked), "sch", "left_semi")
            .groupBy("sch").agg(F.count(F.lit(1)).alias("n")))


@query("s08_synthetic_vectors", sql(f"""
  SELECT p_partkey AS row_id, d AS dim,
    round({fx.hash_sql("'1234'", "p_partkey", "d")} / 4294967296.0
      + CASE WHEN d = 0 THEN p_partkey / 1000.0 ELSE 0 END, 6) + 0.0 AS value
  FROM part, range(0, 8) t(d)"""))
def s08(spark, sf):
    vecs = clicklog.synthetic_vectors(fx.table(spark, sf, "part"), "p_partkey", 8)
    return (vecs.select("row_id", F.posexplode("vec").alias("dim", "x"))
            .select("row_id", F.col("dim").cast("bigint").alias("dim"),
                    rounded(F.col("x")).alias("value")))


view("listing", """
  SELECT DISTINCT pdate AS day, phour AS hour, phour <> '13' AS is_complete FROM clicks_a""",
     "clicks_a")


def _listing(spark, sf):
    return (fx.clicks_a(spark, sf).select(F.col("pdate").alias("day"), F.col("phour").alias("hour"))
            .distinct().withColumn("is_complete", F.col("hour") != "13"))


@query("s09_latest_snapshot", sql("""
  SELECT day, hour FROM listing ORDER BY day DESC, hour DESC LIMIT 1""", "listing"))
def s09(spark, sf):
    return snapshots.latest_snapshot(_listing(spark, sf))


REQUIRED = """
  SELECT day, hour, 'click' AS source, 'pdate=' || day || '/phour=' || hour AS part FROM listing
  UNION ALL
  SELECT day, hour, 'profile', 'pday=' || day || '/phour=' || hour FROM listing
  UNION ALL
  SELECT day, hour, 'profile', 'pday=' ||
    strftime(strptime(day || hour, '%Y%m%d%H') + INTERVAL 1 HOUR, '%Y%m%d') || '/phour=' ||
    strftime(strptime(day || hour, '%Y%m%d%H') + INTERVAL 1 HOUR, '%H') FROM listing"""
PRESENT = """
  SELECT DISTINCT 'click' AS source, 'pdate=' || pdate || '/phour=' || phour AS part FROM clicks_a
  UNION ALL
  SELECT DISTINCT 'profile', 'pday=' || pday || '/phour=' || phour FROM user_profile"""


def _present(spark, sf):
    clicks = (fx.clicks_a(spark, sf)
              .select(F.lit("click").alias("source"),
                      F.concat(F.lit("pdate="), "pdate", F.lit("/phour="), "phour").alias("part"))
              .distinct())
    profiles = (fx.user_profile(spark, sf)
                .select(F.lit("profile").alias("source"),
                        F.concat(F.lit("pday="), "pday", F.lit("/phour="), "phour").alias("part"))
                .distinct())
    return clicks.unionByName(profiles)


@query("s10_readiness_gate", sql(f"""
  SELECT day, hour, source, part FROM ({REQUIRED}) r
  WHERE NOT EXISTS (SELECT 1 FROM ({PRESENT}) p
    WHERE p.source = r.source AND p.part = r.part)""", "listing", "user_profile"))
def s10(spark, sf):
    needed = snapshots.required_partitions(_listing(spark, sf))
    missing = snapshots.missing_partitions(needed, _present(spark, sf))
    return missing.select("day", "hour", "source", "part")


@query("s10_ready_hours", sql(f"""
  SELECT r.day, r.hour FROM ({REQUIRED}) r LEFT JOIN ({PRESENT}) p USING (source, part)
  GROUP BY r.day, r.hour HAVING bool_and(p.part IS NOT NULL)""", "listing", "user_profile"))
def s10_ready(spark, sf):
    hours = _listing(spark, sf).select("day", "hour")
    return snapshots.ready_hours(hours, _present(spark, sf))


@query("s11_retention", sql("""
  SELECT day FROM (SELECT day, dense_rank() OVER (ORDER BY day DESC) AS r FROM listing) t
  WHERE r > 7 GROUP BY day""", "listing"))
def s11(spark, sf):
    return snapshots.expired_days(_listing(spark, sf), 7)


@query("s12_next_run", sql("""
  SELECT day, hour,
    strftime(strptime(day || hour, '%Y%m%d%H') + INTERVAL 1 HOUR, '%Y%m%d') AS next_day,
    strftime(strptime(day || hour, '%Y%m%d%H') + INTERVAL 1 HOUR, '%H') AS next_hour
  FROM (SELECT day, hour FROM listing ORDER BY day DESC, hour DESC LIMIT 1) t""", "listing"))
def s12(spark, sf):
    return snapshots.next_run(_listing(spark, sf))


@query("s13_partition_count", sql("SELECT event_id, uid, id, ctime FROM clicks_a", "clicks_a"))
def s13(spark, sf):
    rows = fx.clicks_a(spark, sf).select("event_id", "uid", "id", "ctime")
    return clicklog.exact_partitions(rows, 10)


@query("s13_partition_numbers", sql(
    "SELECT CAST(10 AS BIGINT) AS n_parts, count(*) AS n_rows FROM clicks_a", "clicks_a"))
def s13_numbers(spark, sf):
    parts = clicklog.exact_partitions(fx.clicks_a(spark, sf).select("event_id"), 10)
    sizes = parts.groupBy(F.spark_partition_id().alias("part")).count()
    return sizes.agg(F.count("part").alias("n_parts"), F.sum("count").alias("n_rows"))
