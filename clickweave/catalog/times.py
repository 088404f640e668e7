"""Scalar functions on partition times, lists and ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweave.catalog import fixtures as fx
from clickweave.catalog.registry import query, sql, view
from clickweave.functions import hashing as hs, timeutil as tu
from clickweave.operators.aggregates import count_per_key

view("hours", "SELECT DISTINCT pdate, phour FROM clicks_a", "clicks_a")


def _hours(spark, sf):
    return fx.clicks_a(spark, sf).select("pdate", "phour").distinct()


@query("t01_shift_hours", sql("""
  SELECT pdate, phour, n,
    strftime(strptime(pdate || phour, '%Y%m%d%H') + to_hours(n), '%Y%m%d') AS new_day,
    strftime(strptime(pdate || phour, '%Y%m%d%H') + to_hours(n), '%H') AS new_hour
  FROM hours, (VALUES (-168), (-1), (1), (25)) s(n)""", "hours"))
def t01(spark, sf):
    steps = F.explode(F.array(*[F.lit(n) for n in (-168, -1, 1, 25)]))
    day, hour = tu.shift_hours(F.col("pdate"), F.col("phour"), F.col("n"))
    return (_hours(spark, sf).withColumn("n", steps)
            .select("pdate", "phour", "n", day.alias("new_day"), hour.alias("new_hour")))


@query("t02_next_day", sql("""
  SELECT DISTINCT pdate, strftime(strptime(pdate, '%Y%m%d') + INTERVAL 1 DAY, '%Y%m%d') AS next_day
  FROM hours""", "hours"))
def t02(spark, sf):
    return (_hours(spark, sf).select("pdate").distinct()
            .withColumn("next_day", tu.next_day(F.col("pdate"))))


@query("t03_next_hour", sql("""
  SELECT pdate, phour,
    strftime(strptime(pdate || phour, '%Y%m%d%H') + INTERVAL 1 HOUR, '%Y%m%d') AS next_day,
    strftime(strptime(pdate || phour, '%Y%m%d%H') + INTERVAL 1 HOUR, '%H') AS next_hour
  FROM hours""", "hours"))
def t03(spark, sf):
    day, hour = tu.next_hour(F.col("pdate"), F.col("phour"))
    return _hours(spark, sf).select("pdate", "phour", day.alias("next_day"),
                                    hour.alias("next_hour"))


@query("t04_epoch_of_hour", sql("""
  SELECT pdate, phour, CAST(epoch(strptime(pdate || phour, '%Y%m%d%H') - INTERVAL 8 HOUR) AS BIGINT)
    AS epoch_shanghai, CAST(epoch(strptime(pdate || phour, '%Y%m%d%H')) AS BIGINT) AS epoch_utc
  FROM hours""", "hours"))
def t04(spark, sf):
    text = F.concat("pdate", "phour")
    return _hours(spark, sf).select(
        "pdate", "phour", tu.epoch_of_hour(text, "Asia/Shanghai").alias("epoch_shanghai"),
        tu.epoch_of_hour(text, "UTC").alias("epoch_utc"))


@query("t05_partition_path", sql("""
  SELECT 'pdate=' || pdate || '/phour=' || phour AS click_part,
    'pday=' || pdate || '/phour=' || phour AS profile_part FROM hours""", "hours"))
def t05(spark, sf):
    part = tu.click_partition(F.col("pdate"), F.col("phour"))
    return _hours(spark, sf).select(part.alias("click_part"),
                                    tu.profile_partition(part).alias("profile_part"))


@query("t06_day_in_path", sql("""
  SELECT '/clicks/' || pdate || '/' || phour AS path, pdate AS day FROM hours""", "hours"))
def t06(spark, sf):
    path = F.concat(F.lit("/clicks/"), "pdate", F.lit("/"), "phour")
    return _hours(spark, sf).select(path.alias("path"), tu.day_in_path(path).alias("day"))


@query("t09_auto_dim", sql("""
  SELECT l_suppkey AS k, n, CAST(6 * floor(pow(n, 0.25)) AS INTEGER) AS dim
  FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey) t"""))
def t09(spark, sf):
    sizes = count_per_key(fx.table(spark, sf, "lineitem"), "l_suppkey")
    return sizes.select(F.col("l_suppkey").alias("k"), "n", hs.auto_dim(F.col("n")).alias("dim"))


@query("t10_hash_bucket", sql(f"""
  SELECT event_id, {fx.hash_sql('id')} % 100 AS plain,
    CASE WHEN id = 0 THEN 0 ELSE {fx.hash_sql('id')} % 99 + 1 END AS masked,
    {fx.hash_sql('sch')} % 100 AS text_bucket
  FROM clicks_a""", "clicks_a"))
def t10(spark, sf):
    return fx.clicks_a(spark, sf).select(
        "event_id", hs.bucket(F.col("id"), 100).alias("plain"),
        hs.bucket(F.col("id"), 100, mask_zero=True).alias("masked"),
        hs.bucket(F.col("sch"), 100).alias("text_bucket"))
