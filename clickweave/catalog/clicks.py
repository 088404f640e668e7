"""Filters, aggregates, sorts and set operations on the click log and the profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweave.catalog import fixtures as fx
from clickweave.catalog.registry import query, sql
from clickweave.operators import aggregates as ag, filters as fl
from clickweave.operators.dedup import distinct_values, latest_per_key, union_all
from clickweave.operators.ordering import (
    first_rows, history_lists, in_order_read, shuffled, sort_rows,
)
from clickweave.plans.window_job import cutoff_epoch
from clickweave.sources.clicklog import exact_partitions

COLS = ["event_id", "uid", "id", "ctime"]
MAP_BOUND = 40
NOT_NULL = "uid IS NOT NULL AND id IS NOT NULL AND ctime IS NOT NULL"


@query("f01_not_null", sql(f"SELECT event_id, uid, id, ctime FROM clicks_a WHERE {NOT_NULL}",
                           "clicks_a"))
def f01(spark, sf):
    return fx.clicks_a(spark, sf).where(fl.not_null()).select(*COLS)


@query("f02_channel_blocklist", sql("""
  SELECT event_id, sch FROM clicks_a WHERE sch NOT IN ('error', 'signup')""", "clicks_a"))
def f02(spark, sf):
    return fx.clicks_a(spark, sf).where(fl.channel_allowed(fx.BLOCKED)).select("event_id", "sch")


@query("f03_item_type_allowlist", sql("""
  SELECT event_id, itemtype FROM clicks_a
  WHERE itemtype IN ('docpic', 'video', 'minivideo')""", "clicks_a"))
def f03(spark, sf):
    return fx.clicks_a(spark, sf).where(fl.item_type_allowed()).select("event_id", "itemtype")


@query("f04_engagement_threshold", sql("""
  SELECT event_id, dur_sec, readrate FROM clicks_a
  WHERE dur_sec >= 10.0 OR readrate >= 10.0""", "clicks_a"))
def f04(spark, sf):
    return fx.clicks_a(spark, sf).where(fl.engaged()).select("event_id", "dur_sec", "readrate")


@query("f05_partition_range", sql("""
  SELECT event_id, pdate, phour FROM clicks_a
  WHERE pdate || phour BETWEEN '2024010501' AND '2024011201'""", "clicks_a"))
def f05(spark, sf):
    return (fx.click_table(spark, sf).where(fl.hour_range("2024010501", "2024011201"))
            .select("event_id", "pdate", "phour"))


@query("f06_partition_equality", sql("""
  SELECT event_id, pdate, phour FROM clicks_a
  WHERE CAST(pdate AS BIGINT) = 20240121 AND CAST(phour AS BIGINT) = 1""", "clicks_a"))
def f06(spark, sf):
    return (fx.click_table(spark, sf).where(fl.partition_is(20240121, 1))
            .select("event_id", "pdate", "phour"))


@query("f07_sliding_cutoff", sql("""
  SELECT event_id, ctime FROM clicks_a
  WHERE ctime > CAST(epoch(TIMESTAMP '2024-01-21 00:00:00' - INTERVAL 168 HOUR) AS BIGINT)""",
                                 "clicks_a"))
def f07(spark, sf):
    return (fx.clicks_a(spark, sf).where(fl.newer_than(cutoff_epoch("20240121", "00")))
            .select("event_id", "ctime"))


@query("f08_valid_time", sql("SELECT event_id, ctime FROM clicks_a WHERE ctime > 0", "clicks_a"))
def f08(spark, sf):
    return fx.clicks_a(spark, sf).where(fl.valid_time()).select("event_id", "ctime")


@query("f09_first_rows", sql("""
  SELECT event_id, uid, id, ctime FROM good_clicks ORDER BY ctime, id, event_id LIMIT 20""",
                             "good_clicks"))
def f09(spark, sf):
    return first_rows(fx.good_clicks(spark, sf).select(*COLS), ["ctime", "id", "event_id"], 20)


@query("f09_first_rows_many", sql(
    "SELECT ctime, id, uid FROM clicks_b ORDER BY ctime, id, uid LIMIT 12000", "clicks_b"))
def f09_many(spark, sf):
    """More rows than a sort on one task takes, by an order with many ties."""
    return first_rows(fx.clicks_b(spark, sf).select("ctime", "id", "uid"), ["ctime"], 12_000)


@query("f10_pair_shape", sql(f"SELECT uid, id AS v_id, ctime AS v_ctime FROM clicks_a WHERE {NOT_NULL}",
                             "clicks_a"))
def f10(spark, sf):
    pairs = fl.keyed_pairs(fx.clicks_a(spark, sf).where(fl.not_null()))
    return pairs.select("uid", F.col("v.id").alias("v_id"), F.col("v.ctime").alias("v_ctime"))


@query("f11_profile_attributes", sql("""
  SELECT uid, user_group, round(general_doc_timesensitive, 6) AS general_doc_timesensitive
  FROM user_profile WHERE pday = '20240101' AND phour = '03'
    AND general_doc_timesensitive IS NOT NULL""", "user_profile"))
def f11(spark, sf):
    rows = fl.attribute_rows(fx.user_profile(spark, sf),
                             ["uid", "user_group", "general_doc_timesensitive"],
                             "20240101", "03", "general_doc_timesensitive")
    return rows.withColumn("general_doc_timesensitive", F.round("general_doc_timesensitive", 6))


# --- aggregates ----------------------------------------------------------------

@query("a01_row_count", sql(f"""
  SELECT count(*) AS n FROM clicks_a WHERE {NOT_NULL} AND sch NOT IN ('error', 'signup')""",
                            "clicks_a"))
def a01(spark, sf):
    return ag.row_count(fx.clicks_a(spark, sf), fl.not_null() & fl.channel_allowed(fx.BLOCKED))


@query("a02_distinct_count", sql("""
  SELECT 'user' AS kind, count(DISTINCT uid) AS n FROM user_profile
  WHERE pday || phour BETWEEN '2024010101' AND '2024010121' AND uid IS NOT NULL
    AND dump_time IS NOT NULL AND recom_time IS NOT NULL
  UNION ALL
  SELECT 'item', count(DISTINCT recom_id) FROM item_profile
  WHERE pday || phour BETWEEN '2024010101' AND '2024010121' AND recom_id IS NOT NULL
    AND dump_time IS NOT NULL AND recom_time IS NOT NULL""", "user_profile", "item_profile"))
def a02(spark, sf):
    out = None
    for kind, df, key in (("user", fx.user_profile(spark, sf), "uid"),
                          ("item", fx.item_profile(spark, sf), "recom_id")):
        rows = df.where(fl.hour_range("2024010101", "2024010121", "pday")
                        & fl.not_null([key, "dump_time", "recom_time"]))
        one = ag.distinct_count(rows, key).select(F.lit(kind).alias("kind"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("a03_count_per_key", sql("SELECT id, count(*) AS n FROM clicks_a GROUP BY id", "clicks_a"))
def a03(spark, sf):
    return ag.count_per_key(fx.clicks_a(spark, sf), "id")


@query("a04_having_count", sql(f"""
  SELECT id, count(*) AS n FROM clicks_a WHERE {NOT_NULL} GROUP BY id HAVING count(*) > 100""",
                               "clicks_a"))
def a04(spark, sf):
    return ag.frequent_keys(fx.clicks_a(spark, sf).where(fl.not_null()), "id", 100)


@query("a05_sum_per_key", sql("""
  SELECT uid, CAST(sum(id) AS BIGINT) AS total FROM clicks_a GROUP BY uid""", "clicks_a"))
def a05(spark, sf):
    return ag.sum_per_key(fx.clicks_a(spark, sf), "uid", "id")


def _sliced(spark, sf, slices):
    rows = fx.clicks_a(spark, sf)
    return rows.withColumn("part", ag.slice_of(F.col("event_id"), rows.count(), slices))


A06 = """
  SELECT uid, CAST(sum(p) AS BIGINT) AS result FROM (
    SELECT uid, part, {agg} AS p FROM (
      SELECT uid, id, ((event_id + 1) * {n} - 1) // (SELECT count(*) FROM clicks_a) AS part
      FROM clicks_a) s GROUP BY uid, part) t GROUP BY uid"""


@query("a06_two_phase_max", sql(A06.format(agg="greatest(max(id), 3)", n=6), "clicks_a"))
def a06(spark, sf):
    return ag.max_then_sum(_sliced(spark, sf, 6), "uid", "id", "part", 3)


@query("a07_two_phase_sum", sql(A06.format(agg="sum(id) + 1", n=4), "clicks_a"))
def a07(spark, sf):
    return ag.sum_with_zero(_sliced(spark, sf, 4), "uid", "id", "part", 1)


@query("a08_history_lists", sql(f"""
  SELECT uid, CAST(0 AS BIGINT) AS part,
    string_agg(CAST(id AS VARCHAR), ',' ORDER BY ctime, id) AS history
  FROM clicks_a WHERE {NOT_NULL} GROUP BY uid""", "clicks_a"))
def a08(spark, sf):
    rows = fx.clicks_a(spark, sf).where(fl.not_null())
    lists = history_lists(rows, "uid", ["ctime", "id"], ["id"])
    return lists.withColumn("history", F.array_join("history", ","))


@query("a09_pairs_as_map", sql("""
  SELECT sch AS k, count(*) AS v FROM clicks_a WHERE sch IS NOT NULL GROUP BY sch""", "clicks_a"))
def a09(spark, sf):
    rows = fx.clicks_a(spark, sf).where("sch is not null")
    return ag.pairs_as_map(ag.count_per_key(rows, "sch"), "sch", "n").select(
        F.explode("m").alias("k", "v"))


@query("a09_maps_in_parts", sql("""
  SELECT id AS k, count(*) AS v, true AS fits, true AS in_its_part FROM clicks_a
  WHERE id IS NOT NULL GROUP BY id""", "clicks_a"))
def a09_parts(spark, sf):
    """More keys than a value holds: every piece within its bound, every key in its part."""
    rows = fx.clicks_a(spark, sf).where("id is not null")
    maps = ag.pairs_as_maps(ag.count_per_key(rows, "id"), "id", "n", MAP_BOUND)
    entries = maps.select("part", "parts", F.size("m").alias("size"), F.explode("m").alias("k", "v"))
    return entries.select("k", "v", (F.col("size") <= MAP_BOUND).alias("fits"),
                          (F.col("part") == ag.map_part(F.col("k"), F.col("parts"))).alias("in_its_part"))


@query("a10_partition_profile")
def a10(spark, sf):
    return ag.partition_profile(exact_partitions(fx.clicks_a(spark, sf), 8), "event_id")


@query("a10_profile_facts", sql("""
  SELECT CAST(8 AS BIGINT) AS n_parts, count(*) AS n_rows, min(event_id) AS lo, max(event_id) AS hi
  FROM clicks_a""", "clicks_a"))
def a10_facts(spark, sf):
    """What the profile of any split into eight partitions adds up to."""
    profile = ag.partition_profile(exact_partitions(fx.clicks_a(spark, sf), 8), "event_id")
    return profile.agg(F.count("part").alias("n_parts"), F.sum("n").alias("n_rows"),
                       F.min("lo").alias("lo"), F.max("hi").alias("hi"))


@query("a11_funnel", sql(f"""
  SELECT stage, count(*) AS n_rows, count(DISTINCT id) AS n_items, count(DISTINCT uid) AS n_users
  FROM (SELECT 'all' AS stage, uid, id FROM clicks_a
        UNION ALL SELECT 'not_null', uid, id FROM clicks_a WHERE {NOT_NULL}
        UNION ALL SELECT 'quality', uid, id FROM good_clicks) s
  GROUP BY stage""", "good_clicks"))
def a11(spark, sf):
    quality = (fl.not_null() & fl.channel_allowed(fx.BLOCKED) & fl.engaged()
               & fl.item_type_allowed())
    return ag.funnel(fx.clicks_a(spark, sf), [("all", F.lit(True)), ("not_null", fl.not_null()),
                                              ("quality", quality)])


# --- sorts -----------------------------------------------------------------------

@query("o01_global_sort", sql("SELECT uid, id, ctime FROM clicks_b ORDER BY ctime, id, uid",
                              "clicks_b"))
def o01(spark, sf):
    return sort_rows(fx.clicks_b(spark, sf), ["ctime", "id"])


@query("o01_places", sql("""
  SELECT uid, id, ctime, row_number() OVER (ORDER BY ctime, id, uid) - 1 AS place FROM clicks_b""",
                         "clicks_b"))
def o01_places(spark, sf):
    """The place in which a reader of the sorted table meets each row."""
    return in_order_read(sort_rows(fx.clicks_b(spark, sf), ["ctime", "id"]))


@query("o04_random_order", sql(f"""
  SELECT event_id, uid, id, {fx.hash_sql('event_id', "'11'")} AS sort_key FROM clicks_a""",
                               "clicks_a"))
def o04(spark, sf):
    return shuffled(fx.clicks_a(spark, sf).select("event_id", "uid", "id"), ["event_id"], 11)


# --- sets --------------------------------------------------------------------------

@query("d01_union_all", sql("""
  SELECT uid, id, ctime FROM good_clicks WHERE pdate < '20240110'
  UNION ALL SELECT uid, id, ctime FROM good_clicks WHERE pdate >= '20240108'""", "good_clicks"))
def d01(spark, sf):
    rows = fx.good_clicks(spark, sf)
    return union_all(rows.where("pdate < '20240110'").select("uid", "id", "ctime"),
                     rows.where("pdate >= '20240108'").select("uid", "id", "ctime"))


@query("d02_latest_per_key", sql("""
  SELECT uid, id, max(ctime) AS ctime FROM good_clicks GROUP BY uid, id""", "good_clicks"))
def d02(spark, sf):
    return latest_per_key(fx.good_clicks(spark, sf))


@query("d03_distinct_items", sql("SELECT DISTINCT id FROM clicks_b", "clicks_b"))
def d03(spark, sf):
    return distinct_values(fx.clicks_b(spark, sf), ["id"])
