"""Click logs, profiles and vectors derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickweave.catalog.registry import view
from clickweave.functions.hashing import portable_hash
from clickweave.functions.timeutil import epoch_of_ntz
from clickweave.operators.filters import hourly_clicks
from clickweave.session import scratch_path
from clickweave.sources.clicklog import click_table_schema, read_click_table, write_click_table

BLOCKED = ("error", "signup")
INUM, UNUM, LENGTH = 25, 40, 64
PER_USER = 4


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _gap(col: str, every: int, value: Column) -> Column:
    return F.when(F.col(col) % every != 0, value)


def clicks_a(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    kind = (F.when(F.col("event_id") % 4 == 0, "docpic").when(F.col("event_id") % 4 == 1, "video")
            .when(F.col("event_id") % 4 == 2, "minivideo").otherwise("other"))
    return e.select(
        "event_id",
        _gap("event_id", 97, F.col("user_id")).alias("uid"),
        F.get_json_object("props", "$.k").cast("bigint").alias("id"),
        _gap("event_id", 101, epoch_of_ntz(F.col("ts"))).alias("ctime"),
        _gap("event_id", 89, F.col("event_type")).alias("sch"),
        kind.alias("itemtype"),
        F.col("value").alias("dur_sec"),
        (F.col("event_id") % 20).cast("double").alias("readrate"),
        F.date_format("ts", "yyyyMMdd").alias("pdate"),
        F.date_format("ts", "HH").alias("phour"))


view("clicks_a", """
  SELECT event_id,
    CASE WHEN event_id % 97 <> 0 THEN user_id END AS uid,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS id,
    CASE WHEN event_id % 101 <> 0 THEN CAST(floor(epoch(ts)) AS BIGINT) END AS ctime,
    CASE WHEN event_id % 89 <> 0 THEN event_type END AS sch,
    CASE event_id % 4 WHEN 0 THEN 'docpic' WHEN 1 THEN 'video' WHEN 2 THEN 'minivideo'
      ELSE 'other' END AS itemtype,
    value AS dur_sec, CAST(event_id % 20 AS DOUBLE) AS readrate,
    strftime(ts, '%Y%m%d') AS pdate, strftime(ts, '%H') AS phour
  FROM events""")

view("good_clicks", """
  SELECT * FROM clicks_a
  WHERE uid IS NOT NULL AND id IS NOT NULL AND ctime IS NOT NULL AND ctime > 0
    AND sch NOT IN ('error', 'signup') AND (dur_sec >= 10.0 OR readrate >= 10.0)
    AND itemtype IN ('docpic', 'video', 'minivideo')""", "clicks_a")


def good_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return hourly_clicks(clicks_a(spark, sf), blocked=BLOCKED)


_CLICK_TABLES: dict[tuple[str, str], tuple[str, object]] = {}


def click_table(spark: SparkSession, sf: str) -> DataFrame:
    """clicks_a as a table partitioned by hour; written once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CLICK_TABLES:
        rows, path = clicks_a(spark, sf), scratch_path(spark, "click_table")
        write_click_table(rows, path)
        _CLICK_TABLES[key] = path, click_table_schema(rows)
    path, schema = _CLICK_TABLES[key]
    return read_click_table(spark, path, schema)


def clicks_b(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("uid"),
        epoch_of_ntz(F.col("o_orderdate")).alias("ctime"))
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"),
                                                F.col("l_partkey").alias("id"))
    return orders.join(lines, "k").select("uid", "id", "ctime")


view("clicks_b", """
  SELECT o_custkey AS uid, l_partkey AS id, CAST(epoch(o_orderdate) AS BIGINT) AS ctime
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")


def _profile(df: DataFrame, key: str, out: str) -> list[Column]:
    k = F.col(key)
    return [k.alias(out), _gap(key, 11, k).alias("dump_time"), _gap(key, 13, k).alias("recom_time"),
            F.lit("20240101").alias("pday"),
            F.lpad((k % 24).cast("string"), 2, "0").alias("phour")]


def user_profile(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(*_profile(c, "c_custkey", "uid"),
                    _gap("c_custkey", 7, F.col("c_mktsegment")).alias("user_group"),
                    _gap("c_custkey", 5, F.col("c_acctbal")).alias("general_doc_timesensitive"))


view("user_profile", """
  SELECT c_custkey AS uid,
    CASE WHEN c_custkey % 11 <> 0 THEN c_custkey END AS dump_time,
    CASE WHEN c_custkey % 13 <> 0 THEN c_custkey END AS recom_time,
    '20240101' AS pday, lpad(CAST(c_custkey % 24 AS VARCHAR), 2, '0') AS phour,
    CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS user_group,
    CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS general_doc_timesensitive
  FROM customer""")


def item_profile(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return p.select(*_profile(p, "p_partkey", "recom_id"), F.col("p_name").alias("title"),
                    F.col("p_type").alias("c"), F.col("p_brand").alias("source"))


view("item_profile", """
  SELECT p_partkey AS recom_id,
    CASE WHEN p_partkey % 11 <> 0 THEN p_partkey END AS dump_time,
    CASE WHEN p_partkey % 13 <> 0 THEN p_partkey END AS recom_time,
    '20240101' AS pday, lpad(CAST(p_partkey % 24 AS VARCHAR), 2, '0') AS phour,
    p_name AS title, p_type AS c, p_brand AS source
  FROM part""")


# --- vectors: every embedding is an item and a query vector --------------------

def items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("item_id"), F.col("embedding").alias("vec"), "label")


def queries(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("vec"), "label")


view("vecs", "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings")

CENTROID_IDS = (100, 109)
CODE_IDS = (100, 131)
PARTS, WIDTH = 8, 8


def _given(spark: SparkSession, sf: str, ids: tuple[int, int]) -> np.ndarray:
    rows = (items(spark, sf).where(F.col("item_id").between(*ids)).orderBy("item_id").collect())
    return np.array([r["vec"] for r in rows], dtype=np.float64)


def given_centroids(spark: SparkSession, sf: str) -> np.ndarray:
    """A given model: the vectors 100 .. 109."""
    return _given(spark, sf, CENTROID_IDS)


def given_codebook(spark: SparkSession, sf: str) -> np.ndarray:
    """A given model: sub-vectors of the residuals of the vectors 100 .. 131."""
    from clickweave.operators.blockscore import nearest_rows
    centers = given_centroids(spark, sf)
    vecs = _given(spark, sf, CODE_IDS)
    gap = vecs - centers[nearest_rows(vecs, centers, 1)[0][:, 0]]
    return gap.reshape(len(vecs), PARTS, WIDTH).transpose(1, 0, 2)


view("centroids", """
  SELECT vec_id - 100 AS cell, v FROM vecs WHERE vec_id BETWEEN 100 AND 109""", "vecs")
view("cell_dist", """
  SELECT vec_id, cell, round(pow(list_distance(a.v, c.v), 2), 9) AS d,
    row_number() OVER (PARTITION BY vec_id ORDER BY round(pow(list_distance(a.v, c.v), 2), 9),
      cell) AS r
  FROM vecs a CROSS JOIN centroids c""", "vecs", "centroids")
view("assigned", "SELECT vec_id, cell FROM cell_dist WHERE r = 1", "cell_dist")
view("pair_dist", """
  SELECT q.vec_id AS query_id, i.vec_id AS item_id,
    round(pow(list_distance(q.v, i.v), 2), 9) AS distance
  FROM vecs q CROSS JOIN vecs i""", "vecs")


# --- numbers fixed by a hash, for models given by a rule ------------------------

def rule_number(*parts) -> float:
    """Value in [-1, 1] in steps of 1/1000."""
    text = ":".join(str(p) for p in parts)
    return (int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % 2001 - 1000) / 1000.0


def rule_column(*parts: Column | str) -> Column:
    text = F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(p)
                              for p in parts])
    return (F.pmod(portable_hash(text), F.lit(2001)) - 1000) / F.lit(1000.0)


def hash_sql(*parts: str) -> str:
    """SQL of the portable hash; parts are SQL expressions."""
    text = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def rule_sql(*parts: str) -> str:
    return f"(({hash_sql(*parts)} % 2001 - 1000) / CAST(1000 AS DOUBLE))"
