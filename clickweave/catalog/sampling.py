"""Support filters, id codes, positions and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickweave.catalog import fixtures as fx
from clickweave.catalog.registry import query, sql, view
from clickweave.functions.arrays import pad_post
from clickweave.operators import samples as sm
from clickweave.operators.dedup import overlap
from clickweave.operators.ordering import in_order_read, with_history, with_position
from clickweave.operators.skew import key_sizes, skew_join
from clickweave.plans.sample_job import Prepared, prepare
from clickweave.session import materialize

view("item_kept", """
  SELECT * FROM clicks_b WHERE id IN (
    SELECT id FROM clicks_b GROUP BY id HAVING count(*) >= 25)""", "clicks_b")
view("kept", """
  SELECT * FROM item_kept WHERE uid IN (
    SELECT uid FROM item_kept GROUP BY uid HAVING count(*) >= 40)""", "item_kept")
view("user_codes", """
  SELECT uid, dense_rank() OVER (ORDER BY uid) AS code FROM (SELECT DISTINCT uid FROM kept) t""",
     "kept")
view("item_codes", """
  SELECT id, dense_rank() OVER (ORDER BY id) AS code FROM (SELECT DISTINCT id FROM kept) t""",
     "kept")
view("coded", """
  SELECT u.code AS user_id, i.code AS item_id, k.ctime
  FROM kept k JOIN user_codes u USING (uid) JOIN item_codes i USING (id)""",
     "user_codes", "item_codes")
view("placed", """
  SELECT user_id, item_id, ctime,
    row_number() OVER w - 1 AS pos, lead(1) OVER w IS NULL AS is_last,
    list_reverse(list(item_id) OVER (PARTITION BY user_id ORDER BY ctime, item_id
      ROWS BETWEEN 64 PRECEDING AND 1 PRECEDING)) AS hist
  FROM coded WINDOW w AS (PARTITION BY user_id ORDER BY ctime, item_id)""", "coded")
view("samples", """
  SELECT user_id, item_id, 1 AS label, hist, pos AS hist_len, pos, is_last AS is_test
  FROM placed WHERE pos >= 1""", "placed")


def prepared(spark, sf) -> Prepared:
    return prepare(fx.clicks_b(spark, sf), fx.INUM, fx.UNUM, fx.LENGTH)


def _joined(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.array_join(col, ","))


@query("j01_semi_join", sql("SELECT uid, id, ctime FROM item_kept", "item_kept"))
def j01(spark, sf):
    clicks = fx.clicks_b(spark, sf)
    sizes = key_sizes(clicks, ["id"])
    return skew_join(clicks, sizes.where(F.col("n") >= fx.INUM).select("id"), ["id"],
                     "left_semi", sizes=sizes).select("uid", "id", "ctime")


@query("j02_anti_join", sql("""
  SELECT DISTINCT pdate, phour FROM clicks_a c WHERE NOT EXISTS (
    SELECT 1 FROM user_profile p WHERE p.pday = c.pdate AND p.phour = c.phour)""",
                            "clicks_a", "user_profile"))
def j02(spark, sf):
    hours = fx.clicks_a(spark, sf).select("pdate", "phour").distinct()
    present = fx.user_profile(spark, sf).select(F.col("pday").alias("pdate"), "phour").distinct()
    return hours.join(present, ["pdate", "phour"], "left_anti")


@query("p01_item_support", sql("SELECT uid, id, ctime FROM item_kept", "item_kept"))
def p01(spark, sf):
    return sm.min_support(fx.clicks_b(spark, sf), "id", fx.INUM).select("uid", "id", "ctime")


@query("p02_user_support", sql("SELECT uid, id, ctime FROM kept", "kept"))
def p02(spark, sf):
    return sm.support_filter(fx.clicks_b(spark, sf), fx.INUM, fx.UNUM).select("uid", "id", "ctime")


@query("p03_preprocess", sql("SELECT uid, id, ctime FROM kept ORDER BY ctime, id, uid", "kept"))
def p03(spark, sf):
    return sm.preprocess(fx.clicks_b(spark, sf), fx.INUM, fx.UNUM).select("uid", "id", "ctime")


@query("p03_places", sql("""
  SELECT uid, id, ctime, row_number() OVER (ORDER BY ctime, id, uid) - 1 AS place FROM kept""",
                         "kept"))
def p03_places(spark, sf):
    rows = sm.preprocess(fx.clicks_b(spark, sf), fx.INUM, fx.UNUM).select("uid", "id", "ctime")
    return in_order_read(rows)


@query("p03_default_support", sql("""
  SELECT uid, count(*) AS n FROM (
    SELECT * FROM clicks_b WHERE id IN (
      SELECT id FROM clicks_b GROUP BY id HAVING count(*) >= 3)) t
  GROUP BY uid HAVING count(*) >= 6""", "clicks_b"))
def p03_default(spark, sf):
    return key_sizes(sm.support_filter(fx.clicks_b(spark, sf)), ["uid"])


@query("p04_label_encoding", sql("SELECT uid, user_id, id, item_id, ctime FROM (SELECT k.uid, "
                                 "u.code AS user_id, k.id, i.code AS item_id, k.ctime FROM kept k "
                                 "JOIN user_codes u USING (uid) JOIN item_codes i USING (id)) t",
                                 "user_codes", "item_codes"))
def p04(spark, sf):
    kept = materialize(sm.support_filter(fx.clicks_b(spark, sf), fx.INUM, fx.UNUM), "kept")
    coded = sm.encode(kept, "uid", sm.dictionary(kept, "uid"), "user_id")
    coded = sm.encode(coded, "id", sm.dictionary(kept, "id"), "item_id")
    return coded.select("uid", "user_id", "id", "item_id", "ctime")


@query("p05_vocabulary_size", sql("""
  SELECT 'uid' AS feature, max(code) + 1 AS vocabulary_size FROM user_codes
  UNION ALL SELECT 'id', max(code) + 1 FROM item_codes""", "user_codes", "item_codes"))
def p05(spark, sf):
    kept = materialize(sm.support_filter(fx.clicks_b(spark, sf), fx.INUM, fx.UNUM), "kept")
    sizes = [sm.vocabulary_size(sm.dictionary(kept, c)).select(F.lit(c).alias("feature"),
                                                               "vocabulary_size")
             for c in ("uid", "id")]
    return sizes[0].unionByName(sizes[1])


W01 = """
  SELECT uid, id, ctime, pos, array_to_string(list_reverse(hist), ',') AS hist FROM (
    SELECT uid, id, ctime, row_number() OVER w - 1 AS pos,
      list(id) OVER (PARTITION BY uid ORDER BY ctime, id ROWS BETWEEN 64 PRECEDING AND 1 PRECEDING)
        AS hist
    FROM clicks_b WINDOW w AS (PARTITION BY uid ORDER BY ctime, id)) t"""


@query("w01_running_prefix", sql(W01.replace("array_to_string(list_reverse(hist), ',')",
                                             "coalesce(array_to_string(list_reverse(hist), ','), '')"),
                                 "clicks_b"))
def w01(spark, sf):
    out = with_history(fx.clicks_b(spark, sf), "uid", ["ctime", "id"], "id", fx.LENGTH)
    return _joined(out, "hist").select("uid", "id", "ctime", "pos", "hist")


@query("w02_position_and_last", sql("""
  SELECT uid, id, ctime, row_number() OVER w - 1 AS pos, lead(1) OVER w IS NULL AS is_last
  FROM clicks_b WINDOW w AS (PARTITION BY uid ORDER BY ctime, id)""", "clicks_b"))
def w02(spark, sf):
    return (with_position(fx.clicks_b(spark, sf), "uid", ["ctime", "id"])
            .select("uid", "id", "ctime", "pos", "is_last"))


@query("t07_reverse_list", sql("""
  SELECT user_id, pos, array_to_string(list_reverse(hist), ',') AS oldest_first
  FROM samples""", "samples"))
def t07(spark, sf):
    return (prepared(spark, sf).samples
            .select("user_id", "pos", F.array_join(F.reverse("hist"), ",").alias("oldest_first")))


@query("t08_pad_truncate", sql("""
  SELECT user_id, pos, array_to_string(list_concat(hist,
      list_transform(range(0, 64 - len(hist)), lambda x: 0)), ',') AS padded
  FROM samples""", "samples"))
def t08(spark, sf):
    rows = prepared(spark, sf).samples
    return rows.select("user_id", "pos",
                       F.array_join(pad_post(F.col("hist"), fx.LENGTH), ",").alias("padded"))


@query("d04_overlap", sql("""
  SELECT user_id, pos, len(list_distinct(list_filter(hist[1:10],
      lambda x: list_contains(hist[11:64], x)))) AS n_both
  FROM samples""", "samples"))
def d04(spark, sf):
    rows = prepared(spark, sf).samples
    both = overlap(F.slice("hist", 1, 10), F.slice("hist", 11, 54))
    return rows.select("user_id", "pos", both.cast("bigint").alias("n_both"))


SAMPLE_SQL = "SELECT user_id, item_id, label, array_to_string(hist, ',') AS hist, hist_len, pos"


def _sample_cols(df: DataFrame) -> DataFrame:
    return _joined(df, "hist").withColumn("item_id", F.col("item_id").cast("bigint"))


@query("p06_prefix_samples", sql(SAMPLE_SQL + " FROM samples", "samples"))
def p06(spark, sf):
    return _sample_cols(prepared(spark, sf).samples).drop("is_test")


@query("p07_leave_last_out", sql(SAMPLE_SQL + ", is_test FROM samples", "samples"))
def p07(spark, sf):
    rows = prepared(spark, sf).samples
    return _sample_cols(sm.train_rows(rows).unionByName(sm.test_rows(rows)))


INPUT_SQL = """
  SELECT user_id, item_id, array_to_string(list_concat(hist,
      list_transform(range(0, 64 - len(hist)), lambda x: 0)), ',') AS hist_item_id,
    hist_len, label, is_test FROM samples"""


def _input_cols(df: DataFrame) -> DataFrame:
    return _joined(df, "hist_item_id").withColumn("item_id", F.col("item_id").cast("bigint"))


@query("p08_model_input", sql(INPUT_SQL, "samples"))
def p08(spark, sf):
    rows = prepared(spark, sf).samples
    return _input_cols(sm.model_input(rows, fx.LENGTH))


@query("p09_validation_split", sql(f"""
  SELECT user_id, pos, {fx.hash_sql('user_id', 'pos')} % 1000 < 500 AS in_validation
  FROM samples WHERE NOT is_test""", "samples"))
def p09(spark, sf):
    rows = sm.train_rows(prepared(spark, sf).samples)
    return rows.select("user_id", "pos", sm.in_validation(0.5).alias("in_validation"))


@query("p10_truth", sql("SELECT user_id, item_id AS true_item FROM samples WHERE is_test",
                        "samples"))
def p10(spark, sf):
    return (sm.truth(prepared(spark, sf).samples)
            .withColumn("true_item", F.col("true_item").cast("bigint")))


@query("p11_prepare", sql(INPUT_SQL, "samples"))
def p11(spark, sf):
    return _input_cols(prepared(spark, sf).inputs)
