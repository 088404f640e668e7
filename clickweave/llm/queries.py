"""The operators applied to the given tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickweave.llm import language_id, token_files
from clickweave.llm.bpe import bpe_encode
from clickweave.llm.chunk_dedup import repeated_spans
from clickweave.llm.common import table
from clickweave.llm.compression import compression_rules
from clickweave.llm.decontaminate import contamination
from clickweave.llm.filter_audit import filter_audit
from clickweave.llm.jaccard_join import jaccard_components
from clickweave.llm.kd_shards import kd_tree_shards
from clickweave.llm.license_scan import license_scan
from clickweave.llm.quality_fm import fold, score, train
from clickweave.llm.registry import QUERIES, SQL, query
from clickweave.llm.spelling import spelling_variants
from clickweave.llm.warc import fresh_folder, read_warc, write_warc

__all__ = ["QUERIES", "SQL"]


@query("op3_compression_bands")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_rules(table(spark, sf_dir, "documents"))


@query("op7_bpe_forced_boundaries")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe_encode(table(spark, sf_dir, "documents"), path, decode=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@query("op2_warc_sequential", """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex FROM p),
f AS (SELECT page_id, payload_bytes, hex, min(page_id) OVER (PARTITION BY hex) AS first FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::INTEGER, 5))::INTEGER
               >> (15 - 5 * (i % 4))::INTEGER) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_warc(table(spark, sf_dir, "pages"), fresh_folder(spark))
    records = read_warc(spark, archives, payload=False)

    def page(name: str) -> Column:
        return F.substring_index(name, ":", -1).cast("long")

    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest",
                          "record_type", page("refers_to").alias("refers_to"))


@query("op10_license_positional")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


@query("op8_kd_tree_shards")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_tree_shards(table(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op1_quality_fm")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"),
                                     "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op5_spaced_seeds")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_gear_chunks")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = repeated_spans(table(spark, sf_dir, "documents"))
    return spans.select(F.col("id").alias("doc_id"), F.col("start").cast("long").alias("start_byte"),
                        F.col("end").cast("long").alias("end_byte"),
                        F.col("n_words").cast("long").alias("n_words"),
                        F.col("first_id").alias("first_doc_id"))


@query("op6_jaccard_prefix_join", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 5
      THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w) t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (
  SELECT doc_id AS id, doc_id AS root FROM documents
  UNION
  SELECT l.b, r.root FROM r JOIN l ON l.a = r.id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.root) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.id = d.doc_id
GROUP BY d.doc_id, n.n""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (jaccard_components(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_shingles", "component_id"))


@query("op9_context_mixing_ids")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_tokens(table(spark, sf_dir, "documents"),
                                     token_files.fresh_folder(spark),
                                     public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_tokens(spark, files, with_ids=False).withColumnRenamed("id", "doc_id")


@query("op11_partenum_spelling", r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, b:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents) u
  WHERE length(run) >= 6 GROUP BY ALL),
bytes AS (
  SELECT doc_id, run, n, hex(coalesce(doc_id::VARCHAR, '') || ':' || run) AS x FROM runs),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, (2 * i + 1)::INTEGER, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) AS h
  FROM bytes, crc_table),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0
      THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed) u
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (
  SELECT DISTINCT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (
    SELECT word, unnest(range(length(word))) AS i FROM words) u),
pairs AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i
  WHERE a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON w.word = c.rest),
best AS (
  SELECT p.word, count(*) AS n_near, max(w.n) AS top,
         arg_min(p.near, (-w.n, p.near)) AS near
  FROM pairs p JOIN words w ON w.word = p.near GROUP BY p.word),
placed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.top >= 5 * w.n THEN b.near END AS form,
         CASE WHEN b.top >= 5 * w.n THEN b.top END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
paths AS (
  SELECT word, word AS root FROM placed
  UNION ALL
  SELECT p.word, f.form FROM paths p JOIN placed f ON f.word = p.root WHERE f.form IS NOT NULL)
SELECT p.word, p.form, r.root, p.n, p.n_near, p.form_n
FROM placed p JOIN paths r ON r.word = p.word JOIN placed l ON l.word = r.root
WHERE l.form IS NULL""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


@query("op12_gray_code_audit", r"""
WITH judged AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS lowest
  FROM documents),
known AS (
  SELECT doc_id, max((coalesce(quality, 0) = 1)::INTEGER) AS good,
         max((coalesce(toxic, 0) = 1)::INTEGER) AS toxic
  FROM labels GROUP BY doc_id),
marked AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(w) < 100)::INTEGER + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INTEGER
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INTEGER
         + 8 * regexp_matches(text, '[#$%&*|]')::INTEGER
         + 16 * coalesce(j.doc_id > j.lowest, false)::INTEGER AS mask
  FROM judged j LEFT JOIN known k ON k.doc_id = j.doc_id),
cells AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM marked GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS o
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT array_to_string(o, '') AS filter_order, s.step,
         list_sum(list_transform(o[:s.step - 1], lambda f: 1 << (ascii(f) - 65)))::INTEGER AS before,
         1 << (ascii(o[s.step]) - 65) AS bit
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s),
found AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & (coalesce(before, 0) | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & coalesce(before, 0) = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & coalesce(before, 0) <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & coalesce(before, 0) = 0 AND mask & bit <> 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (mask & coalesce(before, 0) = 0 AND mask & bit <> 0), 0)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM found""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_segmentation_unigrams")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    held_out = language_id.fold(F.col("id")) == language_id.HELD_OUT
    found = language_id.identify(docs.select(F.col("doc_id").alias("id"), "text"), model, "id")
    return found.select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score")
