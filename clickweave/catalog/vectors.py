"""Nearest neighbours, merged hits and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickweave.catalog import fixtures as fx
from clickweave.catalog.registry import query, sql, view
from clickweave.functions.arrays import rounded
from clickweave.operators import bounded as bd, evaluation as ev, index as ix, retrieval as rt
from clickweave.operators.ordering import first_in_group, top_k
from clickweave.operators.skew import with_row_index
from clickweave.session import scratch_path

K, PROBES, SIZE = 10, 3, 100

view("ranked", """
  SELECT query_id, item_id, distance,
    row_number() OVER (PARTITION BY query_id ORDER BY distance, item_id) AS rank
  FROM pair_dist""", "pair_dist")


def _out(hits: DataFrame, *keys: str) -> DataFrame:
    return hits.select(*keys, "item_id", rounded(F.col("distance")).alias("distance"),
                       F.col("rank").cast("bigint").alias("rank"))


OUT = "SELECT query_id, item_id, round(distance, 6) + 0.0 AS distance, rank FROM "


@query("r01_exact_search", sql(OUT + "ranked WHERE rank <= 10", "ranked"))
def r01(spark, sf):
    return _out(rt.exact_search(fx.items(spark, sf), fx.queries(spark, sf), K), "query_id")


@query("r01_exact_search_blocks", sql(OUT + "ranked WHERE rank <= 10", "ranked"))
def r01_blocks(spark, sf):
    """The form for query sets that do not fit a task."""
    hits = rt.exact_search(fx.items(spark, sf), fx.queries(spark, sf), K, small_values=0,
                           item_block=128, query_block=200)
    return _out(hits, "query_id")


def _bounded(spark, sf):
    """Small blocks and query sets that count as large, as on large tables."""
    return bd.bounded_search(fx.items(spark, sf), fx.queries(spark, sf), K,
                             pivots=fx.given_centroids(spark, sf), small_values=0,
                             item_block=128, query_block=200)


@query("r01_bounded_search", sql(OUT + "ranked WHERE rank <= 10", "ranked"))
def r01_bounded(spark, sf):
    """The same result from the cells that distance bounds leave."""
    return _out(_bounded(spark, sf).hits, "query_id")


@query("j05_distance_join_per_cell", sql("""
  SELECT query_id, item_id, round(distance, 6) + 0.0 AS distance, rank FROM (
    SELECT p.query_id, p.item_id, p.distance,
      row_number() OVER (PARTITION BY p.query_id ORDER BY p.distance, p.item_id) AS rank
    FROM pair_dist p JOIN vecs a ON a.vec_id = p.query_id
      JOIN vecs b ON b.vec_id = p.item_id AND b.label = a.label) t
  WHERE rank <= 3""", "pair_dist"))
def j05(spark, sf):
    hits = rt.exact_search(fx.items(spark, sf), fx.queries(spark, sf), 3, cell="label")
    return _out(hits, "query_id")


NAMED_CELLS = """
  SELECT query_id, item_id, round(distance, 6) + 0.0 AS distance, rank FROM (
    SELECT p.query_id, p.item_id, p.distance,
      row_number() OVER (PARTITION BY p.query_id ORDER BY p.distance, p.item_id) AS rank
    FROM pair_dist p JOIN vecs a ON a.vec_id = p.query_id
      JOIN vecs b ON b.vec_id = p.item_id AND b.label = a.label
    WHERE p.query_id % 7 <> 0 AND p.item_id % 7 <> 0) t
  WHERE rank <= 3"""


def _named_cells(df, key):
    """Text cells, missing in every seventh row."""
    name = F.when(F.col(key) % 7 != 0, F.concat(F.lit("cell "), F.col("label").cast("string")))
    return df.withColumn("named", name)


@query("j05_text_cells", sql(NAMED_CELLS, "pair_dist"))
def j05_text(spark, sf):
    hits = rt.exact_search(_named_cells(fx.items(spark, sf), "item_id"),
                           _named_cells(fx.queries(spark, sf), "query_id"), 3, cell="named")
    return _out(hits, "query_id")


@query("j05_text_cells_blocks", sql(NAMED_CELLS, "pair_dist"))
def j05_text_blocks(spark, sf):
    hits = rt.exact_search(_named_cells(fx.items(spark, sf), "item_id"),
                           _named_cells(fx.queries(spark, sf), "query_id"), 3, cell="named",
                           small_values=0, item_block=64, query_block=16)
    return _out(hits, "query_id")


@query("o02_top_k", sql("""
  SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, rank FROM (
    SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, row_number() OVER (
      PARTITION BY l_suppkey ORDER BY l_extendedprice, l_orderkey, l_linenumber) AS rank
    FROM lineitem) t WHERE rank <= 5"""))
def o02(spark, sf):
    lines = fx.table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber",
                                                   "l_extendedprice")
    out = top_k(lines, ["l_suppkey"], ["l_extendedprice", "l_orderkey", "l_linenumber"], 5)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


# --- inverted lists ---------------------------------------------------------------

_INDEXES: dict[tuple[str, str], str] = {}


def stored_index(spark, sf):
    """All items in cells, with vectors and codes; written once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _INDEXES:
        path = scratch_path(spark, "index")
        ix.build_index(fx.items(spark, sf).select("item_id", "vec"), path,
                       fx.given_centroids(spark, sf), fx.given_codebook(spark, sf))
        _INDEXES[key] = path
    return ix.open_index(spark, _INDEXES[key])


def _indexed(spark, sf):
    centers = fx.given_centroids(spark, sf)
    return rt.assign_cells(fx.items(spark, sf), centers), centers


@query("r02_ivf_assign", sql("SELECT vec_id AS item_id, cell FROM assigned", "assigned"))
def r02(spark, sf):
    return _indexed(spark, sf)[0].select("item_id", F.col("cell").cast("bigint").alias("cell"))


@query("r02_ivf_train")
def r02_train(spark, sf):
    vecs = fx.items(spark, sf)
    return rt.assign_cells(vecs, rt.train_centroids(vecs, 10)).select("item_id", "cell")


@query("r02_train_facts", """
  SELECT count(*) AS n_items, CAST(10 AS BIGINT) AS n_cells, CAST(0 AS BIGINT) AS n_misplaced
  FROM embeddings""")
def r02_facts(spark, sf):
    """Trained cells that are used, and items that lie nearer to another centroid than theirs."""
    vecs = fx.items(spark, sf)
    centers = rt.train_centroids(vecs, 10)
    placed = rt.assign_cells(vecs, centers).select("item_id", "vec", "cell")
    points = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers])
    gap = F.transform(points, lambda c: F.aggregate(
        F.zip_with("vec", c, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    checked = placed.withColumn("gaps", gap)
    own = F.element_at("gaps", F.col("cell") + 1)
    return checked.agg(F.count("item_id").alias("n_items"),
                       F.count_distinct("cell").alias("n_cells"),
                       F.sum(F.when(own > F.array_min("gaps") + 1e-9, 1).otherwise(0))
                       .alias("n_misplaced"))


IVF_HITS = OUT + """(
  SELECT p.query_id, p.item_id, p.distance, row_number() OVER (
    PARTITION BY p.query_id ORDER BY p.distance, p.item_id) AS rank
  FROM pair_dist p JOIN assigned a ON a.vec_id = p.item_id
    JOIN cell_dist c ON c.vec_id = p.query_id AND c.cell = a.cell AND c.r <= 3) t
  WHERE rank <= 10"""


@query("r03_ivf_search", sql(IVF_HITS, "pair_dist", "assigned"))
def r03(spark, sf):
    return _out(stored_index(spark, sf).search(fx.queries(spark, sf), K, PROBES), "query_id")


@query("r03_ivf_search_blocks", sql(IVF_HITS, "pair_dist", "assigned"))
def r03_blocks(spark, sf):
    """The form for query sets that do not fit a task."""
    hits = stored_index(spark, sf).search(fx.queries(spark, sf), K, PROBES, small_values=0,
                                          item_block=64, query_block=64)
    return _out(hits, "query_id")


# --- product codes ----------------------------------------------------------------

view("resid", """
  SELECT a.vec_id, a.cell, d, v.v[d + 1] - c.v[d + 1] AS x
  FROM assigned a JOIN vecs v ON v.vec_id = a.vec_id JOIN centroids c ON c.cell = a.cell,
    range(0, 64) t(d)""", "assigned", "centroids", "vecs")
view("codebook", """
  SELECT vec_id - 100 AS code, d // 8 AS sub, d % 8 AS j, x FROM resid
  WHERE vec_id BETWEEN 100 AND 131""", "resid")
view("codes", """
  SELECT vec_id, cell, sub, code FROM (
    SELECT vec_id, cell, sub, code, row_number() OVER (
      PARTITION BY vec_id, sub ORDER BY round(dist, 9), code) AS r
    FROM (SELECT r.vec_id, r.cell, b.sub, b.code, sum((r.x - b.x) * (r.x - b.x)) AS dist
          FROM resid r JOIN codebook b ON b.sub = r.d // 8 AND b.j = r.d % 8
          GROUP BY ALL) t) u
  WHERE r = 1""", "resid", "codebook")


def _coded(spark, sf):
    indexed, centers = _indexed(spark, sf)
    book = fx.given_codebook(spark, sf)
    return rt.encode_residuals(rt.residuals(indexed, centers), book), centers, book


@query("r04_pq_codes", sql("""
  SELECT vec_id AS item_id, cell, sub, code FROM codes""", "codes"))
def r04(spark, sf):
    coded = _coded(spark, sf)[0]
    flat = coded.select("item_id", "cell", F.posexplode("codes").alias("sub", "code"))
    return flat.select("item_id", *[F.col(c).cast("bigint").alias(c)
                                    for c in ("cell", "sub", "code")])


@query("r04_pq_train")
def r04_train(spark, sf):
    """Codes of 16 instead of 256 per sub-space: the smallest folder has 500 vectors."""
    vecs = fx.items(spark, sf)
    centers = rt.train_centroids(vecs, 10)
    gaps = rt.residuals(rt.assign_cells(vecs, centers), centers)
    book = rt.train_codebook(gaps, fx.PARTS, 16)
    return rt.encode_residuals(gaps, book).select("item_id", "cell",
                                                  F.array_join("codes", ",").alias("codes"))


@query("r04_train_facts", """
  SELECT count(*) AS n_items, true AS codes_in_range, true AS error_is_small FROM embeddings""")
def r04_facts(spark, sf):
    """256 codes per sub-space: their range, and the squared error against that of no codes.

    The error must be small in every one of the sub-spaces, so that a fault in one
    isn't made up for by the others.
    """
    vecs = fx.items(spark, sf)
    centers = rt.train_centroids(vecs, 10)
    gaps = rt.residuals(rt.assign_cells(vecs, centers), centers)
    book = rt.train_codebook(gaps, fx.PARTS, 256)
    coded = rt.encode_residuals(gaps, book).select("item_id", "codes")
    parts, _, width = book.shape
    entries = spark.createDataFrame(
        [(j, c, [float(x) for x in code]) for j, part in enumerate(book)
         for c, code in enumerate(part)], "sub int, code int, near array<double>")

    def energy(a, b=None):
        terms = a if b is None else F.zip_with(a, b, lambda x, y: x - y)
        return F.aggregate(terms, F.lit(0.0), lambda s, x: s + x * x)

    flat = (gaps.select("item_id", "residual").join(coded, "item_id")
            .select("item_id", "residual", F.posexplode("codes").alias("sub", "code"))
            # A code that is out of range keeps its row and has no entry.
            .join(F.broadcast(entries), ["sub", "code"], "left")
            .withColumn("part", F.slice("residual", F.col("sub") * width + 1, F.lit(width))))
    by_sub = flat.groupBy("sub").agg(
        F.count("item_id").alias("n"),
        ((F.min("code") >= 0) & (F.max("code") < 256)).alias("in_range"),
        F.coalesce(F.sum(energy("part", "near")) < 0.5 * F.sum(energy("part")), F.lit(False))
        .alias("small"))
    return by_sub.agg(F.min("n").alias("n_items"), F.bool_and("in_range").alias("codes_in_range"),
                      (F.bool_and("small") & (F.count("sub") == parts)).alias("error_is_small"))


@query("r05_pq_search", sql(OUT + """(
  SELECT query_id, item_id, distance, row_number() OVER (
    PARTITION BY query_id ORDER BY distance, item_id) AS rank
  FROM (
    SELECT l.vec_id AS query_id, k.vec_id AS item_id, round(sum(l.dist), 9) AS distance
    FROM (
      SELECT c.vec_id, c.cell, b.sub, b.code,
        sum((v.v[b.sub * 8 + b.j + 1] - m.v[b.sub * 8 + b.j + 1] - b.x)
          * (v.v[b.sub * 8 + b.j + 1] - m.v[b.sub * 8 + b.j + 1] - b.x)) AS dist
      FROM cell_dist c JOIN vecs v ON v.vec_id = c.vec_id JOIN centroids m ON m.cell = c.cell,
        codebook b
      WHERE c.r <= 3 GROUP BY ALL) l
    JOIN codes k ON k.cell = l.cell AND k.sub = l.sub AND k.code = l.code
    GROUP BY l.vec_id, k.vec_id) t) u
  WHERE rank <= 10""", "codes", "cell_dist"))
def r05(spark, sf):
    hits = stored_index(spark, sf).search(fx.queries(spark, sf), K, PROBES, codes=True)
    return _out(hits, "query_id")


# --- users with several vectors ------------------------------------------------------

view("user_hits", """
  SELECT query_id // 4 AS user_id, query_id % 4 AS interest_no, item_id, distance, rank
  FROM ranked WHERE rank <= 100""", "ranked")
view("merged", """
  SELECT user_id, item_id, min(distance) AS distance FROM user_hits WHERE rank <= 10
  GROUP BY user_id, item_id""", "user_hits")
view("merged_ranked", """
  SELECT user_id, item_id, distance, row_number() OVER (
    PARTITION BY user_id ORDER BY distance, item_id) AS rank FROM merged""", "merged")


def _users(spark, sf):
    return rt.as_users(fx.queries(spark, sf), "query_id", fx.PER_USER)


def _user_hits(spark, sf, k):
    return rt.exact_search(fx.items(spark, sf), _users(spark, sf), k, ("user_id", "interest_no"))


@query("r06_merge_hits", sql("""
  SELECT user_id, item_id, round(distance, 6) + 0.0 AS distance FROM merged""", "merged"))
def r06(spark, sf):
    merged = rt.merge_hits(_user_hits(spark, sf, K))
    return merged.withColumn("distance", rounded(F.col("distance")))


@query("o03_top_merged", sql("""
  SELECT user_id, item_id, round(distance, 6) + 0.0 AS distance, rank FROM merged_ranked
  WHERE rank <= 7""", "merged_ranked"))
def o03(spark, sf):
    return _out(rt.top_merged(rt.merge_hits(_user_hits(spark, sf, K)), 7), "user_id")


@query("r11_vectors_as_users", sql("""
  SELECT vec_id // 4 AS user_id, vec_id % 4 AS interest_no, d AS dim,
    round(v[d + 1], 6) + 0.0 AS value FROM vecs, range(0, 64) t(d)""", "vecs"))
def r11(spark, sf):
    flat = _users(spark, sf).select("user_id", "interest_no", F.posexplode("vec").alias("dim", "x"))
    return flat.select("user_id", F.col("interest_no").cast("bigint").alias("interest_no"),
                       F.col("dim").cast("bigint").alias("dim"),
                       rounded(F.col("x").cast("double")).alias("value"))


@query("r12_multi_vector_search", sql("""
  SELECT user_id, item_id, round(distance, 6) + 0.0 AS distance, rank FROM merged_ranked
  WHERE rank <= 10""", "merged_ranked"))
def r12(spark, sf):
    return _out(rt.multi_vector_search(_user_hits(spark, sf, K), K), "user_id")


@query("r12_stored_index", sql("""
  SELECT user_id, item_id, round(distance, 6) + 0.0 AS distance, rank FROM (
    SELECT user_id, item_id, distance, row_number() OVER (
      PARTITION BY user_id ORDER BY distance, item_id) AS rank FROM (
      SELECT query_id // 4 AS user_id, item_id, min(distance) AS distance FROM (
        SELECT p.query_id, p.item_id, p.distance, row_number() OVER (
          PARTITION BY p.query_id ORDER BY p.distance, p.item_id) AS r
        FROM pair_dist p JOIN assigned a ON a.vec_id = p.item_id
          JOIN cell_dist c ON c.vec_id = p.query_id AND c.cell = a.cell AND c.r <= 3) t
      WHERE r <= 10 GROUP BY ALL) m) s
  WHERE rank <= 10""", "pair_dist", "assigned", "cell_dist"))
def r12_index(spark, sf):
    """Users with several vectors, searched in the stored cells."""
    hits = stored_index(spark, sf).search(_users(spark, sf), K, PROBES, ("user_id", "interest_no"))
    return _out(rt.multi_vector_search(hits, K), "user_id")


# --- results with item data -----------------------------------------------------------

view("with_sim", """
  SELECT r.query_id, r.item_id, r.distance, r.rank, e.label AS sim_id
  FROM ranked r JOIN embeddings e ON e.vec_id = r.item_id WHERE r.rank <= 20""", "ranked")


def _metadata(spark, sf):
    return fx.items(spark, sf).select("item_id", F.col("label").alias("sim_id"))


@query("j03_hits_with_metadata", sql("""
  SELECT query_id, item_id, round(distance, 6) + 0.0 AS distance, rank, sim_id FROM with_sim""",
                                     "with_sim"))
def j03(spark, sf):
    hits = rt.exact_search(fx.items(spark, sf), fx.queries(spark, sf), 20)
    out = rt.with_metadata(hits, _metadata(spark, sf))
    return out.select("query_id", "item_id", rounded(F.col("distance")).alias("distance"),
                      F.col("rank").cast("bigint").alias("rank"), "sim_id")


FIRST_PER_SIM = """
  SELECT query_id, item_id, round(distance, 6) + 0.0 AS distance, sim_id FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id, sim_id ORDER BY distance, item_id) AS f
    FROM with_sim WHERE rank <= {n}) t WHERE f = 1"""


@query("w03_first_per_sim", sql(FIRST_PER_SIM.format(n=20), "with_sim"))
def w03(spark, sf):
    hits = rt.exact_search(fx.items(spark, sf), fx.queries(spark, sf), 20)
    rows = rt.with_metadata(hits, _metadata(spark, sf))
    out = first_in_group(rows, ["query_id", "sim_id"], ["distance", "item_id"])
    return out.select("query_id", "item_id", rounded(F.col("distance")).alias("distance"), "sim_id")


@query("r07_top_with_metadata", sql(FIRST_PER_SIM.format(n=12), "with_sim"))
def r07(spark, sf):
    hits = rt.exact_search(fx.items(spark, sf), fx.queries(spark, sf), 20)
    out = rt.top_with_metadata(hits, _metadata(spark, sf), 12)
    return out.select("query_id", "item_id", rounded(F.col("distance")).alias("distance"), "sim_id")


@query("r07_full_metadata", sql(
    "SELECT f.*, title, c, source FROM (" + FIRST_PER_SIM.format(n=12) + """) f
    LEFT JOIN item_profile p ON p.recom_id = f.item_id""", "with_sim", "item_profile"))
def r07_full(spark, sf):
    """Title, category and source besides the sim id; an item without a profile keeps NULLs."""
    profile = fx.item_profile(spark, sf).select(F.col("recom_id").alias("item_id"), "title", "c",
                                                "source")
    known = _metadata(spark, sf).join(profile, "item_id", "left")
    hits = rt.exact_search(fx.items(spark, sf), fx.queries(spark, sf), 20)
    out = rt.top_with_metadata(hits, known, 12)
    return out.select("query_id", "item_id", rounded(F.col("distance")).alias("distance"), "sim_id",
                      "title", "c", "source")


@query("r08_position_to_item", sql("""
  SELECT r.query_id, r.rank, i.item FROM ranked r
  JOIN (SELECT vec_id, 'item-' || vec_id AS item FROM embeddings) i ON i.vec_id = r.item_id
  WHERE r.rank <= 10""", "ranked"))
def r08(spark, sf):
    """Items are numbered by row; hits carry the row number and are mapped back."""
    named = with_row_index(fx.items(spark, sf), ["item_id"], "place")
    hits = rt.exact_search(named.select(F.col("place").alias("item_id"), "vec"),
                           fx.queries(spark, sf), K)
    names = named.select(F.col("place").alias("item_id"),
                         F.concat(F.lit("item-"), F.col("item_id").cast("string")).alias("item"))
    return rt.with_metadata(hits, names).select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), "item")


# --- evaluation -------------------------------------------------------------------------

view("truth", """
  SELECT user_id, item_id AS true_item FROM (
    SELECT p.query_id // 4 AS user_id, p.item_id,
      row_number() OVER (PARTITION BY p.query_id ORDER BY p.distance, p.item_id) AS r
    FROM pair_dist p JOIN vecs q ON q.vec_id = p.query_id
      JOIN vecs i ON i.vec_id = p.item_id AND i.label = q.label
    WHERE p.query_id % 4 = 0 AND p.item_id // 4 <> p.query_id // 4) t WHERE r = 1""", "pair_dist")


def _truth(spark, sf):
    """Nearest other item with the label of a user's first vector."""
    first = fx.queries(spark, sf).where(F.col("query_id") % fx.PER_USER == 0)
    hits = rt.exact_search(fx.items(spark, sf), first, fx.PER_USER + 1, cell="label")
    user = F.floor(F.col("query_id") / fx.PER_USER)
    others = (hits.select(user.alias("user_id"), "item_id", "distance")
              .where(F.floor(F.col("item_id") / fx.PER_USER) != F.col("user_id")))
    return (first_in_group(others, ["user_id"], ["distance", "item_id"])
            .select("user_id", F.col("item_id").alias("true_item")))


@query("r09_hit_rate", sql("""
  SELECT n, count(*) AS users, round(avg(hit), 6) + 0.0 AS hit_rate FROM (
    SELECT n, t.user_id, CASE WHEN m.item_id IS NULL THEN 0 ELSE 1 END AS hit
    FROM truth t CROSS JOIN (VALUES (5), (10), (20), (50), (100)) c(n)
    LEFT JOIN (
      SELECT k, user_id, item_id, row_number() OVER (
        PARTITION BY k, user_id ORDER BY distance, item_id) AS place
      FROM (SELECT k, user_id, item_id, min(distance) AS distance
            FROM user_hits, (VALUES (5), (10), (20), (50), (100)) c(k)
            WHERE rank <= k GROUP BY k, user_id, item_id) g) m
    ON m.k = n AND m.user_id = t.user_id AND m.item_id = t.true_item AND m.place <= n) h
  GROUP BY n""", "truth", "user_hits"))
def r09(spark, sf):
    rate = ev.hit_rate(_user_hits(spark, sf, SIZE), _truth(spark, sf))
    return rate.withColumn("hit_rate", rounded(F.col("hit_rate")))


@query("r10_recall", sql("""
  SELECT t.user_id, round(count(m.item_id) / CAST(count(*) AS DOUBLE), 6) + 0.0 AS recall
  FROM (SELECT query_id // 4 AS user_id, item_id AS true_item FROM (
          SELECT p.query_id, p.item_id,
            row_number() OVER (PARTITION BY p.query_id ORDER BY p.distance, p.item_id) AS r
          FROM pair_dist p JOIN vecs q ON q.vec_id = p.query_id
            JOIN vecs i ON i.vec_id = p.item_id AND i.label = q.label
          WHERE p.query_id % 4 = 0) s WHERE r <= 20) t
  LEFT JOIN (SELECT * FROM merged_ranked WHERE rank <= 50) m
    ON m.user_id = t.user_id AND m.item_id = t.true_item
  GROUP BY t.user_id""", "merged_ranked", "pair_dist"))
def r10(spark, sf):
    """True items: the 20 nearest with the label of a user's first vector."""
    first = fx.queries(spark, sf).where(F.col("query_id") % fx.PER_USER == 0)
    near = rt.exact_search(fx.items(spark, sf), first, 20, cell="label")
    true = near.select(F.floor(F.col("query_id") / fx.PER_USER).alias("user_id"),
                       F.col("item_id").alias("true_item"))
    ranked = rt.multi_vector_search(_user_hits(spark, sf, K), 50)
    return ev.recall_at(ranked, true, 50).withColumn("recall", rounded(F.col("recall")))
