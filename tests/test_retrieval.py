"""Searches against brute force, and what must hold between them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.catalog import vectors as catalog
from clickweave.operators import evaluation as ev, retrieval as rt
from clickweave.sources.clicklog import synthetic_vectors
from tests.conftest import SMALL, rows

DIM = 8


@pytest.fixture(scope="module")
def vectors():
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(300, DIM))
    x[100:200] = x[100]  # a third of all items are copies of one
    return x


@pytest.fixture(scope="module")
def items(spark, vectors):
    return spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(vectors)],
                                 "item_id bigint, vec array<double>").repartition(5)


@pytest.fixture(scope="module")
def queries(spark, vectors):
    rnd = np.random.default_rng(4)
    asked = np.concatenate([vectors[95:105], rnd.normal(size=(20, DIM))])
    return spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(asked)],
                                 "query_id bigint, vec array<double>")


def pairs(df):
    return rows(df.select("query_id", "item_id", "distance", "rank"))


def brute(items, queries, k):
    out = []
    x = {r["item_id"]: np.array(r["vec"]) for r in items.collect()}
    for r in queries.collect():
        d = sorted((round(float(((np.array(r["vec"]) - v) ** 2).sum()), 9), i) for i, v in x.items())
        out += [(r["query_id"], i, dist, n) for n, (dist, i) in enumerate(d[:k], start=1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("limits", [{}, {"item_block": 32},
                                    {"small_values": 0, "item_block": 64, "query_block": 7}])
def test_exact_search_with_many_copies(items, queries, limits):
    assert pairs(rt.exact_search(items, queries, 12, **limits)) == brute(items, queries, 12)


def test_a_vector_is_its_own_nearest(items, vectors):
    got = rt.exact_search(items, items.withColumnRenamed("item_id", "query_id"), 1)
    for q, i, d, _ in pairs(got):
        assert d == 0.0 and (i == q or (100 <= q < 200 and i == 100))


def test_more_wanted_than_there_are(spark, items, queries):
    few = items.where("item_id < 3")
    assert pairs(rt.exact_search(few, queries, 10)) == brute(few, queries, 10)


def test_text_item_ids(items, queries):
    named = items.withColumn("item_id", F.concat(F.lit("i"), F.lpad(F.col("item_id").cast("string"),
                                                                    4, "0")))
    for limits in ({}, {"small_values": 0}):
        got = pairs(rt.exact_search(named, queries, 4, **limits))
        plain = sorted(((q, int(i[1:]), d, r) for q, i, d, r in got), key=repr)
        assert plain == brute(items, queries, 4)


@pytest.fixture(scope="module")
def centroids(vectors):
    return vectors[[0, 50, 100, 210, 290]]


def test_probing_every_cell_is_exact(items, queries, centroids):
    indexed = rt.assign_cells(items, centroids)
    want = pairs(rt.exact_search(items, queries, 9))
    for limits in ({}, {"small_values": 0, "item_block": 30, "query_block": 10}):
        assert pairs(rt.ivf_search(indexed, queries, centroids, 9, 5, **limits)) == want


def test_recall_grows_with_probes(items, queries, centroids):
    indexed = rt.assign_cells(items, centroids)
    true = {(q, i) for q, i, _, _ in pairs(rt.exact_search(items, queries, 9))}
    found = [len(true & {(q, i) for q, i, _, _ in pairs(
        rt.ivf_search(indexed, queries, centroids, 9, n))}) for n in range(1, 6)]
    assert found == sorted(found) and found[-1] == len(true)


def test_index_on_disk_reads_probed_cells(spark, items, queries, centroids, tmp_path):
    path = str(tmp_path / "index")
    rt.write_index(rt.assign_cells(items, centroids), path)
    stored = spark.read.parquet(path)
    one = queries.where("query_id = 12")
    got = rt.ivf_search(stored, one, centroids, 5, 1)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert pairs(got) == pairs(rt.ivf_search(rt.assign_cells(items, centroids), one, centroids, 5, 1))


def test_one_code_per_sub_vector_is_exact(items, queries, vectors, centroids):
    indexed = rt.assign_cells(items, centroids)
    gaps = rt.residuals(indexed, centroids)
    by_item = {r["item_id"]: np.array(r["residual"]) for r in gaps.collect()}
    book = np.array([[by_item[i][j * 4:(j + 1) * 4] for i in range(300)] for j in range(2)])
    coded = rt.encode_residuals(gaps, book)
    want = rt.exact_search(items, queries, 9)
    for limits in ({}, {"small_values": 0, "item_block": 50}):
        got = rt.pq_search(coded, queries, centroids, book, 9, 5, **limits)
        assert [(a, b, r) for a, b, _, r in pairs(got)] == [(a, b, r) for a, b, _, r in pairs(want)]


def test_trained_models_have_the_asked_shape(items):
    centers = rt.train_centroids(items, 4)
    assert centers.shape == (4, DIM)
    gaps = rt.residuals(rt.assign_cells(items, centers), centers)
    book = rt.train_codebook(gaps, 2, 8)
    assert book.shape == (2, 8, 4)
    with pytest.raises(ValueError):
        rt.train_codebook(gaps, 3, 8)
    codes = rt.encode_residuals(gaps, book).collect()
    assert len(codes) == 300 and all(len(r["codes"]) == 2 for r in codes)


def test_metadata_is_joined_after_the_cut(spark, items, queries):
    hits = rt.exact_search(items, queries, 8)
    data = items.select("item_id", (F.col("item_id") % 3).alias("sim_id"))
    got = rt.top_with_metadata(hits, data, 4).collect()
    per = {}
    for r in got:
        per.setdefault(r["query_id"], []).append(r["sim_id"])
    assert all(len(v) == len(set(v)) <= 3 for v in per.values())


def test_hit_rate_equals_one_search_per_n(spark, items, queries):
    users = rt.as_users(queries, "query_id", 3)
    truth = spark.createDataFrame([(u, (u * 37) % 300) for u in range(10)],
                                  "user_id bigint, true_item bigint")
    keys = ("user_id", "interest_no")
    cuts = (2, 5, 20)
    want = []
    for n in cuts:
        top = rt.top_merged(rt.merge_hits(rt.exact_search(items, users, n, keys)), n)
        hits = top.join(truth, "user_id").where("item_id = true_item").count()
        want.append((n, 10, hits / 10))
    got = rows(ev.hit_rate(rt.exact_search(items, users, 20, keys), truth, cuts))
    assert got == sorted(want, key=repr)
    assert [r[2] for r in sorted(got)] == sorted(r[2] for r in got)
    assert ev.hit_rate(rt.exact_search(items, users, 20, keys), truth, cuts,
                       max_users=4).first()["users"] == 4


def test_recall_counts_true_items(spark):
    ranked = spark.createDataFrame([(1, 5, 1), (1, 6, 2), (1, 7, 3), (2, 9, 1)],
                                   "user_id bigint, item_id bigint, rank int")
    truth = spark.createDataFrame([(1, 5), (1, 7), (1, 8), (1, 7), (2, 3)],
                                  "user_id bigint, true_item bigint")
    assert rows(ev.recall_at(ranked, truth, 2)) == [(1, 0.25), (2, 0.0)]
    assert rows(ev.recall_at(ranked, truth, 3)) == [(1, 0.5), (2, 0.0)]


def test_synthetic_vectors_ignore_partitions(spark):
    ids = spark.range(40)
    a = rows(synthetic_vectors(ids.repartition(1), "id", 3))
    assert a == rows(synthetic_vectors(ids.repartition(7), "id", 3))
    assert all(0 <= v < 1.05 for _, vec in a for v in vec)


@pytest.mark.parametrize("sub", [0, 3, 7])
def test_train_facts_see_a_fault_in_any_sub_space(spark, monkeypatch, sub):
    encode = rt.encode_residuals

    def faulty(gaps, book):
        coded = encode(gaps, book)
        wrong = F.transform("codes", lambda c, i: F.when(i == sub, (c + 128) % 256).otherwise(c))
        return coded.withColumn("codes", wrong.cast("array<int>"))

    monkeypatch.setattr(rt, "encode_residuals", faulty)
    facts = catalog.r04_facts(spark, SMALL).first()
    assert facts.codes_in_range and not facts.error_is_small
