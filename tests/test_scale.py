"""What keeps a query's shuffles and memory in proportion to its input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.operators import (
    blockscore as bs, features as ft, gather, interests as it, mapped, retrieval as rt,
)
from clickweave.plans import recall_job
from tests.conftest import rows

DIM = 3


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def emb(spark):
    return spark.range(1, 40).select(
        F.lit("item").alias("embedding_name"), F.col("id").alias("idx"),
        F.array(*[(F.col("id") * (d + 2) % 7 / 7).cast("double") for d in range(DIM)]).alias("vec"))


@pytest.fixture(scope="module")
def samples(spark):
    return spark.createDataFrame(
        [(1, 3, [1.0, 0.5, -1.0]), (2, 0, [0.0, 0.0, 0.0]), (3, 77, [2.0, 1.0, 1.0]),
         (4, None, [1.0, 1.0, 1.0]), (5, 39, None)], "row_id bigint, item int, user_vec array<double>")


def test_a_table_beyond_a_broadcast_is_looked_up_without_a_shuffle(samples, emb, monkeypatch):
    item = ft.SparseFeature("item", 40, DIM)
    joined = ft.lookup(samples, emb, item, small_values=0)
    monkeypatch.setattr(ft, "fits_broadcast", lambda table: False)
    found = ft.lookup(samples, emb, item)
    assert "Exchange" not in plan_of(found) and "Join" not in plan_of(found)
    assert rows(found.select("row_id", "item_vec")) == rows(joined.select("row_id", "item_vec"))
    with pytest.raises(Exception, match="no vector for index"):
        ft.lookup(samples, emb, item, unknown="fail").collect()


def test_an_id_twice_in_the_table_is_joined(samples, emb, monkeypatch):
    item, twice = ft.SparseFeature("item", 40, DIM), emb.unionByName(emb.where("idx = 3"))
    monkeypatch.setattr(ft, "fits_broadcast", lambda table: False)
    assert ft.lookup(samples, twice, item).count() == samples.count() + 1


@pytest.mark.parametrize("distribution", [it.UNIFORM, it.LOG_UNIFORM])
def test_draws_are_scored_where_rows_lie(samples, emb, distribution):
    table = emb.select(F.col("idx").alias("item_id"), "vec")
    near, far = (it.sampled_softmax(samples, table, 60, 20, true_item="item", small_values=v,
                                    distribution=distribution) for v in (1_000, 0))
    assert "Exchange" not in plan_of(near)
    for a, b in zip(rows(near), rows(far), strict=True):
        assert a[0] == b[0] and (a[1] == b[1] or a[1] == pytest.approx(b[1], abs=1e-12))


def test_softmax_weights_need_no_window(spark, emb):
    lists = spark.createDataFrame([(1, [4, 0, 9, 50], [0.5, 9.0, 2.0, 1.0]), (2, [0], [1.0])],
                                  "row_id bigint, ids array<int>, w array<float>")
    f = ft.SequenceFeature(ft.SparseFeature("ids", 60, DIM, embedding_name="item"), 4, "sum", None, "w")
    for small in (1_000, 0):
        vectors = ft.sequence_lookup(lists, emb, f, small_values=small)
        out = ft.weight_positions(vectors)
        assert "Window" not in plan_of(out) and set(out.columns) == {"row_id", "pos", "vec"}
        by_window = ft.weight_positions(vectors.drop("weight_lse"))
        for a, b in zip(rows(out), rows(by_window), strict=True):
            assert a[:2] == b[:2] and a[2] == pytest.approx(b[2])


def test_small_blocks_grow_with_the_table(spark):
    x = np.random.default_rng(1).normal(size=(400, 4)).round(3)
    table = spark.createDataFrame([(i, i % 2, v.tolist()) for i, v in enumerate(x)],
                                  "item_id bigint, cell int, vec array<double>")
    asked = table.withColumnRenamed("item_id", "query_id")
    for cell in (None, "cell"):
        limits = {"small_values": 0, "item_block": 1, "query_block": 1}
        hits = rt._search(table, asked, ["query_id"], 3, "vec", bs.FlatScore(), cell, rank=False,
                          **limits)
        # At most k rows for each query and block of items.
        assert hits.count() <= 400 * 3 * rt.MOST_BLOCKS
        assert rows(rt.exact_search(table, asked, 3, cell=cell, **limits)) == rows(
            rt.exact_search(table, asked, 3, cell=cell))


# --- tables in files --------------------------------------------------------------------------------

@pytest.fixture
def filed(monkeypatch):
    """Every table is too large for a broadcast and lies in several slices."""
    monkeypatch.setattr(gather, "SENT_VALUES", 0)
    monkeypatch.setattr(mapped, "SLICE_VALUES", 10 * DIM)
    monkeypatch.setattr(ft, "fits_broadcast", lambda table: False)


def gaps(emb):
    """Some ids are missing, some without a number."""
    return emb.where("idx % 7 <> 3").unionByName(emb.where("idx = 1").withColumn(
        "idx", F.lit(None).cast("bigint")))


def test_a_table_beyond_a_broadcast_of_values_is_mapped(spark, samples, emb, filed):
    some, item = gaps(emb), ft.SparseFeature("item", 40, DIM)
    table = gather.vector_table(some, "item", DIM)
    assert isinstance(table, mapped.MappedTable) and len(table.slices) > 1
    assert gather.vector_table(some, "item", DIM) is table  # written once
    assert gather.vector_table(some, "item", DIM, limit=10) is None
    found, joined = (ft.lookup(samples, some, item, small_values=v) for v in (1_000, 0))
    assert "Exchange" not in plan_of(found) and "Join" not in plan_of(found)
    assert rows(found) == rows(joined.select(*found.columns))
    lists = spark.createDataFrame([(1, [4, 0, 9, 50], 4), (2, [], 0), (3, None, None), (4, [39, 3], 1)],
                                  "row_id bigint, ids array<int>, n int")
    ids = ft.SequenceFeature(ft.SparseFeature("ids", 60, DIM, embedding_name="item"), 4, "mean", "n")
    for mode in ("sum", "mean", "max"):
        near, far = (ft.pool_modes(lists, some, ids, {"v": mode}, small_values=v) for v in (1_000, 0))
        assert "Exchange" not in plan_of(near)
        assert rows(near.select("row_id", "v")) == rows(far.select("row_id", "v"))
    near, far = (it.sampled_softmax(samples, some.select(F.col("idx").alias("item_id"), "vec"), 60, 20,
                                    true_item="item", small_values=v) for v in (1_000, 0))
    assert "Exchange" not in plan_of(near)
    for a, b in zip(rows(near), rows(far), strict=True):
        assert a[0] == b[0] and (a[1] == b[1] or a[1] == pytest.approx(b[1], abs=1e-12))


def test_odd_tables_are_not_mapped(emb, filed):
    for odd in (emb.unionByName(emb.where("idx = 3")),
                emb.withColumn("vec", F.when(F.col("idx") != 5, F.col("vec"))),
                emb.withColumn("vec", F.when(F.col("idx") == 5, F.array(F.lit(1.0))).otherwise(F.col("vec")))):
        assert gather.vector_table(odd, "item", DIM) is None
    assert gather.vector_table(emb.where("idx < 0"), "item", DIM) is not None


def test_the_tower_with_tables_in_files(spark, sf, monkeypatch):
    from clickweave.catalog import tower
    rows_, emb, sizes = tower._inputs(spark, sf, "train")
    user, history, item, logits, bilinear, layers = tower._model(sizes)
    job = [rows_, emb, user, history, item, logits, bilinear, layers, tower.K_MAX]
    sent = {r["row_id"]: r["loss"] for r in recall_job.training_losses(*job).collect()}
    monkeypatch.setattr(gather, "SENT_VALUES", 0)
    monkeypatch.setattr(mapped, "SLICE_VALUES", 1_000)
    monkeypatch.setattr(ft, "fits_broadcast", lambda table: False)
    found = recall_job.training_losses(*job)
    assert "Exchange" not in plan_of(found)
    assert {r["row_id"]: r["loss"] for r in found.collect()} == pytest.approx(sent, abs=1e-9)
