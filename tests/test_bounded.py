"""The bounded search against brute force, and the blocks it leaves out."""

import numpy as np
import pytest

from clickweave.operators import bounded as bd
from tests import test_retrieval as plain

SMALL_BLOCKS = {"small_values": 0, "item_block": 64, "query_block": 7}


def short(found):
    """Sums of squares in another order differ in the last digits."""
    return sorted((q, rank, item, round(d, 5)) for q, item, d, rank in found)


def pairs(df):
    return short(plain.pairs(df))


def brute(items, queries, k):
    return short(plain.brute(items, queries, k))


def table(spark, vectors, key):
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"{key} bigint, vec array<double>").repartition(4)


@pytest.fixture(scope="module")
def clustered(spark):
    rnd = np.random.default_rng(5)
    centers = rnd.normal(size=(12, 6)) * 20
    x = np.repeat(centers, 30, axis=0) + rnd.normal(size=(360, 6))
    x[60:180] = x[60]  # a third of all items are copies of one
    asked = np.concatenate([x[55:65], centers + rnd.normal(size=(12, 6)), rnd.normal(size=(3, 6)) * 40])
    return table(spark, x, "item_id"), table(spark, asked, "query_id"), centers


@pytest.mark.parametrize("limits", [{}, SMALL_BLOCKS])
@pytest.mark.parametrize("k", [1, 40, 500])
def test_equals_brute_force(clustered, k, limits):
    items, queries, centers = clustered
    assert pairs(bd.bounded_search(items, queries, k, pivots=centers, **limits).hits) == brute(items, queries, k)


def test_blocks_are_skipped_and_counted(clustered):
    items, queries, centers = clustered
    found = bd.bounded_search(items, queries, 5, pivots=centers, **SMALL_BLOCKS)
    effort = found.effort().first()
    assert found.cells == 9  # the copies took the place of three clusters
    assert effort["pairs"] == 25 * 9
    assert effort["searched"] + effort["skipped"] == effort["pairs"]
    assert effort["skipped"] > effort["pairs"] // 2
    asked = [tuple(r) for t in (found.first, found.second) for r in t.select("query_id", "cell").collect()]
    assert len(asked) == len(set(asked)) == effort["searched"]


def test_any_pivots_give_the_same_result(spark, clustered):
    items, queries, centers = clustered
    want = brute(items, queries, 4)
    for pivots in (None, np.zeros((1, 6)), np.full((3, 6), 1e4), bd.choose_pivots(items, 30)):
        assert pairs(bd.bounded_search(items, queries, 4, pivots=pivots, **SMALL_BLOCKS).hits) == want


def test_large_norms_lose_nothing(spark):
    rnd = np.random.default_rng(6)
    x = rnd.normal(size=(200, 4)) + 1e5
    items, queries = table(spark, x, "item_id"), table(spark, x[:20], "query_id")
    got = pairs(bd.bounded_search(items, queries, 3, pivots=x[:8], **SMALL_BLOCKS).hits)
    assert got == brute(items, queries, 3)


def test_empty_tables(clustered):
    items, queries, centers = clustered
    for a, b in ((items.limit(0), queries), (items, queries.limit(0)), (items.limit(0), queries.limit(0))):
        for pivots in (None, centers):
            found = bd.bounded_search(a, b, 3, pivots=pivots)
            assert found.hits.collect() == [] and found.effort().first()["searched"] == 0
