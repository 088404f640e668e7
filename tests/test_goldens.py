"""Worked examples with known results."""

import pytest
from pyspark.sql import functions as F

from clickweave.functions import arrays, hashing, timeutil as tu
from clickweave.operators import aggregates as ag
from clickweave.operators.features import SparseFeature
from clickweave.operators.ordering import history_lists
from clickweave.sources.clicklog import memory_table
from tests.conftest import rows


@pytest.fixture(scope="module")
def letters(spark):
    data = [("a", 3), ("b", 1), ("a", 1), ("a", 1), ("b", 1), ("b", 1)]
    return memory_table(spark, data, "k string, v int", 3)


def test_count_and_sum_per_key(letters):
    assert rows(ag.count_per_key(letters, "k")) == [("a", 3), ("b", 3)]
    assert rows(ag.sum_per_key(letters, "k", "v")) == [("a", 5), ("b", 3)]


def test_frequent_keys(spark):
    df = memory_table(spark, [("B", 1), ("B", 2), ("A", 3), ("A", 4), ("A", 5)], "k string, v int")
    assert rows(ag.frequent_keys(df, "k", 2)) == [("A", 3)]


@pytest.mark.parametrize("slices, want", [
    (1, [(1, 7), (2, 4)]), (2, [(1, 10), (2, 7)]), (3, [(1, 10), (2, 7)]), (6, [(1, 13), (2, 10)])])
def test_two_phase_max_depends_only_on_the_slices(spark, slices, want):
    data = [(i, k, v) for i, (k, v) in
            enumerate([(1, 1), (1, 2), (2, 1), (2, 3), (2, 4), (1, 7)])]
    df = memory_table(spark, data, "i bigint, k int, v int", 5)
    df = df.withColumn("part", ag.slice_of(F.col("i"), 6, slices))
    assert rows(ag.max_then_sum(df, "k", "v", "part", 3)) == want


def test_history_lists(spark):
    data = [("a", "ITEM_2", "2018"), ("b", "USER_1", "2010"), ("a", "ITEM_1", "2017"),
            ("a", "ITEM_3", "2019"), ("b", "UER", "2000")]
    df = memory_table(spark, data, "uid string, id string, ctime string", 4)
    out = history_lists(df, "uid", ["ctime", "id"], ["id"])
    assert rows(out) == [("a", 0, ["ITEM_1", "ITEM_2", "ITEM_3"]), ("b", 0, ["UER", "USER_1"])]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_epoch_of_hour_ignores_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("2021052100",), ("2021052101",)], "h string")
        out = df.select(tu.epoch_of_hour(F.col("h"), "Asia/Shanghai"))
        assert rows(out) == [(1621526400,), (1621530000,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_shift_over_midnight(spark):
    df = spark.createDataFrame([("20210523", "23"), ("20210601", "00")], "d string, h string")
    day, hour = tu.next_hour(F.col("d"), F.col("h"))
    back_day, back_hour = tu.shift_hours(F.col("d"), F.col("h"), -1)
    assert rows(df.select(day, hour, back_day, back_hour)) == [
        ("20210524", "00", "20210523", "22"), ("20210601", "01", "20210531", "23")]


def test_prefix_mask(spark):
    df = spark.createDataFrame([(1,), (3,), (2,)], "n int")
    got = [r[0] for r in df.orderBy("n").select(arrays.prefix_mask(F.col("n"), 5)).collect()]
    assert got == [[i < n for i in range(5)] for n in (1, 2, 3)]


def test_pad_post(spark):
    df = spark.createDataFrame([([],), ([1, 2],), ([1, 2, 3, 4, 5],)], "a array<int>")
    got = [r[0] for r in df.select(arrays.pad_post(F.col("a"), 4)).collect()]
    assert got == [[0, 0, 0, 0], [1, 2, 0, 0], [1, 2, 3, 4]]


def test_interest_count_is_exact_at_powers_of_two(spark):
    df = spark.range(0, 300)
    for n, got in df.select("id", arrays.log2_floor_1p(F.col("id"))).collect():
        assert got == (n + 1).bit_length() - 1


def test_hash_buckets_stay_in_range(spark):
    df = spark.range(0, 500)
    got = df.select(hashing.bucket(F.col("id"), 10).alias("p"),
                    hashing.bucket(F.col("id"), 10, True).alias("m"), "id").collect()
    assert {r["p"] for r in got} == set(range(10))
    assert {r["m"] for r in got if r["id"] != 0} == set(range(1, 10))
    assert [r["m"] for r in got if r["id"] == 0] == [0]


def test_auto_dim():
    assert SparseFeature("x", 10_000, "auto").dim == 60


def test_map_of_pairs_is_bounded(spark):
    pairs = spark.range(20).select(F.col("id").alias("k"), F.col("id").alias("v"))
    assert ag.pairs_as_map(pairs, "k", "v").first()["m"] == {i: i for i in range(20)}
    with pytest.raises(ValueError):
        ag.pairs_as_map(pairs, "k", "v", max_entries=10)


def test_maps_in_parts_hold_every_pair_within_the_bound(spark):
    pairs = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    maps = ag.pairs_as_maps(pairs, "k", "v", max_entries=7)
    got = maps.collect()
    assert all(1 <= len(r["m"]) <= 7 for r in got)
    assert {k: v for r in got for k, v in r["m"].items()} == {i: 2 * i for i in range(1000)}
    assert sum(len(r["m"]) for r in got) == 1000
    assert len({(r["part"], r["piece"]) for r in got}) == len(got)
    asked = spark.createDataFrame([(3,), (999,), (1000,), (None,)], "k bigint")
    found = {r["k"]: r["value"] for r in ag.look_up_maps(asked, maps, "k").collect()}
    assert found == {3: 6, 999: 1998, 1000: None, None: None}


def test_a_part_with_too_many_keys_goes_on_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(ag, "map_part", lambda key, parts: F.lit(0).cast("bigint"))
    pairs = spark.range(20).select(F.col("id").alias("k"), F.col("id").alias("v"))
    got = ag.pairs_as_maps(pairs, "k", "v", max_entries=6).collect()
    assert sorted(len(r["m"]) for r in got) == [2, 6, 6, 6]
    assert ag.pairs_as_maps(pairs.limit(0), "k", "v").collect() == []
