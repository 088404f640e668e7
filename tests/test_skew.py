"""One key or one row holds a large share of the table: same results, bounded groups."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from clickweave.operators import ordering as od, skew
from clickweave.operators.samples import dictionary, encode, support_filter
from clickweave.plans.sample_job import prepare
from tests.conftest import rows


@pytest.fixture(scope="module")
def clicks():
    """A third of all clicks by one user, many of them the very same row."""
    rnd = random.Random(5)
    data = [(rnd.randrange(20), rnd.randrange(15), rnd.randrange(40)) for _ in range(400)]
    data += [(7, rnd.randrange(15), rnd.randrange(40)) for _ in range(100)]
    data += [(7, 3, 11)] * 100
    rnd.shuffle(data)
    return data


@pytest.fixture(scope="module")
def table(spark, clicks):
    return spark.createDataFrame(clicks, "uid bigint, id bigint, ctime bigint").repartition(5)


def brute_history(data, length):
    by = defaultdict(list)
    for u, i, t in data:
        by[u].append((t, i))
    out = []
    for u, seq in by.items():
        seq.sort()
        for p, (t, i) in enumerate(seq):
            before = [x for _, x in seq[max(0, p - length):p]][::-1]
            out.append((u, i, t, p, p == len(seq) - 1, before))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_rows", [10, 64, 10_000])
def test_history_equals_brute_force(table, clicks, hot_rows):
    got = od.with_history(table, "uid", ["ctime", "id"], "id", 5, hot_rows)
    assert rows(got.select("uid", "id", "ctime", "pos", "is_last", "hist")) == \
        brute_history(clicks, 5)


@pytest.mark.parametrize("hot_rows", [10, 10_000])
def test_position_equals_brute_force(table, clicks, hot_rows):
    got = od.with_position(table, "uid", ["ctime", "id"], hot_rows)
    want = sorted((r[:5] for r in brute_history(clicks, 5)), key=repr)
    assert rows(got.select("uid", "id", "ctime", "pos", "is_last")) == want


def test_long_histories_go_on_in_parts(table, clicks):
    got = od.history_lists(table, "uid", ["ctime", "id"], ["id", "ctime"], list_rows=30)
    parts = defaultdict(dict)
    for r in got.collect():
        assert len(r["history"]) <= 30
        parts[r["uid"]][r["part"]] = [(e["ctime"], e["id"]) for e in r["history"]]
    for u, by in parts.items():
        assert sorted(by) == list(range(len(by)))
        assert sum((by[p] for p in sorted(by)), []) == sorted((t, i) for x, i, t in clicks if x == u)
    assert set(parts) == {c[0] for c in clicks}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [20, 10_000])
def test_skew_join_equals_plain_join(spark, table, how, hot_rows):
    right = spark.createDataFrame([(i, f"n{i}") for i in range(0, 20, 2)] + [(7, "n7")],
                                  "uid bigint, name string")
    if how in ("left_semi", "left_anti"):
        right = right.select("uid")
    want = rows(table.join(right, ["uid"], how))
    assert rows(skew.skew_join(table, right, ["uid"], how, hot_rows, small_rows=0)) == want
    assert rows(skew.skew_join(table, right, ["uid"], how, hot_rows)) == want


def test_only_measured_small_tables_are_broadcast(spark, table):
    wide = spark.createDataFrame([(1, "x" * 2000, [[1.0]], {"a": 1})],
                                 "k int, s string, v array<array<double>>, m map<string,int>")
    assert skew.fits_broadcast(wide) and not skew.fits_broadcast(wide, size=1000)
    assert not skew.fits_broadcast(table, rows=599) and skew.fits_broadcast(table, rows=600)


def test_copies_are_numbered(table, clicks):
    got = skew.number_copies(table, chunk=7)
    want = sorted((r + (c,) for r, n in Counter(clicks).items() for c in range(n)), key=repr)
    assert rows(got) == want


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_row_index_is_the_place_in_the_order(spark, table, clicks, partitions):
    numbered = skew.number_copies(table, "c")
    got = skew.with_row_index(numbered, ["ctime", "id", "uid", "c"], "place", partitions)
    ordered = [tuple(r)[:3] for r in got.orderBy("place").collect()]
    assert ordered == sorted(clicks, key=lambda c: (c[2], c[1], c[0]))
    assert [r[0] for r in got.select("place").orderBy("place").collect()] == list(range(len(clicks)))


@pytest.mark.parametrize("hot_rows", [50, 10_000])
def test_global_sort_keeps_every_copy(table, clicks, hot_rows):
    got = [tuple(r) for r in od.sort_rows(table, ["ctime", "id"], hot_rows).collect()]
    assert got == sorted(clicks, key=lambda c: (c[2], c[1], c[0]))


def test_first_rows_both_ways(table, clicks, monkeypatch):
    want = sorted(clicks, key=lambda c: (c[2], c[1], c[0]))[:25]
    order = ["ctime", "id", "uid"]
    assert sorted(map(tuple, od.first_rows(table, order, 25).collect())) == sorted(want)
    monkeypatch.setattr(od, "TOP_K_BOUND", 5)
    assert sorted(map(tuple, od.first_rows(table, order, 25).collect())) == sorted(want)
    assert sorted(map(tuple, od.first_rows(table, order, 25, hot_rows=9).collect())) == sorted(want)


def test_codes_follow_the_sorted_values_and_decode(spark, table):
    codes = dictionary(table, "uid", partitions=3)
    pairs = {r["uid"]: r["code"] for r in codes.collect()}
    assert pairs == {u: n for n, u in enumerate(sorted(pairs), start=1)}
    back = encode(table, "uid", codes, "user_id", hot_rows=50).join(
        codes.select(F.col("uid").alias("again"), F.col("code").alias("user_id")), "user_id")
    assert back.where("uid <> again").count() == 0 and back.count() == table.count()


def test_support_filter_is_one_pass(spark, table, clicks):
    items = Counter(c[1] for c in clicks)
    kept = [c for c in clicks if items[c[1]] >= 38]
    users = Counter(c[0] for c in kept)
    want = sorted((c for c in kept if users[c[0]] >= 12), key=repr)
    assert rows(support_filter(table, 38, 12).select("uid", "id", "ctime")) == want
    assert rows(support_filter(table, 38, 12, hot_rows=30).select("uid", "id", "ctime")) == want


def test_preparation_does_not_depend_on_partitions_or_skew_paths(spark, table):
    seen = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, hot in ((1, 10_000), (4, 40), (16, 10_000)):
            spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
            out = prepare(table, 30, 10, length=6, hot_rows=hot)
            seen.append(rows(out.inputs))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2] and seen[0]


def test_every_user_with_two_clicks_has_one_test_row(spark, table):
    out = prepare(table, 1, 1, length=6)
    assert out.samples.where("is_test").count() == out.users.count()
    assert out.samples.count() == out.kept.count() - out.users.count()
    capped = prepare(table, 1, 1, length=6, max_rows=50)
    assert capped.kept.count() == 50


def test_missing_keys_may_be_hot_too(spark):
    data = [(None, i % 7, i) for i in range(60)] + [(1, i % 5, i) for i in range(20)]
    df = spark.createDataFrame(data, "uid bigint, id bigint, ctime bigint").repartition(3)
    want = rows(od.with_history(df, "uid", ["ctime", "id"], "id", 3))
    assert rows(od.with_history(df, "uid", ["ctime", "id"], "id", 3, hot_rows=10)
                .select("uid", "id", "ctime", "pos", "is_last", "hist")) == want
    names = spark.createDataFrame([(1, "a"), (2, "b")], "uid bigint, name string")
    for how in ("left", "left_anti"):
        right = names if how == "left" else names.select("uid")
        got = skew.skew_join(df, right, ["uid"], how, hot_rows=15, small_rows=0)
        assert rows(got) == rows(df.join(right, ["uid"], how))
