"""The rolling window: single hours, many hours, the written tree and the streams."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickweave.operators import filters as fl
from clickweave.plans import window_job as wj
from clickweave.session import scratch_path
from clickweave.sources import clicklog as cl, snapshots as sn
from clickweave.streaming import hourly as hs
from tests.conftest import rows

START = datetime(2024, 1, 1)
SCHEMA = "uid bigint, id bigint, ctime bigint, pdate string, phour string"


def hour_name(n):
    t = START + timedelta(hours=n)
    return t.strftime("%Y%m%d"), t.strftime("%H")


@pytest.fixture(scope="module")
def clicks():
    """Clicks of 40 hours; some reach an hour's partition late."""
    rnd = random.Random(9)
    base = int((START - datetime(1970, 1, 1)).total_seconds())
    out = []
    for _ in range(500):
        h = rnd.randrange(40)
        at = base + h * 3600 + rnd.randrange(3600) - rnd.choice([0, 0, 0, 20_000, 60_000])
        out.append((rnd.randrange(6), rnd.randrange(8), at, *hour_name(h)))
    return out


@pytest.fixture(scope="module")
def table(spark, clicks):
    return spark.createDataFrame(clicks, SCHEMA).repartition(3)


def fold(clicks, hours, window):
    """The hourly rule, one hour after the other, in plain Python."""
    state = {}
    for h in hours:
        day, hour = hour_name(h)
        cut = wj.cutoff_epoch(day, hour, window)
        state = {k: t for k, t in state.items() if t > cut}
        for u, i, t, d, hh in clicks:
            if (d, hh) == (day, hour):
                state[(u, i)] = max(t, state.get((u, i), t))
    return sorted(((u, i, t) for (u, i), t in state.items()), key=repr)


@pytest.mark.parametrize("window", [3, 12, 168])
def test_backfill_equals_the_fold(spark, table, clicks, window):
    empty = table.limit(0)
    got = wj.backfill(empty, table, *hour_name(39), hours=window)
    assert rows(got) == fold(clicks, range(40), window)


def test_merge_hour_by_hour(spark, table, clicks):
    state = table.select("uid", "id", "ctime").limit(0)
    for h in range(3):
        new = table.where(fl.partition_is(*hour_name(h)))
        state = wj.merge_window(state, new, *hour_name(h), hours=2)
    assert rows(state) == fold(clicks, range(3), 2)


def test_cutoff_follows_the_zone():
    assert wj.cutoff_epoch("20210528", "01", 168, "Asia/Shanghai") == 1621530000


def test_written_tree(spark, table, clicks, tmp_path):
    base = str(tmp_path / "tree")
    assert sn.list_snapshots(spark, base).count() == 0
    previous = None
    for h in (0, 1):
        new = table.where(fl.partition_is(*hour_name(h)))
        out = wj.run_hour(spark, base, previous, new, *hour_name(h), hours=2, files=3)
        previous = hour_name(h)
    got = sorted(((int(u), int(i), t) for u, i, t in rows(out)), key=repr)
    assert got == fold(clicks, range(2), 2)
    assert rows(sn.next_run(sn.list_snapshots(spark, base))) == [
        ("20240101", "01", "20240101", "02")]
    with pytest.raises(Exception, match="exists"):
        wj.run_hour(spark, base, None, table, *hour_name(1))


def test_incomplete_latest_snapshot_fails(spark):
    listing = spark.createDataFrame([("20240101", "05", True), ("20240102", "00", False)],
                                    sn.LISTING_SCHEMA)
    with pytest.raises(Exception, match="not complete"):
        sn.latest_snapshot(listing).collect()


def test_retention(spark, tmp_path):
    base = tmp_path / "keep"
    for d in range(10, 20):
        (base / f"202401{d}" / "00").mkdir(parents=True)
    assert wj.clean(spark, str(base), 7) == ["20240110", "20240111", "20240112"]
    assert len(list(base.iterdir())) == 7
    assert wj.clean(spark, str(base), 7) == []


def test_malformed_time_is_dropped(spark, tmp_path):
    folder = tmp_path / "tsv"
    folder.mkdir()
    (folder / "part-0").write_text("uid\tid\tctime\na\tx\t17\nb\ty\tsoon\nc\t\t5\n")
    (folder / "_SUCCESS").write_text("")
    assert rows(cl.read_snapshot(spark, str(folder))) == [("a", "x", 17)]


def test_partitioned_table_prunes(spark, table, tmp_path):
    path = str(tmp_path / "clicks")
    cl.write_click_table(table, path)
    stored = cl.read_click_table(spark, path, cl.click_table_schema(table))
    assert stored.schema["phour"].dataType.simpleString() == "string"
    for df in (cl.scan_hour(stored, *hour_name(7)), stored.where(fl.hour_range("2024010103", "2024010105"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert rows(stored.where(fl.hour_range("2024010103", "2024010105")).select(*table.columns)) == rows(
        table.where(F.concat("pdate", "phour").between("2024010103", "2024010105")))


def test_readiness(spark):
    hours = spark.createDataFrame([("20240101", "22"), ("20240101", "23")], "day string, hour string")
    present = spark.createDataFrame(
        [("click", "pdate=20240101/phour=22"), ("click", "pdate=20240101/phour=23"),
         ("profile", "pday=20240101/phour=22"), ("profile", "pday=20240101/phour=23")],
        "source string, part string")
    missing = sn.missing_partitions(sn.required_partitions(hours), present)
    assert rows(missing.select("hour", "part")) == [("23", "pday=20240102/phour=00")]
    assert rows(sn.ready_hours(hours, present)) == [("20240101", "22")]


def test_partitions_of_a_catalog_table(spark, table, tmp_path):
    (table.where(fl.hour_range("2024010103", "2024010104")).write.partitionBy("pdate", "phour")
     .option("path", str(tmp_path / "t")).saveAsTable("clicks_by_hour"))
    assert rows(sn.partitions_of(spark, "clicks_by_hour", "click")) == [
        ("click", "pdate=20240101/phour=03"), ("click", "pdate=20240101/phour=04")]
    spark.sql("DROP TABLE clicks_by_hour")


@pytest.fixture(scope="module")
def streamed(spark, table, clicks):
    source = scratch_path(spark, "clicks")
    cl.write_click_table(table, source)
    schema = cl.click_table_schema(table)
    return lambda: cl.read_click_table(spark, source, schema)


def announce(spark, hours, path):
    hs.announce_hours(spark.createDataFrame([hour_name(h) for h in hours],
                                            "pdate string, phour string"), path)


def state_of(spark, base):
    day, hour = hs.latest_complete(spark, base)
    return (day, hour), rows(cl.read_snapshot(spark, f"{base}/{day}/{hour}",
                                              "uid bigint, id bigint, ctime bigint"))


def test_stream_ends_in_the_folded_state(spark, streamed, clicks):
    base, markers, loop = (scratch_path(spark, n) for n in ("snap", "mark", "loop"))
    for hours in (range(0, 10), range(10, 11), range(11, 40)):
        announce(spark, hours, markers)
        hs.run_hourly(spark, markers, base, streamed, loop, hours=12, files=2).awaitTermination()
        name, state = state_of(spark, base)
        assert name == hour_name(hours[-1])
        assert state == fold(clicks, range(hours[-1] + 1), 12)


def test_repeated_batch_changes_nothing(spark, streamed, clicks):
    base = scratch_path(spark, "snap")
    ready = spark.createDataFrame([hour_name(h) for h in range(5)], "pdate string, phour string")
    step = hs.snapshot_step(spark, base, streamed, lambda: ready, hours=12, files=1)
    step(ready, 0)
    before = state_of(spark, base)
    step(ready, 0)
    step(ready.limit(1), 1)
    assert state_of(spark, base) == before == (hour_name(4), fold(clicks, range(5), 12))


def test_stream_dedup_keeps_each_key_once_per_window(spark, table, clicks):
    source, sink = scratch_path(spark, "rows"), scratch_path(spark, "seen")
    table.select("uid", "id", "ctime").write.parquet(source)
    stream = hs.continuous_dedup(spark.readStream.schema("uid bigint, id bigint, ctime bigint")
                                 .parquet(source))
    (stream.writeStream.format("parquet").option("path", sink)
     .option("checkpointLocation", scratch_path(spark, "dedup"))
     .trigger(availableNow=True).start().awaitTermination())
    got = rows(spark.read.parquet(sink).select("uid", "id"))
    assert got == sorted({(c[0], c[1]) for c in clicks}, key=repr)


def test_hours_behind_a_gap_wait(spark, streamed, clicks, tmp_path):
    markers, base, loop = (str(tmp_path / n) for n in ("m", "b", "l"))
    states = []
    for announced in ([0], [2], [4, 3], [1]):
        announce(spark, announced, markers)
        hs.run_hourly(spark, markers, base, streamed, loop, hours=12, files=2).awaitTermination()
        states.append(hs.latest_complete(spark, base))
    assert states == [hour_name(0)] * 3 + [hour_name(4)]
    assert state_of(spark, base)[1] == fold(clicks, range(5), 12)


def test_markers_of_earlier_days_are_not_opened(spark, tmp_path):
    path = str(tmp_path / "m")
    names = [("20240105", "23"), ("20240106", "00"), ("20240106", "05"), ("20240107", "01")]
    hs.announce_hours(spark.createDataFrame(names * 2, "pdate string, phour string"), path)
    assert len(list((tmp_path / "m").glob("pdate=*"))) == 3
    waiting = hs.announced_hours(hs.read_markers(spark, path), ("20240106", "00"))
    assert rows(waiting) == names[2:]
    plan = waiting._jdf.queryExecution().executedPlan().toString()
    assert "pdate" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows(hs.announced_hours(hs.read_markers(spark, path), None)) == names


def test_the_first_hour_is_waited_for(spark, streamed, tmp_path):
    markers, base, loop = (str(tmp_path / n) for n in ("m", "b", "l"))
    for announced, want in (([2], None), ([1], None), ([0], hour_name(2))):
        announce(spark, announced, markers)
        hs.run_hourly(spark, markers, base, streamed, loop, first=hour_name(0)).awaitTermination()
        assert hs.latest_complete(spark, base) == want


def test_the_gate_holds_an_hour_back(spark, streamed, tmp_path):
    from clickweave.sources.snapshots import required_partitions
    markers, base, loop = (str(tmp_path / n) for n in ("m", "b", "l"))
    parts = required_partitions(spark.createDataFrame([hour_name(0), hour_name(1)], "day string, hour string"))
    announce(spark, [0, 1, 2], markers)
    hs.run_hourly(spark, markers, base, streamed, loop, present=lambda: parts).awaitTermination()
    assert hs.latest_complete(spark, base) == hour_name(1)


def test_the_loop_writes_a_failed_hour_again(spark, streamed, tmp_path):
    markers, base, loop = (str(tmp_path / n) for n in ("m", "b", "l"))
    announce(spark, [0], markers)
    hs.run_hourly(spark, markers, base, streamed, loop).awaitTermination()
    day, hour = hour_name(1)
    (tmp_path / "b" / day / hour).mkdir(parents=True)
    (tmp_path / "b" / day / hour / "part-0").write_text("half a row")
    announce(spark, [1], markers)
    hs.run_hourly(spark, markers, base, streamed, loop).awaitTermination()
    assert hs.latest_complete(spark, base) == (day, hour)


def test_text_ids_come_back_as_they_were(spark, tmp_path):
    odd = [(" s ", "", 1), ("tab\there", 'quo"te', 2), ("a\\b", "x", 3), ("#c", '"', 4), ("é", " ", 5)]
    table = spark.createDataFrame(odd, cl.SNAPSHOT_SCHEMA)
    cl.write_snapshot(table, str(tmp_path / "t"), 1)
    assert rows(cl.read_snapshot(spark, str(tmp_path / "t"))) == sorted(odd, key=repr)
    broken = spark.createDataFrame([("a\nb", "x", 1)], cl.SNAPSHOT_SCHEMA)
    with pytest.raises(Exception, match="line break"):
        cl.write_snapshot(broken, str(tmp_path / "u"))


@pytest.mark.parametrize("name", ["s01_partition_scan", "f05_partition_range", "f06_partition_equality"])
def test_registered_partition_queries_prune(spark, sf, name):
    import __spark_entry__ as contract
    plan = contract.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "pdate" in filters
