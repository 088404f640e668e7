"""N-gram Jaccard self-join: documents whose word 5-grams overlap by 80 % or more.

Texts with the same set of n-grams are one class; all work is on classes, so copies
cost one row each. Then, without losing a link:

1. Screen. In any fixed order of the n-grams, two sets that overlap enough share
   ``l`` of their first ``n - need + l``. Here the order is that of the hashes, and
   ``l`` a twentieth of the set. A class of whose first n-grams too few occur in
   another class has no partner. Most classes end here.
2. Prefixes, rarest n-grams first. Rarity is counted per bucket of hashes among the
   classes left, in a table of fixed size that every task gets; any order is right,
   and this one keeps frequent passages out of the prefixes. Two linked classes
   share an n-gram of their prefixes.
3. Candidates by a join on prefix n-grams, under the length filter (5 * shorter >=
   4 * longer) and the positional filter (what follows the shared n-gram must be
   long enough on both sides). A first round pairs each n-gram's leader, the class
   that has it earliest, with the others; a second pairs those that this leaves in
   another component than the leader with all others. A large group of near copies
   so costs about a pair per member, not one for each two members.
4. Verification, once per pair: the suffix filter (both sets are split at the same
   hashes; the sizes of the parts, a few bytes per class, bound the overlap), then
   the exact overlap for the pairs that pass.

N-grams are compared as 64-bit hashes.

Words are split at ASCII white space and A-Z lower-cased; shorter texts are one
n-gram. Defined results: null, empty and blank texts have an empty set and are
alone; a null id is never the smallest, and a component without any id has null;
rows may repeat; an empty table gives no rows; other columns are ignored by
:func:`jaccard_components` and kept by :func:`one_per_component`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from clickweave.llm.common import (column, record_batch, sliced, texts, unused, utf8,
                                   worker_memo)
from clickweave.llm.components import components
from clickweave.llm.words import U64, hash_cache, hashes, window_hashes
from clickweave.operators.skew import skew_join
from clickweave.session import materialize, ship_package

WORDS = 5
#: Counters of the rarity table.
BUCKET_BITS = 18
SEEN = 100_000
#: Words whose hashes a task remembers.
WORDS_KEPT = 150_000
#: Parts of the suffix filter.
PARTS = 256
PIVOTS = np.arange(1, PARTS, dtype=np.uint64) << U64(56)


def need_of(n: int) -> int:
    """Least overlap with any partner: 0.8 n, rounded up."""
    return -(-8 * n // 10)


def ngrams(text: bytes, cache) -> np.ndarray:
    """Distinct n-grams as sorted hashes."""
    words = text.lower().split()
    if not words:
        return np.empty(0, U64)
    numbers = hashes(words, cache)
    if len(words) < WORDS:
        return window_hashes(numbers, tuple(range(len(words))), 100 + len(words))
    return np.unique(window_hashes(numbers, tuple(range(WORDS)), 100))


def class_of(grams: np.ndarray) -> int | None:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())))) if len(grams) else None


def screen_length(n: int) -> int:
    return n - need_of(n) + -(-n // 20)


def screen_need() -> Column:
    """Of the n-grams sent, how many must be shared: a twentieth of the smallest partner."""
    return F.ceil(F.ceil(F.col("n") * 8 / 10) / 20)


class _Once:
    """True the first time a class comes by; forgets when full."""

    def __init__(self) -> None:
        self.seen: set[int] = set()

    def __call__(self, value: int) -> bool:
        if value in self.seen:
            return False
        if len(self.seen) >= SEEN:
            self.seen.clear()
        self.seen.add(value)
        return True


def _long_lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0, U64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _class_table(rows: DataFrame) -> DataFrame:
    """(id, key, cls, n, screen) of every row; written once.

    ``screen`` holds what the screen needs of a set. Only the first row of a class that a
    task meets has it, so copies are sent once a task.
    """
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, fresh = worker_memo("n-grams", lambda: hash_cache(WORDS_KEPT)), _Once()
        for batch in sliced(batches):
            sets = [ngrams(t, cache) for t in utf8(batch)]
            names = [class_of(s) for s in sets]
            sent = [s[:screen_length(len(s))] if c is not None and fresh(c) else s[:0]
                    for c, s in zip(names, sets)]
            yield record_batch({"id": (column(batch, "id"), None),
                                "key": (column(batch, "key"), None),
                                "cls": (names, pa.int64()),
                                "n": ([len(s) for s in sets], pa.int64()),
                                "screen": (_long_lists(sent), None)})

    return materialize(rows.mapInArrow(
        run, f"id {kind}, key long, cls long, n long, screen array<long>"), "classes")


def _sets(rows: DataFrame) -> DataFrame:
    """(cls, n, grams) of each class that a task meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, fresh = worker_memo("n-grams", lambda: hash_cache(WORDS_KEPT)), _Once()
        for batch in sliced(batches):
            found = [(class_of(s), s) for s in (ngrams(t, cache) for t in utf8(batch)) if len(s)]
            found = [(c, s) for c, s in found if fresh(c)]
            if found:
                yield record_batch({
                    "cls": ([c for c, _ in found], pa.int64()),
                    "n": ([len(s) for _, s in found], pa.int64()),
                    "grams": (_long_lists([s for _, s in found]), None)})

    return rows.mapInArrow(run, "cls long, n long, grams array<long>")


def _screen(classes: DataFrame) -> DataFrame:
    """(cls, n, key): classes that may have a partner, and a row to take the set from."""
    sent = classes.select("cls", F.explode("screen").alias("gram"))
    shared = (sent.groupBy("gram").agg(F.min("cls").alias("low"), F.max("cls").alias("high"))
              .where("low < high").select("gram"))
    met = sent.join(materialize(shared, "shared"), "gram", "left_semi")
    counts = met.groupBy("cls").agg(F.count(F.lit(1)).alias("met"))
    own = classes.where("cls IS NOT NULL").groupBy("cls").agg(
        F.min("n").alias("n"), F.min("key").alias("key"))
    return (own.join(counts, "cls").where(F.col("met") >= screen_need())
            .select("cls", "n", "key"))


def _rarity(sets: DataFrame) -> np.ndarray:
    """How many n-grams fall into each bucket of hashes; 2 ** BUCKET_BITS numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in sliced(batches):
            grams = column(batch, "grams").flatten().to_numpy(zero_copy_only=False).view(U64)
            total += np.bincount((grams >> U64(64 - BUCKET_BITS)).astype(np.int64),
                                 minlength=len(total))
        used = np.nonzero(total)[0]
        yield record_batch({"bucket": (pa.array(used.astype(np.int32)), None),
                            "times": (pa.array(total[used]), None)})

    counted = (sets.select("grams").mapInArrow(run, "bucket int, times long")
               .groupBy("bucket").agg(F.sum("times").alias("times")).toArrow())
    out = np.zeros(1 << BUCKET_BITS, np.int64)
    out[counted.column("bucket").to_numpy()] = counted.column("times").to_numpy()
    return out


def _prefixes(sets: DataFrame, rarity: np.ndarray) -> DataFrame:
    """(gram, cls, pos, n): the rarest n-grams of each class with their places."""
    shared = sets.sparkSession.sparkContext.broadcast(rarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = shared.value
        for batch in sliced(batches):
            chosen = []
            for values in column(batch, "grams"):
                grams = values.values.to_numpy(zero_copy_only=False).view(U64)
                order = np.lexsort((grams, times[(grams >> U64(64 - BUCKET_BITS)).astype(np.int64)]))
                chosen.append(grams[order[:len(grams) - need_of(len(grams)) + 1]])
            yield record_batch({"cls": (column(batch, "cls"), None), "n": (column(batch, "n"), None),
                                "grams": (_long_lists(chosen), None)})

    return (sets.mapInArrow(run, "cls long, n long, grams array<long>")
            .select("cls", "n", F.posexplode("grams").alias("pos", "gram")))


def _may_link(n: Column, i: Column, m: Column, j: Column) -> Column:
    """Length and positional filter for a shared n-gram at places i of n and j of m."""
    need = F.ceil((n + m) * 4 / 9)
    return ((F.least(n, m) * 5 >= F.greatest(n, m) * 4)
            & (F.least(n - i, m - j) >= need))


def part_sizes(grams: np.ndarray) -> np.ndarray:
    """Sizes of the parts into which fixed hashes split a sorted set, at most 255 each."""
    ends = np.searchsorted(grams, PIVOTS)
    return np.minimum(np.diff(np.concatenate([[0], ends, [len(grams)]])), 255).astype(np.uint8)


def _part_table(sets: DataFrame) -> DataFrame:
    """(cls, n, parts): what the suffix filter needs of each set; PARTS bytes a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            parts = [part_sizes(x.values.to_numpy(zero_copy_only=False).view(U64)).tobytes()
                     for x in column(batch, "grams")]
            yield record_batch({"cls": (column(batch, "cls"), None), "n": (column(batch, "n"), None),
                                "parts": (parts, pa.binary())})

    return materialize(sets.mapInArrow(run, "cls long, n long, parts binary"), "parts")


def _side(table: DataFrame, name: str, value: str) -> DataFrame:
    """One side of a pair. Pairs and sets both grow with the data, so they are joined
    alike at every size."""
    renamed = {"cls": name, value: f"{value}_{name}", "n": f"n_{name}"}
    return table.withColumnsRenamed(renamed).hint("merge")


def suffix_filter(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose parts don't differ too much in size.

    Sets that overlap by ``need`` differ in at most n + m - 2 * need elements, and
    in no fewer than the sum of the differences of their parts' sizes.
    """
    met = (pairs.join(_side(parts, "b", "parts"), "b").join(_side(parts, "a", "parts"), "a")
           .select("a", "b", "n_a", "n_b", "parts_a", "parts_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(column(batch, f"parts_{x}").to_pylist()), np.uint8)
                    .reshape(batch.num_rows, PARTS).astype(np.int64) for x in "ab")
            both = column(batch, "n_a").to_numpy() + column(batch, "n_b").to_numpy()
            good = np.abs(a - b).sum(axis=1) <= both - 2 * -(-4 * both // 9)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return met.mapInArrow(run, "a long, b long")


def _verify(pairs: DataFrame, sets: DataFrame, parts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets overlap by 0.8 or more."""
    close = materialize(suffix_filter(pairs, parts), "close")
    wanted = close.select(F.col("a").alias("cls")).union(close.select("b")).distinct()
    few = materialize(skew_join(sets.select("cls", "grams"), materialize(wanted, "wanted"), ["cls"],
                                "left_semi"), "sets")
    met = (close.join(_side(few, "b", "grams"), "b").join(_side(few, "a", "grams"), "a")
           .select("a", "b", "grams_a", "grams_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            good = [_linked(*(x.values.to_numpy(zero_copy_only=False).view(U64) for x in pair))
                    for pair in zip(column(batch, "grams_a"), column(batch, "grams_b"))]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return met.mapInArrow(run, "a long, b long")


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Do two sorted sets overlap by 0.8 or more?"""
    need = -(-4 * (len(a) + len(b)) // 9)
    return len(np.intersect1d(a, b, assume_unique=True)) >= need


def _links(sets: DataFrame) -> DataFrame:
    """(a, b): links between classes that leave no two linked classes unconnected."""
    parts = _part_table(sets)
    prefixes = materialize(_prefixes(sets, _rarity(sets)), "prefixes")
    buckets = (prefixes.groupBy("gram")
               .agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("pos", "cls", "n")).alias("l"))
               .where("size > 1")
               .select("gram", F.col("l.cls").alias("leader"), F.col("l.pos").alias("leader_pos"),
                       F.col("l.n").alias("leader_n")))
    members = materialize(prefixes.join(materialize(buckets, "buckets"), "gram")
                          .where("cls <> leader"), "members")
    led = (members.where(_may_link(F.col("n"), F.col("pos"), F.col("leader_n"),
                                   F.col("leader_pos")))
           .select(F.col("leader").alias("a"), F.col("cls").alias("b")).distinct())
    links = materialize(_verify(materialize(led, "pairs"), sets, parts), "links")

    labels = components(links)

    def label_of(rows: DataFrame, node: str, name: str) -> DataFrame:
        named = labels.select(F.col("node").alias(node), F.col("label").alias("_label"))
        return (skew_join(rows, named, [node], "left")
                .withColumn(name, F.coalesce("_label", node)).drop("_label"))

    placed = materialize(label_of(label_of(members, "cls", "comp"), "leader", "leader_comp"),
                         "placed")
    apart = placed.where("comp <> leader_comp").alias("x")
    others = placed.alias("y")
    rest = apart.join(others, F.col("x.gram") == F.col("y.gram")).where(
        (F.col("x.comp") != F.col("y.comp"))
        & ((F.col("x.cls") < F.col("y.cls")) | (F.col("y.comp") == F.col("y.leader_comp")))
        & _may_link(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos")))
    rest = rest.select(F.least("x.cls", "y.cls").alias("a"),
                       F.greatest("x.cls", "y.cls").alias("b")).distinct()
    rest = materialize(rest, "pairs")
    if rest.isEmpty():
        return links
    return links.union(_verify(rest, sets, parts))


def _components(rows: DataFrame) -> DataFrame:
    """(id, key, n, cls, component, component_id) of rows (id, text, key)."""
    ship_package(rows.sparkSession)
    table = _class_table(rows)
    classes = table.drop("screen")
    alive = materialize(_screen(table), "alive")
    chosen = skew_join(rows.select("key", "text"), alive.select("key"), ["key"], "left_semi")
    sets = materialize(_sets(chosen), "sets")
    if not sets.groupBy("cls").count().where("count > 1").isEmpty():
        sets = materialize(sets.groupBy("cls").agg(F.first("n").alias("n"),
                                                   F.first("grams").alias("grams")), "sets")
    labels = components(_links(sets))

    own = classes.where("cls IS NOT NULL").groupBy("cls").agg(F.min("id").alias("low"))
    named = labels.select(F.col("node").alias("cls"), "label").join(own, "cls")
    by_label = named.groupBy("label").agg(F.min("low").alias("lowest"))
    linked = skew_join(named.select("cls", "label"), materialize(by_label, "lowest"), ["label"])
    found = (own.join(linked, "cls", "left")
             .select("cls", F.coalesce("label", "cls").alias("component"),
                     F.when(F.col("label").isNull(), F.col("low")).otherwise(F.col("lowest"))
                     .alias("component_id")))
    out = skew_join(classes, materialize(found, "found"), ["cls"], "left")
    return out.withColumn("component_id", F.when(F.col("cls").isNull(), F.col("id"))
                          .otherwise(F.col("component_id")))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, cls, component, component_id), one row per row of ``docs``.

    ``cls`` names the set (null when empty), ``component`` the component of sets;
    ``component_id`` is the smallest id in it, the row's own id for empty sets.
    """
    rows = texts(docs, id_col, text_col).withColumn("key", F.xxhash64("id", "text"))
    return _components(rows).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                                    "cls", "component", "component_id")


def one_per_component(docs: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: of each component the smallest id.

    Empty texts all stay. Of rows that share the smallest id, or of a component
    without ids, one row stays.
    """
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    key = unused(docs, "_key")
    rows = texts(docs, id_col, text_col).withColumn("key", F.xxhash64("id", "text"))
    found = _components(rows).where("cls IS NOT NULL")
    first = materialize(found.where(F.col("id").eqNullSafe(F.col("component_id")))
                        .groupBy("component").agg(F.min("key").alias(key)).select(key), "stay")
    blank = text.isNull() | (F.btrim(text, F.lit(" \t\n\x0b\x0c\r")) == "")
    keyed = docs.withColumn(key, F.xxhash64(id_, text))
    stay = skew_join(keyed.where(~blank), first, [key], "left_semi")
    often = materialize(found.groupBy(F.col("key").alias(key)).count().where("count > 1")
                        .select(key), "often")
    if not often.isEmpty():
        often = materialize(often.join(first, key, "left_semi"), "often")
        stay = (skew_join(stay, often, [key], "left_anti")
                .unionByName(skew_join(stay, often, [key], "left_semi").dropDuplicates([key])))
    return stay.drop(key).unionByName(docs.where(blank))
