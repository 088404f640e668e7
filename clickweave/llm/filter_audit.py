"""What each of five filters removes in every order, by a Gray-code walk over filter sets.

A document's failed filters are a mask of five bits; documents are counted by part and
mask, 32 cells a part at most. The walk visits all 32 sets of filters, each differing from
the one before by a single filter. Every cell keeps how many of the filters in the
set it fails; a toggle changes the counters of the cells that fail the toggled filter, and
only cells whose counter becomes or leaves zero change the running number of
survivors. The 32 numbers are stored. A step of an order is the difference of two
stored numbers, and a filter's share over all orders is a weighted sum of such.

Copies are found by a digest of the text (128 bits). Rows of a digest that many rows
share are not gathered: the smallest id of each digest is an aggregate, joined back
with :func:`skew_join`.

Defined results: a null text is empty; a null lang is the empty string; a null
id equals no label, is no smaller id, and its own row is no copy; rows that repeat
an id are no copies of one another; a document is good, or toxic, if any of its labels
says so; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickweave.llm.common import column, map_batches, record_batch, utf8
from clickweave.operators.skew import skew_join
from clickweave.session import materialize, ship_package

FILTERS = "ABCDE"
SETS = 1 << len(FILTERS)
COPY = 1 << FILTERS.index("E")
MEASURES = ("n", "good", "toxic")
_UPPER = string.ascii_uppercase.encode()
_CONTINUED = bytes(range(0x80, 0xC0))
_MARK = re.compile(rb"[#$%&*|]").search


def failed(text: bytes) -> int:
    """The filters A to D that a text fails, as bits."""
    words = text.split()
    n = len(words)
    capitals = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _CONTINUED))
    return ((n < 100) | (100 * len(set(words)) < 80 * n) << 1
            | (100 * capitals > 10 * points) << 2 | (_MARK(text) is not None) << 3)


def failure_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and set of failed filters."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                       F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"))
    kind = dict(rows.dtypes)["id"]

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = utf8(batch)
        return record_batch({
            "id": (column(batch, "id"), None), "part": (column(batch, "part"), None),
            "mask": ([failed(t) for t in found], pa.int32()),
            "digest": ([hashlib.md5(t, usedforsecurity=False).digest() for t in found],
                       pa.binary())})

    judged = materialize(map_batches(rows, make, f"id {kind}, part string, mask int, digest binary"),
                         "judged")
    firsts = materialize(judged.where("id IS NOT NULL").groupBy("digest")
                         .agg(F.min("id").alias("first"), F.max("id").alias("last"))
                         .where("first < last").select("digest", "first"), "copied")
    marked = (skew_join(judged, firsts, ["digest"], "left")
              .withColumn("mask", F.col("mask") + F.when(F.col("id") > F.col("first"), COPY)
                          .otherwise(0))
              .select("id", "part", "mask"))
    id_ = F.col(f"`{id_col}`")
    known = (labels.where(id_.isNotNull()).groupBy(id_.alias("id"))
             .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                  F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
             .where("good + toxic > 0"))
    joined = skew_join(marked, materialize(known, "known"), ["id"], "left")
    return joined.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.coalesce(F.sum(m), F.lit(0)).cast("long").alias(m) for m in MEASURES[1:]])


def walk(masks: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Survivors of each of the 32 sets of filters, a column per measure.

    ``counts`` has a row per cell, ``masks`` the cell's failed filters.
    """
    out = np.zeros((SETS, counts.shape[1]), np.int64)
    active = np.zeros(len(masks), np.int64)
    alive = counts.sum(axis=0)
    out[0] = alive
    chosen = 0
    for step in range(1, SETS):
        toggled = step & -step  # the bit in which a Gray code and the next differ
        on = not chosen & toggled
        chosen ^= toggled
        failing = (masks & toggled) != 0
        before = active == 0
        active[failing] += 1 if on else -1
        lost, back = before & (active != 0), ~before & (active == 0)
        alive = alive - counts[lost].sum(axis=0) + counts[back].sum(axis=0)
        out[chosen] = alive
    return out


def steps(masks: np.ndarray, counts: np.ndarray) -> dict[str, list]:
    """All steps of all orders for one part."""
    kept = walk(masks, counts)
    own = np.zeros(SETS, np.int64)
    own[masks] = counts[:, 0]
    failing = {f: int(own[[m for m in range(SETS) if m >> i & 1]].sum())
               for i, f in enumerate(FILTERS)}
    shares = {f: sum(factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count())
                     * int(kept[s][0] - kept[s | 1 << i][0])
                     for s in range(SETS) if not s >> i & 1)
              for i, f in enumerate(FILTERS)}
    out: dict[str, list] = {name: [] for name, _ in COLUMNS}
    for order in permutations(FILTERS):
        chosen = 0
        for step, f in enumerate(order, 1):
            bit = 1 << FILTERS.index(f)
            gone = kept[chosen] - kept[chosen | bit]
            chosen |= bit
            for name, value in (
                    ("filter_order", "".join(order)), ("step", step), ("kept", kept[chosen][0]),
                    ("removed", gone[0]), ("redundant", failing[f] - gone[0]),
                    ("unique_fails", own[bit]), ("good_lost", gone[1]), ("toxic_lost", gone[2]),
                    ("shapley", shares[f])):
                out[name].append(value)
    return out


COLUMNS = (("filter_order", pa.string()), ("step", pa.int32()),
           *[(c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails",
                                       "good_lost", "toxic_lost", "shapley")])


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley): 600 rows per part."""
    ship_package(docs.sparkSession)
    cells = failure_cells(docs, labels, id_col, text_col, part_col)
    # At most 32 cells of a few bytes a part.
    by_part = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = steps(np.array([c["mask"] for c in found]),
                            np.array([[c[m] for m in MEASURES] for c in found], np.int64))
                yield record_batch({"part": ([part] * len(got["step"]), pa.string()),
                                    **{c: (got[c], t) for c, t in COLUMNS}})

    return by_part.mapInArrow(
        run, "part string, filter_order string, step int, kept long, removed long, "
             "redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")
