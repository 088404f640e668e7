"""Exact nearest neighbours that skip blocks of items by distance bounds.

Items are placed in the cell of their nearest pivot. A first round searches, per query,
the nearest cells that hold ``k`` items between them; its k-th distance bounds the answer.
Every item of a cell lies in a ring around the pivot, so by the triangle inequality a query
at distance d from the pivot is at least max(d - outer, inner - d) away from all of them: a
second round searches only the cells for which that is within the bound. The result is that
of ``exact_search``, whatever the pivots; good pivots skip more.

Items travel once per block of queries that still needs their cell, instead of once per
block of all queries. The pivots are a model of at most MODEL_VALUES values in every task;
cells of any size are cut into blocks by the search itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from clickweave.operators import retrieval as rt
from clickweave.operators.blockscore import (
    CELLS_PER_STEP, DIGITS, FlatScore, matrix, squared_l2,
)
from clickweave.operators.ordering import top_k
from clickweave.session import materialize

MOST_PIVOTS = 4_096


def choose_pivots(items: DataFrame, count: int) -> np.ndarray:
    """Vectors of ``count`` different items, chosen by a hash of the id."""
    few = (items.select("vec", "item_id", F.xxhash64("item_id").alias("_h"))
           .orderBy("_h", "item_id").limit(count).select(F.col("vec").cast("array<double>")))
    return matrix(few.toArrow().column(0))


@dataclass(frozen=True)
class Rings:
    """Pivots of the cells that hold items, with the squared distances of their items."""

    pivots: np.ndarray
    cells: np.ndarray
    sizes: np.ndarray
    inner: np.ndarray
    outer: np.ndarray

    def squared(self, vectors: np.ndarray) -> tuple[np.ndarray, float]:
        """Squared distances to the pivots, and what rounding may add to or take from them."""
        return squared_l2(vectors, self.pivots), FlatScore().slack(vectors, self.pivots)

    def first(self, vectors: np.ndarray, k: int) -> np.ndarray:
        """(vectors, cells): the nearest cells until they hold ``k`` items."""
        order = np.argsort(self.squared(vectors)[0], axis=1, kind="stable")
        before = np.cumsum(self.sizes[order], axis=1) - self.sizes[order]
        chosen = np.zeros(order.shape, dtype=bool)
        np.put_along_axis(chosen, order, before < k, axis=1)
        return chosen

    def within(self, vectors: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """(vectors, cells): cells that may hold an item at the squared distance ``bound``."""
        dist, slack = self.squared(vectors)
        unit = 10.0 ** -DIGITS
        low = np.sqrt(np.maximum(dist - slack, 0)) - np.sqrt(self.outer + unit)
        high = np.sqrt(np.maximum(self.inner - unit, 0)) - np.sqrt(dist + slack)
        nearest = np.maximum(np.maximum(low, high), 0) * (1 - unit)
        return nearest <= np.sqrt(bound + unit)[:, None]


def rings_of(placed: DataFrame, pivots: np.ndarray) -> Rings:
    """One row per pivot comes to the driver."""
    rows = (placed.groupBy("cell").agg(F.count(F.lit(1)), F.min("cell_distance"),
                                       F.max("cell_distance")).orderBy("cell").collect())
    cells = np.array([r[0] for r in rows], dtype=np.int64)
    sizes, inner, outer = (np.array([r[i] for r in rows], dtype=t)
                           for i, t in ((1, np.int64), (2, np.float64), (3, np.float64)))
    return Rings(pivots[cells], cells, sizes, inner, outer)


def _probes(asked: DataFrame, keys: Sequence[str], rings: Rings, k: int,
            bounded: bool) -> DataFrame:
    """(keys, vec, cell) of the first round, or of the second for queries with a bound."""
    out = T.StructType([*[asked.schema[c] for c in [*keys, "vec"]],
                        T.StructField("cell", T.IntegerType())])
    shared = asked.sparkSession.sparkContext.broadcast(rings)
    step = max(1, CELLS_PER_STEP // max(1, len(rings.cells)))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                vecs = matrix(batch.column("vec"))
                need = known.first(vecs, k)
                if bounded:
                    bound = batch.column("bound").to_numpy(zero_copy_only=False)
                    need = known.within(vecs, bound) & ~need
                rows, cols = np.nonzero(need)
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(take) for c in [*keys, "vec"]],
                     pa.array(known.cells[cols].astype(np.int32))], names=[*keys, "vec", "cell"])

    return asked.mapInArrow(choose, out)


@dataclass(frozen=True)
class BoundedSearch:
    """Result of a search, and the (keys, vec, cell) it looked at in either round."""

    hits: DataFrame
    first: DataFrame
    second: DataFrame
    queries: int
    cells: int

    def effort(self) -> DataFrame:
        """One row (pairs, searched, skipped) of pairs of a query and a cell with items."""
        searched = self.first.select("cell").unionByName(self.second.select("cell"))
        pairs = F.lit(self.queries * self.cells).cast("bigint")
        return (searched.agg(F.count(F.lit(1)).alias("searched"))
                .select(pairs.alias("pairs"), "searched",
                        (pairs - F.col("searched")).alias("skipped")))


def bounded_search(items: DataFrame, queries: DataFrame, k: int,
                   keys: Sequence[str] = ("query_id",), pivots: np.ndarray | None = None,
                   **limits) -> BoundedSearch:
    """The ``k`` nearest items (keys, item_id, distance, rank), squared L2, of every query.

    ``keys`` name a query: they are unique and not null. Without ``pivots`` there is one
    for each ITEM_BLOCK of items, at most MOST_PIVOTS, taken from the items by hash.
    """
    keys = list(keys)
    items = items.select("item_id", F.col("vec").cast("array<double>").alias("vec"))
    if pivots is None:
        pivots = choose_pivots(items, min(MOST_PIVOTS, max(1, -(-items.count() // rt.ITEM_BLOCK))))
    points = np.asarray(pivots, dtype=np.float64)
    asked = materialize(queries.select(*keys, F.col("vec").cast("array<double>").alias("vec")),
                        "asked")
    count = asked.count()
    if len(points) == 0 or items.isEmpty():
        none = asked.select(*keys, "vec", F.lit(0).alias("cell")).limit(0)
        return BoundedSearch(rt.exact_search(items, asked, k, keys, **limits), none, none, count, 0)
    placed = materialize(rt.assign_cells(items, points), "placed")
    rings = rings_of(placed, points)
    first = materialize(_probes(asked, keys, rings, k, False), "first")
    near = materialize(rt.search_cells(placed, first, keys, k, "vec", FlatScore(), **limits), "near")
    # Fewer than k items altogether: all of them were searched, nothing is left for a second round.
    bounds = near.groupBy(*keys).agg(F.max("distance").alias("bound"))
    second = materialize(_probes(asked.join(bounds, keys), keys, rings, k, True), "second")
    more = rt.search_cells(placed, second, keys, k, "vec", FlatScore(), rank=False, **limits)
    both = near.drop("rank").unionByName(more.select(*keys, "item_id", "distance"))
    return BoundedSearch(top_k(both, keys, ["distance", "item_id"], k), first, second, count,
                         len(rings.cells))
