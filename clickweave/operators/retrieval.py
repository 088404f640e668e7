"""Nearest-neighbour search over vector tables, exact and approximate.

Items are a table (item_id, vec), queries a table (<keys>, vec). A search never
forms a table of all pairs: each task scores blocks of queries against blocks
of items and hands on at most k rows per query, which a ranked window merges.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickweave.operators.blockscore import (
    CodeScore, FlatScore, block_top_k, list_column, matrix, nearest_rows,
)
from clickweave.operators.ordering import first_in_group, top_k
from clickweave.operators.skew import skew_join
from clickweave.session import materialize, ship_package

ITEM_BLOCK = 16_384
QUERY_BLOCK = 16_384
#: Smaller blocks of a side grow, up to those sizes, when there are more than so many.
MOST_BLOCKS = 4
SMALL_QUERY_VALUES = 2_000_000
MODEL_VALUES = 32_000_000


def _with_cell(df: DataFrame, cell: str | None) -> DataFrame:
    """Cells as numbers: whole numbers stay, anything else is hashed. A row without a cell
    matches nothing, on either side."""
    if cell is None:
        return df.withColumn("_cell", F.lit(0).cast("bigint"))
    whole = isinstance(df.schema[cell].dataType, T.IntegralType)
    number = F.col(cell).cast("bigint") if whole else F.xxhash64(cell)
    return df.where(F.col(cell).isNotNull()).withColumn("_cell", number)


def _partials(table: pa.Table, keys: Sequence[str], rows: np.ndarray, ids: pa.Array,
              dist: np.ndarray) -> pa.Table:
    take = pa.array(rows)
    cols = [table.column(c).take(take) for c in keys]
    return pa.table([*cols, ids, pa.array(dist, pa.float64())],
                    names=[*keys, "item_id", "distance"])


def _search(items: DataFrame, queries: DataFrame, keys: Sequence[str], k: int, payload: str,
            score, cell: str | None = None, small_values: int = SMALL_QUERY_VALUES,
            item_block: int = ITEM_BLOCK, query_block: int = QUERY_BLOCK,
            rank: bool = True) -> DataFrame:
    ship_package(items.sparkSession)
    keys = list(keys)
    items = _with_cell(items, cell).select("item_id", F.col(payload).alias("_payload"), "_cell")
    # Read several times below, and often the end of a long job: written once.
    queries = materialize(_with_cell(queries, cell).select(*keys, "vec", "_cell"), "queries")
    out = T.StructType([*[f for f in queries.schema if f.name in keys],
                        items.schema["item_id"], T.StructField("distance", T.DoubleType())])
    # What a task holds: the queries, and up to k found rows for each of them.
    width = F.greatest(F.size("vec"), F.lit(k))
    size = queries.agg(F.coalesce(F.sum(width), F.lit(0)).alias("n")).first()["n"]
    if size <= small_values:
        found = _search_small(items, queries, keys, k, score, out, item_block)
    else:
        found = _search_blocks(items, queries, keys, k, score, out, cell, item_block, query_block)
    return top_k(found, keys, ["distance", "item_id"], k) if rank else found


def _search_small(items, queries, keys, k, score, out, item_block) -> DataFrame:
    """Queries fit every task (their size was checked): items are not shuffled at all."""
    asked = queries.orderBy("_cell", *keys).toArrow()
    cells = asked.column("_cell").to_numpy() if asked.num_rows else np.zeros(0, np.int64)
    probed = np.unique(cells)
    if 0 < len(probed) <= 1000:
        items = items.where(F.col("_cell").isin([int(c) for c in probed]))
    shared = items.sparkSession.sparkContext.broadcast(asked)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        vecs = matrix(table.column("vec"))
        cell_of = table.column("_cell").to_numpy() if table.num_rows else np.zeros(0, np.int64)
        best = _Best(k, keys)
        waiting, rows = [], 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows >= item_block:
                _score_cells(score, table, vecs, cell_of, pa.Table.from_batches(waiting), keys, k,
                             best)
                waiting, rows = [], 0
        if rows:
            _score_cells(score, table, vecs, cell_of, pa.Table.from_batches(waiting), keys, k, best)
        yield from best.batches()

    return items.mapInArrow(scan, out)


def _score_cells(score, asked, vecs, cell_of, block, keys, k, best) -> None:
    block_cells = block.column("_cell").to_numpy()
    payload = matrix(block.column("_payload"), _payload_type(score))
    ids = block.column("item_id").combine_chunks()
    plain_ids = ids.to_numpy(zero_copy_only=False)
    for cell in np.unique(block_cells):
        lo, hi = (np.searchsorted(cell_of, cell, side) for side in ("left", "right"))
        if lo == hi:
            continue
        here = np.nonzero(block_cells == cell)[0]
        rows, cols, dist = block_top_k(score, vecs[lo:hi], payload[here], plain_ids[here],
                                       int(cell), k)
        best.add(_partials(asked, keys, rows + lo, ids.take(pa.array(here[cols])), dist))


def _payload_type(score):
    return np.int64 if isinstance(score, CodeScore) else np.float64


class _Best:
    """Running best k rows per query of one task."""

    def __init__(self, k: int, keys: Sequence[str]):
        self.k, self.keys, self.parts, self.rows, self.kept = k, list(keys), [], 0, 0

    def add(self, part: pa.Table) -> None:
        self.parts.append(part)
        self.rows += part.num_rows
        if self.rows > 2 * self.kept + 1_000_000:
            self._shrink()

    def _shrink(self) -> None:
        frame = pa.concat_tables(self.parts)
        order = [(c, "ascending") for c in [*self.keys, "distance", "item_id"]]
        frame = frame.sort_by(order)
        same = np.ones(frame.num_rows, dtype=bool)
        for c in self.keys:
            v = frame.column(c).to_numpy()
            same[1:] &= v[1:] == v[:-1]
        same[:1] = False
        starts = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
        frame = frame.filter(pa.array(np.arange(len(same)) - starts < self.k))
        self.parts, self.rows, self.kept = [frame], frame.num_rows, frame.num_rows

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            self._shrink()
            yield from self.parts[0].combine_chunks().to_batches(max_chunksize=65_536)


def _search_blocks(items, queries, keys, k, score, out, cell, item_block, query_block) -> DataFrame:
    """Many queries: both sides are cut into blocks of bounded size that meet in one task each.

    A cell with very many items or queries gets more blocks, so the work per
    task does not depend on how the rows are spread over the cells. A row travels once per
    block of the other side: blocks of fewer rows than ITEM_BLOCK and QUERY_BLOCK grow with
    the cell rather than become more than MOST_BLOCKS.
    """
    def blocks(rows: Column, least: int, most: int) -> Column:
        grown = F.least(F.lit(most), F.ceil(rows / MOST_BLOCKS))
        return F.ceil(rows / F.greatest(F.lit(least), grown))

    if cell is None:
        sizes = [F.greatest(F.lit(1), blocks(F.lit(side.count()), block, most)).cast("bigint")
                 for side, block, most in ((items, item_block, ITEM_BLOCK),
                                           (queries, query_block, QUERY_BLOCK))]

        def with_cuts(df: DataFrame) -> DataFrame:
            return df.withColumn("_splits", sizes[0]).withColumn("_blocks", sizes[1])
    else:
        n_items, n_queries = (df.groupBy("_cell").agg(F.count(F.lit(1)).alias(n))
                              for df, n in ((items, "_ni"), (queries, "_nq")))
        # One row per cell, and a cell may be any value of the data: measured by skew_join.
        cuts = materialize(n_items.join(n_queries, "_cell").select(
            "_cell", blocks(F.col("_ni"), item_block, ITEM_BLOCK).alias("_splits"),
            blocks(F.col("_nq"), query_block, QUERY_BLOCK).alias("_blocks")), "cuts")

        def with_cuts(df: DataFrame) -> DataFrame:
            return skew_join(df, cuts, ["_cell"])

    zero = F.lit(0).cast("bigint")
    item_side = (with_cuts(items)
                 .withColumn("_split", F.pmod(F.xxhash64("item_id"), F.col("_splits")))
                 .withColumn("_block", F.explode(F.sequence(zero, F.col("_blocks") - 1)))
                 .drop("_splits", "_blocks"))
    query_side = (with_cuts(queries)
                  .withColumn("_block", F.pmod(F.xxhash64(*keys), F.col("_blocks")))
                  .withColumn("_split", F.explode(F.sequence(zero, F.col("_splits") - 1)))
                  .drop("_splits", "_blocks"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return _partials(right, keys, np.zeros(0, np.int64),
                             left.column("item_id").slice(0, 0).combine_chunks(), np.zeros(0))
        ids = left.column("item_id").combine_chunks()
        cell = left.column("_cell")[0].as_py()
        rows, cols, dist = block_top_k(
            score, matrix(right.column("vec")),
            matrix(left.column("_payload"), _payload_type(score)),
            ids.to_numpy(zero_copy_only=False), cell, k)
        return _partials(right, keys, rows, ids.take(pa.array(cols)), dist)

    by = ["_cell", "_split", "_block"]
    return item_side.groupBy(*by).cogroup(query_side.groupBy(*by)).applyInArrow(meet, out)


# --- exact ------------------------------------------------------------------

def exact_search(items: DataFrame, queries: DataFrame, k: int, keys: Sequence[str] = ("query_id",),
                 cell: str | None = None, **limits) -> DataFrame:
    """(keys, item_id, distance, rank): the k nearest items, squared L2.

    With ``cell`` only items and queries of the same cell meet.
    """
    return _search(items, queries, keys, k, "vec", FlatScore(), cell, **limits)


# --- inverted lists ---------------------------------------------------------

def _checked(model: np.ndarray, what: str) -> np.ndarray:
    if model.size > MODEL_VALUES:
        raise ValueError(f"{what} has {model.size} values, more than {MODEL_VALUES} per task")
    return model


def train_centroids(items: DataFrame, cells: int, seed: int = 1, iterations: int = 10,
                    vec: str = "vec") -> np.ndarray:
    """k-means centroids of the item vectors, as a (cells, dim) array."""
    points = items.select(array_to_vector(F.col(vec).cast("array<double>")).alias("features"))
    model = KMeans(k=cells, seed=seed, maxIter=iterations).fit(points)
    return np.array(model.clusterCenters())


def assign_cells(vectors: DataFrame, centroids: np.ndarray, nearest: int = 1,
                 vec: str = "vec") -> DataFrame:
    """One row per vector and nearby cell: all columns, ``cell`` and ``cell_distance``."""
    ship_package(vectors.sparkSession)
    points = _checked(np.asarray(centroids, dtype=np.float64), "the centroid table")
    out = T.StructType([*vectors.schema.fields, T.StructField("cell", T.IntegerType()),
                        T.StructField("cell_distance", T.DoubleType())])
    shared = vectors.sparkSession.sparkContext.broadcast(points)

    def place(batches):
        centers = shared.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            cells, dist = nearest_rows(matrix(batch.column(vec)), centers, nearest)
            rows = pa.array(np.repeat(np.arange(batch.num_rows), cells.shape[1]))
            cols = [c.take(rows) for c in batch.columns]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(cells.reshape(-1).astype(np.int32)), pa.array(dist.reshape(-1))],
                names=[*batch.schema.names, "cell", "cell_distance"])

    return vectors.mapInArrow(place, out)


def write_index(indexed: DataFrame, path: str) -> None:
    """Inverted lists on disk: a search reads only the folders of probed cells."""
    indexed.hint("rebalance", "cell").write.partitionBy("cell").parquet(path)


def search_cells(items: DataFrame, probing: DataFrame, keys: Sequence[str], k: int, payload: str,
                 score, **limits) -> DataFrame:
    """The k nearest items of each query among those that share one of its cells."""
    return _search(items, probing, keys, k, payload, score, "cell", **limits)


def ivf_search(indexed: DataFrame, queries: DataFrame, centroids: np.ndarray, k: int,
               probes: int = 1, keys: Sequence[str] = ("query_id",), **limits) -> DataFrame:
    """Exact distances within the ``probes`` cells nearest to each query."""
    probing = assign_cells(queries.select(*keys, "vec"), centroids, probes)
    return search_cells(indexed, probing, keys, k, "vec", FlatScore(), **limits)


# --- product codes ----------------------------------------------------------

def residuals(indexed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Vector minus the centroid of its cell, as ``residual``."""
    ship_package(indexed.sparkSession)
    points = _checked(np.asarray(centroids, dtype=np.float64), "the centroid table")
    out = T.StructType([*indexed.schema.fields,
                        T.StructField("residual", T.ArrayType(T.DoubleType()))])
    shared = indexed.sparkSession.sparkContext.broadcast(points)

    def subtract(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            gap = matrix(batch.column("vec")) - shared.value[batch.column("cell").to_numpy()]
            yield pa.RecordBatch.from_arrays([*batch.columns, list_column(gap)],
                                             names=[*batch.schema.names, "residual"])

    return indexed.mapInArrow(subtract, out)


def train_codebook(with_residual: DataFrame, parts: int, codes: int = 256, seed: int = 1,
                   iterations: int = 10) -> np.ndarray:
    """k-means of each sub-space of the residuals, as a (parts, codes, width) array."""
    dim = len(with_residual.first()["residual"])
    if dim % parts:
        raise ValueError(f"{dim} dimensions cannot be cut into {parts} equal sub-spaces")
    width = dim // parts
    stored = materialize(with_residual.select("residual"), "residuals")  # read once per sub-space
    book = []
    for j in range(parts):
        sub = stored.select(F.slice("residual", j * width + 1, width).alias("vec"))
        centers = train_centroids(sub, codes, seed + j, iterations)
        # k-means returns fewer centers when there are fewer distinct vectors.
        fill = np.repeat(centers[-1:], codes - len(centers), axis=0)
        book.append(np.concatenate([centers, fill]))
    return np.array(book)


def encode_residuals(with_residual: DataFrame, codebook: np.ndarray,
                     keep: Sequence[str] = ()) -> DataFrame:
    """(item_id, cell, [keep,] codes): nearest code of every sub-space, ties to the smaller code."""
    ship_package(with_residual.sparkSession)
    book = _checked(np.asarray(codebook, dtype=np.float64), "the codebook")
    names = ["item_id", "cell", *keep]
    kept = with_residual.select(*names, "residual")
    out = T.StructType([*[kept.schema[c] for c in names],
                        T.StructField("codes", T.ArrayType(T.IntegerType()))])
    shared = kept.sparkSession.sparkContext.broadcast(book)

    def to_codes(batches):
        m, _, width = shared.value.shape
        for batch in batches:
            if batch.num_rows == 0:
                continue
            gap = matrix(batch.column("residual"))
            codes = np.empty((batch.num_rows, m), dtype=np.int32)
            for j in range(m):
                sub = gap[:, j * width:(j + 1) * width]
                codes[:, j] = nearest_rows(sub, shared.value[j], 1)[0][:, 0]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], list_column(codes)], names=[*names, "codes"])

    return kept.mapInArrow(to_codes, out)


def pq_search(coded: DataFrame, queries: DataFrame, centroids: np.ndarray, codebook: np.ndarray,
              k: int, probes: int = 1, keys: Sequence[str] = ("query_id",), **limits) -> DataFrame:
    """Distances to the codes of the items in the probed cells."""
    centers = np.asarray(centroids, dtype=np.float64)
    book = _checked(np.asarray(codebook, dtype=np.float64), "the codebook")
    probing = assign_cells(queries.select(*keys, "vec"), centers, probes)
    return search_cells(coded, probing, keys, k, "codes", CodeScore(centers, book), **limits)


# --- results ----------------------------------------------------------------

def merge_hits(hits: DataFrame, user: str = "user_id") -> DataFrame:
    """Smallest distance per user and item over all vectors of the user."""
    return hits.groupBy(user, "item_id").agg(F.min("distance").alias("distance"))


def top_merged(merged: DataFrame, n: int, user: str = "user_id") -> DataFrame:
    """The n nearest items per user, ascending."""
    return top_k(merged, [user], ["distance", "item_id"], n)


def with_metadata(hits: DataFrame, items: DataFrame, key: str = "item_id") -> DataFrame:
    """Hits joined to one row of metadata each; a popular item may be hit by every query."""
    return skew_join(hits, items, [key])


def top_with_metadata(hits: DataFrame, items: DataFrame, size: int,
                      query: str = "query_id", sim: str = "sim_id") -> DataFrame:
    """Cut to ``size``, add metadata, keep the nearest hit of each sim id.

    The cut comes first, so fewer than ``size`` rows may come back.
    """
    cut = hits.where(F.col("rank") <= size).drop("rank")
    return first_in_group(with_metadata(cut, items), [query, sim], ["distance", "item_id"])


def as_users(vectors: DataFrame, row: str, per_user: int) -> DataFrame:
    """Consecutive rows as the several vectors of one user."""
    return vectors.select(F.floor(F.col(row) / per_user).alias("user_id"),
                          F.pmod(F.col(row), F.lit(per_user)).cast("int").alias("interest_no"),
                          "vec")


def multi_vector_search(hits_of: DataFrame, n: int) -> DataFrame:
    """Hits of (user_id, interest_no) queries to the n nearest items per user."""
    return top_merged(merge_hits(hits_of), n)

