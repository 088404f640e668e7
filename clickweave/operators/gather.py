"""Look-ups and pooling of id lists inside Arrow batches.

A vector table that was measured to be small goes to every task as one matrix, a larger
one is written to files that tasks map (:mod:`clickweave.operators.mapped`). A list of ids is
then looked up and pooled where its row lies: no row per position is made, nothing is joined
and nothing shuffled. Tables beyond both sizes take the join of
:mod:`clickweave.operators.features`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickweave.operators.blockscore import list_column, matrix
from clickweave.operators.mapped import MAPPED_VALUES, MappedTable, mapped_table
from clickweave.session import ship_package

#: Values of a vector table that may go to every task: 200 MB.
SENT_VALUES = 25_000_000
#: Values of a vector table that is looked up without a join.
GATHER_VALUES = MAPPED_VALUES
POOLING_EPS = 1e-8
POOLING_FLOOR = -1e9
INDEX = "_index"
#: Logarithm of the sum of the exponentials of a row's counted weights.
WEIGHT_LSE = "weight_lse"


@dataclass(frozen=True)
class VectorTable:
    """Sorted ids, their vectors, and a last row of zeros for ids without one."""

    ids: np.ndarray
    vectors: np.ndarray

    def places(self, index: np.ndarray, unknown: str = "zero") -> np.ndarray:
        """The row of each id; an unknown one gets the zeros, or ends the job."""
        none = len(self.ids)
        if not none:
            at = np.full(len(index), none)
        elif self.ids[-1] - self.ids[0] == none - 1 and self.distinct:
            at = index - self.ids[0]
            at = np.where((at >= 0) & (at < none), at, none)
        else:
            at = np.minimum(np.searchsorted(self.ids, index), none - 1)
            at = np.where(self.ids[at] == index, at, none)
        if unknown == "fail":
            lost = index[(at == none) & (index != 0)]
            if len(lost):
                raise ValueError(f"no vector for index {lost[0]}")
        return at

    @cached_property
    def distinct(self) -> bool:
        return bool((np.diff(self.ids) > 0).all())

    @property
    def none(self) -> int:
        return len(self.ids)

    def take(self, at: np.ndarray) -> np.ndarray:
        """The vectors of rows."""
        return self.vectors[at]


Table = VectorTable | MappedTable


def vector_table(emb: DataFrame, name: str, dim: int, limit: int = GATHER_VALUES) -> Table | None:
    """The vectors of one embedding name, or None if there are more than ``limit`` values."""
    return table_of(emb.where(F.col("embedding_name") == name), dim, limit, (emb, name))


def table_of(vectors: DataFrame, dim: int, limit: int = GATHER_VALUES,
             source: tuple[DataFrame, str] | None = None) -> Table | None:
    """The same for all rows of a table (idx, vec).

    Files are written once for a ``source``, the DataFrame that the rows are the named part of.
    """
    rows = vectors.where(F.col("idx").isNotNull()).select(F.col("idx").cast("bigint").alias("idx"), "vec")
    values = rows.count() * dim
    if values > limit:
        return None
    if values > SENT_VALUES:
        return mapped_table(*(source or (vectors, "")), rows, dim)
    got = rows.orderBy("idx").toArrow()
    vectors = matrix(got.column("vec")) if got.num_rows else np.zeros((0, dim))
    ids = got.column("idx").to_numpy() if got.num_rows else np.zeros(0, np.int64)
    return VectorTable(ids, np.vstack([vectors, np.zeros((1, dim))]))


def with_index(rows: DataFrame, col: str,
               index: Callable[[Column], Column] | None) -> DataFrame:
    """Adds the table index of each position; padding (id 0) and missing ids are 0 or null.

    Whole numbers without an ``index`` rule stay as they are.
    """
    kind = rows.schema[col].dataType.elementType
    if index is None and isinstance(kind, T.IntegralType):
        return rows.withColumn(INDEX, F.col(col))
    index = index or (lambda x: x)
    is_text = isinstance(kind, T.StringType)
    zero = F.lit("0") if is_text else F.lit(0)
    return rows.withColumn(INDEX, F.transform(
        col, lambda x: F.when(x != zero, index(x).cast("bigint"))))


@dataclass(frozen=True)
class Positions:
    """The counted positions of a batch, row by row: batch row, place in the list, index."""

    row: np.ndarray
    pos: np.ndarray
    index: np.ndarray
    n_rows: int

    def reduce(self, vectors: np.ndarray, how, empty: float) -> np.ndarray:
        """``how`` over the vectors of each row; rows without any get ``empty``."""
        out = np.full((self.n_rows, vectors.shape[1]), empty)
        if len(self.row):
            present, start = np.unique(self.row, return_index=True)
            out[present] = how.reduceat(vectors, start)
        return out

    @property
    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.n_rows)


def lengths(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).cast(pa.int64()).fill_null(0).to_numpy()


def positions(batch: pa.RecordBatch, length: str | None) -> Positions:
    lists = batch.column(INDEX)
    sizes = lists.value_lengths().fill_null(0).to_numpy()
    row = np.repeat(np.arange(batch.num_rows), sizes)
    pos = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    flat = lists.flatten()
    index = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    counted = index != 0
    if length:
        counted &= pos < lengths(batch, length)[row]
    return Positions(row[counted], pos[counted], index[counted], batch.num_rows)


def weights(batch: pa.RecordBatch, at: Positions, name: str, normalise: bool) -> np.ndarray:
    """The weight of each counted position, after a softmax over its row if wanted."""
    lists = batch.column(name)
    sizes = lists.value_lengths().fill_null(0).to_numpy()
    flat = lists.flatten().cast(pa.float64()).fill_null(0.0).to_numpy()
    if not len(at.row):
        return np.zeros(0)
    start = np.cumsum(sizes) - sizes
    inside = at.pos < sizes[at.row]
    w = np.where(inside, flat[np.where(inside, start[at.row] + at.pos, 0)] if len(flat) else 0.0, 0.0)
    if not normalise:
        return w
    top = at.reduce(w[:, None], np.maximum, 0.0)[:, 0]
    e = np.exp(w - top[at.row])
    return e / at.reduce(e[:, None], np.add, 1.0)[at.row, 0]


def pooled(at: Positions, vectors: np.ndarray, mode: str, length: np.ndarray | None) -> np.ndarray:
    """Sum, mean or max per row, see :func:`clickweave.operators.features.pool_positions`."""
    if mode == "max":
        return at.reduce(vectors, np.maximum, POOLING_FLOOR)
    total = at.reduce(vectors, np.add, 0.0)
    if mode == "sum":
        return total
    size = at.counts if length is None else length
    return total / (size + POOLING_EPS)[:, None]


def map_rows(rows: DataFrame, make: Callable[[pa.RecordBatch], list[pa.Array]],
             added: Sequence[T.StructField]) -> DataFrame:
    """The rows without the index, and new columns, batch by batch."""
    ship_package(rows.sparkSession)
    kept = [c for c in rows.columns if c != INDEX]
    out = T.StructType([*[rows.schema[c] for c in kept], *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *make(batch)],
                                                 names=out.names)

    return rows.mapInArrow(run, out)


def pool_lists(rows: DataFrame, table: Table, modes: dict[str, str],
               length: str | None = None, weight: str | None = None, normalise: bool = True,
               unknown: str = "zero") -> DataFrame:
    """Adds a pooled vector per entry (column: mode) of ``modes``, all in one pass."""
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        at = positions(batch, length)
        vectors = shared.value.take(shared.value.places(at.index, unknown))
        if weight:
            vectors = vectors * weights(batch, at, weight, normalise)[:, None]
        size = lengths(batch, length) if length else None
        return [list_column(pooled(at, vectors, mode, size)) for mode in modes.values()]

    return map_rows(rows, make, [T.StructField(c, T.ArrayType(T.DoubleType())) for c in modes])


def look_up(rows: DataFrame, table: Table, out: str, unknown: str = "zero") -> DataFrame:
    """Adds the vector of the id in the column INDEX, where the row lies."""
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        index = batch.column(INDEX)
        if unknown == "fail" and index.null_count:
            raise ValueError("no vector for index NULL")
        at = shared.value.places(index.fill_null(0).to_numpy(zero_copy_only=False), unknown)
        at = np.where(index.is_valid().to_numpy(zero_copy_only=False), at, shared.value.none)
        return [list_column(shared.value.take(at))]

    return map_rows(rows, make, [T.StructField(out, T.ArrayType(T.DoubleType()))])


def score_lists(rows: DataFrame, table: Table, row_id: str, vec: str, lower: str,
                out: str) -> DataFrame:
    """(row_id, out): cross-entropy of the first id of the list in INDEX against all of them.

    A logit is the product of ``vec`` and the id's vector, less the number beside it in the
    list ``lower``. A first id that is missing gives a missing loss.
    """
    ship_package(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(table)
    needed = rows.select(row_id, vec, lower, INDEX)
    schema = T.StructType([rows.schema[row_id], T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            flat = batch.column(INDEX).flatten()
            sizes = batch.column(INDEX).value_lengths().to_numpy()
            row, first = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes) - sizes
            given = batch.column(vec).is_valid().to_numpy(zero_copy_only=False)
            known = flat.is_valid().to_numpy(zero_copy_only=False)
            at = shared.value.places(flat.fill_null(0).to_numpy(zero_copy_only=False))
            vectors = shared.value.take(np.where(known, at, shared.value.none))
            own = np.zeros((batch.num_rows, vectors.shape[1]))
            own[given] = matrix(batch.column(vec).drop_null()) if given.any() else 0.0
            logit = np.einsum("nd,nd->n", own[row], vectors)
            logit -= batch.column(lower).flatten().fill_null(0.0).to_numpy(zero_copy_only=False)
            top = np.maximum.reduceat(logit, first)
            loss = top + np.log(np.add.reduceat(np.exp(logit - top[row]), first)) - logit[first]
            yield pa.RecordBatch.from_arrays(
                [batch.column(row_id), pa.array(loss, mask=~known[first])], names=schema.names)

    return needed.mapInArrow(run, schema)


def counted_lists(rows: DataFrame, length: str | None = None) -> DataFrame:
    """Adds the places and ids (``places``, ``index``) of the counted positions of INDEX."""
    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        at = positions(batch, length)
        ends = pa.array(np.concatenate([[0], np.cumsum(at.counts)]).astype(np.int32))
        return [pa.ListArray.from_arrays(ends, pa.array(x))
                for x in (at.pos.astype(np.int32), at.index)]

    return map_rows(rows, make, [T.StructField("places", T.ArrayType(T.IntegerType())),
                                 T.StructField("index", T.ArrayType(T.LongType()))])


def flat_lists(rows: DataFrame, table: Table | None, row_id: str, length: str | None = None,
               weight: str | None = None, unknown: str = "zero") -> DataFrame:
    """(row_id, pos, [weight, weight_lse,] vec), one row per counted position.

    Without a ``table`` the position's id, ``_idx``, stands in the place of ``vec``.
    """
    ship_package(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(table)
    fields = [rows.schema[row_id], T.StructField("pos", T.IntegerType())]
    if weight:
        fields += [T.StructField(c, T.DoubleType()) for c in ("weight", WEIGHT_LSE)]
    fields.append(T.StructField("_idx", T.LongType()) if table is None else
                  T.StructField("vec", T.ArrayType(T.DoubleType())))
    out = T.StructType(fields)
    needed = rows.select(row_id, *filter(None, dict.fromkeys([length, weight])), INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = positions(batch, length)
            if not len(at.row):
                continue
            columns = [batch.column(row_id).take(pa.array(at.row)), pa.array(at.pos.astype(np.int32))]
            if weight:
                w = weights(batch, at, weight, False)
                top = at.reduce(w[:, None], np.maximum, 0.0)[:, 0]
                total = at.reduce(np.exp(w - top[at.row])[:, None], np.add, 1.0)[:, 0]
                columns += [pa.array(w), pa.array((top + np.log(total))[at.row])]
            if shared.value is None:
                last = pa.array(at.index)
            else:
                last = list_column(shared.value.take(shared.value.places(at.index, unknown)))
            yield pa.RecordBatch.from_arrays([*columns, last], names=out.names)

    return needed.mapInArrow(run, out)
