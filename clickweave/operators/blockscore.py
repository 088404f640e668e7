"""Scoring of one block of queries against one block of items, inside a task.

Distances are squared L2. They are compared after rounding to nine digits, ties
go to the smaller item id; with that rule a result does not depend on how the
blocks were cut.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

DIGITS = 9
#: Distances of a step: 16 MB, and a few arrays of that size beside them.
CELLS_PER_STEP = 2_000_000


def matrix(column: pa.ChunkedArray | pa.Array, dtype=np.float64) -> np.ndarray:
    """A list column of equal lengths as a two-dimensional array."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(arr) == 0:
        return np.zeros((0, 0), dtype=dtype)
    flat = arr.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(dtype, copy=False).reshape(len(arr), -1)


def list_column(values: np.ndarray) -> pa.Array:
    """Rows of a two-dimensional array as a list column."""
    n, width = values.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(width))
    return pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1)))


def nested_lists(values: np.ndarray) -> pa.Array:
    """(rows, k, dim) as a column of lists of lists."""
    n, k, dim = values.shape
    inner = pa.ListArray.from_arrays(
        pa.array(np.arange(n * k + 1, dtype=np.int32) * np.int32(dim)), pa.array(values.reshape(-1)))
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(k)), inner)


def squared_l2(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a @ b.T
    out *= -2.0
    out += (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
    return np.maximum(out, 0.0, out=out)


@dataclass(frozen=True)
class FlatScore:
    """Exact distance to full vectors."""

    def __call__(self, queries: np.ndarray, items: np.ndarray, cell: int) -> np.ndarray:
        return squared_l2(queries, items)

    def slack(self, queries: np.ndarray, items: np.ndarray) -> float:
        # The product form above loses digits in proportion to the norms.
        top = (queries * queries).sum(1).max() + (items * items).sum(1).max()
        return 10.0 ** -DIGITS + 1e-13 * float(top)

    def exact(self, queries: np.ndarray, items: np.ndarray) -> np.ndarray:
        return ((queries - items) ** 2).sum(1)

    def between(self, queries: np.ndarray, items: np.ndarray, cell: int) -> np.ndarray:
        """The distance of each pair."""
        return self.exact(queries, items)

    def offsets(self, items: np.ndarray, center: np.ndarray) -> np.ndarray:
        """What an item stands for, seen from its cell's centroid."""
        return items - center


@dataclass(frozen=True)
class CodeScore:
    """Distance to product codes of the residual from the cell's centroid."""

    centroids: np.ndarray
    codebook: np.ndarray

    def __call__(self, queries: np.ndarray, items: np.ndarray, cell: int) -> np.ndarray:
        m, codes, width = self.codebook.shape
        residual = (queries - self.centroids[cell]).reshape(len(queries), m, width)
        out = np.zeros((len(queries), len(items)))
        for j in range(m):
            gap = residual[:, j, None, :] - self.codebook[j][None, :, :]
            table = (gap * gap).sum(2)
            out += table[:, items[:, j]]
        return out

    def slack(self, queries: np.ndarray, items: np.ndarray) -> float:
        return 10.0 ** -DIGITS

    exact = None

    def between(self, queries: np.ndarray, items: np.ndarray, cell: int) -> np.ndarray:
        """The distance of each pair."""
        m, codes, width = self.codebook.shape
        residual = (queries - self.centroids[cell]).reshape(len(queries), m, width)
        out = np.zeros(len(queries))
        for j in range(m):
            gap = residual[:, j] - self.codebook[j][items[:, j]]
            out += (gap * gap).sum(1)
        return out

    def offsets(self, items: np.ndarray, center: np.ndarray) -> np.ndarray:
        """What an item's codes stand for, seen from its cell's centroid."""
        return np.concatenate([book[items[:, j]] for j, book in enumerate(self.codebook)], axis=1)


def block_top_k(score, queries: np.ndarray, items: np.ndarray, ids: np.ndarray, cell: int,
                k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, item position, distance) of the k nearest items of each query."""
    rows_out, cols_out, dist_out = [], [], []
    if len(queries) == 0 or len(items) == 0:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(0)
    by_id = np.argsort(ids, kind="stable")
    items = items[by_id]
    step = max(1, CELLS_PER_STEP // len(items))
    for start in range(0, len(queries), step):
        q = queries[start:start + step]
        rough = score(q, items, cell)
        if rough.shape[1] > k:
            bar = np.partition(rough, k - 1, axis=1)[:, k - 1:k]
            rows, cols = np.nonzero(rough <= bar + score.slack(q, items))
        else:
            rows, cols = (a.reshape(-1) for a in np.indices(rough.shape))
        if score.exact is None:
            dist = rough[rows, cols]
        else:
            dist = np.empty(len(rows))
            span = max(1, CELLS_PER_STEP // items.shape[1])
            for lo in range(0, len(rows), span):
                part = slice(lo, lo + span)
                dist[part] = score.exact(q[rows[part]], items[cols[part]])
        dist = np.round(dist, DIGITS)
        order = np.lexsort((cols, dist, rows))
        rows, cols, dist = rows[order], cols[order], dist[order]
        first = np.searchsorted(rows, np.arange(len(q)))
        keep = np.arange(len(rows)) - first[rows] < k
        rows_out.append(rows[keep] + start)
        cols_out.append(by_id[cols[keep]])
        dist_out.append(dist[keep])
    return np.concatenate(rows_out), np.concatenate(cols_out), np.concatenate(dist_out)


def nearest_rows(vectors: np.ndarray, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Index and distance of the k nearest points of each vector, as (rows, k) arrays."""
    k = min(k, len(points))
    numbers = np.arange(len(points))
    _, cols, dist = block_top_k(FlatScore(), vectors, points, numbers, 0, k)
    return cols.reshape(-1, k), dist.reshape(-1, k)
