"""Vector tables as files that tasks map into memory.

A table too large for a broadcast is written once, by tasks, below the scratch folder: ids and
vectors in slices by id range. Tasks map the slices, so workers of a machine share one copy in
its page cache and read only the vectors they ask for. A store that can't be mapped is copied
to an executor's temporary folder once.
"""

from __future__ import annotations

import fcntl
import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from clickweave.operators.blockscore import matrix
from clickweave.session import scratch_path, ship_package

#: Values of a table that may lie in files: 8 GB.
MAPPED_VALUES = 1_000_000_000
#: Slices get larger, not more, beyond this number: a look-up visits each of them.
SLICE_VALUES, MOST_SLICES = 25_000_000, 8

_WRITTEN: WeakKeyDictionary = WeakKeyDictionary()


def local_path(uri: str) -> str:
    """A path to the file on this machine, copied there unless its store is mounted."""
    store, path = fs.FileSystem.from_uri(uri)
    if isinstance(store, fs.LocalFileSystem):
        return path
    copy = os.path.join(tempfile.gettempdir(), f"clickweave-{os.path.basename(path)}")
    with open(f"{copy}.lock", "w") as lock:
        fcntl.flock(lock, fcntl.LOCK_EX)
        if not os.path.exists(copy):
            with store.open_input_stream(path) as source, open(f"{copy}.part", "wb") as out:
                while piece := source.read(1 << 24):
                    out.write(piece)
            os.replace(f"{copy}.part", copy)
    return copy


@dataclass(frozen=True)
class Slice:
    """Rows of one range of ids, ascending and distinct."""

    uri: str
    low: int
    high: int
    rows: int
    dim: int

    @cached_property
    def ids(self) -> np.ndarray:
        return np.memmap(local_path(f"{self.uri}.ids"), np.int64, "r", shape=(self.rows,))

    @cached_property
    def vectors(self) -> np.ndarray:
        return np.memmap(local_path(f"{self.uri}.vec"), np.float64, "r", shape=(self.rows, self.dim))

    def places(self, index: np.ndarray) -> np.ndarray:
        """The rows of ids within the range, -1 for those that are missing."""
        if self.high - self.low == self.rows - 1:
            return index - self.low
        at = np.searchsorted(self.ids, index)
        return np.where(self.ids[at] == index, at, -1)


@dataclass(frozen=True)
class MappedTable:
    """The same look-ups as :class:`clickweave.operators.gather.VectorTable`, from files."""

    slices: tuple[Slice, ...]
    dim: int
    distinct = True

    @cached_property
    def first(self) -> np.ndarray:
        """The number of the first row of each slice, and the number of rows."""
        return np.concatenate([[0], np.cumsum([s.rows for s in self.slices])]).astype(np.int64)

    @property
    def none(self) -> int:
        return int(self.first[-1])

    def places(self, index: np.ndarray, unknown: str = "zero") -> np.ndarray:
        """The row of each id; an unknown one gets the zeros, or ends the job."""
        at = np.full(len(index), self.none, np.int64)
        for s, first in zip(self.slices, self.first):
            here = np.flatnonzero((index >= s.low) & (index <= s.high))
            row = s.places(index[here])
            found = row >= 0
            at[here[found]] = row[found] + first
        if unknown == "fail":
            lost = index[(at == self.none) & (index != 0)]
            if len(lost):
                raise ValueError(f"no vector for index {lost[0]}")
        return at

    def take(self, at: np.ndarray) -> np.ndarray:
        """The vectors of rows."""
        out = np.zeros((len(at), self.dim))
        for s, first in zip(self.slices, self.first):
            here = np.flatnonzero((at >= first) & (at < first + s.rows))
            if len(here) == len(at):
                return s.vectors[at - first]
            out[here] = s.vectors[at[here] - first]
        return out


def mapped_table(source: DataFrame, part: str, rows: DataFrame, dim: int) -> MappedTable | None:
    """The rows (idx, vec) as files; written once for ``part`` of the DataFrame ``source``.

    None if an id stands twice, or a vector is missing, has a missing value or another length.
    """
    known = _WRITTEN.setdefault(source, {})
    if (part, dim) not in known:
        known[part, dim] = _write(rows, dim)
    return known[part, dim]


def _write(rows: DataFrame, dim: int) -> MappedTable | None:
    vec = F.col("vec").cast("array<double>")
    plain = F.coalesce((F.size(vec) == dim) & ~F.exists(vec, lambda x: x.isNull()), F.lit(False))
    n = rows.count()
    if rows.where(plain).count() < n:
        return None
    spark = rows.sparkSession
    ship_package(spark)
    folder = scratch_path(spark, "vectors")
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    slices = max(1, min(MOST_SLICES, -(-n * dim // SLICE_VALUES)))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"{os.path.basename(path)}-{context.partitionId()}-{context.taskAttemptId()}"
        store = fs.FileSystem.from_uri(folder)[0]
        low, high, count, rising = None, None, 0, True
        with store.open_output_stream(f"{path}/{name}.ids", compression=None) as ids, \
                store.open_output_stream(f"{path}/{name}.vec", compression=None) as vectors:
            for batch in batches:
                if not batch.num_rows:
                    continue
                idx = batch.column("idx").to_numpy()
                rising &= bool((np.diff(idx) > 0).all()) and (high is None or idx[0] > high)
                low, high = int(idx[0]) if low is None else low, int(idx[-1])
                count += len(idx)
                ids.write(np.ascontiguousarray(idx, np.int64).tobytes())
                vectors.write(np.ascontiguousarray(matrix(batch.column("vec"))).tobytes())
        if count:
            yield pa.RecordBatch.from_pylist([{"uri": f"{folder}/{name}", "low": low, "high": high,
                                               "n": count, "rising": rising}])

    sliced = (rows.select("idx", vec.alias("vec")).repartitionByRange(slices, "idx")
              .sortWithinPartitions("idx"))
    done = sliced.mapInArrow(write, "uri string, low bigint, high bigint, n bigint, rising boolean").collect()
    if not all(r["rising"] for r in done):
        return None
    return MappedTable(tuple(Slice(r["uri"], r["low"], r["high"], r["n"], dim)
                             for r in sorted(done, key=lambda r: r["low"])), dim)
