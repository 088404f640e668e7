"""Helpers shared by the operators of this package."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickweave.session import ship_package

#: Rows per Arrow batch handed to a task's Python worker; texts may be long.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) alone, so that no other column can clash with an operator's own."""
    return df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most BATCH_ROWS rows; lists made of a slice stay small."""
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(start, BATCH_ROWS)


def map_batches(df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: str) -> DataFrame:
    """One Arrow batch in, one out; ``None`` when a batch gives no rows."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = make(batch)
            if out is not None:
                yield out

    return df.mapInArrow(run, schema)


def dealt(stored: DataFrame, rows: int) -> DataFrame:
    """A written table in partitions of about ``rows`` rows, for work that is long per row
    and whose rows are short, so that files hold many."""
    return stored.repartition(max(1, -(-stored.count() // rows)))


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The column's values as UTF-8, null as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    values = column.cast(pa.large_binary()).to_pylist()
    return [b"" if v is None else v for v in values]


def record_batch(columns: dict[str, tuple[Iterable, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in columns.values()],
        names=list(columns))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


class WordCache(dict):
    """Memo of a function of a word, emptied when it has ``limit`` entries.

    Look-ups run through ``map(cache.__getitem__, words)``, so a known word costs
    one dictionary access. Words longer than ``longest`` are never kept.
    """

    def __init__(self, make: Callable, limit: int = 300_000,
                 longest: int = 64) -> None:
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value


_MEMO: list = [None, None]


def worker_memo(key: object, make: Callable):
    """What a Python worker remembers from task to task: one operator's memo at a time.

    Workers serve many operators. A memo is let go as soon as the worker turns to another
    ``key``, so that their sizes don't add up.
    """
    if _MEMO[0] != key:
        _MEMO[:] = [key, None]
        _MEMO[1] = make()
    return _MEMO[1]


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
