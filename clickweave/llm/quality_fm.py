"""Quality classifier: a factorisation machine.

Features are hashed words, statistics of the text's structure, and metadata (its
stated length). Besides a weight, every feature has a short vector; the product of
two vectors is the weight of that pair. All pairs are summed in linear time, since
sum_{i<j} <v_i,v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

The model is fitted on at most ``train_rows`` labelled documents (those with the
smallest hash of their id, so a larger table gives another sample of the same
kind); every document is scored by its whole text. The model's size depends on its
parameters alone.

Defined results: null and empty texts are scored by structure and metadata; a null
id is held out; a null stated length is 0; labels that are null are left out, of
several labels of one document the smallest counts; repeated rows are scored each
on its own; without any label every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

import operator
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from clickweave.llm.common import WordCache, column, map_batches, record_batch, utf8

FOLDS = 5
STATS = 20


@dataclass(frozen=True)
class Settings:
    train_rows: int = 12_000  # the bound of the sample the model is fitted on
    buckets: int = 1 << 15
    factors: int = 8
    steps: int = 560  # of mini-batches; as many from a small sample as from a full one
    batch: int = 128
    rate: float = 0.05
    decay: float = 1e-5
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """``weights`` and ``vectors`` of the word buckets, then of the statistics."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def margins(self, index: np.ndarray, value: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The machine's sums for documents whose features begin at ``start``."""
        return margins(self.bias, self.weights, self.vectors, index, value, start)[0]


def margins(bias, weights, vectors, index, value, start):
    scaled = vectors[index] * value[:, None]
    total = np.add.reduceat(scaled, start)
    squares = np.add.reduceat(scaled * scaled, start)
    linear = np.add.reduceat(weights[index] * value, start)
    return bias + linear + 0.5 * (total * total - squares).sum(1), scaled, total


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


# --- features --------------------------------------------------------------------------------

_CLASSES = (string.ascii_uppercase, string.digits, ".,;:?", "!", "|", "#*$%&<>@",
            "\"'()[]{}-_/\\", "\n")


@lru_cache(maxsize=4)
def _buckets(buckets: int) -> WordCache:
    return WordCache(lambda w: zlib.crc32(w) % buckets)


@lru_cache(maxsize=1)
def _packer() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=1)


def features(text: bytes, stated: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct word buckets, statistics)."""
    words = text.lower().split()
    hashed = np.fromiter(map(_buckets(buckets).__getitem__, words), np.int32, len(words))
    found, times = np.unique(hashed, return_counts=True)
    size, n = max(1, len(text)), max(1, len(words))
    lines = text.split(b"\n")
    shares = [(len(text) - len(text.translate(None, c.encode()))) / size for c in _CLASSES]
    same = sum(map(operator.eq, words, words[1:]))
    stats = np.array([
        np.log1p(len(text)), np.log1p(len(words)), np.log1p(stated),
        stated / size, *shares,
        (len(text) - len(text.decode("utf-8", "replace"))) / size,
        sum(map(len, words)) / n, len(set(words)) / n, same / n,
        (times.max() / n if len(times) else 0.0), 1 - len(set(lines)) / len(lines),
        np.log1p(size / len(lines)), len(_packer().compress(text)) / (size + 64),
    ])
    return found.astype(np.int32), stats


def rows_of(found: np.ndarray, stats: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of one document; ``stats`` are standardised."""
    index = np.concatenate([found, np.arange(buckets, buckets + len(stats), dtype=np.int32)])
    value = np.concatenate([np.full(len(found), 1 / np.sqrt(max(1, len(found)))), stats / 4])
    return index, value


def standard(stats: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.clip((stats - mean) / spread, -4, 4)


# --- fitting ---------------------------------------------------------------------------------

def _batches(n: int, s: Settings, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """``steps`` mini-batches; every row comes once before any comes again."""
    left = s.steps
    while left:
        order = rng.permutation(n)
        for at in range(0, n, s.batch):
            if left:
                left -= 1
                yield order[at:at + s.batch]


def fit(found: list[np.ndarray], stats: np.ndarray, labels: np.ndarray, s: Settings) -> Model:
    """Logistic loss, adaptive steps, mini-batches in a fixed random order."""
    rng = np.random.default_rng(s.seed)
    width = s.buckets + STATS
    weights, vectors = np.zeros(width), rng.normal(0, 0.05, (width, s.factors))
    mean, spread, bias = np.zeros(STATS), np.ones(STATS), 0.0
    if not len(labels):
        return Model(bias, weights, 0 * vectors, mean, spread)
    mean, spread = stats.mean(0), stats.std(0) + 1e-6
    docs = [rows_of(f, x, s.buckets) for f, x in zip(found, standard(stats, mean, spread))]
    seen_w, seen_v, seen_b = np.full(width, 1e-6), np.full(vectors.shape, 1e-6), 1e-6
    for part in _batches(len(docs), s, rng):
        sizes = np.array([len(docs[i][0]) for i in part])
        index = np.concatenate([docs[i][0] for i in part])
        value = np.concatenate([docs[i][1] for i in part])
        start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        margin, scaled, total = margins(bias, weights, vectors, index, value, start)
        error = (sigmoid(margin) - labels[part]) / len(part)
        each = np.repeat(error, sizes) * value
        to_v = each[:, None] * (np.repeat(total, sizes, axis=0) - scaled)
        touched, where = np.unique(index, return_inverse=True)
        step_w = np.bincount(where, each, len(touched)) + s.decay * weights[touched]
        step_v = np.column_stack([np.bincount(where, to_v[:, f], len(touched))
                                  for f in range(s.factors)]) + s.decay * vectors[touched]
        seen_w[touched] += step_w ** 2
        seen_v[touched] += step_v ** 2
        seen_b += error.sum() ** 2
        weights[touched] -= s.rate * step_w / np.sqrt(seen_w[touched])
        vectors[touched] -= s.rate * step_v / np.sqrt(seen_v[touched])
        bias -= s.rate * error.sum() / np.sqrt(seen_b)
    return Model(bias, weights, vectors, mean, spread)


def fold(id_: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS; 0 is held out."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % FOLDS


def _inputs(docs: DataFrame, id_col: str, text_col: str, length_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                       F.coalesce(F.col(f"`{length_col}`").cast("long"), F.lit(0)).alias("stated"))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(),
          id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars",
          label_col: str = "quality") -> Model:
    """Fits the model on labelled documents of the folds that are not held out."""
    id_ = F.col(f"`{id_col}`")
    known = (labels.where(id_.isNotNull() & F.col(f"`{label_col}`").isNotNull() & (fold(id_) != 0))
             .groupBy(id_.alias("id")).agg(F.min(f"`{label_col}`").cast("int").alias("label")))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(settings.train_rows)
    chosen = (_inputs(docs, id_col, text_col, length_col)
              .join(F.broadcast(sample), "id"))  # at most train_rows small rows
    kind = dict(docs.dtypes)[id_col]
    buckets = settings.buckets

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        stated = column(batch, "stated").to_pylist()
        made = [features(t, n, buckets) for t, n in zip(utf8(batch), stated)]
        return record_batch({
            "id": (column(batch, "id"), None), "label": (column(batch, "label"), None),
            "found": ([f.tobytes() for f, _ in made], pa.binary()),
            "stats": ([x.tobytes() for _, x in made], pa.binary())})

    got = (map_batches(chosen, make, f"id {kind}, label int, found binary, stats binary")
           .orderBy(F.xxhash64("id"), "found").limit(settings.train_rows)
           .select("label", "found", "stats").toArrow())
    found = [np.frombuffer(b, np.int32) for b in got.column("found").to_pylist()]
    stats = np.array([np.frombuffer(b, np.float64) for b in got.column("stats").to_pylist()])
    target = np.array(got.column("label").to_pylist(), float)
    return fit(found, stats.reshape(-1, STATS), target, settings)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          length_col: str = "n_chars") -> DataFrame:
    """(id_col, score): 0 to 1, higher means label 1 is likelier."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)[id_col]

    def make(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if not batch.num_rows:
            return None
        own = shared.value
        buckets = len(own.weights) - STATS
        rows = [features(t, n, buckets)
                for t, n in zip(utf8(batch), column(batch, "stated").to_pylist())]
        rows = [rows_of(f, standard(x, own.mean, own.spread), buckets) for f, x in rows]
        start = np.cumsum([0, *[len(i) for i, _ in rows[:-1]]])
        margin = own.margins(np.concatenate([i for i, _ in rows]),
                             np.concatenate([v for _, v in rows]), start)
        ids = column(batch, "id")
        return record_batch({id_col: (ids, ids.type), "score": (sigmoid(margin), pa.float64())})

    return map_batches(_inputs(docs, id_col, text_col, length_col), make,
                       f"`{id_col}` {kind}, score double")
