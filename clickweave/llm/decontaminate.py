"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over a few neighbouring words: the words under its holes
are ignored, so one substituted word doesn't hide a passage from every seed. The
words under a mask are hashed at every place of the test items and of the training
texts and joined on the hash. Around each hit, text and item are laid on each other
and compared word by word; a passage counts when, in some window of ``window``
words (or the whole item, if shorter), at least ``share`` of the words agree. The
three masks hit every window of 8 to 13 words in which that share agrees. Items of
fewer than 8 words are found where all their words stand one after the other, by
one hash of the whole item.

The items are taken in blocks of at most ``block_words`` words. A block's hashes go
to every task, and each block meets every row of the training table, so neither
its size nor the table's is limited and nothing is shuffled.

Words are split at white space, lower-cased, without punctuation at their ends.
Defined results: null and empty texts and items have no words and match nothing;
items of fewer than 8 words are reported by :func:`contamination`, but can't be told
from chance, so :func:`drop_contaminated` drops for items of ``drop_words`` (8) words
and more; ids may be null or repeat; an empty benchmark matches nothing; other
columns are ignored by :func:`contamination` and kept by :func:`drop_contaminated`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from clickweave.llm.common import WordCache, column, record_batch, sliced, texts, utf8, worker_memo
from clickweave.llm.words import U64, hashes, window_hashes
from clickweave.session import ship_package

MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 6, 7), (0, 1, 2, 3, 4))
MIN_WORDS = 8
EDGE = b".,;:!?\"'()[]{}|*#$%&<>"
TABLE_BITS = 22
STEP = 1 << 18  # pairs, and compared words, that are worked on at a time


@dataclass(frozen=True)
class Rule:
    window: int = 13
    share: float = 0.8
    block_words: int = 500_000
    drop_words: int = MIN_WORDS  # of an item, from which a text that holds it is dropped


def bare_hash(word: bytes) -> int:
    """0 for a word of nothing but punctuation, which is left out."""
    bare = word.decode("utf-8", "replace").lower().encode().strip(EDGE)
    return xxhash.xxh3_64_intdigest(bare) | 1 if bare else 0


def word_hashes(text: bytes, cache: WordCache) -> np.ndarray:
    found = hashes(text.split(), cache)
    return found[found != 0]


class Index:
    """Seeds of a block of test items of at least ``min_words`` words, hashes of short ones."""

    def __init__(self, ids: list, items: list[bytes], min_words: int = 1) -> None:
        cache = WordCache(bare_hash)
        self.ids, kept, keys, owners, places = [], [], [], [], []
        short: dict[int, dict[int, list]] = {}  # length, hash of all words, (id, words)
        for id_, text in zip(ids, items):
            words = word_hashes(text, cache)
            if len(words) < max(1, min_words):
                continue
            if len(words) < MIN_WORDS:
                whole = int(self.wholes(words, len(words))[0])
                short.setdefault(len(words), {}).setdefault(whole, []).append((id_, words))
                continue
            for seed, mask in enumerate(MASKS):
                found = window_hashes(words, mask, seed)
                keys.append(found)
                owners.append(np.full(len(found), len(kept), np.int64))
                places.append(np.arange(len(found)))
            self.ids.append(id_)
            kept.append(words)
        self.words = np.concatenate(kept) if kept else np.empty(0, U64)
        self.sizes = np.array([len(w) for w in kept], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.keys = np.concatenate(keys) if keys else np.empty(0, U64)
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.owners = np.concatenate(owners)[order] if keys else np.empty(0, np.int64)
        self.places = np.concatenate(places)[order] if keys else np.empty(0, np.int64)
        self.known = np.zeros(1 << TABLE_BITS, bool)
        self.known[self.keys >> U64(64 - TABLE_BITS)] = True
        self.short = {n: (np.array(sorted(by), U64), by) for n, by in short.items()}

    @staticmethod
    def wholes(words: np.ndarray, n: int) -> np.ndarray:
        """One hash for each run of ``n`` words."""
        return window_hashes(words, tuple(range(n)), len(MASKS) + n)

    def short_matches(self, words: np.ndarray) -> list[tuple]:
        """(item id, first word, words, equal words) of the first place of each short item."""
        found = []
        for n, (keys, items) in self.short.items():
            own = self.wholes(words, n)
            if not len(own):
                continue
            near = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            at = np.nonzero(keys[near] == own)[0]
            hits, first = np.unique(own[at], return_index=True)
            for hit, place in zip(hits.tolist(), at[first].tolist()):
                found += [(id_, place, n, n) for id_, item in items[hit]
                          if np.array_equal(words[place:place + n], item)]
        return found

    def diagonals(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(items, places of their first words in the text) that some seed proposes.

        In arrays of about STEP, however many items share a hash and however often it
        stands in the text; a pair may come again in a later array.
        """
        longest = int(self.sizes.max(initial=0))
        span, waiting, size = len(words) + longest + 1, [], 0
        for seed, mask in enumerate(MASKS):
            own = window_hashes(words, mask, seed)
            at = np.nonzero(self.known[own >> U64(64 - TABLE_BITS)])[0]
            low = np.searchsorted(self.keys, own[at], "left")
            n = np.searchsorted(self.keys, own[at], "right") - low
            at, low, n = at[n > 0], low[n > 0], n[n > 0]
            if not len(at):
                continue
            steps = (np.cumsum(n) - 1) // STEP
            for part in np.split(np.arange(len(at)), np.nonzero(np.diff(steps))[0] + 1):
                count = n[part]
                hit = np.repeat(low[part] - (np.cumsum(count) - count), count) + np.arange(count.sum())
                start = np.repeat(at[part], count) - self.places[hit] + longest
                waiting.append(np.unique(self.owners[hit] * span + start))
                size += len(waiting[-1])
                if size >= STEP:
                    pairs = np.unique(np.concatenate(waiting))
                    yield pairs // span, pairs % span - longest
                    waiting, size = [], 0
        if waiting:
            pairs = np.unique(np.concatenate(waiting))
            yield pairs // span, pairs % span - longest

    def aligned(self, words: np.ndarray, items: np.ndarray, starts: np.ndarray, length: int,
                rule: Rule) -> tuple[np.ndarray, ...]:
        """(items, first word, words, equal words) of the items of one length, laid on the text
        at ``starts``, that hold a window in which enough words agree."""
        at = starts[:, None] + np.arange(length)
        inside = (at >= 0) & (at < len(words))
        other = self.words[self.offsets[items][:, None] + np.arange(length)]
        same = inside & (words[np.clip(at, 0, len(words) - 1)] == other)
        sums = np.zeros((len(items), length + 1), np.int32)
        np.cumsum(same, axis=1, out=sums[:, 1:])
        size = min(rule.window, length)
        good = sums[:, size:] - sums[:, :-size] >= rule.share * size
        good &= inside[:, :length - size + 1] & inside[:, size - 1:]  # the whole window
        rows = np.nonzero(good.any(axis=1))[0]
        first = good[rows].argmax(axis=1)
        last = good.shape[1] - 1 - good[rows, ::-1].argmax(axis=1) + size
        return items[rows], starts[rows] + first, last - first, sums[rows, last] - sums[rows, first]

    def matches(self, words: np.ndarray, rule: Rule) -> list[tuple]:
        """(item id, first word, words, equal words) of the best window of each item found."""
        best: dict[int, tuple] = {}
        for items, starts in self.diagonals(words):
            lengths = self.sizes[items]
            for length in np.unique(lengths).tolist():
                here = np.nonzero(lengths == length)[0]
                rows = max(1, STEP // length)
                for at in range(0, len(here), rows):
                    part = here[at:at + rows]
                    found = self.aligned(words, items[part], starts[part], length, rule)
                    for item, place, n, equal in zip(*(a.tolist() for a in found)):
                        if item not in best or (equal, -place) > (best[item][3], -best[item][1]):
                            best[item] = (self.ids[item], place, n, equal)
        return list(best.values()) + self.short_matches(words)


def blocks(items: DataFrame, rule: Rule) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts) of the items, at most about ``block_words`` words at a time."""
    sized = items.withColumn("n", F.coalesce(F.size(F.split("text", r"\s+")), F.lit(0)))
    n = max(1, -(-(sized.agg(F.sum("n")).first()[0] or 0) // rule.block_words))
    for block in range(n):
        mine = F.pmod(F.xxhash64("id", "text"), F.lit(n)) == block
        got = items.where(mine).orderBy("id", "text").toArrow()
        yield (got.column("id").to_pylist(),
               [b"" if t is None else t.encode() for t in got.column("text").to_pylist()])


def contamination(docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule(),
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """(id_col, item_col, first_word, n_words, n_equal): an overlap of a text with a test item."""
    spark = docs.sparkSession
    ship_package(spark)
    id_kind, item_kind = dict(docs.dtypes)[id_col], dict(benchmark.dtypes)[item_col]
    item_type = pa.int64() if item_kind == "bigint" else None
    schema = (f"`{id_col}` {id_kind}, `{item_col}` {item_kind}, first_word long, n_words long, "
              "n_equal long")
    found = None
    for ids, items in blocks(texts(benchmark, item_col, item_text_col), rule):
        shared = spark.sparkContext.broadcast(Index(ids, items))

        def run(batches, shared=shared):
            index, cache = shared.value, worker_memo("bare words", lambda: WordCache(bare_hash, 150_000))
            for batch in sliced(batches):
                rows = [(place, *hit) for place, text in enumerate(utf8(batch))
                        for hit in index.matches(word_hashes(text, cache), rule)]
                if rows:
                    at, item, first, n, equal = zip(*rows)
                    ids = column(batch, "id").take(pa.array(at))
                    yield record_batch({id_col: (ids, None), item_col: (list(item), item_type),
                                        "first_word": (list(first), pa.int64()),
                                        "n_words": (list(n), pa.int64()),
                                        "n_equal": (list(equal), pa.int64())})

        part = texts(docs, id_col, text_col).mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule(),
                      text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that no item of ``drop_words`` words overlaps; no shuffle."""
    spark = docs.sparkSession
    ship_package(spark)
    kept = docs
    for ids, items in blocks(texts(benchmark, item_col, item_text_col), rule):
        shared = spark.sparkContext.broadcast(Index(ids, items, rule.drop_words))

        def run(batches, shared=shared):
            index, cache = shared.value, worker_memo("bare words", lambda: WordCache(bare_hash, 150_000))
            for batch in sliced(batches):
                clean = [not index.matches(word_hashes(t, cache), rule)
                         for t in utf8(batch, text_col)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
