"""Substring de-duplication by content-defined chunks.

A gear hash rolls over the bytes; where its value is the largest within ``radius``
words on both sides, a chunk ends. That depends on nothing but the words around,
so an insertion shifts the cuts only next to it, and two documents that share a
passage cut it alike but for its edges. Chunks are then the same where their
digests are. Of equal chunks the first stays (smallest id, then place); the others
are repeated, and runs of neighbouring repeated chunks of at least ``min_bytes``
are taken out. Shorter ones are common phrases.

Digests are counted where they lie before they travel; a chunk that very many
documents have is joined back without bringing its documents together.

Defined results: null and empty texts have no chunks and stay as they are; ids may
be null or repeat, rows that repeat id and text are one document and keep the same
parts; a text without white space is cut between characters; an empty table gives
no spans; other columns are ignored by :func:`repeated_spans` and kept by
:func:`drop_repeated`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from clickweave.llm.common import column, map_batches, record_batch, sliced, unused, utf8, worker_memo
from clickweave.llm.words import U64, mix, odd_numbers
from clickweave.operators.skew import skew_join
from clickweave.session import materialize, ship_package

WINDOW = 16  # bytes that the rolling hash sees, a power of two
LONG_WORD = 64  # bytes of a word beyond which it may be cut inside
GEAR = mix(odd_numbers(256, 11))
WHITE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


@dataclass(frozen=True)
class Rule:
    radius: int = 4
    longest: int = 24  # words after which a chunk ends anyway
    min_words: int = 20


def rolling(data: np.ndarray) -> np.ndarray:
    """The gear hash at each byte: sum of GEAR[byte] << age over the last WINDOW bytes."""
    sums, reach = GEAR[data], 1
    while reach < WINDOW:
        older = sums[:-reach] << U64(reach)
        sums = sums.copy()
        sums[reach:] += older
        reach *= 2
    return sums


def cut_points(text: bytes, radius: int, longest: int) -> np.ndarray:
    """Ends of the chunks; the last one is the length of the text."""
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    white = WHITE[data]
    place = np.arange(n)
    since = place - np.maximum.accumulate(np.where(white, place, -1))
    starts_word = np.empty(n, bool)
    starts_word[0], starts_word[1:] = False, white[:-1] & ~white[1:]
    inside = ~white & (since > LONG_WORD) & ((data & 0xC0) != 0x80)
    allowed = np.nonzero(starts_word | inside)[0]
    if not len(allowed):
        return np.array([n])
    value = mix(rolling(data)[allowed - 1])
    edge = np.zeros(radius, U64)
    padded = np.concatenate([edge, value, edge])
    around = np.lib.stride_tricks.sliding_window_view(padded, radius)
    before, after = around[:len(value)].max(1), around[radius + 1:].max(1)
    cuts = np.concatenate([[-1], np.nonzero((value > before) & (value >= after))[0]])
    # Long stretches without a largest value, as of one word over and over.
    extra = (np.diff(np.append(cuts, len(allowed))) - 1) // longest
    more = np.repeat(cuts, extra) + longest * (
        1 + np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra))
    return np.append(allowed[np.sort(np.concatenate([cuts[1:], more]))], n)


def chunks(text: bytes, radius: int = 4, longest: int = 24) -> tuple[np.ndarray, ...]:
    """(digests, starts, ends, words) of a text's chunks.

    Cuts and digests are those of the text with single spaces for white space, so
    that a passage may be wrapped into other lines; starts and ends are places in
    the text as it is.
    """
    plain = b" ".join(text.split())
    if not plain:
        return np.empty(0, np.int64), *[np.empty(0, np.int32)] * 3
    ends = cut_points(plain, radius, longest)
    starts = np.concatenate([[0], ends[:-1]])
    parts = [plain[a:b].rstrip() for a, b in zip(starts.tolist(), ends.tolist())]
    digests = [xxhash.xxh3_64_intdigest(p) for p in parts]
    words = np.array([p.count(b" ") + 1 for p in parts], np.int32)
    # Every start is the place of a byte that isn't white; these keep their order.
    spaces = np.cumsum(np.frombuffer(plain, np.uint8) == 32)
    solid = np.nonzero(~WHITE[np.frombuffer(text, np.uint8)])[0]
    starts = solid[starts - spaces[starts]]
    ends = np.append(starts[1:], len(text))
    return (np.array(digests, U64).view(np.int64), starts.astype(np.int32),
            ends.astype(np.int32), words)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _text_key(id_: Column, text: Column) -> Column:
    return F.xxhash64(id_, text)


def chunk_table(docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    """(id, key, digest, start, end, words) of every chunk, from a table that is written once."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"),
                       _text_key(F.col(f"`{id_col}`"), text).alias("key"))
    kind = dict(docs.dtypes)[id_col]

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        worker_memo("chunks", lambda: None)  # cutting needs no memo
        made = [chunks(t, rule.radius, rule.longest) for t in utf8(batch)]
        digests, starts, ends, words = zip(*made)
        return record_batch({"id": (column(batch, "id"), None), "key": (column(batch, "key"), None),
                             "digest": (_lists(digests, pa.int64()), None),
                             "start": (_lists(starts, pa.int32()), None),
                             "end": (_lists(ends, pa.int32()), None),
                             "words": (_lists(words, pa.int32()), None)})

    stored = materialize(map_batches(rows, make, f"id {kind}, key long, digest array<long>, "
                                     "start array<int>, end array<int>, words array<int>"), "chunks")
    return stored.select("id", "key", F.inline(F.arrays_zip("digest", "start", "end", "words")))


def runs(parts: list[dict], min_words: int) -> list[tuple]:
    """(start, end, words, id that keeps most of it) of neighbouring repeated chunks."""
    found, parts = [], sorted(parts, key=lambda p: p["start"])
    for i, p in enumerate(parts):
        if i and parts[i - 1]["end"] == p["start"]:
            found[-1].append(p)
        else:
            found.append([p])
    out = []
    for run in found:
        start, end = run[0]["start"], run[-1]["end"]
        words = sum(p["words"] for p in run)
        if words >= min_words:
            kept: dict = {}
            for p in run:
                kept[p["first_id"]] = kept.get(p["first_id"], 0) + p["words"]
            out.append((start, end, words, max(kept, key=lambda k: kept[k])))
    return out


def repeated_spans(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(id, key, start, end, n_words, first_id): bytes of a text that an earlier place has already."""
    all_chunks = chunk_table(docs, rule, id_col, text_col)
    # Rows that repeat id and text have the same place and are counted once.
    place = F.struct("id", "key", "start")
    counted = (all_chunks.groupBy("digest")
               .agg(F.min(place).alias("first"), F.max(place).alias("last"),
                    F.count(F.lit(1)).alias("n"))
               .where("NOT (first <=> last)"))
    copied = materialize(counted.select("digest", F.col("first.id").alias("first_id"),
                                        F.col("first.key").alias("first_key"),
                                        F.col("first.start").alias("first_start"), "n"), "digests")
    # Joined the same way at every size: how many digests repeat grows with the data.
    met = skew_join(all_chunks, copied.drop("n"), ["digest"], sizes=copied.select("digest", "n"),
                    small_rows=0)
    later = met.where(~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("key") == F.col("first_key"))
                        & (F.col("start") == F.col("first_start"))))
    by_text = later.groupBy("id", "key").agg(
        F.collect_set(F.struct("start", "end", "words", "first_id")).alias("parts"))
    ship_package(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = [(at, *span) for at, parts in enumerate(column(batch, "parts").to_pylist())
                    for span in runs(parts, rule.min_words)]
            if rows:
                at, start, end, words, first = zip(*rows)
                ids, keys = column(batch, "id"), column(batch, "key")
                take = pa.array(at)
                yield record_batch({"id": (ids.take(take), None), "key": (keys.take(take), None),
                                    "start": (list(start), pa.int32()),
                                    "end": (list(end), pa.int32()),
                                    "n_words": (list(words), pa.int32()),
                                    "first_id": (list(first), ids.type)})

    return by_text.mapInArrow(run, f"id {kind}, key long, start int, end int, n_words int, "
                              f"first_id {kind}")


def cut_out(text: bytes, spans: list[dict]) -> bytes:
    out, at = [], 0
    for span in sorted(spans, key=lambda s: s["start"]):
        out.append(text[at:span["start"]])
        at = span["end"]
    return b"".join([*out, text[at:]])


def drop_repeated(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with all columns, their texts without the repeated spans."""
    names = docs.columns
    key, id_text, parts = (unused(docs, n) for n in ("_key", "_id", "_spans"))
    spans = (repeated_spans(docs, rule, id_col, text_col)
             .groupBy(F.col("key").alias(key),
                      F.coalesce(F.col("id").cast("string"), F.lit("")).alias(id_text))
             .agg(F.collect_list(F.struct("start", "end")).alias(parts)))
    keyed = docs.withColumns({
        key: _text_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")),
        id_text: F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))})
    joined = skew_join(keyed, materialize(spans, "spans"), [key, id_text], "left")
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            spans_of, own = column(batch, parts).to_pylist(), batch.select(names)
            old = own.column(at)
            new = [t.as_py() if not s else cut_out(t.as_py().encode(), s).decode()
                   for t, s in zip(old, spans_of)]
            yield own.set_column(at, text_col, pa.array(new, old.type))

    return joined.mapInArrow(run, docs.schema)
