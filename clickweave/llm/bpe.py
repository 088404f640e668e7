"""BPE encoding and decoding with forced boundaries.

A merge can only build tokens of the vocabulary. So two neighbouring bytes that
stand side by side in no token are never merged, whatever surrounds them: the
text may be cut between them, the fragments encoded on their own and the ids put
one behind the other. White space is in no token, which cuts a text into words
before anything else; inside a word, every pair of bytes that no token holds is
another cut. Fragments repeat, so their ids are remembered in a bounded memo.

Normalisation and the split into pre-tokens follow the tokenizer's own file; the
special strings of that file are matched in the raw text and never merged.

Defined results: null and empty texts have no ids and decode to an empty string;
a null id is carried; repeated rows are encoded each on its own; other columns
are ignored. A very long word without any cut costs n log n.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from clickweave.llm.common import (WordCache, column, map_batches, record_batch, texts, utf8,
                                   worker_memo)

#: Symbols up to which looking at all pairs after each merge beats a heap.
SHORT = 64
#: Words whose ids a task remembers, about 200 bytes each.
WORDS_KEPT = 600_000
PRINTABLE = re.compile(rb"[!-~]+").fullmatch


class Codec:
    """Encoder and decoder of one tokenizer file of kind BPE with byte-level symbols."""

    def __init__(self, definition: str, words_kept: int = WORDS_KEPT) -> None:
        model = json.loads(definition)["model"]
        added = json.loads(definition)["added_tokens"]
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("special tokens must be matched as they are in the raw text")
        library = Tokenizer.from_str(definition)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in added}
        self.tokens = {i: t for t, i in (self.vocab | self.special).items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[self.vocab[a], self.vocab[b]] = rank, self.vocab[a + b]
        bodies = (t.removesuffix(self.suffix) if self.suffix else t for t in self.vocab)
        self.inside = {t[i:i + 2] for t in bodies for i in range(len(t) - 1)}
        self._split_special = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.has_special = re.compile("|".join(map(re.escape, self.special)).encode()).search
        self.split_plain = self._plain_splitter(json.loads(definition))
        self.no_merge = (len(self.merges), -1)
        self.words = WordCache(self._word, words_kept)
        self.pre_tokens = WordCache(self._pre_token, words_kept // 2)

    @staticmethod
    def _plain_splitter(definition: dict):
        """The file's own pattern, for words of printable ASCII.

        Such a word is its own canonical form and its own byte-level spelling, so
        it takes lower-casing and the pattern alone; None when the file does more.
        """
        normal, split = definition["normalizer"], definition["pre_tokenizer"]
        steps = [s["type"] for s in (normal or {}).get("normalizers", [])]
        parts = (split or {}).get("pretokenizers", [])
        if (steps == ["NFC", "Replace", "Lowercase"]
                and normal["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
                and [p["type"] for p in parts] == ["Split", "ByteLevel"]
                and parts[0]["behavior"] == "Removed" and parts[0]["invert"]
                and not parts[1]["add_prefix_space"] and not parts[1]["use_regex"]):
            return regex.compile(parts[0]["pattern"]["Regex"]).findall
        return None

    def encode(self, text: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.words.__getitem__, text.split()))

    def decode(self, ids: bytes) -> str:
        """The file has no decoder: tokens are put side by side, a space between them."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def _word(self, word: bytes) -> bytes:
        if self.split_plain and PRINTABLE(word) and not self.has_special(word):
            found = self.split_plain(word.decode().lower())
            return b"".join(map(self.pre_tokens.__getitem__, found))
        out = []
        for part in self._split_special.split(word.decode("utf-8", "replace")):
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                normal = self.normalizer.normalize_str(part) if self.normalizer else part
                out += [self.pre_tokens[t] for t, _ in self.pre_tokenizer.pre_tokenize_str(normal)]
        return b"".join(out)

    def _pre_token(self, token: str) -> bytes:
        out, start = [], 0
        for i in range(1, len(token)):
            if token[i - 1:i + 1] not in self.inside:
                out += self._fragment([*token[start:i]])
                start = i
        if token:
            out += self._fragment([*token[start:-1], token[-1] + self.suffix])
        return np.array(out, "<u4").tobytes()

    def _fragment(self, symbols: list[str]) -> list[int]:
        """Merge by rank, the leftmost of equal ranks first."""
        ids = [self.vocab[s] for s in symbols if s in self.vocab]
        if len(ids) > SHORT:
            return self._long_fragment(ids)
        rank_of, none = self.merges.get, self.no_merge
        while len(ids) > 1:
            found = [rank_of(pair, none) for pair in zip(ids, ids[1:])]
            best = min(found)
            if best is none:
                break
            i = found.index(best)
            ids[i:i + 2] = [best[1]]
        return ids

    def _long_fragment(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs over a linked list."""
        n = len(ids)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(self.merges[p][0], i, self.merges[p][1])
                for i, p in enumerate(zip(ids, ids[1:])) if p in self.merges]
        heapq.heapify(heap)
        while heap:
            rank, i, made = heapq.heappop(heap)
            j = right[i] if ids[i] >= 0 else n
            if j >= n or self.merges.get((ids[i], ids[j])) != (rank, made):
                continue
            ids[i], ids[j], right[i] = made, -1, right[j]
            if right[i] < n:
                left[right[i]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b < n and (found := self.merges.get((ids[a], ids[b]))):
                    heapq.heappush(heap, (found[0], a, found[1]))
        return [x for x in ids if x >= 0]


def codec(definition: str, words_kept: int = WORDS_KEPT) -> Codec:
    return worker_memo(("bpe", words_kept, definition), lambda: Codec(definition, words_kept))


def shared_definition(spark: SparkSession, path: str):
    """The tokenizer's file for all tasks; a vocabulary's size doesn't depend on the data."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def bpe_encode(docs: DataFrame, path: str, decode: bool = False, id_col: str = "doc_id",
               text_col: str = "text", words_kept: int = WORDS_KEPT) -> DataFrame:
    """(id_col, n_tokens, ids binary[, decoded string]) of whole texts.

    A task remembers the ids of ``words_kept`` words; fewer cost time, not results.

    ``ids`` holds unsigned 32-bit integers, little-endian. ``decode`` adds the
    text that these ids stand for.
    """
    definition = shared_definition(docs.sparkSession, path)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, ids = codec(definition.value, words_kept), column(batch, "id")
        encoded = [own.encode(t) for t in utf8(batch)]
        out = {id_col: (ids, ids.type), "n_tokens": ([len(e) // 4 for e in encoded], pa.int64()),
               "ids": (encoded, pa.binary())}
        if decode:
            out["decoded"] = ([own.decode(e) for e in encoded], pa.string())
        return record_batch(out)

    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, n_tokens long, ids binary"
    return map_batches(texts(docs, id_col, text_col), make, schema + ", decoded string" * decode)


def bpe_decode(encoded: DataFrame, path: str, id_col: str = "doc_id",
               ids_col: str = "ids") -> DataFrame:
    """(id_col, decoded) of packed ids; null ids decode to an empty string."""
    definition = shared_definition(encoded.sparkSession, path)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, ids = codec(definition.value), column(batch, "id")
        return record_batch({id_col: (ids, ids.type),
                             "decoded": ([own.decode(e) for e in utf8(batch)], pa.string())})

    return map_batches(texts(encoded, id_col, ids_col), make,
                       f"`{id_col}` {dict(encoded.dtypes)[id_col]}, decoded string")
