"""Language identification by unigrams whose segmentation is summed out.

Pieces are the tokens of a fixed public byte-level vocabulary. Every language has
its own probability per piece; the probability of a word (a space and a run of
letters, lower-cased) is the sum over all ways to cut it into pieces, which a forward
algorithm adds up in one pass from left to right. A text's score is the sum of its
words' logarithms and of the language's share of the documents.

Probabilities are learned by expectation maximisation: a backward pass beside the
forward one gives the expected number of each piece over all segmentations. Counts
cover every labelled document outside the held-out fold: words are counted once by
language where they lie, and the rounds run over that table. Only the sums per language
and piece reach the driver, at most languages x vocabulary numbers.

Defined results: null texts and texts without letters are ``und`` with score 0; so is
every text when nothing was learned. A null id is held out with crc32 of an empty
text deciding; null languages teach nothing; ties go to the language first in order;
repeated rows are judged each on its own; a very long word is summed whole; other
columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from clickweave.llm.common import column, dealt, map_batches, record_batch, texts
from clickweave.session import materialize, ship_package

FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
RUNS = regex.compile(r"\p{L}[\p{L}\p{M}]*").findall
#: The same for lower-cased texts without code points above U+00FF.
LATIN_RUNS = re.compile("[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff]+").findall
#: Word counts a task gathers before it hands them on.
COUNTED = 200_000
#: Words whose segmentations a task of a learning round adds up.
WORDS_A_TASK = 50_000
#: Values of words' scores a task remembers, and the longest word among them.
KEPT_VALUES, KEPT_BYTES = 2_000_000, 64
#: Entries of the tables of words that are summed together.
TABLE = 200_000
#: Pieces of up to 24 bytes times the least probability stay far from underflow.
LONGEST, LEAST = 24, 1e-9
BASE, SPREAD, SIEVE_BITS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), 16


@dataclass(frozen=True)
class Settings:
    rounds: int = 2
    #: Weight of the languages' common distribution in each of them, in pieces.
    prior: float = 200.0
    #: Share of the uniform distribution in the common one.
    uniform: float = 1e-3


def read_pieces(path: str) -> list[bytes]:
    """The vocabulary's byte strings by rank, one ``base64 rank`` a line, as far as they
    can stand in a word, and all single bytes."""
    with open(path, "rb") as file:
        ranked = [line.split() for line in file if line.strip()]
    every = [base64.b64decode(p) for p, _ in sorted(ranked, key=lambda r: int(r[1]))]
    inside = re.compile(rb" ?[a-z\x80-\xff]*").fullmatch
    single = [bytes([b]) for b in range(256)]
    return single + [p for p in every if 1 < len(p) <= LONGEST and inside(p)]


def letters(text: str) -> list[str]:
    """Runs of letters and the marks on them, lower-cased."""
    lower = text.lower()
    try:
        lower.encode("latin-1")
    except UnicodeEncodeError:
        return RUNS(lower)
    return LATIN_RUNS(lower)


def spelled(word: str) -> bytes:
    return b" " + word.encode("utf-8", "replace")


class Pieces:
    """Finds pieces in words, which are taken together by length.

    Byte strings are compared as 64-bit numbers, a polynomial of their bytes per length.
    """

    def __init__(self, pieces: list[bytes]) -> None:
        self.none = len(pieces)  # stands for a byte string that is no piece
        self.longest = max(map(len, pieces), default=1)
        self.known: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for n in range(1, self.longest + 1):
            which = np.array([i for i, p in enumerate(pieces) if len(p) == n], np.int32)
            letters_ = np.frombuffer(b"".join(pieces[i] for i in which), np.uint8).reshape(-1, n)
            keys = np.zeros(len(which), np.uint64)
            for i in range(n):
                keys = keys * BASE + letters_[:, i] + np.uint64(1)
            order = np.argsort(keys)
            seen = np.zeros(1 << SIEVE_BITS, bool)
            seen[self._slot(keys)] = True
            self.known.append((keys[order], which[order], seen))

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * SPREAD) >> np.uint64(64 - SIEVE_BITS)

    def table(self, words: list[bytes]) -> np.ndarray:
        """(word, end - 1, length - 1) -> the piece that ends there, for words of one length."""
        n = len(words[0])
        span = min(n, self.longest)
        raw = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), n).astype(np.uint64)
        raw += np.uint64(1)
        out = np.full((len(words), n, span), self.none, np.int32)
        keys, power = np.zeros_like(raw), 1
        for m in range(1, span + 1):
            # The key of the m bytes up to each end, from that of the last m - 1 of them.
            keys = keys[:, 1:] if m > 1 else keys
            keys = keys + raw[:, :n - m + 1] * np.uint64(power)
            power = power * int(BASE) % 2 ** 64
            sorted_keys, which, seen = self.known[m - 1]
            if len(sorted_keys):
                row, col = np.nonzero(seen[self._slot(keys)])
                asked = keys[row, col]
                at = np.minimum(np.searchsorted(sorted_keys, asked), len(sorted_keys) - 1)
                hit = sorted_keys[at] == asked
                out[row[hit], col[hit] + m - 1, m - 1] = which[at[hit]]
        return out

    def by_length(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places in ``words``, their table), so many at a time that a table stays small."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(sizes):
            places = np.nonzero(sizes == n)[0]
            step = max(1, TABLE // int(n * min(n, self.longest)))
            for at in range(0, len(places), step):
                part = places[at:at + step]
                yield part, self.table([words[i] for i in part])


def forward(table: np.ndarray, chance: np.ndarray,
            with_steps: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Logarithms of the words' probabilities, and the steps that lead to every place.

    ``chance`` has a row per piece (the last one is 0) and a column per language. Sums are
    kept relative to the place before, so that no word is too long. The steps into a
    place, (word, end - 1, length - 1, language), are probabilities: how likely the last
    piece of a segmentation up to there is this one.
    """
    words, n, span = table.shape
    width = chance.shape[1]
    logs = np.zeros((words, width))
    before = np.ones((words, 1, width))  # sums at the last places, the nearest first
    steps = np.zeros((words, n, span, width)) if with_steps else None
    for j in range(1, n + 1):
        m = before.shape[1]
        terms = before * chance[table[:, j - 1, :m]]
        total = terms.sum(axis=1, keepdims=True)
        logs += np.log(total[:, 0])
        if steps is not None:
            steps[:, j - 1, :m] = terms / total
        before = np.concatenate([np.ones((words, 1, width)), before[:, :span - 1] / total], axis=1)
    return logs, steps


def expected(steps: np.ndarray, times: np.ndarray) -> np.ndarray:
    """How often each step is taken over all segmentations, for words met ``times`` times."""
    words, n, span = steps.shape
    reached = np.zeros((words, n + 1))
    reached[:, n] = times
    taken = np.zeros_like(steps)
    for j in range(n, 0, -1):
        m = min(j, span)
        taken[:, j - 1, :m] = reached[:, j, None] * steps[:, j - 1, :m]
        reached[:, j - m:j] += taken[:, j - 1, :m][:, ::-1]
    return taken


# --- learning --------------------------------------------------------------------------------

def fold(id_: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS; HELD_OUT is held out."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % FOLDS


def language_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang") -> DataFrame:
    """(lang, word, n) over all documents to learn from; word '' counts documents."""
    ship_package(docs.sparkSession)
    id_, lang = F.col(f"`{id_col}`"), F.col(f"`{lang_col}`")
    rows = (docs.where(lang.isNotNull() & (fold(id_) != HELD_OUT))
            .select(F.col(f"`{text_col}`").alias("text"), lang.cast("string").alias("lang")))

    def handed_on(total: Counter) -> pa.RecordBatch:
        out = record_batch({"lang": ([k for k, _ in total], pa.string()),
                            "word": ([w for _, w in total], pa.string()),
                            "n": (list(total.values()), pa.int64())})
        total.clear()
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text, name in zip(column(batch, "text"), column(batch, "lang").to_pylist()):
                found = letters(text.as_py() or "")
                if found:
                    total[name, ""] += 1
                for word, n in Counter(found).items():
                    total[name, word] += n
                if len(total) >= COUNTED:
                    yield handed_on(total)
        if total:
            yield handed_on(total)

    return (rows.mapInArrow(run, "lang string, word string, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


@dataclass(frozen=True)
class Model:
    """``chance``: a row per piece, a column per language; ``share``: logarithms."""

    languages: list[str]
    pieces: list[bytes]
    chance: np.ndarray
    share: np.ndarray

    def padded(self) -> np.ndarray:
        """``chance`` with a last row for what is no piece."""
        return np.vstack([np.maximum(self.chance, LEAST), np.zeros((1, len(self.languages)))])


def _smoothed(counts: np.ndarray, s: Settings) -> np.ndarray:
    """Each language's counts, drawn towards the common distribution."""
    pooled = counts.sum(axis=1)
    total = pooled.sum()
    uniform = 1 / len(counts)
    common = uniform if not total else (1 - s.uniform) * pooled / total + s.uniform * uniform
    return ((counts + s.prior * np.broadcast_to(common, counts.T.shape).T)
            / (counts.sum(axis=0) + s.prior))


def _expectation(words: DataFrame, model: Model) -> np.ndarray:
    """Expected number of each piece in each language, over all words."""
    shared = words.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, chance = Pieces(shared.value.pieces), shared.value.padded()
        place = {name: i for i, name in enumerate(shared.value.languages)}
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.array([place[x] for x in batch.column(0).to_pylist()], np.int64)
            spellings, times = list(map(spelled, batch.column(1).to_pylist())), np.array(batch.column(2))
            for language in np.unique(at):
                mine = total.setdefault(int(language), np.zeros(len(chance)))
                here = np.nonzero(at == language)[0]
                for part, table in own.by_length([spellings[i] for i in here]):
                    _, steps = forward(table, chance[:, language:language + 1], True)
                    taken = expected(steps[..., 0], times[here[part]])
                    mine += np.bincount(table.reshape(-1), taken.reshape(-1), len(mine))
        for language, mine in total.items():
            used = np.nonzero(mine)[0]
            yield record_batch({"at": (np.full(len(used), language), pa.int32()),
                                "piece": (used, pa.int32()), "times": (mine[used], pa.float64())})

    got = (words.mapInArrow(run, "at int, piece int, times double")
           .groupBy("at", "piece").agg(F.sum("times").alias("times")).toArrow())
    out = np.zeros((len(model.pieces), len(model.languages)))
    out[got.column("piece").to_numpy(), got.column("at").to_numpy()] = got.column("times").to_numpy()
    return out


def train(docs: DataFrame, path: str, settings: Settings = Settings(), id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> Model:
    """Piece probabilities of every language among the documents to learn from."""
    table = materialize(language_words(docs, id_col, text_col, lang_col), "language_words")
    sizes = {r["lang"]: r["n"] for r in table.where("word = ''").collect()}  # one row a language
    languages = sorted(sizes)
    pieces = read_pieces(path)
    share = np.log([(sizes[x] + 1) / (sum(sizes.values()) + len(sizes)) for x in languages])
    model = Model(languages, pieces, np.full((len(pieces), len(languages)), 1 / len(pieces)), share)
    words = dealt(table.where("word <> ''"), WORDS_A_TASK)
    for _ in range(settings.rounds if languages else 0):
        counts = _expectation(words, model)
        model = Model(languages, pieces, _smoothed(counts, settings), share)
    return model


# --- judging ---------------------------------------------------------------------------------

class Judge:
    """Scores texts; remembers the words it has met, within a bound."""

    def __init__(self, model: Model) -> None:
        self.model, self.pieces, self.chance = model, Pieces(model.pieces), model.padded()
        width = max(1, len(model.languages))
        self.kept = np.zeros((max(1, KEPT_VALUES // width), width))
        self.places: dict[str, int] = {}

    def logarithms(self, words: list[str]) -> np.ndarray:
        """A row per word."""
        places, kept = self.places, self.kept
        out = np.empty((len(words), kept.shape[1]))
        found = np.fromiter(map(places.get, words, repeat(-1)), np.int64, len(words))
        out[found >= 0] = kept[found[found >= 0]]
        fresh = np.nonzero(found < 0)[0]
        spellings = [spelled(words[i]) for i in fresh]
        for part, table in self.pieces.by_length(spellings):
            out[fresh[part]] = forward(table, self.chance)[0]
        for i, spelling in zip(fresh, spellings):
            if len(spelling) <= KEPT_BYTES:
                if len(places) >= len(kept):
                    places.clear()
                at = places[words[i]] = len(places)
                kept[at] = out[i]
        return out

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, probability) of each text; so many texts at a time that their
        words' values stay within a bound."""
        counted = [Counter(letters(t or "")) for t in texts]
        out: list[tuple[str, float]] = []
        if not self.model.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        start = 0
        while start < len(counted):
            stop, size = start, 0
            while stop < len(counted) and (stop == start or size < len(self.kept)):
                size += len(counted[stop])
                stop += 1
            known = list(set().union(*counted[start:stop]))
            rows, values = {w: i for i, w in enumerate(known)}, self.logarithms(known)
            for found in counted[start:stop]:
                at = np.fromiter(map(rows.__getitem__, found), np.int64, len(found))
                out.append(self._best(values[at], np.fromiter(found.values(), float, len(found))))
            start = stop
        return out

    def _best(self, values: np.ndarray, times: np.ndarray) -> tuple[str, float]:
        if not len(times):
            return UNKNOWN, 0.0
        total = self.model.share + times @ values
        best = int(np.argmax(total))
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score): the likeliest language and its probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)[id_col]
    judges: list[Judge] = []  # one per Python worker, made on first use

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not judges:
            judges.append(Judge(shared.value))
        got = judges[0](column(batch, "text").to_pylist())
        ids = column(batch, "id")
        return record_batch({id_col: (ids, ids.type), "lang_pred": ([g for g, _ in got], pa.string()),
                             "score": ([s for _, s in got], pa.float64())})

    return map_batches(texts(docs, id_col, text_col), make,
                       f"`{id_col}` {kind}, lang_pred string, score double")
