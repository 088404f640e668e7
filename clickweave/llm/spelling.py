"""Groups spelling variants by PartEnum signatures of their letter multisets.

A word's letters are a binary vector with one dimension for each letter and
occurrence ("banana": a1 a2 a3 b1 n1 n2). One inserted or deleted code point
changes one dimension, one replaced changes two, so near words lie within a Hamming
distance of one or two. PartEnum finds such vectors by equality alone: dimensions are
dealt to parts, and a signature is the vector on all parts but ``k``. Vectors that
differ in at most ``k`` dimensions differ in at most ``k`` parts, so leaving those
out they share a signature. Words of equal length use signatures for k = 2, words
whose lengths differ by one those for k = 1; the length is part of the signature.
Words that share a signature are joined on it and verified letter by letter.

Signatures of many words are split further: an edit lies in the first or in the
second half of a word, so near words share one half, which becomes part of the key.
That loses no pair. What is joined is the vocabulary, one row a word, never the
occurrences; those are counted where rows lie before they are shuffled.

Defined results: null and empty texts have no words; a null id counts as an empty
one; repeated rows count each; of a table without words nothing is returned; other
columns are ignored; a very long word is a word like any other.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from clickweave.llm.common import column, dealt, record_batch, texts
from clickweave.operators.skew import skew_join
from clickweave.session import materialize, ship_package

#: Lower-cased runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8.
RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+").findall
#: Distinct words a task counts before it hands them on.
COUNTED = 200_000
#: Words a task makes signatures of.
WORDS_A_TASK = 20_000
#: Letters from common to rare; neighbours are dealt to different parts.
COMMON_FIRST = {c: i for i, c in enumerate("eaisnrtolucdmpghbfvyqkxzjwéèàçêüöäßñóíáú")}


@dataclass(frozen=True)
class Rules:
    least_length: int = 6
    least_times: int = 5
    #: A form occurs at least this many times as often as its variant.
    factor: int = 5
    #: 1 in this many runs of a document loses a letter before it is counted.
    damaged: int = 199
    #: Parts for words of equal length (all but two in a signature), and of lengths one apart.
    parts_replaced: int = 7
    parts_inserted: int = 5
    #: Words above which a signature is split by halves of its words.
    split: int = 256


def damaged(run: bytes, h: int) -> bytes:
    """``run`` without the code point at ``h`` modulo its length."""
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def word_counts(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(word, n) of all words long and frequent enough; written once."""
    ship_package(docs.sparkSession)
    rows = texts(docs, id_col, text_col).select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "text")
    every, least = rules.damaged, rules.least_length

    def handed_on(total: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
        if total:
            words = [w.decode() for w in total]
            batch = record_batch({"word": (words, pa.string()),
                                  "n": (list(total.values()), pa.int64())})
            yield batch.filter(pa.array([len(w) >= least for w in words]))
            total.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}
        for batch in batches:
            for id_, text in zip(column(batch, "id").to_pylist(), batch.column(1)):
                if not text.is_valid:
                    continue
                before = zlib.crc32(f"{id_}:".encode())
                for word, n in Counter(RUN(text.as_py().encode().lower())).items():
                    if len(word) < least:
                        continue
                    h = zlib.crc32(word, before)
                    if h % every == 0:
                        word = damaged(word, h)
                    total[word] = total.get(word, 0) + n
                if len(total) >= COUNTED:
                    yield from handed_on(total)
        yield from handed_on(total)

    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return materialize(counted.where(F.col("n") >= rules.least_times), "words")


# --- signatures ------------------------------------------------------------------------------

def part_of(letter: str, occurrence: int, parts: int) -> int:
    return (COMMON_FIRST.get(letter, ord(letter)) + 3 * occurrence) % parts


def projections(word: str, parts: int) -> list[str]:
    """The vector's dimensions, as text, by part."""
    found: list[list[str]] = [[] for _ in range(parts)]
    for letter, times in sorted(Counter(word).items()):
        for i in range(times):
            found[part_of(letter, i, parts)].append(f"{letter}{i}")
    return [" ".join(p) for p in found]


def signatures(word: str, parts: int, k: int, *more: object) -> list[int]:
    """One number for each choice of ``k`` parts to leave out."""
    own = projections(word, parts)
    return [xxhash.xxh3_64_intdigest("|".join([str(out), *map(str, more),
                                               *[p for i, p in enumerate(own) if i not in out]]))
            - (1 << 63) for out in combinations(range(parts), k)]


def halves(word: str, length: int) -> tuple[int, int]:
    """What an edit in the second, or in the first half leaves alone.

    ``length`` is that of the shorter word of the pair.
    """
    middle = length // 2
    first, last = word[:middle], word[len(word) - (length - middle):]
    return (xxhash.xxh3_64_intdigest("f" + first) - (1 << 63),
            xxhash.xxh3_64_intdigest("l" + last) - (1 << 63))


def _signature_table(words: DataFrame, rules: Rules) -> DataFrame:
    """(sig, kind, word, first, last): kind is 0 for words of equal length, 1 for the
    shorter and 2 for the longer of lengths one apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                out: list[tuple] = []
                for word in batch.column(0).slice(start, 2000).to_pylist():
                    n = len(word)
                    for kind, length, parts, k in ((0, n, rules.parts_replaced, 2),
                                                   (1, n, rules.parts_inserted, 1),
                                                   (2, n - 1, rules.parts_inserted, 1)):
                        first, last = halves(word, length)
                        out += [(s, kind, word, first, last)
                                for s in signatures(word, parts, k, length, min(kind, 1))]
                yield record_batch({c: (v, t) for (c, t), v in zip(
                    (("sig", pa.int64()), ("kind", pa.int32()), ("word", pa.string()),
                     ("first", pa.int64()), ("last", pa.int64())), zip(*out))})

    return dealt(words.select("word"), WORDS_A_TASK).mapInArrow(
        run, "sig long, kind int, word string, first long, last long")


def near_pairs(words: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(a, b): pairs of words that differ by one inserted, deleted or replaced code point."""
    ship_package(words.sparkSession)
    signed = materialize(_signature_table(words, rules), "signatures")
    sizes = (signed.groupBy("sig").agg(
        F.count(F.lit(1)).alias("size"),
        (F.count_if(F.col("kind") == 0) > 1).alias("same"),
        ((F.min("kind") == 1) & (F.max("kind") == 2)).alias("apart"))
        .where("same OR apart").select("sig", "size"))
    met = signed.join(sizes, "sig")
    half = F.when(F.col("size") > rules.split, F.array("first", "last")).otherwise(
        F.array(F.lit(0).cast("long")))
    keyed = materialize(met.select("sig", "kind", "word", F.explode(half).alias("half")), "keyed")
    left = keyed.where("kind < 2").select("sig", "half", F.col("kind").alias("kind_a"),
                                          F.col("word").alias("a"))
    right = keyed.where("kind <> 1").select("sig", "half", F.col("kind").alias("kind_b"),
                                            F.col("word").alias("b"))
    pairs = left.join(right, ["sig", "half"]).where(
        ((F.col("kind_b") == 2) | (F.col("a") < F.col("b")))
        & (F.levenshtein("a", "b", 1) == 1))
    return pairs.select("a", "b").distinct()


# --- forms -----------------------------------------------------------------------------------

def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a table (word, root) whose roots may have roots: paths are halved
    until none is left. Forms are more frequent by a factor, so paths are short."""
    found = materialize(forms, "roots")
    while True:
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(skew_join(found, onward, ["root"], "left"), "roots")
        found = moved.select("word", F.coalesce("further", "root").alias("root"))
        if moved.where("further IS NOT NULL").isEmpty():
            return found


def spelling_variants(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word."""
    words = word_counts(docs, rules, id_col, text_col)
    pairs = materialize(near_pairs(words, rules), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).union(
        pairs.select("b", "a"))
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best"))
    is_form = -F.col("best.minus") >= rules.factor * F.col("n")
    placed = materialize(
        words.join(best, "word", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                F.when(is_form, F.col("best.near")).alias("form"),
                F.when(is_form, -F.col("best.minus")).alias("form_n")), "forms")
    roots = _roots(placed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return (placed.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                    "form_n"))
