"""Spelling variants, the filter audit and language identification against brute force."""

import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from clickweave.llm import filter_audit, language_id, spelling
from tests.llm.helpers import empty, frame, odd, rows

# --- spelling --------------------------------------------------------------------------------


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(texts):
    counts = Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    out = {}
    for w, n in words.items():
        close = [x for x in words if near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        form = best if best and words[best] >= 5 * n else None
        out[w] = (form, n, len(close), words.get(form))

    def root(w):
        return root(out[w][0]) if out[w][0] else w

    return {w: (f, root(w), n, k, fn) for w, (f, n, k, fn) in out.items()}


def variant_texts(seed):
    """Words, each with chains of variants that are rarer by a factor and more, and anagrams."""
    rng = random.Random(seed)
    letters = "abcdefghéÀß"
    pool = []
    for _ in range(40):
        word, n = "".join(rng.choice(letters) for _ in range(rng.randint(5, 9))), 400
        for _ in range(4):
            pool += [word] * n
            i, kind = rng.randrange(len(word)), rng.randrange(3)
            word = (word[:i] + ("" if kind == 0 else rng.choice(letters))
                    + word[i + (kind < 2):])
            n //= rng.choice([4, 5, 6])
    pool += ["".join(rng.sample("stopper", 7)) for _ in range(3000)]
    rng.shuffle(pool)
    return [(100 + i, " ".join(pool[i::50]).title() if i % 2 else "9 ".join(pool[i::50]))
            for i in range(50)]


@pytest.mark.parametrize("split", [256, 1])
def test_variants_against_brute_force(spark, split):
    texts = odd() + variant_texts(3)
    got = spelling.spelling_variants(frame(spark, texts), spelling.Rules(split=split)).collect()
    want = brute_variants(texts)
    assert len(got) == len(want) and sum(v[0] is not None for v in want.values()) > 20
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want
    assert any(want[v[0]][0] for v in want.values() if v[0])  # forms of forms


def test_variants_of_nothing(spark):
    for texts in ([], [(1, None), (2, ""), (3, "short words only")]):
        docs = frame(spark, texts) if texts else empty(spark)
        assert spelling.spelling_variants(docs).count() == 0


@pytest.mark.parametrize("k, parts", [(1, 5), (2, 7)])
def test_close_vectors_share_a_signature(k, parts):
    rng = random.Random(k)
    for _ in range(500):
        word = [rng.choice("abcdeé") for _ in range(rng.randint(6, 12))]
        other = list(word)
        if k == 1:
            del other[rng.randrange(len(other))]
        else:
            other[rng.randrange(len(other))] = rng.choice("abcxyz")
        a, b = (set(spelling.signatures("".join(w), parts, k)) for w in (word, other))
        assert a & b


# --- filter audit ----------------------------------------------------------------------------

def brute_audit(docs, labels):
    """Applies every order filter by filter."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    lowest = {}
    for i, text, _ in docs:
        if i is not None:
            lowest[text or ""] = min(i, lowest.get(text or "", i))
    fails = []
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails.append((i, lang or "", {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and i > lowest[text]}))
    out = {}
    for part in {p for _, p, _ in fails}:
        own = [(i, f) for i, p, f in fails if p == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [i for i, x in left if x[f]]
                left = [(i, x) for i, x in left if not x[f]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(x[f] for _, x in own) - len(gone),
                    sum(x[f] and sum(x.values()) == 1 for _, x in own),
                    sum(i in good for i in gone), sum(i in toxic for i in gone)]
    for (part, order, step), row in list(out.items()):
        f = order[step - 1]
        row.append(sum(r[1] for (p, o, s), r in out.items() if p == part and o[s - 1] == f
                       and len(r) >= 6))
    return {k: tuple(v) for k, v in out.items()}


def audit_rows():
    rng = random.Random(12)
    docs = []
    for i in range(120):
        n = rng.choice([20, 99, 100, 140])
        words = [f"w{rng.randrange(rng.choice([60, 4000]))}" for _ in range(n)]
        if rng.random() < 0.3:
            words = [w.upper() + "AB" for w in words]
        if rng.random() < 0.3:
            words[0] = rng.choice("#$%&*|")
        docs.append((i, " ".join(words), rng.choice(["en", "de", None, ""])))
    docs += [(200 + i, docs[7][1], "en") for i in range(30)] + [(7, docs[7][1], "de")]
    docs += [(None, docs[7][1], "en"), (300, None, "de"), (301, "", "de"), (None, None, None)]
    return docs


def test_audit_against_every_order(spark):
    docs = audit_rows()
    labels = [(i, random.Random(i).randrange(2), i % 3 == 0) for i in range(0, 210, 2)]
    labels = [(i, q, int(t)) for i, q, t in labels] + [(7, 0, 1), (7, 1, 0), (None, 1, 1), (9, None, None)]
    table = spark.createDataFrame([(i, t, p, "x", 1, "m", 2) for i, t, p in docs],
                                  "doc_id long, text string, lang string, part string, mask int, digest string, n int")
    known = spark.createDataFrame([(*r, "y") for r in labels],
                                  "doc_id long, quality int, toxic int, id string")
    got = filter_audit.filter_audit(table, known).collect()
    want = brute_audit(docs, labels)
    assert len(got) == len(want) == 3 * 600
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == want


def test_audit_of_nothing(spark):
    known = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(empty(spark), known).count() == 0
    odd_rows = filter_audit.filter_audit(frame(spark, odd()), known).collect()
    assert len(odd_rows) == 600 and {r.part for r in odd_rows} == {"en"}


def test_walk_visits_every_set():
    rng = np.random.default_rng(5)
    masks, counts = np.arange(32), rng.integers(0, 9, (32, 3))
    got = filter_audit.walk(masks, counts)
    for chosen in range(32):
        assert (got[chosen] == counts[(masks & chosen) == 0].sum(axis=0)).all()


# --- languages -------------------------------------------------------------------------------

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def segmentations(word, index):
    if not word:
        return [[]]
    return [[index[word[:i]]] + rest for i in range(1, len(word) + 1) if word[:i] in index
            for rest in segmentations(word[i:], index)]


def test_sums_against_all_segmentations():
    pieces = language_id.read_pieces(VOCABULARY)
    index = {p: i for i, p in enumerate(pieces)}
    chance = np.random.default_rng(1).random((len(pieces), 3))
    chance /= chance.sum(axis=0)
    padded, own = np.vstack([chance, np.zeros((1, 3))]), language_id.Pieces(pieces)
    words = [language_id.spelled(w) for w in ("the", "nation", "ère", "étrange", "x", "日本", "oui")]
    seen = []
    for part, table in own.by_length(words):
        logs, steps = language_id.forward(table, padded, True)
        taken = language_id.expected(steps[..., 1], np.full(len(part), 3.0))
        for row, place in enumerate(part):
            every = segmentations(words[place], index)
            weights = np.array([chance[s].prod(axis=0) for s in every])
            assert logs[row] == pytest.approx(np.log(weights.sum(axis=0)))
            want = np.zeros(len(pieces) + 1)
            for s, w in zip(every, weights[:, 1] / weights[:, 1].sum()):
                np.add.at(want, s, 3 * w)
            assert np.bincount(table[row].ravel(), taken[row].ravel(), len(want)) == pytest.approx(want)
            seen.append(place)
    assert sorted(seen) == list(range(len(words)))


def test_long_words_do_not_underflow():
    pieces = language_id.read_pieces(VOCABULARY)
    padded = np.vstack([np.full((len(pieces), 2), 1e-9), np.zeros((1, 2))])
    table = language_id.Pieces(pieces).table([b" " + b"qz" * 20_000])
    assert np.isfinite(language_id.forward(table, padded)[0]).all()


def test_held_out_languages(spark, sf):
    docs = spark.read.parquet(f"{sf}/../sf0.01/documents.parquet")
    model = language_id.train(docs, VOCABULARY)
    assert model.languages == ["de", "en", "es", "fr"]
    assert model.chance.sum(axis=0) == pytest.approx(1.0)
    held = docs.where(language_id.fold(docs.doc_id) == language_id.HELD_OUT)
    got = {r.doc_id: r for r in language_id.identify(held, model).collect()}
    want = {r.doc_id: r.lang for r in held.select("doc_id", "lang").collect()}
    assert len(got) == len(want) > 200
    assert sum(got[i].lang_pred == want[i] for i in want) >= 0.98 * len(want)
    again = language_id.identify(frame(spark, odd()), model).collect()
    assert len(again) == len(odd())
    for r in again:
        assert 0 <= r.score <= 1 and (r.lang_pred in model.languages or r.lang_pred == "und")
    by_id = {r.doc_id: r.lang_pred for r in again if r.doc_id is not None}
    assert [by_id[i] for i in (0, 1, 2)] == ["und"] * 3 and by_id[8] != "und"


def test_small_memo_gives_the_same(spark, monkeypatch):
    pieces = language_id.read_pieces(VOCABULARY)
    chance = np.random.default_rng(2).random((len(pieces), 2))
    model = language_id.Model(["a", "b"], pieces, chance / chance.sum(axis=0), np.log([0.5, 0.5]))
    texts = [t for _, t in odd()] * 2
    whole = language_id.Judge(model)(texts)
    monkeypatch.setattr(language_id, "KEPT_VALUES", 20)
    again = language_id.Judge(model)(texts)
    assert [g for g, _ in again] == [g for g, _ in whole]
    assert [x for _, x in again] == pytest.approx([x for _, x in whole])


def test_nothing_to_learn_from(spark):
    for docs in (empty(spark), frame(spark, odd()).withColumn("lang", F.lit(None).cast("string"))):
        model = language_id.train(docs, VOCABULARY)
        got = language_id.identify(frame(spark, odd()), model).collect()
        assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}


def test_fold_of_a_missing_id(spark):
    docs = spark.createDataFrame(rows([(None, "eins zwei drei")] * 3), "doc_id long, text string, "
                                 "lang string, source string, n_chars long, id long, key string, _key long")
    assert language_id.train(docs, VOCABULARY).languages == ["en"]
