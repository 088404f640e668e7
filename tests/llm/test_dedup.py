"""Jaccard join, components, chunk de-duplication."""

import random

import pytest

from clickweave.llm import chunk_dedup, jaccard_join
from clickweave.llm.components import components
from tests.llm.helpers import empty, frame, odd, prose
from tests.conftest import rows as collected


def brute_components(texts):
    sets = []
    for i, t in texts:
        words = (t or "").encode().lower().split()
        sets.append({tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5
                    else ({tuple(words)} if words else set()))
    group = list(range(len(texts)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                group[root(a)] = root(b)
    out = []
    for k, (i, _) in enumerate(texts):
        ids = [texts[j][0] for j in range(len(texts)) if root(j) == root(k) and texts[j][0] is not None]
        out.append((i, len(sets[k]), min(ids, default=None)))
    return sorted(out, key=repr)


def edited(text, n, seed):
    rng = random.Random(seed)
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


def near_copies():
    texts, at = [], 100
    for base in range(4):
        text = prose(50 + base, [40, 90, 200, 400][base])
        for k in range(25):
            texts.append((at, edited(text, k % 9, at)))
            at += 1
    shared = prose(77, 60)
    for k in range(12):
        texts.append((at + k, prose(500 + k, 40) + " " + shared + " " + prose(600 + k, 20 * k + 1)))
    texts += [(300, "a b"), (301, "A b"), (302, "a"), (303, prose(50, 40)), (303, prose(50, 40))]
    return texts


def test_components_of_near_copies_match_brute_force(spark):
    texts = near_copies() + odd()
    got = jaccard_join.jaccard_components(frame(spark, texts))
    assert collected(got.select("doc_id", "n_shingles", "component_id")) == brute_components(texts)
    assert jaccard_join.jaccard_components(empty(spark)).count() == 0


def test_one_row_of_each_component_stays(spark):
    texts = near_copies() + odd()
    docs = frame(spark, texts)
    kept = jaccard_join.one_per_component(docs)
    assert kept.columns == docs.columns
    want = brute_components(texts)
    linked = {c for i, n, c in want if n and c is not None}
    stay = [r.doc_id for r in kept.collect() if (r.text or "").strip()]
    assert sorted(x for x in stay if x is not None) == sorted(linked) and stay.count(None) == 1
    assert kept.where("text is null or trim(translate(text, '\n\t', '  ')) = ''").count() == 4
    assert jaccard_join.one_per_component(empty(spark)).count() == 0


@pytest.mark.parametrize("a, b, linked", [(5, 4, True), (10, 8, True), (10, 7, False), (100, 80, True), (100, 79, False)])
def test_threshold_is_exact(a, b, linked):
    import numpy as np
    x = np.arange(a, dtype=np.uint64) << np.uint64(55)
    assert jaccard_join._linked(x, x[:b]) is linked


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    rng.shuffle(chain)
    star = [(500, k) for k in range(501, 560)] + [(500, 500)]
    pairs = chain + star + [(1, 2), (2, 3), (3, 1), (3, 1), (7, 9)]
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.label, set()).add(r.node)
    assert sorted(map(sorted, groups.values())) == [
        [1, 2, 3], [7, 9], list(range(100, 161)), list(range(500, 560))]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_cuts_resist_insertions():
    text = prose(8, 2000)
    a = set(chunk_dedup.chunks(text.encode())[0].tolist())
    b = set(chunk_dedup.chunks(("inserted words " + text[:5000] + " more " + text[5000:]).encode())[0].tolist())
    assert len(a & b) >= 0.95 * len(a)
    wrapped = text.replace(" ", "\n", 300)
    assert set(chunk_dedup.chunks(wrapped.encode())[0].tolist()) == a


@pytest.mark.parametrize("text", ["", " ", "x", "x y", "日本語" * 300, "a" * 5000, "the " * 500, prose(4, 700)])
def test_chunks_cover_the_text(text):
    data = text.encode()
    digests, starts, ends, words = chunk_dedup.chunks(data)
    if not data.split():
        assert len(digests) == 0
        return
    assert (starts[1:] == ends[:-1]).all() and ends[-1] == len(data) and words.sum() >= 1
    assert all(data[s:e].decode() is not None for s, e in zip(starts, ends))


def test_repeated_passages_are_found_and_cut_out(spark):
    passages = [prose(900 + k, 60 + k) for k in range(8)]
    texts = []
    for d in range(80):
        words = prose(2000 + d, 150).split()
        if d >= 40:
            words[50:50] = ["\n" + passages[d % 8] + "\n"]
        texts.append((1000 + d, " ".join(words)))
    docs = frame(spark, texts + odd() + [(1100, prose(2000, 150) + " licensed under the terms of x")])
    spans = chunk_dedup.repeated_spans(docs).collect()
    flagged = {r.id for r in spans}
    assert set(range(1048, 1080)) <= flagged
    assert flagged <= set(range(1048, 1080)) | {5, 7, 8, 9, 11, 1100}
    assert {r.first_id for r in spans if r.id == 1049} == {1041}
    out = chunk_dedup.drop_repeated(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    new = {}
    for r in out.collect():
        new.setdefault(r.doc_id, []).append(r.text)
    old = {}
    for i, t in texts + odd():
        old.setdefault(i, []).append(t)
    for i in [*range(1000, 1048), 0, 1, 2, 3, 10]:
        assert sorted(new[i], key=repr) == sorted(old[i], key=repr)
    for i in range(1048, 1080):
        kept, whole = new[i][0].split(), old[i][0].split()
        assert len(whole) - 80 <= len(kept) <= len(whole) - 20 and set(kept) <= set(whole)
    assert new[4][0] and not new[5][0].split() and new[5][0] == new[5][1]
    assert chunk_dedup.repeated_spans(empty(spark)).count() == 0
    assert chunk_dedup.drop_repeated(empty(spark)).count() == 0


def test_part_sizes_never_rule_out_a_link():
    import numpy as np
    rng = np.random.default_rng(5)
    for n in (1, 5, 40, 300, 70_000):
        base = np.unique(rng.integers(0, 2**64, n + n // 4 + 1, dtype=np.uint64))
        a, b = (np.sort(rng.choice(base, n, replace=False)) for _ in range(2))
        both = len(a) + len(b)
        apart = np.abs(jaccard_join.part_sizes(a).astype(int) - jaccard_join.part_sizes(b)).sum()
        assert apart <= both - 2 * len(np.intersect1d(a, b))
        if jaccard_join._linked(a, b):
            assert apart <= both - 2 * -(-4 * both // 9)
