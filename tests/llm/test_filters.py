"""Quality rules, classifier, decontamination, licence scan."""

import base64
import random
import re
import string
import time

import numpy as np
import pytest

from clickweave.llm import compression, decontaminate, license_scan, quality_fm
from clickweave.llm.common import WordCache
from tests.llm.helpers import empty, frame, odd, prose


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup,
            len(inside), failed)


def test_rules_match_brute_force(spark):
    texts = [t for t in odd() if t[1] is None or len(t[1]) < 6000]
    texts += [(20, "a b c a b c # | <x>\nq\nq\n \nq"), (21, "tell me why " * 40), (22, prose(5, 60) + " x")]
    got = compression.compression_rules(frame(spark, texts)).collect()
    want = sorted((i, *brute_rules(t)) for i, t in texts if i is not None)
    assert sorted(tuple(r)[:7] for r in got if r.doc_id is not None) == want
    assert len(got) == len(texts)
    assert not any(r.kept for r in got if r.base_failed)


def test_bands_reject_repetition_and_noise(spark):
    rng = random.Random(4)
    noise = " ".join("".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(40)) for _ in range(80))
    texts = [(1, prose(1, 400)), (2, noise), (3, (prose(2, 40) + "\n") * 60)]
    kept = {r.doc_id: r.kept for r in compression.compression_rules(frame(spark, texts)).collect()}
    assert kept == {1: True, 2: kept[2], 3: False}
    bands = compression.Bands(limits=((0, 0.2, 0.5),))
    assert not any(r.kept for r in compression.compression_rules(frame(spark, [(2, noise)]), bands).collect())


def test_default_bands_tell_noise_from_prose_at_every_length(spark):
    rng = random.Random(14)
    letters = string.ascii_letters + string.digits
    printable = "".join(map(chr, range(33, 127)))

    def words(alphabet, low, high):
        return " ".join("".join(rng.choices(alphabet, k=rng.randint(low, high))) for _ in range(30_000))

    ideographs = [chr(c) for c in range(0x4E00, 0x9FFF)]
    # Letters as frequent as in a real text, in syllables of a few thousand signs.
    usual = rng.choices(ideographs, [1 / (i + 3) for i in range(len(ideographs))], k=60_000)
    noise = {"base64": base64.encodebytes(rng.randbytes(150_000)).decode().replace("\n", " "),
             "base64 words": " ".join(base64.b64encode(rng.randbytes(6)).decode() for _ in range(20_000)),
             "letters": words(letters, 3, 10), "printable": words(printable, 3, 10)}
    bands, packer = compression.Bands(), compression.zstandard.ZstdCompressor(level=3)

    def holds(text):
        return bands.holds(text.encode(), len(packer.compress(text.encode())))

    for size in (256, 400, 600, 800, 1_100, 2_000, 4_096, 9_000, 20_000, 70_000):
        assert not [name for name, text in noise.items() if holds(text[:size])], size
        assert holds(prose(size, size)[:size])
        assert holds("".join(usual)[:size // 3])
        if size >= 4_096:
            assert not holds(words(ideographs, 40, 40)[:size // 3 + 100])
    wide = words(ideographs, 40, 40)[:3_280]
    texts = [(1, prose(1, 400)), (2, wide), (3, noise["letters"][:600]), (4, noise["base64 words"][:9_000]),
             (5, " ".join("".join(usual[i:i + 9]) for i in range(0, 3_000, 9)))]
    kept = {r.doc_id: r.kept for r in compression.compression_rules(frame(spark, texts)).collect()}
    assert kept == {1: True, 2: False, 3: False, 4: False, 5: True}


def test_rules_keep_columns_and_empty_tables(spark):
    docs = frame(spark, odd())
    kept = compression.keep_documents(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {4, 5, 6, None}
    assert compression.keep_documents(empty(spark)).count() == 0
    assert compression.compression_rules(empty(spark)).count() == 0


def test_fm_sum_of_squares_equals_all_pairs():
    rng = np.random.default_rng(0)
    w, v = rng.normal(size=30), rng.normal(size=(30, 4))
    index, value = np.array([3, 7, 9, 20, 1]), rng.normal(size=5)
    start = np.array([0, 3])
    got = quality_fm.margins(0.5, w, v, index, value, start)[0]
    for doc, (a, b) in enumerate(((0, 3), (3, 5))):
        want = 0.5 + sum(w[index[i]] * value[i] for i in range(a, b))
        want += sum(v[index[i]] @ v[index[j]] * value[i] * value[j]
                    for i in range(a, b) for j in range(i + 1, b))
        assert got[doc] == pytest.approx(want)


def test_fm_learns_held_out_labels(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/../sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality_fm.train(docs, labels, quality_fm.Settings(train_rows=2000))
    scored = {r.doc_id: r.score for r in quality_fm.score(docs, model).collect()}
    held = [r for r in labels.where(quality_fm.fold(labels.doc_id) == 0).collect()]
    right = sum((scored[r.doc_id] >= 0.3) == bool(r.quality) for r in held)
    assert right >= 0.93 * len(held)


def test_fm_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (5, 1, 0), (6, None, 0), (None, 1, 0), (11, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    model = quality_fm.train(frame(spark, odd()), labels)
    got = quality_fm.score(frame(spark, odd()), model).collect()
    assert len(got) == len(odd()) and all(0 <= r.score <= 1 for r in got)
    none = quality_fm.train(empty(spark), labels)
    assert quality_fm.score(empty(spark), none).count() == 0
    assert {r.score for r in quality_fm.score(frame(spark, odd()[:4]), none).collect()} == {0.5}


def test_masks_hit_every_allowed_substitution():
    import itertools
    for size in range(8, 14):
        for bad in itertools.combinations(range(size), size - -(-8 * size // 10)):
            assert any(not {s + o for o in mask} & set(bad)
                       for mask in decontaminate.MASKS for s in range(size - mask[-1])), (size, bad)


def test_decontamination_against_brute_force(spark):
    rng = random.Random(9)
    items = [(i, prose(100 + i, 10 + 5 * i)) for i in range(6)] + [(90, "too short"), (91, None), (None, prose(99, 30))]
    texts, planted = [], set()
    for d in range(60):
        words = prose(1000 + d, 80).split()
        if d % 2:
            item, text = items[d % 6]
            part = text.split()
            for k in range(0, len(part), 9):  # far less than one word in five
                part[k] = "changed"
            words[30:30] = part
            if len(part) >= 13:
                planted.add((d, item))
        texts.append((d, " ".join(words).upper() if d % 3 == 0 else " ".join(words)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, texts + odd())
    for rule in (decontaminate.Rule(), decontaminate.Rule(block_words=40)):
        got = {(r.doc_id, r.item_id) for r in decontaminate.contamination(docs, bench, rule).collect()}
        assert planted <= got and {d for d, _ in got} <= {d for d in range(60) if d % 2}
        kept = decontaminate.drop_contaminated(docs, bench, rule)
        assert kept.columns == docs.columns
        assert kept.count() == docs.count() - len({d for d, _ in got})
    nothing = bench.where("item_id < 0")
    assert decontaminate.contamination(docs, nothing).count() == 0
    assert decontaminate.drop_contaminated(docs, nothing).count() == docs.count()
    assert decontaminate.contamination(empty(spark), bench).count() == 0


def every_alignment(items, text, rule):
    """Items laid on the text at every place, compared word by word."""
    found = set()
    words = decontaminate.word_hashes(text.encode(), WordCache(decontaminate.bare_hash)).tolist()
    for id_, item in items:
        other = decontaminate.word_hashes(item.encode(), WordCache(decontaminate.bare_hash)).tolist()
        size = min(rule.window, len(other))
        for start in range(-len(other), len(words)):
            low, high = max(0, -start), min(len(other), len(words) - start)
            same = [words[start + k] == other[k] for k in range(low, high)]
            if any(sum(same[k:k + size]) >= rule.share * size for k in range(len(same) - size + 1)):
                found.add(id_)
    return found


@pytest.mark.parametrize("step", [decontaminate.STEP, 5])
def test_matches_equal_all_alignments(monkeypatch, step):
    monkeypatch.setattr(decontaminate, "STEP", step)
    rng, rule = random.Random(4), decontaminate.Rule()
    items = [(i, " ".join(rng.choices("abcdef", k=rng.randrange(8, 30)))) for i in range(30)]
    index = decontaminate.Index([i for i, _ in items], [t.encode() for _, t in items])
    some = 0
    for _ in range(40):
        text = rng.choices("abcdef", k=25) + items[rng.randrange(30)][1].split()[rng.randrange(9):]
        text = " ".join(w if rng.random() < .85 else "x" for w in text + rng.choices("abcdef", k=5))
        words = decontaminate.word_hashes(text.encode(), WordCache(decontaminate.bare_hash))
        got = index.matches(words, rule)
        assert {g[0] for g in got} == every_alignment(items, text, rule) and len(got) == len({g[0] for g in got})
        some += len(got)
    assert some > 20


def test_a_stem_of_many_items_costs_little():
    stem = "which of the following statements about the text is true"
    items = [f"{stem} {prose(k, 9)}" for k in range(20_000)]
    index = decontaminate.Index(list(range(20_000)), [t.encode() for t in items])
    text = " ".join(f"{stem} {prose(50_000 + k, 30)}" for k in range(10)) + " " + items[77]
    words = decontaminate.word_hashes(text.encode(), WordCache(decontaminate.bare_hash))
    began = time.process_time()
    got = index.matches(words, decontaminate.Rule())
    assert 77 in {g[0] for g in got} and time.process_time() - began < 2


def test_short_items_are_found_word_for_word(spark):
    items = [(n, " ".join(f"q{n}x{k}" for k in range(n))) for n in range(1, 8)]
    items += [(20, items[4][1].upper() + "?"), (None, items[2][1]), (21, "... !"), (22, "")]
    texts = [(n, f"{prose(n, 20)} {text.upper()}. {prose(n, 9)} {text}") for n, text in items[:7]]
    texts += [(30 + n, prose(n, 9) + " " + " ".join(text.split()[:-1] + ["other"])) for n, text in items[1:7]]
    texts += [(50, items[6][1]), (51, ""), (52, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, texts)
    want = {(n, n, 20, n, n) for n in range(1, 8)} | {(5, 20, 20, 5, 5), (3, None, 20, 3, 3), (50, 7, 0, 7, 7)}
    for rule in (decontaminate.Rule(), decontaminate.Rule(block_words=10)):
        got = [tuple(r) for r in decontaminate.contamination(docs, bench, rule).collect()]
        assert set(got) == want and len(got) == len(want)
    assert decontaminate.drop_contaminated(docs, bench).count() == len(texts)
    kept = decontaminate.drop_contaminated(docs, bench, decontaminate.Rule(drop_words=5))
    assert {i for i, _ in texts} - {r.doc_id for r in kept.collect()} == {5, 6, 7, 50}


def brute_base(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    starts, labels = [], set()
    for phrase, label in license_scan.BASE:
        part = phrase.split()
        found = [i for i in range(len(words)) if words[i:i + len(part)] == part]
        starts += found
        labels |= {label} if found else set()
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(labels)))


def test_license_scan_against_brute_force(spark):
    texts = odd() + [
        (30, "Licensed under the Apache License, Version 2.0. MIT License; mit-license CC BY CC BY-NC 4.0"),
        (31, "GNU General Public GNU General Public License gnu general public license, version 3"),
        (32, "cc cc by by license mit Mit LICENSE"),
        (33, prose(1, 50) + " Permission is hereby granted, free of charge, to any person obtaining a copy "
             "of this software and associated documentation files " + prose(2, 20)),
        (34, "Permission is hereby granted, free of charge")]
    docs = frame(spark, texts)
    got = {(r.doc_id, r.n_words): r for r in license_scan.license_scan(docs).collect()}
    for i, t in texts:
        want = brute_base(t)
        r = got[i, want[0]]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    by_id = {i: r for (i, _), r in got.items()}
    assert by_id[30].labels == "apache,apache-2.0,cc-by,cc-by-nc-4.0,mit"
    assert by_id[31].labels == "gpl,gpl-3.0" and by_id[33].labels == "mit" and by_id[34].labels == ""
    assert license_scan.license_scan(empty(spark)).count() == 0
    plan = license_scan.license_scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_license_scan_finds_every_notice_of_a_text(spark):
    base = {"gpl-3.0": "gpl", "gpl-2.0": "gpl", "apache-2.0": "apache", "cc-by-4.0": "cc-by",
            "cc-by-nc-4.0": "cc-by", "cc-by-sa-4.0": "cc-by"}
    all_of_them, rng = list(license_scan.TEMPLATES), random.Random(10)
    long_mit = next(t for t in all_of_them if t.text.startswith("permission is hereby"))
    groups = [[long_mit] + [t for t in all_of_them if t.label == "apache-2.0"],
              [long_mit] + [t for t in all_of_them if t.label == "gpl-3.0"], all_of_them]
    groups += [rng.sample(all_of_them, 3 + n % 4) for n in range(20)]
    texts, want = [], {}
    for i, group in enumerate(groups):
        texts.append((i, prose(i, 9) + " " + " ".join(f"{t.text}. {prose(i, 5)}" for t in group)))
        labels = {t.label for t in group}
        want[i] = ",".join(sorted(labels | {base[x] for x in labels & set(base)}))
    got = license_scan.license_scan(frame(spark, texts)).collect()
    assert {r.doc_id: r.labels for r in got} == want
    assert all(r.score == pytest.approx(1.0) for r in got)


def brute_labels(text):
    """Every template at every start, without an index."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    labels = set(filter(None, brute_base(text)[4].split(",")))
    best = 0.75 if labels else 0.0
    for t in license_scan.TEMPLATES + license_scan.NOTICES:
        own = t.text.split()
        fixed = [(own.index(p.split()[0]), p.split()) for p in t.phrases]
        fixed = [next((i, p) for i in range(len(own)) if own[i:i + len(p)] == p) for _, p in fixed]
        must = {at + i for at, p in fixed for i in range(len(p))}
        for s in range(len(words)):
            if all(words[s + at:s + at + len(p)] == p for at, p in fixed):
                got = sum(5.0 if i in must else 1.0 for i, w in enumerate(own)
                          if s + i < len(words) and words[s + i] == w)
                share = got / sum(5.0 if i in must else 1.0 for i in range(len(own)))
                if share >= t.share:
                    labels, best = labels | {t.label}, max(best, share)
    return ",".join(sorted(labels)), best


def edited(template, rng):
    """One word in ten replaced, but for the mandatory phrases."""
    words, kept = template.words, {a + i for a, p in template.places() for i in range(len(p))}
    for i in rng.sample(range(len(words)), len(words) // 10):
        if i not in kept:
            words[i] = "other"
    return " ".join(words)


def test_whole_notices_edited_and_in_pairs(spark):
    notices, rng = license_scan.NOTICES, random.Random(12)
    texts = [(i, f"{prose(i, 7)} {t.text.upper()}") for i, t in enumerate(notices)]
    texts += [(100 + i, f"{prose(i, 7)} {edited(t, rng)} {prose(i, 3)}") for i, t in enumerate(notices)]
    texts += [(1000 + 100 * i + k, f"{a.text}. {prose(i, 4)} {edited(b, rng)}")
              for i, a in enumerate(notices) for k, b in enumerate(notices)]
    # Parts of notices, and mandatory words in the wrong places.
    texts += [(200 + i, " ".join(t.words[len(t.words) // 3:])) for i, t in enumerate(notices)]
    texts += [(300 + i, " ".join(rng.sample(t.words, len(t.words)))) for i, t in enumerate(notices)]
    got = {r.doc_id: r for r in license_scan.license_scan(frame(spark, texts)).collect()}
    for i, text in texts:
        labels, best = brute_labels(text)
        assert got[i].labels == labels and got[i].score == pytest.approx(best), i
    for i, a in enumerate(notices):
        for k, b in [(i, a), (100 + i, a), *[(1000 + 100 * i + k, b) for k, b in enumerate(notices)]]:
            assert {a.label, b.label} <= set(got[k].labels.split(",")), k


def test_labels_do_not_depend_on_other_rows(spark):
    text = (1, "This work is CC BY-NC 4.0, see the Apache License, Version 2.0")
    other = [(10 + n, f"licensed under the apache foundation, nc license {prose(n, 5)}") for n in range(200)]
    plain = [(10 + n, prose(n, 9)) for n in range(200)]
    got = {license_scan.license_scan(frame(spark, [text, *rest])).where("doc_id = 1").first().labels
           for rest in ([], other, plain)}
    assert got == {"apache,apache-2.0,cc-by,cc-by-nc-4.0"}
