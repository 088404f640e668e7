"""BPE, token files, WARC, shards."""

import gzip
import io
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickweave.llm import kd_shards, range_coder, token_files, warc
from clickweave.llm.bpe import Codec, bpe_decode, bpe_encode
from clickweave.llm.range_coder import FRAME, pack_frame, unpack_frame
from tests.llm.helpers import empty, frame, odd, prose

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
STRANGE = ["a<|endoftext|>b <|startoftext|>", "ÀÉÎ ́a é  x y\x1cz\x85q", "İstanbul ΣΑΣ ß Ǆ",
           "it's we'll 1234 ½ ² don'T 'S foo'Re", "x́" * 300 + "ཱི̈́", "the\x0bq\x0cz y", "<|endoftext",
           "​ a  b\n c \r\n d", "  two  spaces ", "tab\t x", "\U0001f468‍\U0001f469 end "]


def test_codec_equals_the_library(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    texts += STRANGE + [t or "" for _, t in odd()]
    codec, library = Codec(open(WORD_BPE).read()), Tokenizer.from_file(WORD_BPE)
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        got = codec.encode(text.encode())
        assert got == struct.pack(f"<{len(want.ids)}I", *want.ids), text[:80]
        assert codec.decode(got) == library.decode(want.ids, skip_special_tokens=False)


def test_forced_cuts_change_nothing():
    codec = Codec(open(WORD_BPE).read())
    for word in ("the<b>", "!!!abc", "q1w2", "straße", "naïve"):
        pre = [t for t, _ in codec.pre_tokenizer.pre_tokenize_str(word)]
        for token in pre:
            whole = codec._fragment([*token[:-1], token[-1] + codec.suffix])
            assert codec._pre_token(token) == np.array(whole, "<u4").tobytes()
    long = codec._fragment([*"abcdefgh" * 40])
    short = codec._long_fragment([codec.vocab[c] for c in "abcdefgh" * 40])
    assert long == short


def test_bpe_columns(spark):
    docs = frame(spark, odd())
    got = bpe_encode(docs, WORD_BPE, decode=True)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"] and got.count() == len(odd())
    again = bpe_decode(got, WORD_BPE)
    assert sorted(r.decoded for r in got.collect()) == sorted(r.decoded for r in again.collect())
    assert all(r.n_tokens == len(r.ids) // 4 for r in got.collect())
    assert bpe_encode(empty(spark), WORD_BPE).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 2047, 2049, 9000])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 65536, n), np.zeros(n, int), rng.integers(0, 3, n), np.full(n, 65535),
                rng.zipf(1.3, n) % 50000):
        packed = pack_frame(ids)
        assert (unpack_frame(io.BytesIO(packed).read) == ids).all()
    assert len(pack_frame(np.tile([5, 9, 5, 7], n))) < 8 * n or n < 9


def test_coder_notices_damage():
    packed = bytearray(pack_frame(np.arange(5000) % 700))
    packed[FRAME.size + 40] ^= 1
    with pytest.raises(ValueError):
        unpack_frame(io.BytesIO(bytes(packed)).read)
    with pytest.raises(ValueError):
        unpack_frame(io.BytesIO(bytes(packed[:-1])).read)
    assert unpack_frame(io.BytesIO(b"").read) is None


def test_blocks_of_a_frame_learn_together():
    rng = np.random.default_rng(3)
    ids = rng.permutation(50_000)[rng.zipf(1.3, 300_000) % 50_000]
    seen = np.bincount(ids)
    seen = seen[seen > 0]
    entropy = -(seen * np.log2(seen / len(ids))).sum() / 8
    packed = pack_frame(ids)
    assert len(packed) < 1.2 * entropy
    assert (unpack_frame(io.BytesIO(packed).read) == ids).all()


def test_a_full_frame_takes_few_steps(monkeypatch):
    calls, predict = [], range_coder.Models.predict
    monkeypatch.setattr(range_coder.Models, "predict", lambda self, m: calls.append(m) or predict(self, m))
    ids = np.arange(token_files.FRAME_IDS) % 6007
    packed = pack_frame(ids)
    assert len(calls) <= 512 and sum(calls) == len(ids) == 1 << 21
    assert (unpack_frame(io.BytesIO(packed).read) == ids).all()
    assert len(calls) <= 1024 and sum(calls) == 2 * len(ids)


def test_coder_notices_a_damaged_table():
    packed = pack_frame(np.arange(5000) % 700)
    for at in range(FRAME.size, FRAME.size + 36):
        for bit in (1, 2, 128):
            broken = bytearray(packed)
            broken[at] ^= bit
            with pytest.raises(ValueError):
                unpack_frame(io.BytesIO(bytes(broken)).read)


ODD_PARTS = ["a", "B", "the", " ", " ", "  ", "\n", "\n", "\n\n", "\t", "\r", "'", "'s", "'ll", "é", "ß", "中", "\u00a0",
             "\u2003", "\u3000", "\u1680", "\u205f", "\u2028", "\x85", "\x1c", "\x00", "\x7f", "1", "22", "½", ".",
             ",", "<|endoftext|>", "<|", "|>", "endoftext", "\u0301", "\u200b", "!", "-", "_", "İ", "\U0001f468\u200d"]


def encoded(own, texts):
    ids, sizes = own.encode(pa.array(texts, pa.string()))
    assert len(sizes) == len(texts) and sizes.sum() == len(ids)
    return [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]


@pytest.mark.parametrize("mark_bytes, kept", [(1 << 20, 1_000_000), (61, 200), (5, 0)])
def test_pieces_have_the_ids_of_the_library(monkeypatch, mark_bytes, kept):
    monkeypatch.setattr(token_files, "MARK_BYTES", mark_bytes)
    monkeypatch.setattr(token_files, "PIECES_KEPT", kept)
    own, library = token_files.Encoder(open(BYTE_BPE).read()), Tokenizer.from_file(BYTE_BPE)
    assert own.may_cut
    draw = random.Random(mark_bytes)
    odd_texts = ["".join(draw.choices(ODD_PARTS, k=draw.randint(0, 20))) for _ in range(4000)]
    for at in range(0, len(odd_texts), 400):
        texts = [None, "", *odd_texts[at:at + 400], *STRANGE, "long" * 100, "\n", " ", prose(at, 60)]
        want = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
        assert encoded(own, texts) == [w.ids for w in want]
        assert len(own.known) == len(own.ids) <= kept


def test_other_tokenizers_get_whole_texts():
    own, library = token_files.Encoder(open(WORD_BPE).read()), Tokenizer.from_file(WORD_BPE)
    assert not own.may_cut
    texts = ["A b, c.", *STRANGE, "", prose(1, 30)]
    assert encoded(own, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_words_are_encoded_once_whatever_follows_them(monkeypatch):
    own, given = token_files.Encoder(open(BYTE_BPE).read()), []
    ids = token_files.Encoder._ids
    monkeypatch.setattr(token_files.Encoder, "_ids", lambda self, p: given.extend(p) or ids(self, p))
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    for sign in (",", ".", "!", "?", ":", ";\nAnd"):
        encoded(own, [f"Start {w}{sign} end" for w in words])
    assert len(given) == len(set(given)) < len(words) + 20


def test_slices_hold_every_row(monkeypatch):
    monkeypatch.setattr(token_files, "SLICE_BYTES", 100)
    texts = [None, "", "x" * 250, "a", "b" * 60, "c" * 50, "d" * 100, "", "e", None]
    batch = pa.RecordBatch.from_pydict({"id": [*range(10)], "text": pa.array(texts, pa.string())})
    for step in (1, 3, 10):
        parts = list(token_files.by_bytes(iter([batch.slice(0, 0), *(batch.slice(a, step) for a in range(0, 10, step))])))
        assert [t for p in parts for t in p["text"].to_pylist()] == texts
        for p in parts:
            assert p.num_rows == 1 or sum(len(t or "") for t in p["text"].to_pylist()) <= 100
    assert list(token_files.by_bytes(iter([]))) == []


def test_token_files_hold_every_document_in_order(spark):
    texts = [(i, t) for i, t in odd()] + [(100 + i, s) for i, s in enumerate(STRANGE)] + \
        [(1000 + i, prose(i, 50)) for i in range(300)]
    docs = frame(spark, texts).repartition(7)
    files = token_files.write_tokens(docs, token_files.fresh_folder(spark), BYTE_BPE)
    got = sorted(token_files.read_tokens(spark, files).collect(), key=lambda r: r.start)
    library, at = Tokenizer.from_file(BYTE_BPE), 0
    want = {}
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        want.setdefault(i, []).append(np.array(ids, "<u4").tobytes())
    order = [r.id for r in got]
    assert order == sorted(order, key=lambda x: -1 if x is None else x) and len(got) == len(texts)
    for r in got:
        assert r.ids in want[r.id] and r.start == at
        assert r.n_tokens == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids)
        at += r.n_tokens
    none = token_files.write_tokens(empty(spark), token_files.fresh_folder(spark), BYTE_BPE)
    assert token_files.read_tokens(spark, none).count() == 0


PAGES = "page_id long, url string, html string, id long, digest string, payload string"


def pages(spark, values):
    return spark.createDataFrame([(i, u, h, 1, "d", "p") for i, u, h in values], PAGES)


def test_warc_round_trip(spark):
    values = [(5, "http://x/ä b", "<p>one</p>"), (3, None, "<p>one</p>"), (9, "http://y", None), (8, "", ""),
              (1, "http://z", "x" * 300_000), (2, "u", "WARC/1.1\r\n\r\n\r\n"), (None, "n", "<p>one</p>"),
              (7, "a", "only"), (7, "a", "only")] + [(20 + k, "u", f"page {k % 3}") for k in range(30)]
    archives = warc.write_warc(pages(spark, values), warc.fresh_folder(spark), file_bytes=2000)
    got = warc.read_warc(spark, archives).collect()
    assert sum(r.n_records for r in archives.collect()) == len(values) == len(got)
    first = {}
    for i, _, h in values:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    for r in got:
        name = r.record_id.removeprefix(warc.URN)
        i = int(name) if name else None
        payload = next((h or "") for j, _, h in values if j == i)
        assert r.payload_bytes == len(payload.encode())
        assert r.payload_digest == warc.sha1_base32(payload.encode())
        if first[payload] == i:
            assert r.record_type == "response" and r.refers_to is None and r.payload == payload.encode()
        else:
            assert r.record_type == "revisit" and r.refers_to == f"{warc.URN}{first[payload]}"
    none = warc.write_warc(pages(spark, []), warc.fresh_folder(spark))
    assert warc.read_warc(spark, none).count() == 0


def test_small_payloads_stay_responses(spark):
    archives = warc.write_warc(pages(spark, [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "longer"), (4, "d", "longer")]),
                               warc.fresh_folder(spark), min_payload_bytes=3)
    kinds = {r.record_id[-1]: r.record_type for r in warc.read_warc(spark, archives, False).collect()}
    assert kinds == {"1": "response", "2": "response", "3": "response", "4": "revisit"}


def test_reader_is_incremental_and_strict():
    one = warc.record("urn:record:1", "u", b"p" * 200_000, None, "d")
    two = warc.record("urn:record:2", "u", b"q", None, "d")

    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(min(n, 7) if n > 0 else n)

    kinds = [f["warc-record-id"] for f, _ in warc.read_records(Slow(one + two))]
    assert kinds == ["<urn:record:1>", "<urn:record:2>"]
    plain = gzip.decompress(two)
    for broken in (one[:-20], b"junk" + one, gzip.compress(plain + b"x"), gzip.compress(plain[:-2]),
                   gzip.compress(plain.replace(b"q", b"r")), gzip.compress(plain.replace(b"Content-Length", b"X"))):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(broken)))


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_shards_are_even_and_gapless(spark, shards):
    texts = [(i, prose(i, 5 + (i * 37) % 200)) for i in range(600)]
    texts += [(1000 + i, "the same text") for i in range(300)]
    texts += [(i, t) for i, t in odd() if len(t or "") < 6000]
    docs = frame(spark, texts)
    got = kd_shards.kd_tree_shards(docs, shards=shards).collect()
    assert len(got) == len(texts)
    per = {}
    for r in got:
        per.setdefault(r.shard, []).append(r)
    assert sorted(per) == list(range(shards))
    sizes = [sum(r.size for r in rs) for rs in per.values()]
    assert max(sizes) - min(sizes) <= 3 * max(r.size for r in got)
    for rs in per.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    want = sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in texts)
    assert sorted((r.size, r.text_crc32) for r in got) == want


def test_shards_by_target_and_brute_force_median(spark):
    texts = [(i, prose(i, 50 + i % 7)) for i in range(400)]
    got = kd_shards.kd_tree_shards(frame(spark, texts), target_bytes=20_000).collect()
    total = sum(r.size for r in got)
    assert len({r.shard for r in got}) == -(-total // 20_000)
    two = kd_shards.kd_tree_shards(frame(spark, texts), shards=2).collect()
    left = [r.size for r in two if r.shard == 0]
    assert abs(sum(left) - total / 2) <= max(r.size for r in two)
    chars = {i: len(t) for i, t in texts}
    assert max(chars[r.doc_id] for r in two if r.shard == 0) <= min(chars[r.doc_id] for r in two if r.shard == 1)
    assert kd_shards.kd_tree_shards(empty(spark), shards=4).count() == 0
    hot = frame(spark, [(1, "same")] * 96)
    assert {sum(1 for r in kd_shards.kd_tree_shards(hot, shards=8).collect() if r.shard == s)
            for s in range(8)} == {12}
