"""The queries of the package, and the pipeline against its stages done one by one in Python."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from clickweave.llm import chunk_dedup, decontaminate
from clickweave.llm.bpe import codec
from clickweave.llm.common import WordCache
from clickweave.llm.compression import Bands, judge
from tests.llm.helpers import DOCS, empty, frame, odd, prose
from tests.llm.test_dedup import brute_components, near_copies

import public_tokenizers
import zstandard


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_copies", "repeated_passages", "decontamination", "tokens"]
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def brute_pipeline(texts, items):
    packer = zstandard.ZstdCompressor(level=3)
    texts = [(i, t) for i, t in texts if judge((t or "").encode(), Bands(), packer)[-1]]
    component = {}
    for (i, t), (j, _, c) in zip(sorted(texts, key=lambda x: repr((x[0],))), sorted(
            brute_components(texts), key=lambda x: repr((x[0],)))):
        assert i == j
        component[i] = c
    texts = [(i, t) for n, (i, t) in enumerate(texts) if component[i] == i and i not in [x for x, _ in texts[:n]]]
    seen, cut = set(), []
    for i, t in sorted(texts):
        data = t.encode()
        digests, starts, ends, words = (x.tolist() for x in chunk_dedup.chunks(data))
        parts = [{"start": s, "end": e, "words": w, "first_id": 0}
                 for d, s, e, w in zip(digests, starts, ends, words) if d in seen or digests.index(d) < starts.index(s)]
        seen |= set(digests)
        spans = [{"start": s, "end": e} for s, e, *_ in chunk_dedup.runs(parts, 20)]
        cut.append((i, chunk_dedup.cut_out(data, spans)))
    index = decontaminate.Index([i for i, _ in items], [t.encode() for _, t in items])
    cache = WordCache(decontaminate.bare_hash)
    own = codec(open(public_tokenizers.path("word_bpe_49k.json")).read())
    return sorted((i, own.encode(t)) for i, t in cut
                  if not index.matches(decontaminate.word_hashes(t, cache), decontaminate.Rule()))


def test_pipeline_equals_brute_force(spark, tmp_path):
    items = [(1, prose(4000, 25)), (2, prose(4001, 40))]
    shared = prose(5000, 80)
    texts = near_copies() + [(600 + k, prose(700 + k, 120) + " " + shared) for k in range(6)]
    texts += [(700, prose(800, 90) + " " + items[0][1] + " " + prose(801, 30)), (701, prose(802, 200)),
              (702, "ha " * 300), (703, None)]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted((r.doc_id, bytes(r.ids)) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == brute_pipeline(texts, items)
    assert 700 not in dict(got) and 701 in dict(got) and 702 not in dict(got)


@pytest.mark.parametrize("rows", ["odd", "empty"])
def test_every_stage_takes_odd_and_empty_tables(spark, tmp_path, rows):
    docs = frame(spark, odd()) if rows == "odd" else empty(spark)
    spark.createDataFrame([(None, None), (1, "")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "tokens":
            assert out.columns == docs.columns
        assert out.count() <= docs.count()
    assert docs.columns == spark.createDataFrame([], DOCS).columns
