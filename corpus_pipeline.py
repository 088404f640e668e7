"""Documents to model input: rules, near copies, repeated passages, benchmark, tokens.

Each stage takes what the one before it kept; run() writes every result as
Parquet below the shared scratch folder and reads it again, so a lost executor
costs one stage at most.

Defined results: null and empty texts fail the first stage; a null doc_id is
carried, and among linked texts without any id one stays; of rows that repeat id
and text one stays; columns beside those of documents are kept until the last stage;
an empty table, or an empty benchmark, passes through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clickweave.llm.bpe import bpe_encode
from clickweave.llm.chunk_dedup import drop_repeated
from clickweave.llm.common import table
from clickweave.llm.compression import keep_documents
from clickweave.llm.decontaminate import drop_contaminated
from clickweave.llm.jaccard_join import one_per_component
from clickweave.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose compression and repetition look like prose."""
    return keep_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that 5-word shingles link at 0.8 or more, the one with the smallest id."""
    return one_per_component(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier place has already."""
    return drop_repeated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids as little-endian unsigned 32-bit integers.

    The executors' heaps have grown in the stages before, so tasks remember fewer words.
    """
    return bpe_encode(docs, public_tokenizers.path("word_bpe_49k.json"), decode=True,
                      words_kept=150_000)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: Compression ratios, content-defined cuts and merges can't be worked out in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
