"""Columns, types and row counts of the registered queries."""

import pytest

import __spark_entry__ as contract
from tests.conftest import SMALL

WANTED = {
    "op1": "doc_id bigint, held_out boolean, score double, predicted int",
    "op2": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op3": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
           "n_repeat_words bigint, base_failed boolean, kept boolean",
    "op6": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op7": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op8": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op9": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op10": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
            "base_labels string, labels string, score double",
    "op11": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
    "op12": "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
            "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint",
    "op13": "doc_id bigint, held_out boolean, lang_pred string, score double",
}
ROWS = {"op2": "pages", "op11": None, "op12": None}


@pytest.mark.parametrize("op", WANTED)
def test_columns(spark, op):
    name = next(n for n in contract.queries() if n.startswith(op + "_"))
    df = contract.queries()[name](spark, SMALL)
    types = dict(df.dtypes)
    for column in WANTED[op].split(", "):
        column, kind = column.split(" ")
        assert types[column] == kind, column
    source = ROWS.get(op, "documents")
    if source:
        assert df.count() == spark.read.parquet(f"{SMALL}/{source}.parquet").count()
