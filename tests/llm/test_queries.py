import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as E  # noqa: E402

#: Columns that the queries must return, with their types.
COLUMNS = {
    "op1_html_extraction": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op2_minhash_near_dedup": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op3_line_dedup": {"doc_id": "bigint", "source": "string", "text": "string", "n_lines": "bigint", "n_removed": "bigint"},
    "op4_bpe_codec": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op5_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op6_benchmark_decontamination": {"doc_id": "bigint", "item_id": "bigint", "n_shingles": "bigint", "n_shared": "bigint"},
    "op7_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op8_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op9_nearest_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op10_wavelet_ids": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op11_periodic_runs": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
                           "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"},
    "op12_ngram_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op13_conversation_repair": {"conv_id": "bigint", "gaps": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint",
                                 "illegal": "bigint", "cost": "bigint", "audit": "string", "repaired_sha256": "string"},
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, name):
    assert dict(E.queries()[name](spark, "/root/testdata/sf0.001").dtypes) == COLUMNS[name]


def test_all_are_registered():
    assert {n for n in E.queries() if not n.startswith("q_")} == {*COLUMNS, "pipeline"}


def test_sql(spark):
    from oracle_check import compare

    rep = compare(spark, "/root/testdata/sf0.001", [n for n in E.oracle_sql() if n in COLUMNS])
    assert len(rep) == 3 and all(v.startswith("OK") for v in rep.values()), rep
