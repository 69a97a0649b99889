"""The queries with SQL, and the contract's columns of all of them."""

from __future__ import annotations

import pytest
from moodframe.llm import queries
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op2_substrings": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op3_chat": {"conv_id", "turn", "seg", "role", "text", "rendered"},
    "op4_neardup": {"doc_id", "class_id", "kept"},
    "op5_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op6_fingerprints": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    "op7_quality": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op8_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op9_lines": {"doc_id", "text", "lines", "lines_removed"},
    "op10_html": {"page_id", "url", "text", "n_chars"},
    "op11_runs": {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"},
    "op12_warc": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op13_search": {"item_id", "rank", "doc_id", "score"},
}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    r = compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLE[name])
    assert r["ok"], r


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert COLUMNS[name] <= set(df.columns)
    kinds = dict(df.dtypes)
    for c in COLUMNS[name] & {"start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "n_bytes", "n_removed", "n_spans",
                              "n_email", "n_ip", "n_card", "n_phone", "n_chars", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                              "n_repeat_words", "size", "source_size", "taken", "n_runs", "period", "exponent_milli", "payload_bytes", "refers_to", "score"}:
        assert kinds[c] == "bigint", c
    assert set(queries.QUERIES) == set(COLUMNS)
