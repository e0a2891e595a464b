"""The registered training-data queries: columns, and rows of those that SQL can express."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
sys.path.insert(0, str(Path(__file__).parents[2]))

import __spark_entry__ as registry
from compare import database, difference
from tickmart.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op1_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op2_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op3_warc_revisits": "record_id canonical_url resolved_id outcome",
    "op4_ngram_join": "doc_id copy_of class_id n_links",
    "op5_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op6_language_id": "doc_id held_out lang_pred score",
    "op7_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op8_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op9_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op10_url_filters": "page_id host path rule verdict",
    "op11_piece_encoding": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op12_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op13_spelling_variants": "word form root n n_near form_n",
}


def test_all_are_registered():
    assert QUERIES.items() <= registry.queries().items() and "pipeline" in registry.queries()
    assert ORACLES.items() <= registry.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_columns(spark, sf, name):
    assert QUERIES[name](spark, sf).columns[: len(COLUMNS[name].split())] == COLUMNS[name].split()


@pytest.mark.parametrize("name", list(ORACLES))
def test_rows_are_those_of_sql(spark, sf, name):
    message, rows = difference(spark, database(sf), sf, QUERIES[name], ORACLES[name])
    assert not message
    assert rows > 0


def test_revisits_of_the_query_have_every_outcome(spark, sf):
    rows = QUERIES["op3_warc_revisits"](spark, sf).select("record_id", "resolved_id", "outcome").collect()
    found = {o: sum(r["outcome"] == o for r in rows) for o in ("resolved", "mismatch", "unproven", "unknown")}
    assert min(found.values()) > 0 and sum(found.values()) == len(rows)
    # responses right before and further back
    assert {r["resolved_id"] - r["record_id"] for r in rows if r["outcome"] == "resolved"} == {1, 2}
