"""Registered queries against their SQL twins on the smallest tables.

The default run takes a cross-section; ``CORVANE_ALL=1`` runs every query (``check_queries.py`` does so at any scale).
"""

import os

import pytest

import __spark_entry__ as entry
from check_queries import compare, oracle

FOLDER = "/root/testdata/sf0.001"
SECTION = (
    "a1_terms_count a6_flatten_metadata a11_folder_sizes a14_merge_entity_mentions a21_latency_summary c1_chunk_by_tokens "
    "c5_split_children c15_qa_pairs c16_tag_pairs c18_infer_column_types f4_meta_filter f9_metadata_scope f18_toc_entries "
    "g3_cooccurrence_edges g9_resolve_pairs g11_connected_components g19_path_scores j11_nhop_paths k3_term_weights "
    "l6_record_list m4_feedback_deltas m7_edit_metadata m8_remember r1_text_match r2_vector_match r16_message_search "
    "s6_listing_diff s13_write_chunks st4_memory_state u5_digit_in_difference w4_fifo_evict w9_cooccurrence x14_highlight "
    "x20_parse_tag_features"
).split()
PLANS, TWINS = entry.queries(), entry.oracle_sql()
NAMES = list(PLANS) if os.environ.get("CORVANE_ALL") else SECTION


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    ok, message = compare(spark, oracle(FOLDER), PLANS[name], TWINS.get(name), FOLDER)
    assert ok, message


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(PLANS)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
