"""Which training-data queries have no SQL, and which test stands in for it."""

import importlib

import pytest

import __spark_entry__ as entry
from corpusmill.llm import queries

#: Query: module and test that hold it against brute force, a library or held-out rows.
INSTEAD_OF_SQL = {
    "op1_pseudonyms": ("test_pseudonyms", "test_all_dates_map_one_to_one"),
    "op3_neighbours": ("test_neighbours", None),
    "op4_multiset_hash": ("test_multiset_hash", None),
    "op5_bpe": ("test_bpe", None),
    "op6_recompression": ("test_recompression", None),
    "op7_toxicity": ("test_linear", "test_toxicity_on_held_out_rows"),
    "op8_quality": ("test_linear", "test_quality_on_held_out_rows"),
    "op9_signature_tree": ("test_signature_tree", None),
    "op10_packing": ("test_packing", "test_bounds_by_hand"),
    "op11_main_text": ("test_main_text", "test_given_pages"),
    "op12_conversation_trie": ("test_conversation_trie", "test_given_conversations"),
    "op13_whitening": ("test_whitening", "test_given_vectors"),
    "pipeline": ("test_pipeline", "test_stages_by_hand"),
}


def test_all_are_registered_and_tested():
    names = set(queries.queries())
    assert names == set(INSTEAD_OF_SQL) | set(queries.oracle_sql())
    assert names <= set(entry.queries()) and set(queries.oracle_sql()) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))


@pytest.mark.parametrize("module, test", sorted(INSTEAD_OF_SQL.values(), key=str))
def test_the_tests_exist(module, test):
    found = importlib.import_module(f"tests.llm.{module}")
    assert hasattr(found, test) if test else any(n.startswith("test_") for n in dir(found))
