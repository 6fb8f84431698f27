"""The corpus queries that SQL can express, bit for bit."""

import pytest

from oracle import compare, connect
from paytide.llm.oracle import ORACLE
from paytide.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"
# Tested against brute force, the tokenizer library or held-out rows instead.
NO_SQL = {
    "op2_host_suffix_array", "op3_inverted_multi_index", "op4_signature_tree_join", "op5_language_id",
    "op7_secret_scan", "op9_bpe_roundtrip", "op10_shard_documents", "op11_covering_simhash", "op13_periodic_runs",
}


def test_every_query_has_sql_or_a_test():
    assert set(REGISTRY) == set(ORACLE) | NO_SQL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(REGISTRY[name](spark, SF), connect(SF), ORACLE[name]) is None
