"""Queries against their DuckDB twins on the smallest tables."""

import pytest
from compare import connect, differences
from conftest import SF_DIR

from carelake.llm import queries


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_document_fingerprints", "op13_merkle_manifest"])
def test_matches_duckdb(spark, name):
    con = connect(SF_DIR)
    assert differences(queries.queries()[name](spark, SF_DIR), con, queries.oracle_sql()[name]) is None
    con.close()
