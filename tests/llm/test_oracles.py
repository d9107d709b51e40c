"""Queries that SQL can express, against DuckDB; the others must give one row per document."""

from __future__ import annotations

import duckdb
import pytest
from compare import TABLES, compare

from tests.conftest import SMALL
from tillwise.llm import queries


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, con, name):
    ok, note, _ = compare(spark, con, SMALL, name, queries.QUERIES[name], queries.ORACLES[name])
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op8_section_tokens", "op12_ranked_search", "op13_spelling_variants"}))
def test_one_row_per_document(spark, name):
    got = [r["doc_id"] for r in queries.QUERIES[name](spark, SMALL).select("doc_id").collect()]
    assert sorted(got) == list(range(200))
