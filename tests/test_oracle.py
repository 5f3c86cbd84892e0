"""Every registered query against its SQL on DuckDB, and its plan's shape."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from tests.samples import physical_plan

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

# the training-data queries have tests of their own
QUERIES = {k: q for k, q in registered.queries().items() if k not in registered.LLM_QUERIES}
ORACLES = {k: q for k, q in registered.oracle_sql().items() if k not in registered.LLM_SQL}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def ordered(rows):
    return sorted((tuple(row) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("key", QUERIES)
def test_query_equals_its_oracle(spark, oracle, key):
    got = QUERIES[key](spark, SF_DIR)
    expected = oracle.execute(ORACLES[key])
    assert got.columns == [c[0] for c in expected.description]
    rows = ordered(got.collect())
    assert rows and rows == ordered(expected.fetchall())


@pytest.mark.parametrize(
    "key",
    ["scan_parquet", "strip_headings", "derive_desc1", "typed_projection", "contract_rejects"]
    + [k for k in QUERIES if k.startswith("cast_")],
)
def test_row_by_row_queries_do_not_shuffle(spark, key):
    plan = physical_plan(QUERIES[key](spark, SF_DIR))
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan


def test_scans_read_only_the_columns_they_need(spark):
    plan = physical_plan(QUERIES["derive_desc1"](spark, SF_DIR))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_entry(spark):
    result = registered.entry(spark)
    assert result.count() == 6000 and len(result.columns) == 22
