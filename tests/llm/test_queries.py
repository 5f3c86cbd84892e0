"""The registered queries against their SQL on DuckDB, or for the columns and rows of their contracts."""

from __future__ import annotations

import hashlib
import os
from pathlib import Path

import duckdb
import pytest

from factloom.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.test_pii import by_hand, by_pattern

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
# The columns that each query returns.
COLUMNS = {
    "op2_language_id": ("documents", "doc_id bigint, held_out boolean, lang_pred string, score double"),
    "op3_token_files": ("documents", "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"),
    "op4_html_extraction": ("pages", "page_id bigint, url string, text string, n_chars bigint"),
    "op5_sharding": ("documents", "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int"),
    "op6_bpe": ("documents", "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"),
    "op8_substring_dedup": ("documents", "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"),
    "op10_simhash": ("documents", "doc_id bigint, fingerprint string, component_id bigint"),
    "op11_fill_in_middle": (
        "documents", "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"),
    "op12_personal_data": (
        "documents", "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"),
}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("key", ORACLE_SQL)
def test_query_equals_its_sql(spark, tables, key):
    got = QUERIES[key](spark, SF_DIR)
    expected = tables.execute(ORACLE_SQL[key])
    assert sorted(got.columns) == sorted(c[0] for c in expected.description)
    order = [got.columns.index(c[0]) for c in expected.description]
    rows = sorted((tuple(r[i] for i in order) for r in got.collect()), key=repr)
    assert rows == sorted(expected.fetchall(), key=repr)


@pytest.mark.parametrize("key", COLUMNS)
def test_every_row_has_its_columns(spark, tables, key):
    table, columns = COLUMNS[key]
    got = QUERIES[key](spark, SF_DIR)
    assert ", ".join(f"{n} {t}" for n, t in got.dtypes) == columns
    ids = sorted(r[0] for r in got.select(got.columns[0]).collect())
    assert ids == sorted(r[0] for r in tables.execute(f"SELECT {got.columns[0]} FROM {table}").fetchall())


def test_personal_data_against_brute_force(spark, tables):
    rows = dict(tables.execute("SELECT doc_id, text FROM documents").fetchall())
    base = {i: by_pattern(t or "") for i, t in rows.items()}
    texts = [rows[i] for i in sorted(rows)]
    terms = by_hand(texts, 0.8, 3, 30.0) if sorted(rows) == list(range(len(rows))) else set()
    for r in QUERIES["op12_personal_data"](spark, SF_DIR).collect():
        listed = [f"{k}:{a}:{b}" for k, of in base[r.doc_id].items() for a, b in of]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(of) for of in base[r.doc_id].values()]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        spans = [s for s in r.spans.split(",") if s]
        assert spans[: len(listed)] == listed
        words = {rows[r.doc_id][int(a) : int(b)].lower() for k, a, b in (s.split(":") for s in spans[len(listed) :])}
        assert words <= terms


def test_all_are_registered():
    assert set(QUERIES) == {*ORACLE_SQL, *COLUMNS, "pipeline"}
