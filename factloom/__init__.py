"""Prepare, check and load a fact table with Spark DataFrames."""

from factloom.contract import SALES, SALES_IMPORT, Contract, Field, read_ddl
from factloom.operators.casting import cast_columns
from factloom.operators.checks import ContractViolation, check, check_rejects, enforce, split
from factloom.operators.deriving import derive_substring
from factloom.operators.headings import strip_headings
from factloom.plans.chain import run_chain
from factloom.plans.prep import Substring, prep, run_prep, trace_back
from factloom.sources.audit import SchemaDrift, file_schemas
from factloom.sources.files import read_in, scan, write_parquet
from factloom.sources.loading import load_table, recover_load
from factloom.sources.tables import drop, drop_external, drop_managed, export_table, import_external
from factloom.streaming.prep_batches import prep_batches
from factloom.streaming.prep_stream import prep_stream

__all__ = [
    "Contract",
    "ContractViolation",
    "Field",
    "SALES",
    "SALES_IMPORT",
    "SchemaDrift",
    "Substring",
    "cast_columns",
    "check",
    "check_rejects",
    "derive_substring",
    "drop",
    "drop_external",
    "drop_managed",
    "enforce",
    "export_table",
    "file_schemas",
    "import_external",
    "load_table",
    "prep",
    "prep_batches",
    "prep_stream",
    "read_ddl",
    "read_in",
    "recover_load",
    "run_chain",
    "run_prep",
    "scan",
    "split",
    "strip_headings",
    "trace_back",
    "write_parquet",
]
