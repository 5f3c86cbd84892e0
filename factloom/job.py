"""Command line: ``spark-submit factloom/job.py prep SOURCE TARGET`` or ``... chain TABLE BASE LOADED``."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import types as T

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from factloom.contract import SALES, SALES_IMPORT, Contract, Field, read_ddl
from factloom.plans.chain import run_chain
from factloom.plans.prep import DESC1, Substring, run_prep


def read_contract(spark: SparkSession, path: str) -> tuple[Contract, Contract, tuple[Substring, ...]]:
    """The contract, its declared form and the derived columns, from a JSON file that Spark can read.

    ``columns`` lists name, type (as in Spark SQL) and, where they apply, ``nullable``,
    ``max_length`` and ``declared``, the type after the import. ``derive`` lists name,
    source, start and length.
    """
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    data = json.loads(text)
    columns = data["columns"]
    fields = tuple(
        Field(c["name"], _type(c["type"]), c.get("nullable", False), c.get("max_length")) for c in columns)
    contract = Contract(fields)
    declared = contract.retyped(**{c["name"]: _type(c["declared"]) for c in columns if "declared" in c})
    derive = tuple(Substring(d["name"], d["source"], d["start"], d["length"]) for d in data.get("derive", []))
    return contract, declared, derive


def read_declared(spark: SparkSession, path: str) -> Contract:
    """The declared contract from a file with a table definition; see ``read_ddl``."""
    return read_ddl("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


def _type(text: str) -> T.DataType:
    return T.DataType.fromDDL(text)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description="Prepare files, or run the whole chain over a table.")
    commands = parser.add_subparsers(dest="command", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--contract", help="a JSON file with the columns; default: the sales fact")
    common.add_argument("--declared", help="a file with the table definition that the rows must keep to")
    common.add_argument("--on-error", default="null", choices=["null", "fail", "legacy"])
    common.add_argument(
        "--partitions", type=lambda text: text if text == "auto" else int(text),
        help="spread the rows over this many files, or 'auto'",
    )
    prep = commands.add_parser("prep", parents=[common], help="prepare the files in SOURCE into TARGET")
    prep.add_argument("source")
    prep.add_argument("target")
    prep.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    prep.add_argument("--multi-line", action="store_true", help="quoted CSV values may hold line breaks")
    prep.add_argument("--enforce", action="store_true", help="stop at a row that breaks the contract")
    prep.add_argument("--rejects", help="write rows that break the contract here and go on")
    prep.add_argument("--trace", action="store_true", help="rejects carry the file and row they come from")
    prep.add_argument("--drift", default="raise", choices=["raise", "unite", "ignore"], help="what to do where files differ in columns or types")
    chain = commands.add_parser("chain", parents=[common], help="export TABLE under BASE, prepare, import, load")
    chain.add_argument("table")
    chain.add_argument("base")
    chain.add_argument("loaded")
    chain.add_argument("--on-violation", default="fail", choices=["fail", "split"])
    chain.add_argument("--resume", action="store_true", help="skip the steps that an earlier run has done on the same files")
    for name in ("exported-as", "imported-as"):
        chain.add_argument(f"--{name}")
    for name, default in (("export", "export"), ("prepared", "prepared"), ("rejected", "rejected")):
        chain.add_argument(f"--{name}-location", default=default)
    return parser


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    """Run one command. A session that is handed in stays open."""
    args = _parser().parse_args(argv)
    own = spark is None
    spark = spark or SparkSession.builder.appName("factloom").getOrCreate()
    try:
        contract, declared, derive = (
            read_contract(spark, args.contract) if args.contract else (SALES, SALES_IMPORT, DESC1))
        if args.declared:
            declared = read_declared(spark, args.declared)
        if args.command == "prep":
            run_prep(
                spark, args.source, args.target, args.format, contract, derive, args.on_error, args.partitions,
                declared if args.enforce or args.rejects else None, args.rejects, args.multi_line, args.drift, args.trace)
        else:
            run_chain(
                spark, args.table, args.base, args.loaded, contract, declared, derive, args.on_error,
                args.on_violation, args.partitions, args.imported_as, args.exported_as,
                args.export_location, args.prepared_location, args.rejected_location, args.resume,
                lambda step, what: print(f"{step}: {what}"))
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    main()
