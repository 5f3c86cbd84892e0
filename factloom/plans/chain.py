"""The full chain: export a table, prepare it, declare the result, load it."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from factloom.contract import SALES, SALES_IMPORT, Contract
from factloom.operators.checks import require_types
from factloom.plans.compiling import compiled_methods
from factloom.plans.prep import DESC1, Substring, run_prep
from factloom.sources.files import join_path, require_apart, require_outputs_apart, roots, scan
from factloom.sources.loading import load_record, load_table, recover_load
from factloom.sources.publishing import fingerprint, note_of, recover, require_one_publication
from factloom.sources.tables import WrongKind, export_table, import_external, table_kind, table_location

RAN, SKIPPED = "ran", "skipped"


def run_chain(
    spark: SparkSession,
    source_table: str,
    base: str,
    target_table: str,
    contract: Contract = SALES,
    declared: Contract = SALES_IMPORT,
    derive: Sequence[Substring] = DESC1,
    on_error: str = "null",
    on_violation: str = "fail",
    partitions: int | str | None = None,
    imported_as: str | None = None,
    exported_as: str | None = None,
    export_location: str = "export",
    prepared_location: str = "prepared",
    rejected_location: str = "rejected",
    resume: bool = False,
    on_step: Callable[[str, str], None] | None = None,
) -> str:
    """Run the four steps in order; return the loaded table's name.

    Each step leaves Parquet under ``base`` (``export``, ``prepared``) for the
    next, so a lost executor costs only the tasks it was running. An error stops the chain.

    Every step keeps a ledger with what it published: a fingerprint of the files it has read (names,
    lengths, times), of those it has written, and of its parameters. With ``resume`` a step whose
    ledger still holds is skipped, so that a chain that broke off goes on at the first step that has not
    been done on the present files. What is no table of files, such as a view over a
    query, has no fingerprint and is always exported. ``on_step`` is told each step and
    whether it ran.

    ``partitions`` spreads the rows of the loaded table; see ``place``.
    ``exported_as`` and ``imported_as`` name catalog entries over the files.

    No row that breaks the ``declared`` contract is loaded. With
    ``on_violation="fail"`` the first one stops the chain while the prepared
    files are written, before the target is touched; with ``"split"`` the same
    pass writes such rows, with the rules they break, to ``base``/rejected, and
    only the others are loaded.
    """
    if on_violation not in ("fail", "split"):
        raise ValueError(f"on_violation must be 'fail' or 'split', not {on_violation!r}")
    exported, prepared, rejected = (join_path(base, at) for at in (export_location, prepared_location, rejected_location))
    split = on_violation == "split"
    outputs = [exported, prepared, *([rejected] if split else [])]
    require_outputs_apart(spark, *outputs)
    held = table_location(spark, target_table)
    if held is not None:
        require_apart(spark, held, base)  # replacing the target would delete the steps' files
    for name in filter(None, (imported_as, exported_as)):
        if table_kind(spark, name) == "MANAGED":
            raise WrongKind(f"{name} is a managed table and would lose its files")
    told = on_step or (lambda step, what: None)
    for path in outputs:
        recover(spark, path)
    recover_load(spark, target_table)

    source = spark.table(source_table)
    seen = _table_print(source)
    ledger = {"step": "export", "input": seen, "parameters": _digest(source_table, source.schema.json())}
    done = resume and seen is not None and _holds(spark, exported, ledger)
    if not done:
        export_table(spark, source_table, base, export_location, external=exported_as, about={"ledger": ledger})
    elif exported_as is not None and not spark.catalog.tableExists(exported_as):
        spark.sql(f"CREATE TABLE {exported_as} USING parquet LOCATION '{exported}'")
    told("export", SKIPPED if done else RAN)

    ledger = {
        "step": "prep", "input": fingerprint(spark, exported), "parameters": _digest(contract, declared, tuple(derive), on_error, on_violation)}
    done = resume and _holds(spark, prepared, ledger) and (not split or _holds(spark, rejected, ledger))
    if not done:
        run_prep(
            spark, exported, prepared, contract=contract, derive=derive, on_error=on_error, declared=declared,
            rejects=rejected if split else None, drift="ignore", about={"ledger": ledger})
    told("prep", SKIPPED if done else RAN)
    # the files' own schema: after the import every column has its declared type
    require_types(scan(spark, prepared), _as_prepared(contract, declared), extras=True)
    if split:
        require_one_publication(spark, prepared, rejected)

    loadable = import_external(spark, base, prepared_location, declared=declared, name=imported_as, drift="ignore")
    told("import", RAN)
    made_of = f"{fingerprint(spark, prepared)} {_digest(declared, partitions)}"
    shown = load_record(spark, target_table) if resume else None
    done = shown is not None and shown["source"] == made_of
    if not done:
        with compiled_methods(spark):
            load_table(loadable, target_table, partitions, source=made_of)
    told("load", SKIPPED if done else RAN)
    return target_table


def _digest(*values: object) -> str:
    return hashlib.sha256(repr(values).encode()).hexdigest()


def _table_print(table: DataFrame) -> str | None:
    """A fingerprint of the files behind a table and of what a view makes of them; None if there is more behind it."""
    plan, paths = table._jdf.queryExecution(), roots(table)
    if plan.analyzed().collectLeaves().size() != 1 or not plan.analyzed().deterministic() or not paths:
        return None
    # optimized, in which the day of a query is a value
    shape = re.sub(r"#\d+L?", "", plan.optimizedPlan().toString())
    return f"{fingerprint(table.sparkSession, *paths)} {_digest(shape)}"


def _holds(spark: SparkSession, directory: str, ledger: dict[str, object]) -> bool:
    """Whether a directory was published by this step, from this input, and is as it was published."""
    note = note_of(spark, directory)
    return note is not None and note.get("ledger") == ledger and note.get("files") == fingerprint(spark, directory, moved=True)


def _as_prepared(contract: Contract, declared: Contract) -> Contract:
    """The declared columns with the types that preparation gives them."""
    types = {f.name: f.type for f in contract.fields}
    return declared.retyped(**{n: types[n] for n in declared.names if n in types})
