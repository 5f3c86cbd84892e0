"""DuckDB SQL for the registered queries, written apart from the Spark code."""

from __future__ import annotations

from fixtures.sales import COLUMNS, duckdb_from

# Target type by column of the prepared table, in order.
TARGETS = (
    ("SaleKey", "bigint"),
    ("CityKey", "int"),
    ("CustomerKey", "int"),
    ("BillToCustomerKey", "int"),
    ("StockItemKey", "int"),
    ("InvoiceDateKey", "date"),
    ("DeliveryDateKey", "date"),
    ("SalespersonKey", "int"),
    ("WWIInvoiceID", "int"),
    ("Description", "varchar"),
    ("Package", "varchar"),
    ("Quantity", "int"),
    ("UnitPrice", "decimal(18,2)"),
    ("TaxRate", "decimal(18,2)"),
    ("TotalExcludingTax", "decimal(18,2)"),
    ("TaxAmount", "decimal(18,2)"),
    ("Profit", "decimal(18,2)"),
    ("TotalIncludingTax", "decimal(18,2)"),
    ("TotalDryItems", "int"),
    ("TotalChillerItems", "int"),
    ("LineageKey", "int"),
)

# Violations planted by value; the expressions read the same in Spark and in
# DuckDB. A null DeliveryDateKey is allowed.
PLANTED = {
    "SaleKey": "nullif(SaleKey, 4958)",
    "CityKey": "nullif(CityKey, 3)",
    "CustomerKey": "nullif(CustomerKey, 3)",
    "BillToCustomerKey": "nullif(BillToCustomerKey, 2)",
    "StockItemKey": "nullif(StockItemKey, 7)",
    "InvoiceDateKey": "nullif(InvoiceDateKey, DATE '1995-03-05')",
    "DeliveryDateKey": "nullif(DeliveryDateKey, DATE '1995-03-07')",
    "SalespersonKey": "nullif(SalespersonKey, 9)",
    "WWIInvoiceID": "nullif(WWIInvoiceID, 1)",
    "Description": "repeat(Description, 12)",
    "Package": "nullif(repeat(Package, 8), repeat('SMALL', 8))",
    "Quantity": "nullif(Quantity, 50)",
    "UnitPrice": "nullif(UnitPrice, CAST(900.1 AS decimal(18,2)))",
    "TaxRate": "nullif(TaxRate, CAST(0.25 AS decimal(18,2)))",
    "TaxAmount": "nullif(TaxAmount, CAST(0 AS decimal(18,2)))",
    "Profit": "nullif(Profit, CAST(0 AS decimal(18,2)))",
    "TotalDryItems": "nullif(TotalDryItems, 1)",
    "TotalChillerItems": "nullif(TotalChillerItems, 0)",
    "LineageKey": "nullif(LineageKey, 6)",
    "Desc1": "repeat(Desc1, 9)",
}

NULLABLE = "DeliveryDateKey"
LIMITS = {"Description": 100, "Package": 50, "Desc1": 50}


def source(spaced: bool = False) -> str:
    columns = [f'{e} AS "{h if spaced else h.replace(" ", "")}"' for h, e, _ in COLUMNS]
    return f"SELECT {', '.join(columns)} FROM {duckdb_from()}"


def _typed(expr: str, raw: str, target: str) -> str:
    """DuckDB rounds a double that becomes an integer, and makes decimals of its binary value."""
    if raw == "double":
        expr = f"trunc({expr})" if target == "int" else f"CAST({expr} AS varchar)"
    return f"try_cast({expr} AS {target})"


def prepared() -> str:
    columns = [
        f'{_typed(expr, raw, target)} AS "{name}"'
        for (_, expr, raw), (name, target) in zip(COLUMNS, TARGETS, strict=True)
    ]
    columns.append('substring(p_name, 4, 6) AS "Desc1"')
    return f"SELECT {', '.join(columns)} FROM {duckdb_from()}"


def imported() -> str:
    return f"SELECT * REPLACE (CAST(TaxRate AS decimal(18,3)) AS TaxRate) FROM ({prepared()})"


def planted() -> str:
    replaced = ", ".join(f"{expr} AS {name}" for name, expr in PLANTED.items())
    return f"SELECT * REPLACE ({replaced}) FROM ({prepared()})"


def _utf16(text: str) -> str:
    """Characters, plus one for each that needs two UTF-16 units."""
    outside = rf"regexp_replace({text}, '[\x{{0}}-\x{{FFFF}}]', '', 'g')"
    return f"length({text}) + length({outside})"


def _rules() -> dict[str, str]:
    rules = {}
    for name, _ in (*TARGETS, ("Desc1", "varchar")):
        if name != NULLABLE:
            rules[f"{name}_nulls"] = f"{name} IS NULL"
        if name in LIMITS:
            rules[f"{name}_too_long"] = f"coalesce({_utf16(name)} > {LIMITS[name]}, false)"
    return rules


def _count(rules: dict[str, str], table: str) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE {cond}) AS {name}" for name, cond in rules.items())
    return f"SELECT {counts} FROM {table}"


def null_counts() -> str:
    return _count({n: c for n, c in _rules().items() if n.endswith("_nulls")}, f"({planted()})")


def length_counts() -> str:
    return _count({n: c for n, c in _rules().items() if n.endswith("_too_long")}, f"({planted()})")


def text_counts() -> str:
    rules = {
        "text_nulls": "text IS NULL",
        "text_too_long": f"{_utf16('text')} > 100",
        "source_nulls": "source IS NULL",
        "source_too_long": f"{_utf16('source')} > 4",
    }
    return _count(rules, "documents")


def rejected() -> str:
    reasons = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in _rules().items())
    reasons = f"concat_ws(',', {reasons})"
    return f"SELECT *, {reasons} AS violations FROM ({planted()}) WHERE {reasons} <> ''"


def accepted() -> str:
    broken = " OR ".join(f"({cond})" for cond in _rules().values())
    return f"SELECT * FROM ({planted()}) WHERE NOT ({broken})"


def prepared_types() -> str:
    kinds = {"int": "int", "varchar": "string"}
    values = ", ".join(
        f"({n}, '{name}', '{kinds.get(kind, kind)}')" for n, (name, kind) in enumerate((*TARGETS, ("Desc1", "varchar")), 1))
    return (
        "SELECT CAST(position AS bigint) AS position, name, type, row_count"
        f" FROM (VALUES {values}) AS v(position, name, type), (SELECT count(*) AS row_count FROM ({prepared()}))"
    )


def all_counts() -> str:
    return _count(_rules(), f"({planted()})")


def drifted() -> str:
    """Odd lines were written without their package, even ones without the derived text."""
    gone = "CASE WHEN LineageKey % 2 = 1 THEN NULL ELSE Package END AS Package, CASE WHEN LineageKey % 2 = 0 THEN NULL ELSE Desc1 END AS Desc1"
    return f"SELECT * REPLACE ({gone}), CAST(2 AS bigint) AS schemas FROM ({prepared()})"


def resumed() -> str:
    steps = "VALUES ('export', 'ran', 'skipped'), ('prep', 'ran', 'skipped'), ('load', 'failed', 'ran')"
    return f"SELECT step, first_run, second_run, row_count FROM ({steps}) AS v(step, first_run, second_run), (SELECT count(*) AS row_count FROM ({source()}))"


def traced() -> str:
    """Raw rows: a quantity that is null, and a package of eleven times its text."""
    broken = 'nullif("Quantity", 50) AS "Quantity", CASE WHEN "Package" = \'SMALL\' THEN repeat("Package", 11) ELSE "Package" END AS "Package"'
    reasons = "concat_ws(',', CASE WHEN \"Package\" LIKE 'SMALLSMALL%' THEN 'Package_too_long' END, CASE WHEN \"Quantity\" IS NULL THEN 'Quantity_nulls' END)"
    return f"SELECT *, {reasons} AS violations FROM (SELECT * REPLACE ({broken}) FROM ({source(spaced=True)})) WHERE {reasons} <> ''"


def chain_split() -> str:
    broken = (
        "SELECT * REPLACE (nullif(Quantity, 50) AS Quantity,"
        f" CASE WHEN Package = 'SMALL' THEN repeat(Package, 11) ELSE Package END AS Package) FROM ({imported()})"
    )
    rules = _rules()
    reasons = ", ".join(f"CASE WHEN {rules[n]} THEN '{n}' END" for n in ("Package_too_long", "Quantity_nulls"))
    return f"SELECT *, concat_ws(',', {reasons}) AS violations FROM ({broken})"
