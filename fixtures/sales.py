"""A sales fact made from the given tables, with spaced headings and raw types.

Input for the queries, the benchmark and the tests; not part of the package.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from factloom import prep, scan

# Heading, expression, raw type in DuckDB's terms. The expressions
# read the same in Spark and in DuckDB.
COLUMNS = (
    ("Sale Key", "l_orderkey * 8 + l_linenumber", "bigint"),
    ("City Key", "l_suppkey", "bigint"),
    ("Customer Key", "o_custkey", "bigint"),
    ("Bill To Customer Key", "o_custkey", "bigint"),
    ("Stock Item Key", "l_partkey", "bigint"),
    ("Invoice Date Key", "o_orderdate", "timestamp"),
    ("Delivery Date Key", "l_shipdate", "timestamp"),
    ("Salesperson Key", "l_suppkey % 10", "bigint"),
    ("WWI Invoice ID", "l_orderkey", "bigint"),
    ("Description", "p_name", "varchar"),
    ("Package", "p_type", "varchar"),
    ("Quantity", "l_quantity", "double"),
    ("Unit Price", "p_retailprice", "double"),
    ("Tax Rate", "l_tax * CAST(12.5 AS DOUBLE)", "double"),
    ("Total Excluding Tax", "l_extendedprice", "double"),
    ("Tax Amount", "l_extendedprice * l_tax", "double"),
    ("Profit", "l_extendedprice * l_discount", "double"),
    ("Total Including Tax", "l_extendedprice * (1 + l_tax)", "double"),
    ("Total Dry Items", "l_quantity", "double"),
    ("Total Chiller Items", "l_quantity * CAST(0.5 AS DOUBLE)", "double"),
    ("Lineage Key", "l_linenumber", "int"),
)

# The columns that the imported table declares.
SALES_DDL = """
SaleKey bigint NOT NULL, CityKey int NOT NULL, CustomerKey int NOT NULL, BillToCustomerKey int NOT NULL,
StockItemKey int NOT NULL, InvoiceDateKey date NOT NULL, DeliveryDateKey date, SalespersonKey int NOT NULL,
WWIInvoiceID int NOT NULL, Description varchar(100) NOT NULL, Package varchar(50) NOT NULL, Quantity int NOT NULL,
UnitPrice decimal(18,2) NOT NULL, TaxRate decimal(18,3) NOT NULL, TotalExcludingTax decimal(18,2) NOT NULL,
TaxAmount decimal(18,2) NOT NULL, Profit decimal(18,2) NOT NULL, TotalIncludingTax decimal(18,2) NOT NULL,
TotalDryItems int NOT NULL, TotalChillerItems int NOT NULL, LineageKey int NOT NULL, Desc1 varchar(50) NOT NULL
"""

_JOINED = "{0} JOIN {1} ON l_orderkey = o_orderkey JOIN {2} ON l_partkey = p_partkey"


def duckdb_from() -> str:
    return _JOINED.format("lineitem", "orders", "part")


def sales_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined tables. The narrow lines and orders are shuffled at any size, so that the rows lie evenly
    over the tasks; no shuffle of the wide rows need follow."""
    names = [f"parquet.`{sf_dir}/{t}.parquet` AS {t}" for t in ("lineitem", "orders", "part")]
    columns = ", ".join(f"{expr} AS `{heading}`" for heading, expr, _ in COLUMNS)
    return spark.sql(f"SELECT /*+ MERGE(orders) */ {columns} FROM {_JOINED.format(*names)}")


def scratch(spark: SparkSession) -> str:
    """A path not used before, in the folder that the session's cluster shares."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="factloom-")
    return f"{shared.rstrip('/')}/factloom-{uuid.uuid4().hex}"


def scratch_schema(spark: SparkSession) -> str:
    """A new catalog schema whose managed tables lie in the shared folder."""
    name = f"factloom_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{scratch(spark)}'")
    return name


_built: dict[tuple[str, str, str], tuple[str, str]] = {}
_lock = Lock()


def _build_once(
    spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]
) -> tuple[str, str]:
    """A frame written as a catalog table once per application: its full name and its directory."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built or not spark.catalog.tableExists(_built[key][0]):
        table, path = f"{scratch_schema(spark)}.{name}", scratch(spark)
        make().write.option("path", path).option("compression", "zstd").saveAsTable(table)
        _built[key] = (table, path)
    return _built[key]


def sales_fact(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The fact as a catalog table: its name and the directory of its Parquet files.

    The joins run once per application; every query after that starts, as the
    real job does, from a table that is there and lies evenly over its files, as the join by
    orders leaves it.
    """
    with _lock:
        return _build_once(spark, sf_dir, "fact_sale", lambda: sales_source(spark, sf_dir))


def planted_fact(spark: SparkSession, sf_dir: str, planted: dict[str, str]) -> DataFrame:
    """The prepared fact with ``planted`` expressions in place of some columns, as files."""
    fact, _ = sales_fact(spark, sf_dir)

    def make() -> DataFrame:
        prepared = prep(spark.table(fact))
        return prepared.selectExpr(*[f"{planted.get(n, n)} AS {n}" for n in prepared.columns])

    with _lock:
        name = "planted_" + hashlib.sha256(repr(sorted(planted.items())).encode()).hexdigest()[:12]
        _, path = _build_once(spark, sf_dir, name, make)
    return scan(spark, path)
