"""The declared columns of a fact table: names, types, null and length rules."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    type: T.DataType
    nullable: bool = False
    max_length: int | None = None


@dataclass(frozen=True)
class Contract:
    fields: tuple[Field, ...]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def schema(self) -> T.StructType:
        """The contract as a schema; nullable throughout, as Spark reads files."""
        return T.StructType([T.StructField(f.name, f.type) for f in self.fields])

    def without(self, *names: str) -> Contract:
        return Contract(tuple(f for f in self.fields if f.name not in names))

    def retyped(self, **types: T.DataType) -> Contract:
        return Contract(tuple(replace(f, type=types.get(f.name, f.type)) for f in self.fields))


def read_ddl(text: str) -> Contract:
    """The contract that a table definition declares: names, types, ``NOT NULL`` and ``varchar(n)``.

    ``text`` is a list of columns or a whole ``CREATE TABLE``, as Spark's parser takes them. Names and
    types in square brackets, ``NULL``, and text in national characters (``nvarchar``, ``nchar``)
    are put in Spark's terms first. A text of n units is a string with a limit of n.
    """
    plain = re.sub(r"\[([^\]]+)\]\s*\[([^\]]+)\]", r"`\1` \2", _column_list(text))
    plain = re.sub(r"\[([^\]]+)\]", r"`\1`", plain)
    plain = re.sub(r"\bn(varchar|char)\b(?=\s*\()", r"\1", plain, flags=re.IGNORECASE)
    plain = re.sub(r"\bvarchar\s*\(\s*max\s*\)", "string", plain, flags=re.IGNORECASE)
    plain = re.sub(r"(?<!\bNOT)\s+NULL\b", "", plain, flags=re.IGNORECASE)
    fields = []
    for f in T.StructType.fromDDL(plain).fields:
        limit = f.dataType.length if isinstance(f.dataType, T.VarcharType | T.CharType) else None
        fields.append(Field(f.name, T.StringType() if limit is not None else f.dataType, f.nullable, limit))
    return Contract(tuple(fields))


def _column_list(text: str) -> str:
    """What stands between the first bracket of a CREATE TABLE and the one that closes it."""
    if not re.match(r"\s*CREATE\b", text, re.IGNORECASE):
        return text
    start = text.index("(")
    depth = 0
    for at, c in enumerate(text[start:], start):
        depth += {"(": 1, ")": -1}.get(c, 0)
        if depth == 0:
            return text[start + 1 : at]
    raise ValueError("the list of columns is not closed")


_MONEY = T.DecimalType(18, 2)

# The columns of the prepared sales fact, in their declared order.
SALES = Contract((
    Field("SaleKey", T.LongType()),
    Field("CityKey", T.IntegerType()),
    Field("CustomerKey", T.IntegerType()),
    Field("BillToCustomerKey", T.IntegerType()),
    Field("StockItemKey", T.IntegerType()),
    Field("InvoiceDateKey", T.DateType()),
    Field("DeliveryDateKey", T.DateType(), nullable=True),
    Field("SalespersonKey", T.IntegerType()),
    Field("WWIInvoiceID", T.IntegerType()),
    Field("Description", T.StringType(), max_length=100),
    Field("Package", T.StringType(), max_length=50),
    Field("Quantity", T.IntegerType()),
    Field("UnitPrice", _MONEY),
    Field("TaxRate", _MONEY),
    Field("TotalExcludingTax", _MONEY),
    Field("TaxAmount", _MONEY),
    Field("Profit", _MONEY),
    Field("TotalIncludingTax", _MONEY),
    Field("TotalDryItems", T.IntegerType()),
    Field("TotalChillerItems", T.IntegerType()),
    Field("LineageKey", T.IntegerType()),
    Field("Desc1", T.StringType(), max_length=50),
))

# The imported and loaded table declares one more decimal for the tax rate
# than the prepared files hold.
SALES_IMPORT = SALES.retyped(TaxRate=T.DecimalType(18, 3))
