"""Casts that behave the same whatever the session's ANSI setting.

The three ways to treat a value that does not fit its target type:

``null``    the value becomes null (``try_cast``); the contract check then
            finds it in the columns that must not be null.
``fail``    the job stops at the first such value (ANSI ``cast``).
``legacy``  Spark's cast with ANSI off: unreadable text becomes null and an
            integer that is too large wraps around.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What spark.sql.ansi.enabled must be for each mode; try_cast ignores it.
_ANSI_NEEDED = {"null": None, "fail": "true", "legacy": "false"}

# One above the largest value of the integers narrower than a double's 53 bits.
_NARROW = {T.ByteType: 2**7, T.ShortType: 2**15, T.IntegerType: 2**31}

#: Nought in any power, and any number in a power of ten below -99999, which only a longer text could make up for.
_NOUGHT = r"^\s*[+-]?(?:(?:0+\.?0*|\.0+)[eE][+-]?\d+|(?:\d+\.?\d*|\.\d+)[eE]-0*[1-9]\d{5,})\s*$"
#: A digit after 19 that count, or after a digit that was found by this.
_BEYOND = r"(^\s*[+-]?[0.]*+(?:\.?\d){19}|\G(?!^))(\.?)\d"


def require_mode(spark: SparkSession, on_error: str) -> None:
    if on_error not in _ANSI_NEEDED:
        raise ValueError(f"on_error must be one of {sorted(_ANSI_NEEDED)}, not {on_error!r}")
    needed = _ANSI_NEEDED[on_error]
    if needed is not None and spark.conf.get("spark.sql.ansi.enabled").lower() != needed:
        raise ValueError(f"on_error={on_error!r} needs spark.sql.ansi.enabled={needed}")


def _cast(column: Column, target: T.DataType, on_error: str) -> Column:
    return column.try_cast(target) if on_error == "null" else column.cast(target)


def _to_narrow_integer(number: Column, target: T.DataType) -> Column:
    """``try_cast`` for numbers that may be out of range, asked first because it is cheaper.

    A failed ``try_cast`` costs an exception, some hundred times a good one.
    """
    bound = _NARROW[type(target)]
    return F.when((number > -bound - 1) & (number < bound), number.try_cast(target))


def _text_to_integer(text: Column, target: T.DataType, on_error: str) -> Column:
    """The whole part of the number in ``text``; '23.0' and '23.7' are 23, '1.5e3' is 1500.

    The number is read as an exact decimal: an ANSI cast takes '23.0' for no
    integer (and is slow to say so), and a double loses digits of a 19-digit
    key. Up to nine bytes of text need no more than eight decimals, which fit
    the decimal that Spark keeps in one long; only what that leaves open, and
    bad text, takes the wide decimal. Further decimals are rounded on that way, which
    could make 1.99.. a 2, so as text before, every digit after the first 19 that
    count becomes a zero: no integer has more, so its own digits stay, with or without an
    exponent, and what is left has no more than 19 decimals or is below one. Digits are those of
    ASCII: other text is no number.
    """
    short = text.try_cast(T.DecimalType(18, 8)).try_cast(target)
    marked = F.contains(text, F.lit("e")) | F.contains(text, F.lit("E"))
    near = F.when(marked & (F.length(text) < 100_000), F.regexp_replace(text, _NOUGHT, "0")).otherwise(text)
    # group 2, then a zero
    cut = F.regexp_replace(near, _BEYOND, "$1$20")
    # by way of a long: Spark takes a decimal to an int as a double, which rounds
    wide = _cast(_cast(_cast(cut, T.DecimalType(38, 19), on_error), T.LongType(), on_error), target, on_error)
    read = F.coalesce(F.when(F.octet_length(text) <= 9, short), wide)
    return F.when(F.octet_length(text) == F.length(text), read).otherwise(_cast(text, target, on_error))


def cast_to(column: Column, source: T.DataType, target: T.DataType, on_error: str) -> Column:
    """``column`` of type ``source`` as ``target``; no cast at all when they are equal."""
    if source == target:
        return column
    from_text = isinstance(source, T.StringType) and isinstance(target, T.IntegralType)
    if from_text and on_error != "legacy":
        return _text_to_integer(column, target, on_error)
    from_wide = isinstance(source, (T.LongType, T.DoubleType)) and type(target) in _NARROW
    if from_wide and on_error == "null":
        return _to_narrow_integer(column, target)
    return _cast(column, target, on_error)
