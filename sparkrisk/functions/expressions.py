"""Row-wise expressions used by cleaning, validation and encoding."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as a number in a text cell. Narrower than the engine's own parser, which
# also takes a trailing type letter and hexadecimal floats; and texts that cannot be
# numbers are told apart without running into a parse error for each of them.
_NUMBER = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?|nan)\s*$"


def ident(name: str) -> Column:
    """Column by exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Those of ``names`` that the table has, in the given order."""
    have = set(df.columns)
    return [n for n in names if n in have]


def to_number(c: Column, dtype: T.DataType) -> Column:
    """Double value of a cell; unparsable text and NaN become NULL, infinities stay."""
    if isinstance(dtype, T.StringType):
        parsed = F.when(c.rlike(_NUMBER), c.try_cast("double"))
    elif isinstance(dtype, (T.NumericType, T.BooleanType)):
        parsed = c.cast("double")
    else:
        return F.lit(None).cast("double")
    if isinstance(dtype, (T.StringType, T.DoubleType, T.FloatType)):
        return F.nanvl(parsed, F.lit(None).cast("double"))
    return parsed


def number_or_null(c: Column) -> Column:
    """A numeric column as double, NaN as NULL (NaN compares above every limit)."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def as_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    return c.cast("string")


def is_dirty(c: Column, dtype: T.DataType) -> Column:
    """A cell that holds something, but no number (text ``nan`` reads as missing)."""
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return F.lit(False)
    missing = c.isNull()
    if isinstance(dtype, T.StringType):
        missing = missing | (F.lower(F.trim(c)) == "nan")
    return ~missing & to_number(c, dtype).isNull()


def is_legal(c: Column, allowed: Iterable) -> Column:
    """Membership test that is false, not NULL, for a missing cell."""
    values = list(allowed)
    if not values:
        return F.lit(False)
    return F.coalesce(c.isin(values), F.lit(False))
