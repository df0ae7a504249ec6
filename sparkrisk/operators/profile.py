"""Profiling reports. Every function returns a DataFrame; nothing is printed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrisk.functions import as_text, column_type, ident, is_dirty, is_legal, present
from sparkrisk.operators.stats import stat_table


def table_profile(df: DataFrame) -> DataFrame:
    """``(column, dtype, n_rows, non_null, nulls)``, one row per column."""
    return stat_table(df, "column", {
        f.name: {
            "dtype": F.lit(f.dataType.simpleString()),
            "n_rows": F.count(F.lit(1)),
            "non_null": F.count(ident(f.name)),
            "nulls": F.count_if(ident(f.name).isNull()),
        }
        for f in df.schema.fields
    })


def table_shape(df: DataFrame, label: str = "table") -> DataFrame:
    """``(label, n_rows, n_columns)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(label).alias("label"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns")
    )


def preview(df: DataFrame, order_by: str | Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order, kept by a top-n per task."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*[ident(k) for k in keys]).limit(n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(value, n)`` of present values; order by ``n`` descending when displayed."""
    c = ident(column)
    return df.where(c.isNotNull()).groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """``(value, n, share)``; the total is a scalar subquery."""
    counts = value_counts(df, column)
    total = df.agg(F.count(ident(column)).alias("total"))
    return counts.select("value", "n", F.try_divide(F.col("n"), total.scalar()).alias("share"))


def dirty_cells(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """``(column, value)`` for every cell that holds something other than a number."""
    names = list(df.columns if columns is None else columns)
    # Columns that are numeric by type cannot hold text and are not looked at.
    cells = [
        F.when(is_dirty(ident(c), column_type(df, c)),
               F.struct(F.lit(c).alias("column"), as_text(ident(c), column_type(df, c)).alias("value")))
        for c in names if not _typed_number(df, c)
    ]
    if not cells:
        return df.limit(0).select(F.lit("").alias("column"), F.lit("").alias("value"))
    return df.select(F.inline(F.array_compact(F.array(*cells))))


def _typed_number(df: DataFrame, name: str) -> bool:
    return column_type(df, name).typeName() in {
        "byte", "short", "integer", "long", "float", "double", "decimal", "boolean",
    }


def dirty_tally(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """``(column, value, n)`` of unparsable cells, all columns in one pass."""
    return dirty_cells(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def dirty_tokens(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """``(value)``: distinct unparsable texts over all columns but the excluded ones."""
    skip = set(exclude)
    return dirty_cells(df, [c for c in df.columns if c not in skip]).select("value").distinct()


def null_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """``(column, nulls)``."""
    return stat_table(df, "column", {
        c: {"nulls": F.count_if(ident(c).isNull())} for c in (df.columns if columns is None else columns)
    })


def rule_report(df: DataFrame, rules: Mapping[str, Sequence], total: bool = True) -> DataFrame:
    """``(column, rule, invalid, pct)``; a missing cell counts as invalid.

    ``total`` adds a last row named ``TOTAL`` with the sum over all columns.
    """
    ruled = present(df, rules)
    bad = {c: F.count_if(~is_legal(ident(c), rules[c])) for c in ruled}
    table = {
        c: {"rule": F.lit(_rule_text(rules[c])), "invalid": bad[c], "pct": percent(bad[c])} for c in ruled
    }
    if total and ruled:
        everything = bad[ruled[0]]
        for c in ruled[1:]:
            everything = everything + bad[c]
        table["TOTAL"] = {
            "rule": F.lit(None).cast("string"), "invalid": everything, "pct": F.lit(None).cast("double"),
        }
    return stat_table(df, "column", table)


def percent(count: Column, digits: int = 2) -> Column:
    """Share of all rows of the aggregation in percent."""
    return F.round(100.0 * F.try_divide(count, F.count(F.lit(1))), digits)


def _rule_text(allowed: Iterable) -> str:
    return "in (" + ", ".join(str(v) for v in allowed) + ")"
