"""Cleaning: number coercion, column removal, target validity, row filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrisk.functions import as_text, column_type, ident, is_dirty, is_legal, present, to_number
from sparkrisk.operators.stats import stat_table
from sparkrisk.spec import MIXED, TARGET

# A token table is broadcast up to this size, which is measured first; beyond it rows are salted.
BROADCAST_BYTES = 32 << 20
SALTS = 32


def coerce_numeric(df: DataFrame, exclude: Iterable[str] = (MIXED,)) -> DataFrame:
    """Every column but the excluded ones as double; cells that are no number become NULL."""
    skip = set(exclude)
    return df.select(*[
        ident(c) if c in skip else to_number(ident(c), column_type(df, c)).alias(c) for c in df.columns
    ])


def replace_tokens(
    df: DataFrame, tokens: DataFrame | Sequence[str], columns: Iterable[str] | None = None
) -> DataFrame:
    """Cells equal to one of the tokens become NULL.

    ``tokens`` is a list, which enters the plan as literals, or a table of any length with a
    ``value`` column, which is joined, column by column.
    """
    names = list(df.columns if columns is None else columns)
    if isinstance(tokens, DataFrame):
        return _replace_by_join(df, tokens, names)
    listed = list(tokens)
    if not listed:
        return df
    return df.withColumns({
        c: F.when(~is_legal(as_text(ident(c), column_type(df, c)), listed), ident(c)) for c in names
    })


def _replace_by_join(df: DataFrame, tokens: DataFrame, names: Sequence[str]) -> DataFrame:
    """A frequent text, or the missing cell, may fill most of a column: without a broadcast the rows
    of a text are dealt over ``SALTS`` parts, to each of which the tokens are copied."""
    known = tokens.select(F.col("value").alias("__hit")).where(F.col("value").isNotNull()).distinct()
    size = known.agg(F.coalesce(F.sum(F.octet_length("__hit") + 16), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        hits, salt = F.broadcast(known), F.lit(0)
    else:
        hits, salt = known.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), (F.rand(3) * SALTS).cast("int")
    out = df
    for c in names:
        same = as_text(ident(c), column_type(df, c)) == F.col("__hit")
        if size > BROADCAST_BYTES:
            out, same = out.withColumn("__salt", salt), same & (F.col("__salt") == F.col("__part"))
        out = out.join(hits, same, "left").withColumn(c, F.when(F.col("__hit").isNull(), ident(c))).drop("__hit", "__part", "__salt")
    return out


def drop_column(df: DataFrame, name: str | None) -> DataFrame:
    """Without ``name``; unchanged where it is absent or ``None``."""
    return df if name is None or name not in df.columns else df.drop(ident(name))


def valid_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows whose target is 0 or 1; a table without the target is returned as it is."""
    return df.where(ident(target).isin(0, 1)) if target in df.columns else df


def clean(
    df: DataFrame, target: str = TARGET, mixed: str | None = MIXED, keep: Sequence[str] = ()
) -> DataFrame:
    """Coerce, drop the mixed column, keep valid targets; the target becomes an integer.

    Columns in ``keep`` (row keys) are left as they are.
    """
    out = (
        df.transform(coerce_numeric, exclude=[*keep, *([] if mixed is None else [mixed])])
        .transform(drop_column, mixed)
        .transform(valid_target, target)
    )
    return out.withColumn(target, ident(target).cast("int")) if target in out.columns else out


def clean_report(df: DataFrame, target: str = TARGET, mixed: str | None = MIXED) -> DataFrame:
    """One row about the uncleaned table: rows before, removed and left, dirty cells, columns left."""
    names = [c for c in df.columns if c != mixed]
    dirty = F.lit(0).cast("bigint")
    for c in names:
        dirty = dirty + F.count_if(is_dirty(ident(c), column_type(df, c)))
    kept = (
        F.count_if(F.coalesce(to_number(ident(target), column_type(df, target)).isin(0, 1), F.lit(False)))
        if target in df.columns else F.count(F.lit(1))
    )
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"), kept.alias("rows_left"), dirty.alias("dirty_cells")
    ).select(
        "rows_before", (F.col("rows_before") - F.col("rows_left")).alias("rows_removed"), "rows_left",
        "dirty_cells", F.lit(len(names)).cast("bigint").alias("columns_left"),
    )


def separate_target(df: DataFrame, target: str = TARGET, key: str | Sequence[str] | None = None):
    """``(features, target)`` as two tables; both keep the key that pairs them."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    keys = [] if key is None else [key] if isinstance(key, str) else list(key)
    features = df.drop(ident(target))
    return features, df.select(*[ident(k) for k in keys], ident(target))


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """New headers from a dictionary; names the table does not have are ignored."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def complete_cases(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a missing cell."""
    return df.dropna("any", subset=None if columns is None else list(columns))


def all_rules(df: DataFrame, rules: Mapping[str, Sequence]) -> Column:
    """True where every ruled column the table has holds a legal value."""
    test = F.lit(True)
    for c in present(df, rules):
        test = test & is_legal(ident(c), rules[c])
    return test


def filter_by_rules(df: DataFrame, rules: Mapping[str, Sequence]) -> DataFrame:
    """Rows that keep all rules. A missing value fails the bare membership tests as well,
    and those can be handed to the file scan."""
    out = df
    for c in present(df, rules):
        out = out.where(ident(c).isin(list(rules[c])))
    return out


def rule_filter_report(df: DataFrame, rules: Mapping[str, Sequence]) -> DataFrame:
    """``(rows_before, rows_left, rows_removed, pct_removed)`` of :func:`filter_by_rules`."""
    kept = F.count_if(all_rules(df, rules))
    rows = F.count(F.lit(1))
    return df.agg(
        rows.alias("rows_before"), kept.alias("rows_left"), (rows - kept).alias("rows_removed"),
        F.round(100.0 * F.try_divide(rows - kept, rows), 2).alias("pct_removed"),
    )
