"""Descriptive statistics and the data behind the usual plots."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrisk.functions import as_text, column_type, ident, numeric_columns, present, to_number
from sparkrisk.operators import stats
from sparkrisk.operators.outliers import fence, outside
from sparkrisk.spec import OUTLIER_COLUMNS

HISTOGRAM_BINS = 30


def _number(df: DataFrame, column: str) -> Column:
    return to_number(ident(column), column_type(df, column))


def describe(df: DataFrame, columns: Sequence[str] | None = None, where: Column | None = None) -> DataFrame:
    """``(column, count, mean, std, min, q25, q50, q75, max)`` with exact quartiles.

    ``where`` limits the rows, as for a summary of one value range.
    """
    table = df if where is None else df.where(where)
    names = numeric_columns(df) if columns is None else list(columns)
    found = stats.quantiles(table, names, (0.25, 0.5, 0.75))
    return stats.stat_table(table, "column", {
        c: {
            "count": F.count(_number(df, c)), "mean": F.avg(_number(df, c)),
            "std": F.stddev_samp(_number(df, c)), "min": F.min(_number(df, c)),
            **{n: F.lit(found[c]["q"][i]).cast("double") for i, n in enumerate(("q25", "q50", "q75"))},
            "max": F.max(_number(df, c)),
        }
        for c in names
    })


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """``(column, bin, left, right, n)`` with equal widths between min and max.

    The last bin is closed, missing values are left out, empty bins are not listed,
    and a constant column is spread over one unit around its value.
    """
    names = numeric_columns(df) if columns is None else list(columns)
    exprs = {}
    for c in names:
        exprs[f"lo|{c}"], exprs[f"hi|{c}"] = F.min(_number(df, c)), F.max(_number(df, c))
    ends = stats.collect_stats(df, exprs)
    cells = []
    for c in names:
        lo, hi = ends[f"lo|{c}"], ends[f"hi|{c}"]
        if lo is None:
            continue
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        width = (hi - lo) / bins
        v = _number(df, c)
        place = F.floor((v - F.lit(lo)) / F.lit(hi - lo) * bins)
        # least() would turn a missing value into the last bin.
        at = F.when(v.isNotNull(), F.least(place, F.lit(bins - 1).cast("bigint")))
        cells.append(F.struct(
            F.lit(c).alias("column"), at.alias("bin"), F.lit(lo).alias("lo"), F.lit(width).alias("width")
        ))
    if not cells:
        return df.sparkSession.createDataFrame([], "column string, bin bigint, left double, right double, n bigint")
    return (
        df.select(F.inline(F.array(*cells))).where(F.col("bin").isNotNull())
        .groupBy("column", "bin", "lo", "width").agg(F.count(F.lit(1)).alias("n"))
        .select("column", "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("left"),
                (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("right"), "n")
    )


def box_stats(df: DataFrame, columns: Sequence[str] = OUTLIER_COLUMNS) -> DataFrame:
    """``(column, q1, median, q3, whisker_low, whisker_high, fliers)`` of numeric columns."""
    numeric = set(numeric_columns(df))
    names = [c for c in present(df, columns) if c in numeric]
    found = {c: s for c, s in stats.quantiles(df, names, (0.25, 0.5, 0.75)).items() if s["count"]}
    table = {}
    for c, s in found.items():
        q1, median, q3 = s["q"]
        bounds = fence(q1, q3)
        v = _number(df, c)
        inside = F.when(~outside(c, bounds), v)
        table[c] = {
            "q1": F.lit(q1), "median": F.lit(median), "q3": F.lit(q3),
            # Without a value between quartile and fence the whisker ends at the quartile.
            "whisker_low": F.least(F.lit(q1), F.min(inside)), "whisker_high": F.greatest(F.lit(q3), F.max(inside)),
            "fliers": F.count_if(outside(c, bounds)),
        }
    return stats.stat_table(df, "column", table)


def box_fliers(df: DataFrame, columns: Sequence[str] = OUTLIER_COLUMNS) -> DataFrame:
    """``(column, value)`` of every value beyond the whiskers of :func:`box_stats`, repeats included."""
    numeric = set(numeric_columns(df))
    names = [c for c in present(df, columns) if c in numeric]
    found = {c: s for c, s in stats.quantiles(df, names, (0.25, 0.75)).items() if s["count"]}
    cells = [F.struct(F.lit(c).alias("column"), F.when(outside(c, fence(*s["q"])), _number(df, c)).alias("value")) for c, s in found.items()]
    if not cells:
        return df.sparkSession.createDataFrame([], "column string, value double")
    return df.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())


def category_histogram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` of present codes, all columns in one group-by."""
    cells = [
        F.struct(F.lit(c).alias("column"), as_text(ident(c), column_type(df, c)).alias("value")) for c in columns
    ]
    return (
        df.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def correlation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(x, y, r)`` for every ordered pair of numeric columns, on rows where both are present.

    A constant column has no correlation, not even with itself.
    """
    names = numeric_columns(df) if columns is None else list(columns)
    if not names:
        return df.sparkSession.createDataFrame([], "x string, y string, r double")
    values = {c: _number(df, c) for c in names}
    means = stats.collect_stats(df, {c: F.avg(v) for c, v in values.items()})
    # Sums are taken around the means, so that large offsets do not swallow small variances.
    centred = df.select(*[(v - F.lit(means[c] or 0.0)).alias(f"v{k}") for k, (c, v) in enumerate(values.items())])
    sums = centred.mapInPandas(_pair_sums, _PAIR_SUMS).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")],
        *[F.min(c).alias(c) for c in ("x_low", "y_low")], *[F.max(c).alias(c) for c in ("x_high", "y_high")])
    xx = F.col("sxx") - F.try_divide(F.col("sx") * F.col("sx"), F.col("n"))
    yy = F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), F.col("n"))
    xy = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    varies = (F.col("x_low") < F.col("x_high")) & (F.col("y_low") < F.col("y_high")) & (xx > 0) & (yy > 0)
    r = F.when(varies, xy / F.sqrt(xx * yy))
    name = F.array(*[F.lit(c) for c in names])
    found = sums.select(
        F.get(name, F.col("i")).alias("x"), F.get(name, F.col("j")).alias("y"), F.when(F.abs(r) > 1, F.signum(r)).otherwise(r).alias("r"))
    return found


_PAIR_SUMS = ("i int, j int, n long, sx double, sy double, sxx double, syy double, sxy double, "
              "x_low double, y_low double, x_high double, y_high double")


def _pair_sums(batches):
    """Sums over a partition for every ordered pair of columns, of the rows that have both."""
    total = None
    for frame in batches:
        raw = frame.to_numpy(dtype=float, na_value=np.nan)
        for at in range(0, len(raw), 4096):
            part = raw[at:at + 4096]
            there = ~np.isnan(part)
            x, m = np.where(there, part, 0.0), there.astype(float)
            k = x.shape[1]
            low, high = np.empty((k, k)), np.empty((k, k))
            low[:] = np.where(there, part, np.inf).min(0)[:, None]
            high[:] = np.where(there, part, -np.inf).max(0)[:, None]
            for j in np.flatnonzero(~there.all(0)):  # columns with gaps narrow the others' rows
                rows = there[:, j]
                low[:, j] = np.where(there[rows], part[rows], np.inf).min(0, initial=np.inf)
                high[:, j] = np.where(there[rows], part[rows], -np.inf).max(0, initial=-np.inf)
            own = [m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x]
            if total is None:
                total = [*own, low, high]
            else:
                total = [a + b for a, b in zip(total, own)] + [np.minimum(total[4], low), np.maximum(total[5], high)]
    if total is not None:
        n, sx, sxx, sxy, low, high = total
        i, j = (a.ravel() for a in np.indices(n.shape))
        yield pd.DataFrame({
            "i": i, "j": j, "n": n.ravel().astype(np.int64), "sx": sx.ravel(), "sy": sx.T.ravel(), "sxx": sxx.ravel(), "syy": sxx.T.ravel(),
            "sxy": sxy.ravel(), "x_low": low.ravel(), "y_low": low.T.ravel(), "x_high": high.ravel(), "y_high": high.T.ravel()})
