"""Outliers: limits, capping, detection, reports, removal and mean replacement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrisk.functions import column_type, ident, number_or_null, numeric_columns, present
from sparkrisk.operators import stats
from sparkrisk.operators.profile import percent
from sparkrisk.operators.stages import FitFirst, Learned, TypeConverters, keyword_only, make_param
from sparkrisk.spec import OUTLIER_COLUMNS, OUTLIER_METHOD, OUTLIER_PERCENTILES

METHODS = ("IQR", "Percentiles")
Limits = dict[str, tuple[float, float]]


def fence(q1: float, q3: float) -> tuple[float, float]:
    """One and a half interquartile ranges below and above the quartiles."""
    reach = 1.5 * (q3 - q1)
    return q1 - reach, q3 + reach


def limits(
    df: DataFrame,
    columns: Sequence[str],
    method: str = OUTLIER_METHOD,
    percentiles: Sequence[float] = OUTLIER_PERCENTILES,
) -> Limits:
    """Lower and upper limit per column; a column without values has none."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    probs = (0.25, 0.75) if method == "IQR" else tuple(percentiles)
    found = stats.quantiles(df, columns, probs)
    return {
        c: fence(*s["q"]) if method == "IQR" else (s["q"][0], s["q"][1])
        for c, s in found.items() if s["count"]
    }


def limits_table(df: DataFrame, found: Mapping[str, Sequence[float]]) -> DataFrame:
    """``(column, lower, upper)``, one row per column."""
    return df.sparkSession.createDataFrame(
        [(c, float(lo), float(hi)) for c, (lo, hi) in found.items()],
        "column string, lower double, upper double",
    )


def outside(column: str, bounds: Sequence[float]) -> Column:
    """True for a present value beyond the limits; false, not NULL, for a missing one."""
    c = number_or_null(ident(column))
    return F.coalesce((c < bounds[0]) | (c > bounds[1]), F.lit(False))


class OutlierCapper(FitFirst):
    """Learn limits for ``columns``; text columns are passed over, absent ones are an error."""

    columns = make_param("columns", "columns to cap", TypeConverters.toListString)
    method = make_param("method", "'IQR' or 'Percentiles'", TypeConverters.toString)
    percentiles = make_param("percentiles", "low and high share", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, columns=None, method=OUTLIER_METHOD, percentiles=OUTLIER_PERCENTILES):
        super().__init__()
        if method not in METHODS:
            raise ValueError(f"method must be one of {METHODS}")
        self._set(
            columns=list(OUTLIER_COLUMNS if columns is None else columns),
            method=method, percentiles=[float(p) for p in percentiles],
        )

    def _fit(self, df: DataFrame) -> OutlierCapperModel:
        asked = self.getOrDefault("columns")
        absent = [c for c in asked if c not in df.columns]
        if absent:
            raise ValueError(f"columns not found: {absent}")
        numeric = set(numeric_columns(df))
        found = limits(df, [c for c in asked if c in numeric],
                       self.getOrDefault("method"), self.getOrDefault("percentiles"))
        return OutlierCapperModel({"limits": {c: list(b) for c, b in found.items()}})


class OutlierCapperModel(Learned):
    """Move values beyond a limit onto it. Missing cells stay missing."""

    @property
    def limits(self) -> dict:
        return self.learned["limits"]

    def _transform(self, df: DataFrame) -> DataFrame:
        capped = {}
        for c in present(df, self.limits):
            lo, hi = self.limits[c]
            v = number_or_null(ident(c))
            capped[c] = F.when(v < lo, F.lit(lo)).when(v > hi, F.lit(hi)).otherwise(v)
        return df.withColumns(capped)

    def report(self, df: DataFrame) -> DataFrame:
        """``(column, lower, upper, capped)``."""
        return stats.stat_table(df, "column", {
            c: {"lower": F.lit(b[0]), "upper": F.lit(b[1]), "capped": F.count_if(outside(c, b))}
            for c, b in self.limits.items() if c in df.columns
        })


def detect_outliers(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value lies beyond the interquartile limits of ``column``."""
    found = limits(df, [column])
    if column not in found:
        return df.limit(0)
    lo, hi = found[column]
    v, real = _bare(df, column)
    return df.where(((v < lo) | (v > hi)) & real)


def _bare(df: DataFrame, column: str) -> tuple[Column, Column]:
    """The column in a form that filters can hand to the file scan, and a test that it is
    not NaN (which compares above every number)."""
    if isinstance(column_type(df, column), T.DoubleType):
        return ident(column), ~F.isnan(ident(column))
    return ident(column).cast("double"), F.lit(True)


def outlier_report(df: DataFrame, columns: Sequence[str], total: bool = True) -> DataFrame:
    """``(column, outliers, pct)`` plus a ``TOTAL`` row."""
    found = limits(df, columns)
    hits = {c: F.count_if(outside(c, b)) for c, b in found.items()}
    table = {c: {"outliers": n, "pct": percent(n)} for c, n in hits.items()}
    if total and hits:
        everything = F.lit(0).cast("bigint")
        for n in hits.values():
            everything = everything + n
        table["TOTAL"] = {"outliers": everything, "pct": F.lit(None).cast("double")}
    return stats.stat_table(df, "column", table)


def remove_outliers(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[dict]]:
    """Drop rows outside the limits, column after column, limits found anew each time.

    Rows with a missing value in a visited column go as well. Returns the rows left
    and one ``{step, column, lower, upper}`` per visited column. Limits enter the
    plan as literals, so after k columns it is still one scan with k predicates.
    """
    steps: list[dict] = []
    out = df
    for i, c in enumerate(columns):
        found = limits(out, [c])
        if c not in found:
            out = out.where(F.lit(False))
            continue
        lo, hi = found[c]
        out = out.where(_bare(df, c)[0].between(lo, hi))
        steps.append({"step": i + 1, "column": c, "lower": lo, "upper": hi})
    return out, steps


def removal_report(df: DataFrame, steps: Sequence[dict]) -> DataFrame:
    """``(step, column, rows_left, pct_left)`` after each step, in one pass over ``df``."""
    aggregates, keep = {}, F.lit(True)
    for s in steps:
        keep = keep & F.coalesce(ident(s["column"]).cast("double").between(s["lower"], s["upper"]), F.lit(False))
        n = F.count_if(keep)
        aggregates[s["column"]] = {"step": F.lit(s["step"]).cast("bigint"), "rows_left": n, "pct_left": percent(n)}
    return stats.stat_table(df, "column", aggregates)


def outliers_to_mean(
    df: DataFrame, columns: Sequence[str], stop_at_first_clean: bool = False
) -> DataFrame:
    """Replace outliers by the mean of the other present values of their column.

    ``stop_at_first_clean`` leaves all later columns alone once a column has no
    outlier or no mean.
    """
    names = present(df, columns)
    found = limits(df, names)
    exprs = {}
    for c, b in found.items():
        v = number_or_null(ident(c))
        exprs[f"n|{c}"] = F.count_if(outside(c, b))
        exprs[f"m|{c}"] = F.avg(F.when(~outside(c, b), v))
    got = stats.collect_stats(df, exprs) if exprs else {}
    replaced = {}
    for c in names:
        mean = got.get(f"m|{c}")
        if not got.get(f"n|{c}") or mean is None:
            if stop_at_first_clean:
                break
            continue
        replaced[c] = F.when(outside(c, found[c]), F.lit(mean)).otherwise(number_or_null(ident(c)))
    return df.withColumns(replaced)
