"""Statistics primitives: one-pass aggregates, exact quantiles, exact modes.

Only scalars reach the driver, and no aggregate keeps a state that grows with
the table: exact quantiles of columns with many distinct values are found by
narrowing a bracket around each wanted rank, a few narrow scans instead of one
task that holds every value.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrisk.functions import column_type, ident, to_number

# Values that one aggregation buffer may hold.
DIRECT_LIMIT = 100_000
# Sketch size and grid of shares (three times the sketch error) for columns up to
# _SKETCH_ROWS values and beyond. Any sketch gives exact results; a better one, fewer rounds.
_SKETCHES = ((4_096, 1_000), (32_768, 6_000))
_SKETCH_ROWS = 100_000_000
_MERGE_TASKS = 64
_AGGREGATES_PER_JOB = 400


def collect_stats(df: DataFrame, exprs: Mapping) -> dict:
    """Evaluate many aggregates over one scan and return them by name."""
    names = list(exprs)
    out: dict = {}
    for at in range(0, len(names), _AGGREGATES_PER_JOB):
        part = names[at:at + _AGGREGATES_PER_JOB]
        row = df.agg(*[exprs[n].alias(f"s{i}") for i, n in enumerate(part)]).first()
        out.update({n: row[i] for i, n in enumerate(part)})
    return out


def stat_table(df: DataFrame, key: str, aggregates: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """Lazy report with one row per item of ``aggregates`` and one column per statistic.

    All statistics are computed by one aggregation; its single row is then split.
    """
    flat, rows = [], []
    for i, (item, stats) in enumerate(aggregates.items()):
        fields = [F.lit(item).alias(key)]
        for j, (name, expr) in enumerate(stats.items()):
            flat.append(expr.alias(f"a{i}_{j}"))
            fields.append(F.col(f"a{i}_{j}").alias(name))
        rows.append(F.struct(*fields))
    return df.agg(*flat).select(F.inline(F.array(*rows)))


def _rank_weights(n: int, p: float) -> tuple[int, int, float]:
    position = (n - 1) * p
    low = math.floor(position)
    return low, min(low + 1, n - 1), position - low


def _interpolate(low: float, high: float, weight: float) -> float:
    return low if low == high or weight == 0 else (1.0 - weight) * low + weight * high


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    direct_limit: int | None = None,
) -> dict[str, dict]:
    """Exact, linearly interpolated quantiles with count, min and max per column.

    Missing cells are ignored. Returns ``{column: {"count", "min", "max", "q"}}``. A column of at most
    ``direct_limit`` values (``DIRECT_LIMIT`` by default) is read by one aggregate, a longer one is narrowed
    first; both are exact.
    """
    direct_limit = DIRECT_LIMIT if direct_limit is None else direct_limit
    columns = list(dict.fromkeys(columns))
    if not columns:
        return {}
    values = {c: to_number(ident(c), column_type(df, c)) for c in columns}
    first: dict[str, Column] = {}
    for c, v in values.items():
        first[f"n|{c}"], first[f"lo|{c}"], first[f"hi|{c}"] = F.count(v), F.min(v), F.max(v)
    seen = collect_stats(df, first)
    out = {
        c: {"count": seen[f"n|{c}"], "min": seen[f"lo|{c}"], "max": seen[f"hi|{c}"],
            "q": [None] * len(probs)}
        for c in columns
    }
    filled = [c for c in columns if out[c]["count"]]
    direct = [c for c in filled if out[c]["count"] <= direct_limit]
    if direct and probs:
        got = collect_stats(
            df, {c: F.percentile(values[c], F.array(*[F.lit(float(p)) for p in probs])) for c in direct}
        )
        for c in direct:
            out[c]["q"] = list(got[c])
    large = [c for c in filled if c not in direct]
    if large and probs:
        wanted = {c: [_rank_weights(out[c]["count"], p) for p in probs] for c in large}
        narrow = df.select(*[values[c].alias(f"v{i}") for i, c in enumerate(large)])
        found = _order_statistics(
            narrow,
            {f"v{i}": (out[c]["count"], sorted({k for low, high, _ in wanted[c] for k in (low, high)}))
             for i, c in enumerate(large)},
            direct_limit,
        )
        for i, c in enumerate(large):
            out[c]["q"] = [
                _interpolate(found[f"v{i}", low], found[f"v{i}", high], weight)
                for low, high, weight in wanted[c]
            ]
    return out


def _order_statistics(
    df: DataFrame, ranks: Mapping[str, tuple[int, Sequence[int]]], direct_limit: int
) -> dict[tuple[str, int], float]:
    """Value at every wanted 0-based rank of every column: ``{column: (count, ranks)}``.

    Each rank has an open interval known to hold its value. A mergeable sketch, one
    per interval, proposes two cut values around the rank; exact counts below, at,
    between and above the cuts then either name the value or give a smaller interval.
    A cut value leaves the interval, so a value that fills a third of the column is
    settled by its count. What is left is read by one aggregate once the rows in the
    interval fit its buffer.
    """
    found: dict[tuple[str, int], float] = {}
    state = {
        (c, k): {"lo": None, "hi": None, "below": 0, "inside": n}
        for c, (n, wanted) in ranks.items() for k in wanted
    }
    size, grid = _SKETCHES[max(n for n, _ in ranks.values()) > _SKETCH_ROWS]
    while state:
        around = {key: _shares(key[1], s, grid) for key, s in state.items()}
        intervals: dict[tuple, set[float]] = {}
        for (c, k), s in state.items():
            intervals.setdefault((c, s["lo"], s["hi"]), set()).update(around[c, k])
        asked = {at: sorted(shares) for at, shares in intervals.items()}
        picked = _sketched(df, asked, size)
        cuts = {}
        for key, s in state.items():
            at = (key[0], s["lo"], s["hi"])
            by_share = dict(zip(asked[at], picked[at]))
            cuts[key] = tuple(float(by_share[p]) for p in around[key])
        counts = {}
        for c, a, b in {(c, *cut) for (c, _), cut in cuts.items()}:
            v = F.col(c)
            between = (v > a) & (v < b)
            counts["lt", c, a, b] = F.count_if(v < a)
            counts["at", c, a, b] = F.count_if(v == a)
            counts["in", c, a, b] = F.count_if(between)
            counts["to", c, a, b] = F.count_if(v == b) if b != a else F.lit(0)
        counted = collect_stats(df, counts)
        last = {}
        for key, s in state.items():
            c, k = key
            a, b = cuts[key]
            lt, eq, mid, top = (counted[part, c, a, b] for part in ("lt", "at", "in", "to"))
            if k < lt:
                s.update(hi=a, inside=lt - s["below"])
            elif k < lt + eq:
                found[key] = a
            elif k < lt + eq + mid:
                s.update(lo=a, hi=b, below=lt + eq, inside=mid)
                if mid <= direct_limit:
                    last[key] = s
            elif k < lt + eq + mid + top:
                found[key] = b
            else:
                end = lt + eq + mid + top
                s.update(lo=b, inside=s["below"] + s["inside"] - end, below=end)
        if last:
            found.update(collect_stats(df, {
                (c, k): _ranked_value(c, (k - s["below"] + 0.5) / s["inside"], s["lo"], s["hi"])
                for (c, k), s in last.items()
            }))
        state = {key: s for key, s in state.items() if key not in found}
    return found


def _sketched(df: DataFrame, asked: Mapping[tuple, Sequence[float]], size: int) -> dict[tuple, list[float]]:
    """Approximate quantiles inside each interval ``(column, lo, hi)``.

    Sketches are merged in two steps, so no task merges those of all others.
    """
    names = {at: f"k{i}" for i, at in enumerate(asked)}
    sketches = df.groupBy((F.spark_partition_id() % _MERGE_TASKS).alias("part")).agg(*[
        F.kll_sketch_agg_double(_inside(*at), size).alias(name) for at, name in names.items()
    ])
    # An interval may have no row in some part; its empty sketch is left out.
    row = sketches.agg(*[
        F.kll_sketch_get_quantile_double(
            F.kll_merge_agg_double(name, size), F.array(*[F.lit(p) for p in asked[at]])
        ).alias(name) for at, name in names.items()
    ]).first()
    return {at: list(row[name]) for at, name in names.items()}


def approximate_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[float]:
    """Values near the wanted shares of a double column, for cutting it into even parts."""
    at = (column, None, None)
    return _sketched(df, {at: list(shares)}, _SKETCHES[-1][0])[at]


def _shares(k: int, s: dict, grid: int) -> tuple[float, float]:
    """Two shares around a rank, on a grid so that neighbouring ranks ask for the same cuts."""
    at = math.floor((k - s["below"] + 0.5) / s["inside"] * grid)
    return max(0, at - 2) / grid, min(grid, at + 3) / grid


def _ranked_value(c: str, share: float, lo: float, hi: float) -> Column:
    def number(x: float) -> str:
        return f"CAST('{x!r}' AS DOUBLE)"
    return F.expr(
        f"percentile_disc({number(share)}) WITHIN GROUP (ORDER BY CASE WHEN {c} > {number(lo)} "
        f"AND {c} < {number(hi)} THEN {c} END)"
    )


def _inside(c: str, lo: float | None, hi: float | None) -> Column:
    v = F.col(c)
    test = v.isNotNull()
    if lo is not None:
        test = test & (v > lo)
    if hi is not None:
        test = test & (v < hi)
    return F.when(test, v)


def value_counts_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, whole, num, txt, n)``: rows per present value of every column.

    A value stands in the field of its kind, so that integers of 64 bits stay apart where
    doubles would merge them.
    """
    cells = []
    for c in columns:
        kind = column_type(df, c)
        if isinstance(kind, T.StringType):
            value = {"txt": ident(c)}
        elif isinstance(kind, T.IntegralType):
            value = {"whole": ident(c).cast("bigint")}
        else:
            value = {"num": to_number(ident(c), kind)}
        cells.append(F.struct(F.lit(c).alias("column"), *[
            value.get(name, F.lit(None).cast(kind)).alias(name)
            for name, kind in (("whole", "bigint"), ("num", "double"), ("txt", "string"))]))
    long = df.select(F.inline(F.array(*cells)))
    return (
        long.where("whole IS NOT NULL OR num IS NOT NULL OR txt IS NOT NULL")
        .groupBy("column", "whole", "num", "txt").agg(F.count(F.lit(1)).alias("n"))
    )


def counted_value(row):
    """The value of a row of :func:`value_counts_long`, in its own kind."""
    return next((row[k] for k in ("txt", "whole", "num") if row[k] is not None), None)


def modes(df: DataFrame, columns: Sequence[str]) -> dict:
    """Most frequent present value per column, the smallest one on ties.

    Values are counted by a shuffled group-by, so any number of distinct values works.
    """
    if not columns:
        return {}
    top = (
        value_counts_long(df, columns).groupBy("column")
        .agg(F.min(F.struct((-F.col("n")).alias("n"), "whole", "num", "txt")).alias("best"))
        .collect()
    )
    return {r["column"]: counted_value(r["best"]) for r in top}


def legal_modes(df: DataFrame, rules: Mapping[str, Sequence]) -> dict:
    """Most frequent legal value per ruled column; at most one buffer entry per legal code."""
    exprs = {
        c: F.mode(F.when(ident(c).isin(list(allowed)), ident(c)), True)
        for c, allowed in rules.items() if c in df.columns and list(allowed)
    }
    if not exprs:
        return {}
    return {c: v for c, v in collect_stats(df, exprs).items() if v is not None}
