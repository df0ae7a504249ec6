"""Exact ranks without moving rows.

A split, a fold or a sample takes the first k rows of each stratum in the order
of a hashed key. Instead of ranking every row, the key at rank k is looked up:
keys are counted by their leading digits, only the digits around the wanted
ranks are opened further, and the few keys left are compared directly. Labelling
the rows is then a comparison with literals inside the scan.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys that may be compared on the driver, per wanted rank and in all.
_FINISH_PER_RANK = 2_000
_FINISH_IN_ALL = 200_000
_MAX_DIGITS_PER_ROUND = 4
_KEY_DIGITS = 32
# Strata whose sizes and cuts are literals of a plan; of more they stay tables (operators/strata.py).
LITERAL_STRATA = 1_000


def stratum_sizes(df: DataFrame, stratum: str) -> dict[str, int] | None:
    """Rows per stratum, ``None`` for more strata than ``LITERAL_STRATA``; refuses a missing one."""
    rows = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("n")).limit(LITERAL_STRATA + 1).collect()
    if len(rows) > LITERAL_STRATA:
        return None
    if any(r[0] is None for r in rows):
        raise ValueError("rows with a missing stratum cannot be placed")
    return dict(sorted((r[0], r["n"]) for r in rows))


def keys_at_ranks(
    df: DataFrame, sizes: Mapping[str, int], ranks: Mapping[str, Sequence[int]]
) -> dict[tuple[str, int], str]:
    """Key at each 0-based rank of each stratum.

    ``df`` has the columns ``stratum`` and ``key`` (hexadecimal, evenly spread).
    A rank equal to the size of its stratum yields a key above all others. Rows below the
    key are as many as the rank only if no equal keys lie on both sides of it; if some do,
    the key is not unique and no exact answer exists, which is an error.
    """
    found: dict[tuple[str, int], str] = {}
    pending: dict[tuple[str, int], tuple[str, int]] = {}
    for s, wanted in ranks.items():
        for k in wanted:
            if k >= sizes.get(s, 0):
                found[s, k] = "g"
            else:
                pending[s, k] = ("", k)
    rows_open = sum(sizes[s] for s in {s for s, _ in pending})
    while pending:
        opened = sorted({(s, prefix) for (s, _), (prefix, _) in pending.items()})
        depth = len(opened[0][1])
        part = _open(df, opened, depth)
        if rows_open <= min(_FINISH_PER_RANK * len(pending), _FINISH_IN_ALL):
            keys: dict[tuple[str, str], list[str]] = {}
            for r in part.select("stratum", "key").collect():
                keys.setdefault((r["stratum"], r["key"][:depth]), []).append(r["key"])
            ordered = {at: sorted(v) for at, v in keys.items()}
            for (s, k), (prefix, inside) in pending.items():
                near = ordered[s, prefix]
                if inside and near[inside - 1] == near[inside]:
                    raise ValueError("the key is not unique")
                found[s, k] = near[inside]
            return found
        step = 1
        while step < min(_MAX_DIGITS_PER_ROUND, _KEY_DIGITS - depth) and rows_open > (_FINISH_PER_RANK // 2) * len(opened) * 16 ** step:
            step += 1
        counts: dict[tuple[str, str], list[tuple[str, int]]] = {}
        counted = part.groupBy("stratum", F.substring("key", 1, depth + step).alias("prefix")).count()
        for r in counted.collect():
            counts.setdefault((r["stratum"], r["prefix"][:depth]), []).append((r["prefix"], r["count"]))
        steps = {}
        for at, pairs in counts.items():
            pairs.sort()
            steps[at] = ([p for p, _ in pairs], [0, *accumulate(n for _, n in pairs)])
        size_of: dict[tuple[str, str], int] = {}
        for (s, k), (prefix, inside) in pending.items():
            prefixes, ends = steps[s, prefix]
            at = bisect_right(ends, inside) - 1
            pending[s, k] = (prefixes[at], inside - ends[at])
            size_of[s, prefixes[at]] = ends[at + 1] - ends[at]
        if depth + step >= _KEY_DIGITS:  # whole keys: those that remain together are equal
            if any(inside for _, inside in pending.values()):
                raise ValueError("the key is not unique")
            return found | {at: prefix for at, (prefix, _) in pending.items()}
        rows_open = sum(size_of.values())
    return found


def _open(df: DataFrame, opened: Sequence[tuple[str, str]], depth: int) -> DataFrame:
    if depth == 0:
        strata = sorted({s for s, _ in opened})
        return df.where(F.col("stratum").isin(strata))
    tags = [f"{prefix}|{s}" for s, prefix in opened]
    return df.where(F.concat_ws("|", F.substring("key", 1, depth), F.col("stratum")).isin(tags))
