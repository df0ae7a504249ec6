"""Splits, folds and samples with exact sizes, repeatable from a seed and a row key."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrisk.functions import ident, order_key
from sparkrisk.operators import strata
from sparkrisk.operators.cutoffs import keys_at_ranks, stratum_sizes
from sparkrisk.operators.profile import value_shares
from sparkrisk.spec import CV_FOLDS, CV_REPEATS, SEED, TARGET, TEST_SHARE


def _key(seed: int | str, key: str | Sequence[str]) -> Column:
    names = [key] if isinstance(key, str) else list(key)
    return order_key(seed, *[ident(k) for k in names])


def test_sizes(sizes: Mapping[str, int], test_share: float) -> dict[str, int]:
    """Test rows per stratum: train rows by largest remainder, the rest is test."""
    total = sum(sizes.values())
    n_test = math.ceil(round(test_share * total, 9))
    n_train = total - n_test
    if not 0 < test_share < 1 or n_train <= 0:
        raise ValueError(f"test share {test_share} leaves one side of {total} rows empty")
    train = {s: n * n_train // total for s, n in sizes.items()}
    by_remainder = sorted(sizes, key=lambda s: (-(sizes[s] * n_train % total), s))
    for s in by_remainder[: n_train - sum(train.values())]:
        train[s] += 1
    return {s: sizes[s] - train[s] for s in sizes}


def holdout_split(
    df: DataFrame,
    key: str | Sequence[str],
    target: str = TARGET,
    test_share: float = TEST_SHARE,
    seed: int = SEED,
    stratify: bool = True,
    output: str = "split",
) -> DataFrame:
    """Adds ``split`` = ``train`` or ``test``; sizes are exact, class shares are kept.

    ``key`` must name the rows uniquely. No row is shuffled: the hashed key at the
    class's last test rank is found first, then every row is compared with it. Of very many
    classes the sizes and keys are tables.
    """
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    stratum = ident(target).cast("string") if stratify else F.lit("all")
    hashed = _key(seed, key)
    narrow = df.select(stratum.alias("stratum"), hashed.alias("key"))
    sizes = stratum_sizes(narrow, "stratum")
    if sizes is None:
        return strata.holdout(df, stratum, hashed, test_share, output)
    if not sizes:
        return df.withColumn(output, F.lit("train"))
    test = test_sizes(sizes, test_share)
    if stratify and (min(sizes.values()) < 2 or sum(test.values()) < len(sizes)):
        raise ValueError("every class needs two rows and each side room for every class")
    cut = keys_at_ranks(narrow, sizes, {s: [n] for s, n in test.items()})
    is_test = F.lit(False)
    for s, n in test.items():
        is_test = is_test | ((stratum == s) & (hashed < cut[s, n]))
    return df.withColumn(output, F.when(is_test, "test").otherwise("train"))


def split_report(df: DataFrame, target: str = TARGET, split: str = "split") -> DataFrame:
    """``(split, class, n, share)``: class shares inside each side."""
    counts = df.groupBy(ident(split).alias("split"), ident(target).alias("class")).agg(
        F.count(F.lit(1)).alias("n")
    )
    totals = counts.groupBy("split").agg(F.sum("n").alias("side"))
    return counts.join(totals, "split").select(
        "split", "class", "n", F.try_divide(F.col("n"), F.col("side")).alias("share")
    )


def union_parts(train: DataFrame, test: DataFrame) -> DataFrame:
    """Rows of both parts, duplicates kept, columns matched by name."""
    return train.unionByName(test)


def fold_sizes(sizes: Mapping[str, int], folds: int) -> dict[str, list[int]]:
    """Test rows per class and fold. Positions of the class-sorted table are dealt to
    the folds in turn, so class counts and fold sizes each differ by one at most."""
    out, start = {}, 0
    for s in sorted(sizes):
        n = sizes[s]
        out[s] = [len(range((f - start) % folds, n, folds)) for f in range(folds)]
        start += n
    return out


def repeated_folds(
    df: DataFrame,
    key: str | Sequence[str],
    target: str = TARGET,
    folds: int = CV_FOLDS,
    repeats: int = CV_REPEATS,
    seed: int = SEED,
    prefix: str = "fold_",
) -> DataFrame:
    """Adds ``fold_0 .. fold_<repeats-1>``: the fold in which a row is test, per repeat."""
    if folds < 2:
        raise ValueError("at least two folds are needed")
    stratum = ident(target).cast("string")
    sizes = stratum_sizes(df.select(stratum.alias("stratum")), "stratum")
    if sizes is None:
        return strata.folds(df, stratum, [_key(seed + r, key) for r in range(repeats)], folds, prefix)
    if not sizes:
        return df.withColumns({f"{prefix}{r}": F.lit(0) for r in range(repeats)})
    if max(sizes.values()) < folds:
        raise ValueError(f"no class has {folds} rows")
    dealt = fold_sizes(sizes, folds)
    ends = {s: [sum(counts[: f + 1]) for f in range(folds - 1)] for s, counts in dealt.items()}
    hashed = [_key(seed + r, key) for r in range(repeats)]
    # The repeats are looked up together, as separate strata of one table.
    narrow = df.select(F.inline(F.array(*[
        F.struct(F.concat(F.lit(f"{r}:"), stratum).alias("stratum"), h.alias("key"))
        for r, h in enumerate(hashed)
    ])))
    cut = keys_at_ranks(
        narrow,
        {f"{r}:{s}": n for r in range(repeats) for s, n in sizes.items()},
        {f"{r}:{s}": e for r in range(repeats) for s, e in ends.items()},
    )
    labels = {}
    for r, h in enumerate(hashed):
        fold = F.lit(None).cast("int")
        for s in sizes:
            place = F.lit(0)
            for e in ends[s]:
                place = place + F.when(h >= cut[f"{r}:{s}", e], 1).otherwise(0)
            fold = F.when(stratum == s, place).otherwise(fold)
        labels[f"{prefix}{r}"] = fold
    return df.withColumns(labels)


def fold_table(
    df: DataFrame, key: str | Sequence[str], target: str = TARGET,
    folds: int = CV_FOLDS, repeats: int = CV_REPEATS, seed: int = SEED,
) -> DataFrame:
    """Long form of :func:`repeated_folds`: ``(key.., repeat, fold)``."""
    names = [key] if isinstance(key, str) else list(key)
    wide = repeated_folds(df, key, target, folds, repeats, seed)
    return wide.select(*[ident(k) for k in names], F.inline(F.array(*[
        F.struct(F.lit(r).alias("repeat"), F.col(f"fold_{r}").alias("fold")) for r in range(repeats)
    ])))


def sample_rows(df: DataFrame, key: str | Sequence[str], n: int, seed: int = SEED) -> DataFrame:
    """``min(n, rows)`` rows without replacement: those with the smallest hashed keys."""
    hashed = _key(seed, key)
    narrow = df.select(F.lit("all").alias("stratum"), hashed.alias("key"))
    total = df.count()
    if n >= total:
        return df
    cut = keys_at_ranks(narrow, {"all": total}, {"all": [n]})
    return df.where(hashed < cut["all", n])
