"""Neighbour-based oversampling of the smaller class (Chawla et al. 2002; Han et al. 2005).

Synthetic rows are dealt evenly to the rows they start from, the remainder to those
with the smallest hashed keys. Neighbour and position come from a digest of seed,
row key and copy number, so a rerun gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrisk.functions import column_type, ident, order_key, uniform
from sparkrisk.operators.cutoffs import keys_at_ranks
from sparkrisk.operators.encode import as_columns, dense_cells, widths
from sparkrisk.operators.neighbours import nearest
from sparkrisk.session import materialize
from sparkrisk.spec import BORDERLINE_NEIGHBOURS, SEED, SMOTE_NEIGHBOURS

# Copies of one row that one task makes at a time.
CHUNK = 10_000

Resampler = Callable[[DataFrame, Sequence[str], str, str], DataFrame]


def _keyed(df: DataFrame, features: Sequence[str], target: str, key: str) -> DataFrame:
    return df.select(F.lit(0).alias("grp"), ident(key).alias("key"), ident(target).cast("string").alias("label"),
                     dense_cells(df, features).alias("vec"))


def _synthesise(starts: DataFrame, seeds: DataFrame, need: dict[int, int], seed: int, n_seeds: dict[int, int]) -> DataFrame:
    """``(grp, key, copy, vec)``: points between a row and one of its neighbours.

    ``seeds`` are the rows ``starts`` with their neighbours; ``need`` and ``n_seeds`` count by group.
    """
    shares = {g: divmod(n, n_seeds[g]) for g, n in need.items() if n_seeds.get(g)}
    ranked = order_key(f"{seed}:extra", F.col("key"))
    extra = {str(g): [more] for g, (_, more) in shares.items() if more}
    cut = keys_at_ranks(
        starts.select(F.col("grp").cast("string").alias("stratum"), ranked.alias("key")), {str(g): n_seeds[g] for g in shares}, extra)
    copies = F.lit(0)
    for g, (each, more) in shares.items():
        own = F.lit(each) if not more else F.lit(each) + F.when(ranked < cut[str(g), more], 1).otherwise(0)
        copies = F.when(F.col("grp") == g, own).otherwise(copies)
    row = ["grp", "key", "vec", "neighbours"]
    chunks = seeds.withColumn("copies", copies).where(F.col("copies") > 0).select(
        *row, "copies", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / CHUNK))).alias("chunk"))
    if any(each >= CHUNK for each, _ in shares.values()):  # few rows start many copies: deal them out
        chunks = chunks.repartition("grp", "key", "chunk")
    first = F.col("chunk") * CHUNK + 1
    many = chunks.select(*row, F.explode(F.sequence(
        first, F.least(first + (CHUNK - 1), F.col("copies").cast("bigint")))).alias("copy")).withColumn("copy", F.col("copy").cast("int"))
    drawn = many.withColumn("digest", order_key(seed, F.col("key"), F.col("copy"))).withColumn(
        "other",
        F.get("neighbours", F.floor(uniform(F.col("digest")) * F.size("neighbours")).cast("int"))["vec"],
    ).withColumn("u", uniform(F.col("digest"), 9))
    moved = F.zip_with("vec", "other", lambda x, y: x + F.col("u") * (y - x))
    return drawn.select("grp", "key", "copy", moved.alias("vec"))


def _append(df: DataFrame, made: Sequence[tuple[str, DataFrame]], features, target, key) -> DataFrame:
    dtype = column_type(df, target)
    given = [ident(c) if n > 1 else ident(c).cast("double").alias(c) for c, n in zip(features, widths(df, features))]
    out = df.select(ident(key), *given, ident(target), F.lit(0).alias("copy"))
    for label, rows in made:
        out = out.unionByName(rows.select(
            F.col("key").alias(key), *as_columns(F.col("vec"), df, features), F.lit(label).cast(dtype).alias(target), "copy"))
    return out


def _smaller_classes(rows: DataFrame, k: int) -> list[tuple[str, dict[int, int], dict[int, int], dict[int, int]]]:
    """For each class that is smaller than the largest of a group: rows needed, rows there are, and all rows, by group."""
    counted = rows.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("n")).collect()
    sizes: dict[int, dict[str, int]] = {}
    if any(r["label"] is None for r in counted):
        raise ValueError("rows with a missing class cannot be placed")
    for r in counted:
        sizes.setdefault(r["grp"], {})[r["label"]] = r["n"]
    out = []
    for label in sorted({s for own in sizes.values() for s in own}):
        have = {g: own[label] for g, own in sizes.items() if label in own and own[label] < max(own.values())}
        if have:
            fewest = min(have.values())
            if fewest <= k:
                raise ValueError(f"class {label} has {fewest} rows, {k + 1} are needed for {k} neighbours")
            out.append((label, {g: max(sizes[g].values()) - n for g, n in have.items()}, have, {g: sum(sizes[g].values()) for g in have}))
    return out


def smote_rows(
    rows: DataFrame, k: int = SMOTE_NEIGHBOURS, seed: int = SEED, groups: int = 1,
) -> list[tuple[str, DataFrame]]:
    """Synthetic rows ``(grp, key, copy, vec)`` of each smaller class, for ``rows`` of ``(grp, key, label, vec)``.

    Groups are separate tables that are worked on by the same jobs.
    """
    made = []
    for label, need, have, _ in _smaller_classes(rows, k):
        mine = rows.where((F.col("label") == label) & F.col("grp").isin(list(need)))
        made.append((label, _synthesise(mine, nearest(mine, mine, k, groups), need, seed, have)))
    return made


def danger_rows(rows: DataFrame, label: str, m: int, groups: int = 1) -> DataFrame:
    """``(grp, key, label, vec)`` of the class's rows with at least half, but not all, of their
    m nearest rows in other classes."""
    around = nearest(rows.where(F.col("label") == label), rows, m, groups, vectors=False)
    foreign = F.size(F.filter("neighbours", lambda n: n["label"] != F.lit(label)))
    return around.where((foreign >= m / 2) & (foreign < m)).select("grp", "key", "label", "vec")


def borderline_rows(
    rows: DataFrame, k: int = SMOTE_NEIGHBOURS, m: int = BORDERLINE_NEIGHBOURS, seed: int = SEED, groups: int = 1,
) -> list[tuple[str, DataFrame]]:
    """As :func:`smote_rows`, but only rows near the class border start synthetic rows.

    Their neighbours come from their own class. A group without such rows gets none.
    """
    made = []
    for label, need, _, total in _smaller_classes(rows, k):
        if min(total.values()) <= m:
            raise ValueError(f"{m + 1} rows are needed for {m} neighbours")
        asked = rows.where(F.col("grp").isin(list(need)))
        danger = materialize(danger_rows(asked, label, m, groups), "smote-danger")
        n_danger = {r["grp"]: r["count"] for r in danger.groupBy("grp").count().collect()}
        if n_danger:
            seeds = nearest(danger, asked.where(F.col("label") == label), k, groups)
            made.append((label, _synthesise(danger, seeds, need, seed, n_danger)))
    return made


def smote(
    df: DataFrame, features: Sequence[str], target: str, key: str,
    k: int = SMOTE_NEIGHBOURS, seed: int = SEED,
) -> DataFrame:
    """``key, features.., target, copy``: the table plus synthetic rows (``copy`` > 0) that
    raise every smaller class to the size of the largest."""
    return _append(df, smote_rows(_keyed(df, features, target, key), k, seed), features, target, key)


def borderline_smote(
    df: DataFrame, features: Sequence[str], target: str, key: str,
    k: int = SMOTE_NEIGHBOURS, m: int = BORDERLINE_NEIGHBOURS, seed: int = SEED,
) -> DataFrame:
    """As :func:`smote`, but only rows near the class border start synthetic rows.

    Their neighbours come from their own class. Without such rows the table is
    returned as it is.
    """
    return _append(df, borderline_rows(_keyed(df, features, target, key), k, m, seed), features, target, key)


SAMPLERS: dict[str, Resampler] = {"SMOTE": smote, "BorderlineSMOTE": borderline_smote}
#: The same samplers on many tables at once.
GROUPED = {smote: smote_rows, borderline_smote: borderline_rows}


def get_sampler(name: str | None) -> Resampler | None:
    """Sampler by name; ``None`` means no resampling, unknown names are an error."""
    if name is None:
        return None
    if name not in SAMPLERS:
        raise ValueError(f"unknown sampler {name!r}; known: {sorted(SAMPLERS)}")
    return SAMPLERS[name]
