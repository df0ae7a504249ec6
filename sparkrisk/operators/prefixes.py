"""Running sums over written tables of any size: inside blocks of rows, over the blocks of a part, over the parts.

Rows are numbered as they are written, so that a number tells part and block. No task holds more than one block
of a group's rows, one short row for each block of a part, or one for each part.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrisk.session import materialize

#: A block has at most 2^16 rows; the bits of a row's number above the 33rd are its part.
BLOCK_BITS = 16
_PART_BITS = 33
NUMBER = "__number"


def written(df: DataFrame, name: str, order: Sequence[Column] = ()) -> DataFrame:
    """The table written with numbered rows, sorted over ranges if an order is given."""
    if order:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return materialize(df.withColumn(NUMBER, F.monotonically_increasing_id()), name)


def _placed(rows: DataFrame, table: DataFrame, keys: Sequence[str], place: str) -> DataFrame:
    """Joins the one row of ``table`` of equal keys (missing ones too) and place."""
    named = table.withColumnsRenamed({k: f"__key{i}" for i, k in enumerate(keys)} | {place: "__place"})
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)]
    on = reduce(Column.__and__, same, F.col(place) == F.col("__place"))
    return rows.join(named, on).drop("__place", *[f"__key{i}" for i in range(len(keys))])


def running_sums(rows: DataFrame, keys: Sequence[str], values: Sequence[str], bits: int = BLOCK_BITS) -> DataFrame:
    """Adds to rows of :func:`written`, for each value, ``<value>_before`` (its sum over earlier rows of equal keys) and ``<value>_all``
    (over all of them), and ``following``, the values of the next row of equal keys or NULL.

    A block has 2^``bits`` rows; the result is the same for any. Missing keys are a group of their own; an empty table gives none.
    """
    keys = list(keys)
    quoted = [F.col(f"`{k}`") for k in keys]
    numbered = rows.withColumn("__block", F.shiftright(NUMBER, bits))
    blocks = numbered.groupBy(*quoted, "__block").agg(
        *[F.sum(v).alias(v) for v in values], F.min_by(F.struct(*values), NUMBER).alias("__first"),
    ).withColumn("__part", F.shiftright("__block", _PART_BITS - bits))
    parts = blocks.groupBy(*quoted, "__part").agg(*[F.sum(v).alias(v) for v in values], F.min_by("__first", "__block").alias("__first"))

    over_parts = Window.partitionBy(*quoted).orderBy("__part")
    whole = Window.partitionBy(*quoted)
    parts = parts.select(
        *quoted, "__part", F.lead("__first").over(over_parts).alias("__later"),
        *[(F.sum(v).over(over_parts) - F.col(v)).alias(f"__{v}_parts") for v in values], *[F.sum(v).over(whole).alias(f"{v}_all") for v in values])
    over_blocks = Window.partitionBy(*quoted, "__part").orderBy("__block")
    blocks = blocks.select(
        *quoted, "__part", "__block", F.lead("__first").over(over_blocks).alias("__next"),
        *[(F.sum(v).over(over_blocks) - F.col(v)).alias(f"__{v}_blocks") for v in values])
    starts = _placed(blocks, parts, keys, "__part").select(
        *quoted, "__block", F.coalesce("__next", "__later").alias("__next"), *[f"{v}_all" for v in values],
        *[(F.col(f"__{v}_blocks") + F.col(f"__{v}_parts")).alias(f"__{v}_start") for v in values])

    inside = Window.partitionBy(*quoted, "__block").orderBy(NUMBER)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = _placed(numbered, starts, keys, "__block")
    return found.withColumns({
        **{f"{v}_before": F.col(f"__{v}_start") + F.sum(v).over(upto) - F.col(v) for v in values},
        "following": F.coalesce(F.lead(F.struct(*values)).over(inside), F.col("__next")),
    }).drop("__block", "__next", NUMBER, *[f"__{v}_start" for v in values])
