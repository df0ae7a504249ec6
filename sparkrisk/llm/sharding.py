"""Sharding by a weighted hash tree: regions, racks and shards draw for each key, level by level."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrisk.llm.common import let, partitions, text_of, uniform
from sparkrisk.session import materialize


@dataclass(frozen=True)
class Shard:
    """A leaf of the tree. Rack numbers are unique over all regions."""

    shard: int
    rack: int
    region: int
    weight: float = 1.0


def topology(count: int, base: int = 16, per_rack: int = 4, racks_per_region: int = 2) -> list[Shard]:
    """The first ``base`` shards fill racks and regions; each later one is a region of its own.

    A new subtree draws only for itself, so one more shard takes rows into itself alone.
    """
    tree = [Shard(i, i // per_rack, i // (per_rack * racks_per_region)) for i in range(min(count, base))]
    return tree + [Shard(i, i, i) for i in range(base, count)]


def _levels(shards: list[Shard]) -> list[list[tuple[int, int, float]]]:
    """For regions, racks and shards: (parent, id, weight), the weight of a node being that of its leaves."""
    regions: dict[int, float] = {}
    racks: dict[tuple[int, int], float] = {}
    for s in shards:
        regions[s.region] = regions.get(s.region, 0.0) + s.weight
        racks[s.region, s.rack] = racks.get((s.region, s.rack), 0.0) + s.weight
    return [
        [(-1, r, w) for r, w in sorted(regions.items()) if w > 0],
        [(r, k, w) for (r, k), w in sorted(racks.items()) if w > 0],
        [(s.rack, s.shard, s.weight) for s in sorted(shards, key=lambda s: s.shard) if s.weight > 0],
    ]


def place(key: Column, shards: list[Shard]) -> Column:
    """The shard of a key.

    At each level the children of the chosen node draw ``-ln(u) / weight``, u coming from the key and
    the node, and the smallest draw wins: a child wins in proportion to its weight, and a changed weight
    moves rows only out of or into that child. A missing key is a key like any other.
    """
    if not any(s.weight > 0 for s in shards):
        raise ValueError("no shard has a weight")

    def winner(level: int, nodes: list[tuple[int, int, float]], parent: Column) -> Column:
        every = F.array(*[
            F.struct(F.lit(p).alias("parent"), F.lit(i).alias("id"), F.lit(float(w)).alias("weight")) for p, i, w in nodes])
        own = F.filter(every, lambda x: x["parent"] == parent)
        draws = F.transform(own, lambda x: F.struct(
            (-F.ln(uniform(key, F.lit(level), x["id"])) / x["weight"]).alias("draw"), x["id"].alias("id")))
        return F.array_min(draws)["id"]

    regions, racks, leaves = _levels(shards)
    return let(winner(0, regions, F.lit(-1)), lambda region: let(
        winner(1, racks, region), lambda rack: winner(2, leaves, rack)))


def shard_rows(docs: DataFrame, count: int = 16, shards: list[Shard] | None = None, grown: list[Shard] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    ``shards`` and ``grown`` default to the topologies of ``count`` and one more shard. The law is `key`: doc_id
    and the tree alone decide. Slots count from 0 in each shard without gaps, in the order of (part,
    doc_id, crc, size); the rows of a shard are numbered in parts of equal hash, so that no task
    holds a shard. Missing texts are empty, a missing doc_id is one key, repeated rows get slots of
    their own, an empty table gives none.
    """
    shards, grown = shards or topology(count), grown or topology(count + 1)
    parts = partitions(docs)
    rows = docs.select(
        "doc_id",
        (F.octet_length(text_of()) + 1).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
        place(F.col("doc_id"), shards).alias("shard"),
        place(F.col("doc_id"), grown).alias("grown_shard"),
    )
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit("slot")), F.lit(parts)))
    rows = materialize(rows, "shards")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # At most shards x parts rows, whatever the number of documents.
    starts = rows.groupBy("shard", "part").count().select(
        "shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    return rows.withColumn("inside", F.row_number().over(inside)).join(F.broadcast(starts), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") + F.col("inside") - 1).alias("slot"), "grown_shard")
