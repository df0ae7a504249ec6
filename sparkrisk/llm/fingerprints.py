"""SimHash fingerprints and the search for all fingerprints within a Hamming radius."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrisk.llm.common import let, partitions, text_of, words_of
from sparkrisk.session import materialize

BITS = 64
RADIUS = 3
BLOCKS = 6
_PAIR = (1 << 32) + 1


def _terms(text: Column) -> Column:
    """Hash and weight of each word with the word before it; the weight is the word's length."""
    return let(words_of(text), lambda words: F.when(
        F.size(words) == 0, F.array().cast("array<struct<h:bigint,w:int>>")).otherwise(F.transform(
            F.sequence(F.lit(0), F.size(words) - 1),
            lambda i: F.struct(F.xxhash64(F.get(words, i - 1), F.get(words, i)).alias("h"), F.length(F.get(words, i)).alias("w")))))


def simhash(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """``keys`` and ``fingerprint`` (a long) of each row.

    The keys tell rows apart. Each term votes with its weight for or against each bit as its own hash has it; two bits that
    are 32 apart share one sum. A text without words has fingerprint 0.
    """
    votes = [F.sum(F.shiftright("h", i).bitwiseAND(F.lit(_PAIR)) * F.col("w")).alias(f"v{i}") for i in range(32)]
    counted = rows.select(*keys, F.inline_outer(_terms(F.col(text)))).groupBy(*keys).agg(F.sum("w").alias("all"), *votes)
    value = F.lit(0).cast("long")
    for i in range(32):
        for bit, own in ((i, F.col(f"v{i}").bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftrightunsigned(f"v{i}", 32))):
            one = 1 << bit if bit < 63 else -(1 << 63)
            value = value.bitwiseOR(F.when(2 * own > F.col("all"), F.lit(one).cast("long")).otherwise(F.lit(0).cast("long")))
    return counted.select(*keys, value.alias("fingerprint"))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def likeness(a: Column, b: Column) -> Column:
    """Estimate of the cosine of two texts' term vectors, at least 0: the share of differing bits is their angle."""
    return F.greatest(F.lit(0.0), F.cos(distance(a, b) * F.lit(3.141592653589793 / BITS)))


def masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """The bits that each table compares: every choice of ``blocks - radius`` blocks."""
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("there must be more blocks than differing bits")
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    whole = [sum(c) for c in combinations(parts, blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in whole]


def within(queries: DataFrame, fingerprints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Pairs (query, fingerprint, distance) of the distinct values of the two ``fingerprint`` columns within the radius.

    Values that differ in ``radius`` bits agree on some choice of blocks. Each table moves one such choice to the front
    and joins on it; a pair is kept in the first table that holds it. Keys grow with
    ``blocks - radius``, so tables stay selective for larger inputs with more blocks.
    """
    tables = masks(radius, blocks)

    def fronts(df: DataFrame, name: str) -> DataFrame:
        each = [F.struct(F.lit(t).alias("t"), F.col(name).bitwiseAND(F.lit(m).cast("long")).alias("front")) for t, m in enumerate(tables)]
        distinct = df.select(F.col("fingerprint").alias(name)).where(F.col(name).isNotNull()).distinct()
        return distinct.select(name, F.inline(F.array(*each)))

    q, d = fronts(queries, "query"), fronts(fingerprints, "fingerprint")
    apart = F.col("query").bitwiseXOR(F.col("fingerprint"))
    agree = F.transform(F.array(*[F.lit(m).cast("long") for m in tables]), lambda m: apart.bitwiseAND(m) == 0)
    near = (F.bit_count(apart) <= radius) & (F.array_position(agree, True) == F.col("t") + 1)
    return q.join(d, ["t", "front"]).where(near).select("query", "fingerprint", F.bit_count(apart).alias("distance"))


def _hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _ranges(docs: DataFrame) -> Column:
    """A number for each doc_id, higher for higher ids, that deals the ids evenly; the missing id is lowest."""
    n = min(4096, 8 * partitions(docs))
    shares = F.array(*[F.lit(k / n) for k in range(1, n)])
    found = docs.agg(F.max("doc_id").alias("most"), F.percentile_approx("doc_id", shares, 20 * n).alias("cuts")).first()
    cuts = sorted({c for c in found["cuts"] or () if c < found["most"]})
    if not cuts:
        return F.lit(0)
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
    steps = F.array(*[F.lit(1 << k) for k in range(len(cuts).bit_length() - 1, -1, -1)])
    return let(bounds, lambda all_: F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(cuts)) & (F.get(all_, at + step - 1) < F.col("doc_id")), at + step).otherwise(at)))


def fingerprint_table(docs: DataFrame, every: int = 100, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_within of every row.

    The next document is the one that follows in descending doc_id (a missing id is last, rows with one id follow in
    descending text), after the last the first; a table with one row follows itself. n_within is the number
    of rows, itself included, whose fingerprint is within the radius of the row's; it is given where doc_id is
    divisible by ``every``. Missing texts are empty ones; an empty table gives none.
    """
    keyed = docs.select("doc_id", text_of().alias("text"), _ranges(docs).alias("range"))
    ranges = Window.partitionBy("range").orderBy(F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    placed = keyed.select("*", F.row_number().over(ranges).alias("place"), F.lead("text").over(ranges).alias("follower"))
    top = F.lit(0) if docs.isEmpty() else F.lit(keyed.agg(F.max("range")).first()[0])
    # The first row of the range below follows the last row of a range; one row for each range.
    heads = placed.where("place = 1").select(
        F.when(F.col("range") == top, F.lit(0)).otherwise(F.col("range") + 1).alias("above"), F.col("range").alias("below"), F.col("text").alias("head"))
    linked = placed.join(heads, (F.col("range") == F.col("above")) & F.col("follower").isNull(), "left")
    n = F.length("text")
    linked = linked.select(
        "range", "place", "doc_id", n.cast("long").alias("n_chars"), "text",
        F.coalesce("follower", "head").alias("next"), F.floor(n / 3).cast("int").alias("cut"),
        F.when(F.col("follower").isNull(), F.col("below")).otherwise(F.col("range")).alias("next_range"),
        F.when(F.col("follower").isNull(), F.lit(1)).otherwise(F.col("place") + 1).alias("next_place"))
    edited = F.concat(F.left("text", F.length("text") - F.col("cut")), F.left("next", F.col("cut")))
    linked = linked.select("*", edited.alias("edited")).withColumn("edited_sha256", F.sha2("edited", 256))
    keys = ["range", "place", "doc_id", "n_chars", "next_range", "next_place", "edited_sha256"]
    both = linked.select(*keys, F.inline(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("version")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("version")))))
    marked = simhash(both, "version", [*keys, "kind"]).groupBy(*keys).agg(
        F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))).alias("edited"))
    marked = materialize(marked, "fingerprints")

    following = marked.select(F.col("range").alias("next_range"), F.col("place").alias("next_place"), F.col("fingerprint").alias("next"))
    queries = marked.where(F.col("doc_id") % every == 0)
    copies = marked.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"))
    near = within(queries, marked, radius, blocks).join(copies, "fingerprint").groupBy("query").agg(F.sum("n").alias("n_within"))
    near = materialize(near, "near")
    return marked.join(following, ["next_range", "next_place"]).withColumn(
        "query", F.when(F.col("doc_id") % every == 0, F.col("fingerprint"))).join(near, "query", "left").select(
        "doc_id", "n_chars", "edited_sha256", _hex(F.col("fingerprint")).alias("fingerprint"), _hex(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next")).alias("near_next"), "n_within")
