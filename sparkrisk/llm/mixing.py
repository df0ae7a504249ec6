"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrisk.llm.common import WORD, power_of_two
from sparkrisk.session import materialize

#: A document, and so a source, is used this often at most.
REPEATS = 3
WEIGHTS = (1, 2, 3)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Adds ``target`` to (key, source, source_size): shares by weight, cut at ``repeats`` times the size.

    Sources in code point order, the missing one last, take the weights in turn. What a cut source cannot
    use is shared again by weight. With sources ordered by limit / weight those that are cut come
    first, so one pass of running sums finds the share of one unit of weight.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * repeats)
    by_need = Window.orderBy(F.col("most") / F.col("weight"), "key")
    before, every = by_need.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    unit = (F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    tried = ranked.withColumn("unit", unit)
    fits = F.when(F.col("unit") * F.col("weight") <= F.col("most"), F.col("unit"))
    # The first source that is not cut fixes the unit; all before it are cut.
    fixed = F.first(fits, ignorenulls=True).over(by_need.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return tried.withColumn("fixed", fixed).select(
        "key", "source_size", F.least(F.col("most").cast("double"), F.coalesce(F.col("fixed") * F.col("weight"), F.col("most").cast("double"))).alias("target"))


def _bucket(finish: Column, steps: int) -> Column:
    """Numbers that grow with the finish time: even steps up to 4, then steps of a ratio."""
    return F.when(finish < 4, F.floor(finish * steps)).otherwise(4 * steps + F.floor(F.log2(finish) * 64))


def _key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("missing"))


def _queued(docs: DataFrame, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """doc_id, size, source_size, target, key and ``used``, the number of passes that take the row.

    Each document's finish time in pass e over its source is the source's words up to and including it,
    in shuffled order and with all earlier passes, divided by the source's target. All passes of all
    documents are taken in the order of finish times while the sum of sizes stays within the
    sum of all sizes. The shuffle is the digest of doc_id; rows with one doc_id are taken together.
    Neither a source nor the whole order is in one task: running sums are formed over hash
    ranges within a source and over ranges of the finish time, then inside the one range that holds
    the cut.
    """
    spark = docs.sparkSession
    rows = docs.select(
        "doc_id", F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), "source",
        _key().alias("key"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("missing")).cast("binary")).alias("turn"),
    )
    rows = materialize(rows, "mix")
    count, budget = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    digits = max(2, math.ceil(math.log(max(1.0, count / 4096), 16)))
    rows = rows.withColumn("range", F.substring("turn", 1, digits))

    ranges = rows.groupBy("key", "source", "range").agg(F.sum("size").alias("words"))
    shares = targets(ranges.groupBy("key", "source").agg(F.sum("words").alias("source_size")), weights, repeats)
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("key", "range", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start")).join(shares, "key")
    inside = Window.partitionBy("key", "range").orderBy("turn").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    queued = rows.withColumn("inside", F.sum("size").over(inside)).join(ranges, ["key", "range"])
    finish = [(F.col("start") + F.col("inside") + e * F.col("source_size")) / F.col("target") for e in range(repeats)]
    queued = materialize(queued.select(
        "doc_id", "size", "source_size", "target", "key", "turn",
        F.when(F.col("size") > 0, F.array(*finish)).otherwise(F.array().cast("array<double>")).alias("finish"),
    ), "queue")

    # Steps and rows in a step both grow with the root of the number of documents.
    steps = 4 * power_of_two(math.sqrt(max(1, count)))
    passes = queued.select("size", "key", "turn", F.explode("finish").alias("finish")).withColumn("step", _bucket(F.col("finish"), steps))
    running = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        passes.groupBy("step").agg(F.sum("size").alias("words")).withColumn("so_far", F.sum("words").over(running))
        .where(F.col("so_far") > budget).agg(F.min(F.struct("step", (F.col("so_far") - F.col("words")).alias("below"))).alias("cut")).first()["cut"])
    if cut is None:
        taken = F.size("finish")
    else:
        order = F.struct("finish", "key", "turn")
        upto = Window.partitionBy("step").orderBy("finish", "key", "turn").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        last = (
            passes.where(F.col("step") == cut["step"]).withColumn("so_far", F.sum("size").over(upto) + F.lit(cut["below"]))
            .where(F.col("so_far") <= budget).agg(F.max(order).alias("last")).first()["last"])

        def within(f: Column) -> Column:
            if last is None:
                return _bucket(f, steps) < cut["step"]
            bound = F.struct(*[F.lit(v) for v in last])
            return (_bucket(f, steps) < cut["step"]) | (F.struct(f, F.col("key"), F.col("turn")) <= bound)

        taken = F.size(F.filter("finish", within))
    return queued.select("doc_id", "size", "source_size", "target", "key", taken.alias("used"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row.

    size counts words, taken those that the mix takes, repeats included. Missing or empty texts have size 0 and are
    never taken; a missing source is a source; rows with one doc_id are taken together; an empty table gives none.
    """
    return _queued(docs, weights, repeats).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("used")).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """The rows, with all their columns, as often as the mix takes them; rows without words are never taken."""
    uses = materialize(_queued(docs, weights, repeats).where("used > 0").select(
        F.col("doc_id").alias("used_id"), F.col("key").alias("used_key"), "used").distinct(), "uses")
    rows = docs.where(F.regexp_like(F.col("text"), F.lit(WORD))).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("own_id"), _key().alias("own_key"))
    taken = rows.join(uses, F.col("own_id").eqNullSafe(F.col("used_id")) & (F.col("own_key") == F.col("used_key")))
    return taken.select("row", F.explode(F.sequence(F.lit(1), "used"))).select("row.*")


#: DuckDB: the same mix with one running sum for each source and one over all.
SQL = """
WITH sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'missing')) AS turn,
         coalesce('=' || source, 'missing') AS key
  FROM documents),
sources AS (
  SELECT key, source, CAST(sum(size) AS BIGINT) AS source_size, 3 * CAST(sum(size) AS BIGINT) AS most,
         1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS weight
  FROM sized GROUP BY key, source),
tried AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER before, 0))
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS unit
  FROM sources
  WINDOW before AS (ORDER BY most / CAST(weight AS DOUBLE), key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
fixed AS (
  SELECT unit FROM tried WHERE unit * weight <= most ORDER BY most / CAST(weight AS DOUBLE), key LIMIT 1),
shares AS (
  SELECT key, source_size, least(CAST(most AS DOUBLE), coalesce((SELECT unit FROM fixed) * weight, CAST(most AS DOUBLE))) AS target
  FROM tried),
queued AS (
  SELECT doc_id, size, source_size, target, s.key, turn,
         CAST(sum(size) OVER (PARTITION BY s.key ORDER BY turn RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS place
  FROM sized s JOIN shares USING (key)),
passes AS (
  SELECT *, (place + e * source_size) / target AS finish FROM queued, (SELECT unnest([0, 1, 2]) AS e) WHERE size > 0),
kept AS (
  SELECT doc_id, key, turn, size,
         CASE WHEN sum(size) OVER (ORDER BY finish, key, turn RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                   <= (SELECT sum(size) FROM sized) THEN 1 ELSE 0 END AS used
  FROM (SELECT * FROM passes)),
uses AS (SELECT doc_id, key, turn, CAST(sum(used) AS BIGINT) AS used FROM kept GROUP BY doc_id, key, turn)
SELECT q.doc_id, CAST(q.size AS BIGINT) AS size, CAST(q.source_size AS BIGINT) AS source_size, q.target,
       CAST(q.size * coalesce(u.used, 0) AS BIGINT) AS taken
FROM queued q LEFT JOIN uses u ON q.doc_id IS NOT DISTINCT FROM u.doc_id AND q.key = u.key AND q.turn = u.turn
"""
