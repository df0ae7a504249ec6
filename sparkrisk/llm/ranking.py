"""Ranked lexical search of a stated set of queries: exact best documents by norm buckets of impact vectors.

A document is a vector of impacts over the terms of the queries. Vectors are ordered by length, so that a bucket of
neighbours has a known greatest length, and the product of that length and a query's length bounds every score in
it (Cauchy-Schwarz). Inside a bucket only documents are looked at that have one of the query's few greatest coordinates,
chosen so that the others cannot reach the bound by themselves; their own coordinates and remaining lengths give
a bound for each. What is left is scored in 64-bit integers, and these scores alone decide.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrisk.llm.common import map_texts, partitions
from sparkrisk.session import materialize

BEST = 10
#: Bytes of query texts that are searched in one pass over the documents, on average.
BLOCK_BYTES = 4 << 20
#: Vectors of a bucket. As many of the longest are searched first, for the bounds the others start with.
BUCKET = 4096
#: Bounds are computed in doubles and widened by this share, so that rounding never drops a document.
SLACK = 1e-9

#: Every byte of a term stands for itself, in lower case; other ASCII characters become spaces.
_LETTERS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased, in UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS).split()


class Queries:
    """A block of queries over the terms that they use: sparse counts of terms, exact weights once these are known."""

    def __init__(self, texts: list[str | None]):
        counts = [Counter(terms_of(t)) for t in texts]
        self.ids = {t: k for k, t in enumerate(sorted(set().union(*counts)))} if counts else {}
        self.terms = [np.array([self.ids[t] for t in c], np.int64) for c in counts]
        self.times = [np.array(list(c.values()), np.int64) for c in counts]

    def weigh(self, n_docs: int, n_terms: int, held: dict[int, int]) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(k, 0) + 1))) for k in range(len(self.ids))], np.int64)
        self.roots = np.sqrt(self.weights.astype(float))

    def impacts(self, lengths: np.ndarray, terms: np.ndarray, times: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The integer factor beside the weight, for the flattened terms of documents with ``sizes`` terms each."""
        m = 25 + (75 * lengths * self.n_docs) // self.n_terms
        return (1_000_000_000 * times) // (1000 * times + 8 * np.repeat(m, sizes))

    def norms(self, impacts: np.ndarray, terms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        owner = np.repeat(np.arange(len(sizes)), sizes)
        return np.sqrt(np.bincount(owner, (impacts * self.roots[terms]) ** 2, minlength=len(sizes)))


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Values and sizes of an Arrow column of lists."""
    import pyarrow.compute as pc

    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.int64), pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)


class Best:
    """The best documents of each query so far, and the score that another one has to reach."""

    def __init__(self, bounds: np.ndarray):
        self.bounds = bounds.copy()
        self.rows: list[list[tuple[int, bool, int]]] = [[] for _ in bounds]

    def offer(self, query: int, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        if len(scores) > BEST:
            enough = np.partition(scores, len(scores) - BEST)[len(scores) - BEST]
            some = scores >= enough
            scores, ids, missing = scores[some], ids[some], missing[some]
        merged = self.rows[query] + [(-s, m, i) for s, m, i in zip(scores.tolist(), missing.tolist(), ids.tolist())]
        merged.sort()
        self.rows[query] = merged[:BEST]
        if len(merged) >= BEST:
            self.bounds[query] = max(self.bounds[query], -self.rows[query][-1][0])


def search_bucket(queries: Queries, best: Best, ids, missing, impacts, terms, sizes, norms) -> None:
    """Offers every document of a bucket that may be among the best of a query."""
    longest = norms.max(initial=0.0)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(terms, kind="stable")
    places = np.searchsorted(terms[order], np.arange(len(queries.ids) + 1))
    shared = impacts * queries.roots[terms]
    dense = np.zeros(len(queries.ids), np.int64)
    for q, (own, times) in enumerate(zip(queries.terms, queries.times)):
        bound = best.bounds[q]
        sides = times * queries.roots[own]
        if math.sqrt(float(sides @ sides)) * longest * (1 + SLACK) < bound:
            continue
        by_size = np.argsort(-sides, kind="stable")
        rest = np.sqrt(np.append(np.cumsum(sides[by_size[::-1]] ** 2)[::-1], 0.0))
        focus = int(np.argmax(rest * longest * (1 + SLACK) < bound)) if bound > 0 else len(own)
        entries = np.concatenate([order[places[t]:places[t + 1]] for t in own[by_size[:focus]]] or [np.zeros(0, np.int64)])
        if not len(entries):
            continue
        factor = np.repeat(sides[by_size[:focus]], [places[t + 1] - places[t] for t in own[by_size[:focus]]])
        rows = owner[entries]
        product = np.bincount(rows, shared[entries] * factor, minlength=len(sizes))
        square = np.bincount(rows, shared[entries] ** 2, minlength=len(sizes))
        met = np.bincount(rows, minlength=len(sizes)) > 0
        upper = (product + rest[focus] * np.sqrt(np.maximum(norms ** 2 * (1 + SLACK) - square, 0))) * (1 + SLACK) + SLACK
        left = np.flatnonzero(met & (upper >= bound))
        if not len(left):
            continue
        dense[own] = times * queries.weights[own]
        many = sizes[left]
        at = np.repeat(starts[left] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        sums = np.concatenate([[0], np.cumsum(dense[terms[at]] * impacts[at])])
        ends = np.cumsum(many)
        scores = sums[ends] - sums[ends - many]
        dense[own] = 0
        enough = (scores > 0) & (scores >= bound)
        best.offer(q, scores[enough], ids[left][enough], missing[left][enough])


def _vectors(docs: DataFrame, queries) -> DataFrame:
    """doc_id, n, terms, times of the rows with a term; ``terms`` are those that some query has."""

    def work(texts: Iterable[str | None]):
        known = queries.value.ids
        for text in texts:
            found = Counter(terms_of(text))
            own = [(known[t], k) for t, k in found.items() if t in known]
            yield found.total(), [x for x, _ in own], [x for _, x in own]

    return materialize(map_texts(docs, "n long, terms array<int>, times array<int>", work).where("n > 0"), "impact-terms")


def _held(vectors: DataFrame, size: int) -> dict[int, int]:
    """Documents that hold a term, for the terms of a block of queries: one row of the size of the block for each task."""

    def count(batches):
        import pyarrow as pa

        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column(0))[0], minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["term", "held"])

    summed = vectors.select("terms").mapInArrow(count, "term long, held long").groupBy("term").agg(F.sum("held").alias("held"))
    return {r["term"]: r["held"] for r in summed.collect()}


def _search(vectors: DataFrame, queries, bounds: np.ndarray) -> DataFrame:
    """query, doc_id, score: of each task and query the best rows that reach the query's bound."""

    def run(batches):
        import pyarrow as pa

        known: Queries = queries.value
        best = Best(bounds)
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                part = batch.slice(at, BUCKET)
                terms, sizes = _flat(part.column("terms"))
                times, _ = _flat(part.column("times"))
                lengths = part.column("n").to_numpy(zero_copy_only=False)
                missing = part.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                ids = part.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
                impacts = known.impacts(lengths, terms, times, sizes)
                search_bucket(known, best, ids, missing, impacts, terms, sizes, known.norms(impacts, terms, sizes))
        found = [(q, None if gone else i, -minus) for q, rows in enumerate(best.rows) for minus, gone, i in rows if -minus >= bounds[q]]
        columns = list(zip(*found)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["query", "doc_id", "score"])

    return vectors.select("doc_id", "n", "terms", "times").mapInArrow(run, "query int, doc_id long, score long")


def _by_length(vectors: DataFrame, queries) -> DataFrame:
    """The vectors by falling length as a written table: ``bucket`` numbers ranges of length, ``place`` the rows inside."""

    def measure(batches):
        import pyarrow as pa

        for batch in batches:
            terms, sizes = _flat(batch.column("terms"))
            times, _ = _flat(batch.column("times"))
            known: Queries = queries.value
            impacts = known.impacts(batch.column("n").to_numpy(zero_copy_only=False), terms, times, sizes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(known.norms(impacts, terms, sizes))], names=[*batch.schema.names, "norm"])

    measured = vectors.mapInArrow(measure, "doc_id long, n long, terms array<int>, times array<int>, norm double").where("norm > 0")
    spread = F.xxhash64("doc_id", F.rand(11))  # copies have one length, and any part of the table
    ordered = measured.withColumn("spread", spread).repartitionByRange(partitions(vectors), F.desc("norm"), "spread").sortWithinPartitions(F.desc("norm"))
    number = F.monotonically_increasing_id()
    return materialize(ordered.drop("spread").select(
        "*", F.shiftright(number, 33).alias("bucket"), number.bitwiseAND((1 << 33) - 1).alias("place")), "impact-vectors")


def _rank(found: DataFrame, keys: list[str]) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BEST)


def _block(docs: DataFrame, rows: list) -> DataFrame:
    """query, rank, doc_id, score for one block of queries."""
    context = docs.sparkSession.sparkContext
    plain = Queries([r["text"] for r in rows])
    vectors = _vectors(docs, context.broadcast(plain))
    totals = vectors.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    plain.weigh(totals["docs"], max(1, totals["terms"]), _held(vectors, len(plain.ids)))
    queries = context.broadcast(plain)
    ordered = _by_length(vectors, queries)
    nothing = np.zeros(len(rows), np.int64)
    first = (F.col("bucket") == 0) & (F.col("place") < BUCKET)
    seed = _rank(_search(ordered.where(first), queries, nothing), ["query"]).where(F.col("rank") == BEST).select("query", "score").collect()
    bounds = nothing.copy()
    for r in seed:
        bounds[r["query"]] = r["score"]
    return _rank(_search(ordered, queries, bounds), ["query"])


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank, doc_id, score: the ten best rows of ``docs`` for every row of ``items``.

    Rows of both tables with missing or empty texts, or without a term, have no place in the result. Repeated rows of
    ``docs`` are documents of their own; equal scores are ordered by doc_id, a missing one last. Items that repeat with
    the same id and text are searched once and returned as often as they come. Empty tables give none. Other columns are not
    looked at. The items are searched in blocks of some four megabytes of text, each by one pass over the documents;
    a block's terms are sent to every task.
    """
    asked = items.groupBy("item_id", "text").agg(F.count("*").alias("copies"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = 1 + size // BLOCK_BYTES
    dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = []
    for block in range(blocks):
        rows = asked.where(dealt == block).collect()
        if not rows:
            continue
        names = docs.sparkSession.createDataFrame(
            [(k, r["item_id"], r["copies"]) for k, r in enumerate(rows)], f"query int, item_id {items.schema['item_id'].dataType.simpleString()}, copies long")
        found = _block(docs, rows).join(F.broadcast(names), "query")
        out.append(found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("item_id", "rank", "doc_id", "score"))
    if not out:
        return docs.sparkSession.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    total = out[0]
    for more in out[1:]:
        total = total.unionByName(more)
    return total


_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
WITH held AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_PATTERN}')) AS term FROM documents) AS d
  GROUP BY doc_id, term),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_PATTERN}')) AS term FROM benchmark) AS b
  GROUP BY item_id, term),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM held GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term) AS f, totals),
shares AS (SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM sizes, totals),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN shares USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) AS r
WHERE rank <= 10
"""
