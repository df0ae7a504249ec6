"""Quality rules for texts and for the hosts they come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrisk.llm.common import GAP, let, lookup_join, text_of, words_of
from sparkrisk.session import materialize

SYMBOLS = r"[#*$%&|<>]"
FEWEST_WORDS = 50
MOST_REPEATED = 50
WINDOW = 3
#: A host goes if its shrunk share of failures is above this.
WORST_RATE = 0.5


def _repeated_words(words: Column) -> Column:
    """How many words lie in three-word windows that occur twice or more in the text."""

    def covered(windows: Column, repeated: Column, steps: Column) -> Column:
        def found(h: Column) -> Column:  # binary search among the sorted repeated hashes
            last = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
                (at + step <= F.size(repeated)) & (F.get(repeated, at + step - 1) <= h), at + step).otherwise(at))
            return F.get(repeated, last - 1) == h

        starts = F.filter(F.transform(windows, lambda h, i: F.when(found(h), i)), lambda i: i.isNotNull())
        # A window adds the words that the one before it has not covered.
        added = F.aggregate(
            starts, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
            lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")))
        return added["n"]

    def counted(windows: Column) -> Column:
        def of_sorted(ordered: Column) -> Column:
            twice = F.zip_with(ordered, F.slice(ordered, 2, F.size(ordered)), lambda a, b: F.when(a == b, a))
            return let(F.array_distinct(F.filter(twice, lambda x: x.isNotNull())), of_repeated)

        def of_repeated(repeated: Column) -> Column:
            exponents = F.sequence(F.ceil(F.log2(F.size(repeated) + 1)).cast("int"), F.lit(0))
            return let(F.transform(exponents, lambda b: F.call_function("shiftleft", F.lit(1), b)), lambda steps: covered(windows, repeated, steps))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(F.array_sort(windows), of_sorted))

    hashes = F.when(F.size(words) < WINDOW, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])))
    return let(hashes, counted)


def measures(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""

    def of_lines(lines: Column) -> Column:
        return F.size(lines) - F.size(F.array_distinct(lines))

    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    return let(words_of(text), lambda words: F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, F.lit(GAP), F.lit(""))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, of_lines).cast("long").alias("n_dup_lines"),
        _repeated_words(words).cast("long").alias("n_repeat_words"),
    ))


def failed(m: Column) -> Column:
    return (m["n_words"] < FEWEST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])


def host_verdicts(rows: DataFrame, worst: float = WORST_RATE) -> DataFrame:
    """(host, host_kept) from rows of (host, base_failed).

    A host's failure rate is drawn towards the rate of all documents as a beta prior demands whose
    mean and variance are those of the hosts' rates: (failures + mean k) / (n + k), with
    k = mean (1 - mean) / variance - 1, at least 2 and at most a million.
    """
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("f"))
    n, f, squares = hosts.agg(F.sum("n"), F.sum("f"), F.sum(F.col("f") * F.col("f") / F.col("n"))).first()
    mean = f / n if n else 0.0
    variance = squares / n - mean * mean if n else 0.0
    k = max(2.0, min(1e6, mean * (1 - mean) / variance - 1)) if variance > 1e-12 else 1e6
    return hosts.select("host", ((F.col("f") + F.lit(mean * k)) / (F.col("n") + F.lit(k)) <= worst).alias("host_kept"))


def _host() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("missing"))


def judge(docs: DataFrame, worst: float = WORST_RATE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every row.

    The host of a document is its source; documents without one share a host. Missing texts are empty ones
    and fail; repeated rows count as often as they occur; an empty table gives none.
    """
    rows = docs.select("doc_id", _host().alias("host"), measures(text_of()).alias("m"))
    rows = materialize(rows.select("doc_id", "host", "m", failed(F.col("m")).alias("base_failed")), "rules")
    judged = lookup_join(rows, host_verdicts(rows, worst), "host")
    return judged.select("doc_id", "m.*", "base_failed", (~F.col("base_failed") & F.col("host_kept")).alias("kept"))


def filter_documents(docs: DataFrame, worst: float = WORST_RATE) -> DataFrame:
    """The rows, with all their columns, that pass the rules of texts and hosts."""
    rows = docs.select(_host().alias("host"), failed(measures(text_of())).alias("base_failed"))
    verdicts = materialize(host_verdicts(rows, worst), "hosts")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    passing = docs.where(~failed(measures(text_of()))).select(row, _host().alias("host"))
    return lookup_join(passing, verdicts, "host", "inner").where("host_kept").select("row.*")


#: DuckDB: the same figures from exploded words and lines.
SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, 'missing') AS host, coalesce(text, '') AS text FROM documents),
tokens AS (
  SELECT r, word, pos FROM (
    SELECT r, unnest(ws) AS word, unnest(range(len(ws))) AS pos
    FROM (SELECT r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM docs))),
counted AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars FROM tokens GROUP BY r),
windows AS (
  SELECT r, pos, word AS a, lead(word, 1) OVER w AS b, lead(word, 2) OVER w AS c
  FROM tokens WINDOW w AS (PARTITION BY r ORDER BY pos)),
again AS (
  SELECT r, pos FROM (SELECT r, pos, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows WHERE c IS NOT NULL) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, pos + k AS p FROM again, (SELECT unnest([0, 1, 2]) AS k)) GROUP BY r),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
base AS (
  SELECT d.doc_id, d.host, coalesce(t.n_words, 0) AS n_words, coalesce(t.word_chars, 0) AS word_chars,
         len(regexp_extract_all(d.text, '[#*$%&|<>]')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words,
         coalesce(t.n_words, 0) < 50 OR 100 * coalesce(c.n, 0) > 50 * coalesce(t.n_words, 0) AS base_failed
  FROM docs d LEFT JOIN counted t USING (r) LEFT JOIN lines l USING (r) LEFT JOIN covered c USING (r)),
hosts AS (SELECT host, count(*) AS n, sum(CAST(base_failed AS INT)) AS f FROM base GROUP BY host),
whole AS (SELECT sum(f) / CAST(sum(n) AS DOUBLE) AS mean, sum(f * f / CAST(n AS DOUBLE)) / sum(n) AS squares FROM hosts),
prior AS (
  SELECT mean, CASE WHEN squares - mean * mean > 1e-12
    THEN greatest(2.0, least(1e6, mean * (1 - mean) / (squares - mean * mean) - 1)) ELSE 1e6 END AS k FROM whole),
verdicts AS (SELECT host, (f + mean * k) / (n + k) <= 0.5 AS host_kept FROM hosts, prior)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND host_kept AS kept
FROM base JOIN verdicts USING (host)
"""
