"""Column expressions, hashing of words and joins that the corpus operators share."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
_GAP_CHARACTERS = " \t\n\x0b\x0c\r"
#: A table may be broadcast up to this size, which is measured first.
BROADCAST_BYTES = 32 << 20
SALTS = 32


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def text_of(column: str = "text") -> Column:
    """The text, an empty one where it is missing."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text in their order; none for an empty or missing text."""
    inner = F.btrim(text, F.lit(_GAP_CHARACTERS))
    return F.when(F.coalesce(inner, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(inner, GAP))


def uniform(*parts: Column) -> Column:
    """A number strictly between 0 and 1 that the parts decide."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def power_of_two(x: float) -> int:
    return 1 << max(0, math.ceil(math.log2(max(1.0, x))))


def lookup_join(rows: DataFrame, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Joins ``rows`` to ``table``, which has one row for each value of ``key`` (never null).

    Any one key may hold a large share of ``rows``. The table is broadcast only if its measured
    size is below ``BROADCAST_BYTES``; otherwise the rows of a key are dealt over ``SALTS`` parts
    and each row of the table is repeated for each part.
    """
    width = sum((F.length(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) + 16 for c in table.columns), F.lit(0))
    size = table.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), key, how)
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("_salt", (F.rand(7) * SALTS).cast("int"))
    return dealt.join(salted, [key, "_salt"], how).drop("_salt")


def hashed_words(texts: Iterable[str | None], lower: bool = False, block: int = 400_000) -> Iterator[tuple[int, np.ndarray]]:
    """For each text its place and the 64-bit hashes of its words; words are hashed in blocks."""
    waiting: list[tuple[int, int]] = []
    words: list[bytes] = []

    def flush():
        hashes = pd.util.hash_array(np.array([*words, b""], dtype=object)[:-1], categorize=False) if words else np.zeros(0, np.uint64)
        at = 0
        for place, n in waiting:
            yield place, hashes[at:at + n]
            at += n

    for place, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        own = (raw.lower() if lower else raw).split()  # for bytes both touch ASCII only
        waiting.append((place, len(own)))
        words += own
        if len(words) >= block:
            yield from flush()
            waiting, words = [], []
    yield from flush()


def stirred(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (the finalizer of SplitMix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = np.uint64(0x9E3779B97F4A7C15)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word windows of a sequence of word hashes, by doubling; none if it is shorter."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        power, square, done, have, out = _BASE, words, 0, 1, None
        while True:
            if n & have:
                m = len(words) - n + 1
                piece = square[done:done + m]
                out = piece.copy() if out is None else out * power + piece
                done += have
            if done == n:
                return stirred(out + np.uint64(n))
            square = square[:-have] * power + square[have:]
            power, have = power * power, have * 2


def map_texts(
    docs: DataFrame, columns: str, work: Callable[[Iterable[str | None]], Iterable[tuple]], keep: tuple[str, ...] = ("doc_id",), rows: int = 500,
) -> DataFrame:
    """The columns ``keep`` and what ``work`` yields for each text, in Arrow batches of at most ``rows`` documents.

    ``columns`` declares the yielded columns; a text is never cut.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    chosen = docs.select(*keep, "text")
    k = len(keep)
    schema = StructType(chosen.schema.fields[:k] + StructType.fromDDL(columns).fields)
    kinds = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                found = list(work(part.column(k).to_pylist()))
                kept = [part.column(i).cast(kinds.types[i]) for i in range(k)]
                made = [pa.array([x[i] for x in found], kinds.types[k + i]) for i in range(len(kinds) - k)]
                yield pa.RecordBatch.from_arrays(kept + made, schema=kinds)

    return chosen.mapInArrow(run, schema)
