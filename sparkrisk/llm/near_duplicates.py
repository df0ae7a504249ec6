"""Near-duplicates by SetSketch registers, bands, a joint likelihood and full sets."""

from __future__ import annotations

import hashlib
from collections import OrderedDict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from sparkrisk.llm.common import grams, hashed_words, map_texts
from sparkrisk.llm.links import components
from sparkrisk.session import materialize

SHINGLE = 5
PERCENT = 80
REGISTERS = 128
#: Register values of a band. A pair of similarity 0.8 agrees in none of 32 bands in 5 of 100 million cases.
ROWS = 4
#: The registers' base and rate, and their largest value (the parameters of 16-bit SetSketches).
BASE, RATE, LARGEST = 1.001, 20.0, 65_535
#: A pair goes no further if its most likely similarity is this much below the wanted one (over five deviations).
MARGIN = 0.2
#: Bits of a parity sketch, in longs of 64.
PARITY_LONGS = 16
_rng = np.random.default_rng(20240611)
_FACTORS = _rng.integers(1, 1 << 62, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 62, REGISTERS, dtype=np.uint64)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle, one without words has none."""
    return np.unique(grams(words, min(size, len(words)))) if len(words) else np.zeros(0, np.uint64)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers of non-empty sets: floor(1 - log_b x) of the least exponential draw x of the set's elements,
    cut to the register's range."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    every = np.concatenate(sets)
    least = np.empty((REGISTERS, len(sets)), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(REGISTERS):
            least[k] = np.minimum.reduceat(every * _FACTORS[k] + _SHIFTS[k], starts)
    x = -np.log1p(-(least.T + 1.0) / 2.0**64 * (1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, LARGEST).astype(np.uint16)


def similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs, from which registers are larger, smaller and equal and the sets' sizes."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u, v = na / (na + nb), nb / (na + nb)

    def p(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        up, down = p(u - v * j), p(v - u * j)
        return more * np.log(up) + less * np.log(down) + same * np.log(np.maximum(1 - up - down, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood has one peak
        left, right = low + (high - low) / 3, high - (high - low) / 3
        better = likelihood(left) < likelihood(right)
        low, high = np.where(better, left, low), np.where(better, high, right)
    return (low + high) / 2


def parities(s: np.ndarray) -> list[int]:
    """Bits that say for each value of a short hash whether an odd number of elements has it.

    The parities of two sets differ in at most as many bits as elements lie in one set only.
    """
    odd = np.bincount((s & np.uint64(64 * PARITY_LONGS - 1)).astype(np.int64), minlength=64 * PARITY_LONGS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def sketches(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """The other columns of every row and n, cls, sketch, odd of its text: size of the shingle set, a hash of the set, its
    registers and its parities. cls and what follows are missing for an empty set."""

    def work(texts):
        block: list[np.ndarray] = []

        def flush():
            full = [s for s in block if len(s)]
            rows = iter(registers(full)) if full else iter(())
            for s in block:
                if not len(s):
                    yield 0, None, None, None
                    continue
                r = next(rows)
                cls = int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
                yield len(s), cls, r.tobytes(), parities(s)

        for _, words in hashed_words(texts, lower=True, block=30_000):
            block.append(shingle_set(words, size))
            if sum(map(len, block[-1:])) > 30_000 or len(block) >= 64:
                yield from flush()
                block.clear()
        yield from flush()

    return map_texts(docs, "n long, cls long, sketch binary, odd array<long>", work, keep=tuple(c for c in docs.columns if c != "text"))


def _confirm(pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b, with sizes, sketches and texts) whose full sets are similar enough, as (a, b)."""
    import pyarrow as pa

    schema = StructType([StructField("a", pairs.schema["a"].dataType), StructField("b", pairs.schema["b"].dataType)])

    def run(batches):
        known: OrderedDict[int, np.ndarray] = OrderedDict()

        def set_of(cls, text):
            found = known.get(cls)
            if found is None:
                (_, words), = hashed_words([text], lower=True)
                found = known[cls] = shingle_set(words, size)
                while len(known) > 64:
                    known.popitem(last=False)
            return found

        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                column = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
                a, b = (np.frombuffer(b"".join(column[c].to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("sketch_a", "sketch_b"))
                na, nb = (column[c].to_numpy().astype(float) for c in ("n_a", "n_b"))
                likely = np.flatnonzero(similarity(a, b, na, nb) >= percent / 100 - MARGIN)
                out_a, out_b = [], []
                for k in likely.tolist():
                    ca, cb = column["a"][k].as_py(), column["b"][k].as_py()
                    sa, sb = set_of(ca, column["text_a"][k].as_py()), set_of(cb, column["text_b"][k].as_py())
                    both = len(np.intersect1d(sa, sb, assume_unique=True))
                    if 100 * both >= percent * (len(sa) + len(sb) - both):
                        out_a.append(ca)
                        out_b.append(cb)
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return pairs.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b", "text_a", "text_b").mapInArrow(run, schema)


def _fits(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _labelled(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n, component_id and chosen of every row.

    chosen says whether id and text are those that stand for the row's component: the least id, missing ones last, and
    of its texts the one of least hash. It is missing where the set is empty.

    Rows with equal sets are one class, so copies cost no links. In each band the classes with equal
    registers are compared with the bucket's least and greatest class; what these links join is one
    component. Then every pair of classes that share a bucket but not a component is compared, so no link that
    matters is lost. Pairs within a component are never formed, and pairs across become rows only if their sizes and
    parities leave room for the similarity; that test is exact, it loses no link.
    """
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    marked = materialize(sketches(keyed, size), "sketches")
    full = marked.where("cls IS NOT NULL")
    classes = materialize(full.groupBy("cls").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("odd").alias("odd"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("copy")), "classes")
    width = 2 * ROWS
    buckets = F.transform(F.sequence(F.lit(0), F.lit(REGISTERS // ROWS - 1)), lambda k: F.xxhash64(
        k, F.substring(F.col("sketch"), k * width + 1, F.lit(width))))
    members = classes.select("cls", "n", F.explode(buckets).alias("bucket"))
    ends = members.groupBy("bucket").agg(
        F.min(F.struct("cls", "n")).alias("first"), F.max(F.struct("cls", "n")).alias("last")).where("first.cls <> last.cls")
    shared = materialize(members.join(ends, "bucket"), "buckets")

    wanted = classes.join(shared.select("cls").distinct(), "cls", "left_semi").select(
        "cls", "n", "sketch", F.col("copy.doc_id").alias("id"), F.col("copy.text_hash").alias("hash"))
    texts = keyed.join(wanted, (F.col("text_hash") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("id")))
    info = materialize(texts.select("cls", "n", "sketch", "text").dropDuplicates(["cls"]), "texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        def side(s):
            return info.select(F.col("cls").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "sketch", "text")])

        return materialize(_confirm(pairs.join(side("a"), "a").join(side("b"), "b"), size, percent), "confirmed")

    stars = shared.select("cls", "n", F.explode(F.array("first", "last")).alias("end")).where(
        (F.col("cls") != F.col("end.cls")) & _fits(F.col("n"), F.col("end.n"), percent)).select(
        F.least("cls", "end.cls").alias("a"), F.greatest("cls", "end.cls").alias("b")).distinct()
    stars = materialize(stars, "stars")
    links = confirmed(stars)

    joined = components(links)
    rooted = shared.drop("first", "last").join(joined.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    rooted = materialize(rooted, "rooted")
    mixed = rooted.groupBy("bucket", "root").count().groupBy("bucket").agg(
        F.max(F.struct("count", "root"))["root"].alias("main"), F.count(F.lit(1)).alias("roots")).where("roots > 1").select("bucket", "main")
    odd = [f"odd{k}" for k in range(PARITY_LONGS)]
    rooted = rooted.join(mixed, "bucket").join(
        classes.select("cls", *[F.col("odd")[k].alias(c) for k, c in enumerate(odd)]), "cls")
    rooted = materialize(rooted, "mixed")
    outside = rooted.where("root <> main").select(
        "bucket", F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("root").alias("root_a"), *[F.col(c).alias(f"{c}_a") for c in odd])
    unequal = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_a"))) for c in odd), F.lit(0))
    # Similar sets have at most this many elements that are in one of them only.
    close = (100 + percent) * unequal <= (100 - percent) * (F.col("n") + F.col("n_a"))
    across = outside.join(rooted, "bucket").where(
        (F.col("root") != F.col("root_a")) & _fits(F.col("n"), F.col("n_a"), percent) & close).select(
        F.least("a", "cls").alias("a"), F.greatest("a", "cls").alias("b")).distinct().join(stars, ["a", "b"], "left_anti")
    more = confirmed(across)

    roots = components(links.union(more)).withColumnRenamed("node", "cls")
    rooted = classes.select("cls", "copy").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    smallest = rooted.groupBy("root").agg(F.min("copy").alias("best"))
    of_class = materialize(rooted.join(smallest, "root").select("cls", "best"), "components")
    chosen = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))
    return marked.select("doc_id", "text_hash", "n", "cls").join(of_class, "cls", "left").select(
        "doc_id", "text_hash", "n", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("component_id"),
        F.when(F.col("cls").isNotNull(), chosen).alias("chosen"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Texts are sets of shingles of ``size`` words, A to Z in lower case; a shorter text is one shingle. Rows are linked if the
    intersection of their sets is at least ``percent`` hundredths of the union. component_id is the smallest
    doc_id that links reach, kept says whether it is the row's own. Missing or empty texts are linked with nothing.
    A row without doc_id belongs to the component of its links, whose id is missing if none of them has one;
    it is kept only then. Repeated rows have equal sets. An empty table gives none.
    """
    return _labelled(docs, size, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns.

    It has the least doc_id of the group, missing ones come last; of equal ids the text of least hash, of repeated rows any one.
    Rows without text or words are linked with nothing, so all of them stay, repeated or not. An empty table gives none.
    """
    labels = materialize(_labelled(docs, size, percent).where("chosen").select("doc_id", "text_hash"), "kept")
    rows, distinct = labels.count(), labels.distinct().count()
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("own_id"),
        F.xxhash64("text").alias("own_hash"), wordless.alias("wordless"))
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash"))
    kept = own.join(labels.distinct(), same, "left").where(F.col("wordless") | F.col("text_hash").isNotNull())
    if rows > distinct:  # equal rows meet before the shuffle
        each = F.when(F.col("wordless"), F.monotonically_increasing_id()).alias("each")
        kept = kept.groupBy("own_id", "own_hash", each).agg(F.first("row").alias("row"))
    return kept.select("row.*")
