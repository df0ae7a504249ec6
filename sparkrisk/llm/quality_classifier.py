"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrisk.llm.common import map_texts, stirred

BUCKETS = 1 << 18
#: Labelled rows that are learned from at most: those with the smallest digest of their id.
TRAINING_DOCUMENTS = 8192
_TOKEN = re.compile(rb"[0-9A-Za-z_\x80-\xff]+|[^0-9A-Za-z_\x80-\xff\s]+")
_PAIR, _AGAIN, _LENGTH, _SALT = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 1, 1000, 0xD6E8FEB86659FD93))


def token_hashes(texts: Iterable[str | None], block: int = 300_000) -> Iterator[np.ndarray]:
    """For each text the hashes of its words; marks that stick to a word are words of their own."""
    words, sizes = [], []

    def flush():
        hashes = pd.util.hash_array(np.array([*words, b""], dtype=object)[:-1], categorize=False) if words else np.zeros(0, np.uint64)
        yield from np.split(hashes, np.cumsum(sizes)[:-1]) if sizes else ()

    for text in texts:
        own = _TOKEN.findall((text or "").encode("utf-8", "surrogatepass"))
        words += own
        sizes.append(len(own))
        if len(words) >= block:
            yield from flush()
            words, sizes = [], []
    yield from flush()


def features(tokens: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Sparse vector of a text: bucket numbers (they may repeat) and values.

    Words and pairs of words count by their share of the text. Two further features hold the share of pairs
    that the text has had before and the magnitude of its length; a constant is the bias.
    """
    n = len(tokens)
    with np.errstate(over="ignore"):
        pairs = stirred(tokens[:-1] * _PAIR + tokens[1:]) if n > 1 else np.zeros(0, np.uint64)
        special = stirred(np.array([0, _AGAIN, _LENGTH + np.uint64(n.bit_length())], np.uint64) * _SALT)
    again = len(pairs) - len(np.unique(pairs))
    index = (np.concatenate([special, stirred(tokens), pairs]) & np.uint64(buckets - 1)).astype(np.int64)
    values = np.full(len(index), 10.0 / max(n, 1))
    values[:3] = 1.0, 3.0 * again / max(len(pairs), 1), 1.0
    return index, values


def train(vectors: list[tuple[np.ndarray, np.ndarray, int]], buckets: int = BUCKETS, passes: int = 4,
          alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> np.ndarray:
    """Weights after the follow-the-regularised-leader updates of the vectors, in their order, again in each pass."""
    z, n = np.zeros(buckets), np.zeros(buckets)
    summed = []
    for index, values, label in vectors:
        own, place = np.unique(index, return_inverse=True)
        summed.append((own, np.bincount(place, values), label))

    def weights(z, n):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(passes):
        for index, values, label in summed:
            w = weights(z[index], n[index])
            g = (1.0 / (1.0 + np.exp(-np.clip(w @ values, -35, 35))) - label) * values
            grown = n[index] + g * g
            z[index] += g - (np.sqrt(grown) - np.sqrt(n[index])) / alpha * w
            n[index] = grown
    return weights(z, n)


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAINING_DOCUMENTS, buckets: int = BUCKETS) -> np.ndarray:
    """Weights learned from the texts of (doc_id, label) rows, of which at most ``most`` are used.

    Which ones depends on their ids alone. One task runs the updates, over vectors that many tasks make.
    Rows without id or label teach nothing; of several labels of an id the lowest counts; without any row
    all weights are zero.
    """
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = chosen.orderBy(order, "doc_id").limit(most)
    # At most ``most`` pairs of numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def vectors(batches):
        for frame in batches:
            for at in range(0, len(frame), 500):
                part = frame.iloc[at:at + 500]
                found = [features(t, buckets) for t in token_hashes(part["text"])]
                yield pd.DataFrame({
                    "turn": part["turn"].to_numpy(), "label": part["label"].to_numpy(),
                    "packed": [i.astype(np.int32).tobytes() + v.astype(np.float32).tobytes() for i, v in found]})

    def learn(batches):
        rows = sorted((r for f in batches for r in zip(f["turn"], f["packed"], f["label"])), key=lambda r: (r[0], r[1]))
        made = []
        for _, packed, label in rows:
            k = len(packed) // 8
            made.append((np.frombuffer(packed, np.int32, k).astype(np.int64), np.frombuffer(packed, np.float32, k, 4 * k).astype(float), int(label)))
        w = train(made, buckets) if made else np.zeros(buckets)
        yield pd.DataFrame({"weights": [zlib.compress(w.astype(np.float32).tobytes())]})

    packed = rows.select(order.alias("turn"), F.col("label").cast("int").alias("label"), "text").mapInPandas(
        vectors, "turn long, label int, packed binary")
    model = packed.repartition(1).mapInPandas(learn, "weights binary").first()
    return np.frombuffer(zlib.decompress(model["weights"]), np.float32).astype(float) if model else np.zeros(buckets)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id and score of every row: the logistic value of the dot product of weights and features.

    The weights are a vector of fixed length. Missing texts are empty ones, whose score rests on the bias and
    the length; repeated rows are scored each; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def work(texts):
        w = shared.value
        for tokens in token_hashes(texts):
            index, values = features(tokens, len(w))
            yield (float(1.0 / (1.0 + np.exp(-np.clip(w[index] @ values, -35, 35)))),)

    return map_texts(docs, "score double", work)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; learned from labels outside the held-out fold alone."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))
    known = labels.select("doc_id", F.col("quality").alias("label")).where(fold != 0)
    scored = score(docs, fit(docs, known))
    return scored.select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
