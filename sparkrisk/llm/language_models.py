"""Scores documents by the difference of two language models' losses.

A target model learns from chosen documents, a background model from all. Both are interpolated word
pairs and words over one vocabulary, the words of all documents. The counts are exact (n-grams are told
apart by 64-bit hashes) and grow with the input, so they are never in one place: documents are dealt into
chunks, a chunk counts its own n-grams once, and each range of n-gram hashes adds up what all chunks have
counted and returns to each chunk the sums of the n-grams it has asked for.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrisk.llm.common import hashed_words, power_of_two, stirred

#: Documents of a chunk, which one task holds at a time.
CHUNK = 2048
PAIRS = 0.5
SMOOTHING = 0.5
#: N-gram hashes have 64 bits, the last of which tells words from pairs.
_ONE = np.uint64(1)
_START = np.uint64(0x5DEECE66D)


def _keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each word, of the word before it (or the start) and of the pair."""
    own = np.concatenate([[_START], words])
    singles = stirred(own) | _ONE
    with np.errstate(over="ignore"):
        pairs = stirred(own[:-1] * np.uint64(0x9E3779B97F4A7C15) + own[1:]) & ~_ONE
    return singles[1:], singles[:-1], pairs


_START_KEY = _keys(np.array([1], np.uint64))[1][0]


def _chunk_keys(texts) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    found = [_keys(words) for _, words in hashed_words(texts)]
    return [f[0] for f in found], [f[1] for f in found], [f[2] for f in found]


def _pack(numbers: np.ndarray) -> bytes:
    """Sorted distinct numbers as differences of 48 bits; the few that need more keep their upper bits aside."""
    steps = np.diff(numbers, prepend=np.uint64(0))
    high = (steps >> np.uint64(48)).astype(np.uint16)
    at = np.flatnonzero(high).astype(np.uint32)
    low = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return np.array([len(at)], np.uint32).tobytes() + at.tobytes() + high[at].tobytes() + low.tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    at, high = np.frombuffer(raw, np.uint32, n, 4), np.frombuffer(raw, np.uint16, n, 4 + 4 * n)
    low = np.frombuffer(raw, np.uint8, -1, 4 + 6 * n).reshape(-1, 6)
    steps = np.zeros((len(low), 8), np.uint8)
    steps[:, :6] = low
    steps = steps.reshape(-1).view("<u8").astype(np.uint64)
    steps[at] |= high.astype(np.uint64) << np.uint64(48)
    return np.cumsum(steps, dtype=np.uint64)


def _squeeze(counts: np.ndarray) -> bytes:
    """Counts in as many bytes (1, 2, 4 or 8, kept in front) as the largest needs, compressed."""
    width = np.min_scalar_type(int(counts.max(initial=0))).itemsize
    return bytes([width]) + zlib.compress(counts.astype(f"u{width}").tobytes(), 1)


def _counts(raw: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw[1:]), f"u{raw[0]}").astype(np.int64)


def score(docs: DataFrame, target: DataFrame, chunk: int = CHUNK, pairs: float = PAIRS, smoothing: float = SMOOTHING) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, difference of every row; the last is the mean over tokens of the target's
    less the background's loss (in nats), lower for documents that are more like the target.

    ``target`` has the doc_ids of the target documents. p(w | v) is ``pairs`` c(v w) / c(v) plus the rest times
    (c(w) + s) / (n + s V) in both models, with V the number of words of all documents. Missing and empty texts have no
    tokens and no losses; rows without doc_id are background; repeated rows count as often as they occur; an
    empty table gives none, an empty target leaves the smoothed words alone.
    """
    kind = dict(docs.dtypes)["doc_id"]
    number = max(1, -(-docs.count() // chunk))
    ranges = power_of_two(number / 2)
    starts = np.arange(1, ranges, dtype=np.uint64) << np.uint64(65 - ranges.bit_length())

    def of(column):
        return F.pmod(F.xxhash64(column), F.lit(number))

    dealt = docs.select(
        F.when(F.col("doc_id").isNull(), of(F.col("text"))).otherwise(of(F.col("doc_id").cast("string"))).alias("chunk"),
        F.col("doc_id").cast("string").alias("doc_id"), "text")
    chosen = target.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("string").alias("doc_id")).distinct().select(
        of(F.col("doc_id")).alias("chunk"), "doc_id")

    def count(key, rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"part": [], "chunk": [], "keys": [], "n": [], "n_target": []})
        in_target = rows["doc_id"].isin(set(wanted["doc_id"])).to_numpy()
        words, before, both = _chunk_keys(rows["text"])
        start = [np.array([_START_KEY])] * len(rows)
        every = np.concatenate([x for doc in zip(words, both, start) for x in doc])
        sizes = [len(w) * 2 + 1 for w in words]
        marks = np.repeat(in_target, sizes)
        keys, place = np.unique(every, return_inverse=True)
        n, n_target = np.bincount(place, minlength=len(keys)), np.bincount(place[marks], minlength=len(keys))
        cuts = np.searchsorted(keys, starts)
        return pd.DataFrame({
            "part": np.arange(ranges), "chunk": key[0], "keys": [_pack(k) for k in np.split(keys, cuts)],
            "n": [_squeeze(c) for c in np.split(n, cuts)], "n_target": [_squeeze(c) for c in np.split(n_target, cuts)]})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [_unpack(k) for k in rows["keys"]]
        sums, place = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(place, np.concatenate([_counts(c) for c in rows["n"]]), len(sums))
        n_target = np.bincount(place, np.concatenate([_counts(c) for c in rows["n_target"]]), len(sums))
        words = (sums & _ONE).astype(bool) & (sums != _START_KEY)
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        return pd.DataFrame({
            "part": rows["part"], "chunk": rows["chunk"],
            "n": [_squeeze(n[p]) for p in np.split(place, cuts)], "n_target": [_squeeze(n_target[p]) for p in np.split(place, cuts)],
            "words": int(words.sum()), "all": int(n[words].sum()), "all_target": int(n_target[words].sum())})

    def losses(rows: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        words, before, both = _chunk_keys(rows["text"])
        sizes = np.array([len(w) for w in words])
        sums = sums.sort_values("part")
        word, prior, pair = (np.concatenate(x) if len(x) else np.zeros(0, np.uint64) for x in (words, before, both))
        keys = np.unique(np.concatenate([word, pair, [_START_KEY]]))
        vocabulary = sums["words"].sum()
        at = [np.searchsorted(keys, x) for x in (word, prior, pair)]
        means = []
        for column, total in (("n_target", "all_target"), ("n", "all")):
            c = np.concatenate([_counts(x) for x in sums[column]]).astype(float)
            if len(c) != len(keys):
                raise ValueError("a chunk was not counted as it is now")
            w, v, vw = (c[a] for a in at)
            p = pairs * np.divide(vw, v, out=np.zeros(len(vw)), where=v > 0) + (1 - pairs) * (w + smoothing) / (sums[total].sum() + smoothing * vocabulary)
            loss = np.concatenate([[0.0], np.cumsum(-np.log(p))])
            ends = np.cumsum(sizes)
            means.append(np.where(sizes > 0, (loss[ends] - loss[ends - sizes]) / np.maximum(sizes, 1), np.nan))
        return pd.DataFrame({
            "doc_id": rows["doc_id"], "n_tokens": sizes, "target_loss": means[0], "background_loss": means[1], "difference": means[0] - means[1]})

    counted = dealt.groupBy("chunk").cogroup(chosen.groupBy("chunk")).applyInPandas(
        count, "part long, chunk long, keys binary, n binary, n_target binary")
    added = counted.groupBy("part").applyInPandas(
        add, "part long, chunk long, n binary, n_target binary, words long, `all` long, all_target long")
    scored = dealt.groupBy("chunk").cogroup(added.groupBy("chunk")).applyInPandas(
        losses, "doc_id string, n_tokens long, target_loss double, background_loss double, difference double")
    clean = [F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("target_loss", "background_loss", "difference")]
    return scored.select(F.col("doc_id").cast(kind).alias("doc_id"), "n_tokens", *clean)
