"""Alignment of two tokenizers: groups of tokens that cover the same bytes, and how often two tokens meet in a group.

Where both tokenizers end a token at the same byte, a group ends. Most texts have long stretches in which the
tokens are one to one: there the two lists of ends agree at one shift of their indices, and the length of the
stretch is found by comparing runs of 1, 2, 4, ... ends at that shift. Between stretches the two lists are walked
token by token up to their next common end, which also gives the next shift.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrisk.llm.common import lookup_join, map_texts
from sparkrisk.session import materialize

#: Fixed value: how byte-level vocabularies of this kind cut a text before they merge.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A pair of ids is one number: the first id above, the second below this many bits.
BITS = 20
#: Products of a group up to this size are written out pair by pair, larger ones by distinct ids.
SMALL_GROUP = 256


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1 stands for itself, the rest follows U+0100 upwards."""
    own = {b for b in range(256) if chr(b).isprintable() and b != 0x20}
    others = (b for b in range(256) if b not in own)
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """The first tokenizer: byte-level merges read from a JSON vocabulary. Special tokens are plain text."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        model, cut = stated["model"], stated["pre_tokenizer"]
        if model["type"] != "BPE" or cut["type"] != "ByteLevel" or not cut["use_regex"] or stated["normalizer"] is not None:
            raise ValueError("not byte-level merges over unchanged text")
        letters = byte_letters()
        special = {t["content"] for t in stated["added_tokens"] if t["special"]}
        raw = {i: bytes(letters[c] for c in entry) for entry, i in model["vocab"].items() if entry not in special}
        merged = ("".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"])
        if [model["vocab"][m] for m in merged] != list(range(256, 256 + len(model["merges"]))):
            raise ValueError("ids do not follow the order of the merges")
        self.raw = raw
        self.model = tiktoken.Encoding(path, pat_str=CUT, mergeable_ranks={r: i for i, r in raw.items()}, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.model.encode_ordinary(" " + t) for t in texts]


class Pieces:
    """The second tokenizer: a SentencePiece model that puts a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.raw = {
            i: bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            for i in range(self.model.get_piece_size()) for piece in [self.model.id_to_piece(i)]}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def inner_tokens(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """The places of two ascending arrays of ends (64 bits) whose ends the other one lacks. The last ends are equal."""
    raw_a, raw_b = a.tobytes(), b.tobytes()
    a, b = a.tolist(), b.tolist()
    n_a, n_b = len(a), len(b)
    inner_a, inner_b, i, j = [], [], 0, 0
    while i < n_a:
        x, y = a[i], b[j]
        if x == y:
            n, step = 1, 1
            longest = min(n_a - i, n_b - j)
            while n + step <= longest and raw_a[8 * (i + n):8 * (i + n + step)] == raw_b[8 * (j + n):8 * (j + n + step)]:
                n += step
                step *= 2
            while step := step // 2:
                if n + step <= longest and raw_a[8 * (i + n):8 * (i + n + step)] == raw_b[8 * (j + n):8 * (j + n + step)]:
                    n += step
            i += n
            j += n
            continue
        while x != y:
            if x < y:
                inner_a.append(i)
                i += 1
                x = a[i]
            else:
                inner_b.append(j)
                j += 1
                y = b[j]
        i += 1
        j += 1
    return inner_a, inner_b


def _starts(ends: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], ends[:-1]])


class Aligner:
    """Aligns the tokens of two tokenizers text by text."""

    def __init__(self, first: str, second: str):
        self.first, self.second = ByteLevel(first), Pieces(second)
        self.sizes = tuple(np.array([len(t.raw.get(i, b"")) for i in range(max(t.raw) + 1)], np.int64) for t in (self.first, self.second))
        self.written = [f"{i}{mark}" for i in range(max(len(s) for s in self.sizes)) for mark in ",|;"]

    def align(self, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[int, int, str, np.ndarray, np.ndarray]:
        """Groups, links, the groups as text, the pairs of ids and how many links each has."""
        inner_a, inner_b = inner_tokens(np.cumsum(self.sizes[0][ids_a]), np.cumsum(self.sizes[1][ids_b]))
        last_a, last_b = np.ones(len(ids_a), bool), np.ones(len(ids_b), bool)
        last_a[inner_a] = last_b[inner_b] = False
        ends_a, ends_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1  # of each group, exclusive
        starts_a, starts_b = _starts(ends_a), _starts(ends_b)
        n_a, n_b = ends_a - starts_a, ends_b - starts_b
        products = n_a * n_b

        codes = np.empty(len(ids_a) + len(ids_b), np.int64)  # tokens in the order in which groups are written
        codes[np.arange(len(ids_a)) + np.repeat(starts_b, n_a)] = ids_a * 3 + last_a
        codes[np.arange(len(ids_b)) + np.repeat(ends_a, n_b)] = ids_b * 3 + last_b * 2
        said = "".join(map(self.written.__getitem__, codes.tolist()))[:-1]

        small = np.flatnonzero(products <= SMALL_GROUP)
        group = np.repeat(small, products[small])
        within = np.arange(len(group)) - np.repeat(np.cumsum(products[small]) - products[small], products[small])
        wide = n_b[group]
        keys = ids_a[starts_a[group] + within // wide] << BITS | ids_b[starts_b[group] + within % wide]
        pairs, times = np.unique(keys, return_counts=True)
        if len(small) < len(products):
            large = Counter(dict(zip(pairs.tolist(), times.tolist())))
            for g in np.flatnonzero(products > SMALL_GROUP).tolist():
                own_b = Counter(ids_b[starts_b[g]:ends_b[g]].tolist())
                for x, many in Counter(ids_a[starts_a[g]:ends_a[g]].tolist()).items():
                    for y, more in own_b.items():
                        large[x << BITS | y] += many * more
            pairs, times = np.array(list(large), np.int64), np.array(list(large.values()), np.int64)
        return len(products), int(products.sum()), said, pairs, times

    def texts(self, texts: Iterable[str | None]):
        """For each text: tokens of both, groups, links, digest of the groups, pairs of ids and their links."""
        texts = [t or "" for t in texts]
        encoded = zip(texts, self.first.encode(texts), self.second.encode(texts))
        raw_a, raw_b = self.first.raw.__getitem__, self.second.raw.__getitem__
        for text, ids_a, ids_b in encoded:
            whole = b" " + text.encode("utf-8", "surrogatepass")
            if not text or b"".join(map(raw_b, ids_b)) != whole or b"".join(map(raw_a, ids_a)) != whole:
                yield 0, 0, 0, 0, "", [], []
                continue
            groups, links, said, pairs, times = self.align(np.array(ids_a, np.int64), np.array(ids_b, np.int64))
            yield len(ids_a), len(ids_b), groups, links, hashlib.sha256(said.encode()).hexdigest(), pairs, times


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(first: str, second: str) -> Aligner:
    """One for each pair of vocabularies and Python process."""
    if (first, second) not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[first, second] = Aligner(first, second)
    return _ALIGNERS[first, second]


def align_table(docs: DataFrame, first: str, second: str) -> DataFrame:
    """_row (a number of its own for each row), doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times, as a written table.

    ``first`` and ``second`` are paths of fixed vocabulary files that every executor has. Texts that are missing, empty or
    not the bytes of their tokens have no tokens. Batches hold 100 texts.
    """
    numbered = docs.select("doc_id", "text").withColumn("_row", F.monotonically_increasing_id())

    def work(texts: Iterable[str | None]):
        return _aligner(first, second).texts(texts)

    columns = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
    return materialize(map_texts(numbered, columns, work, keep=("_row", "doc_id"), rows=100), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, held (rows whose text links the pair), best (0 or 1: no pair of its first id is held by more rows)."""
    counts = materialize(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("held")), "pair-counts")
    first = F.shiftright("pair", BITS).alias("first")
    most = counts.groupBy(first).agg(F.max("held").alias("most"))
    return counts.select("*", first).join(most, "first").select("pair", "held", (F.col("held") == F.col("most")).cast("long").alias("best"))


def alignment(docs: DataFrame, first: str, second: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    Repeated rows are documents of their own and count each; rows without doc_id are kept. Texts without tokens have
    zeros and an empty digest. Ties for the most frequent pair all count as best. An empty table gives none.
    Other columns are not looked at.
    """
    aligned = align_table(docs, first, second)
    counts = materialize(pair_counts(aligned), "pair-best")
    links = aligned.select("_row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    sums = lookup_join(links, counts, "pair", "inner").groupBy("_row").agg(
        F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("held")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return aligned.join(sums, "_row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
