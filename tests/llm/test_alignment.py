"""Alignment of two tokenizers against a plain version over the tokenizers' own libraries."""

import hashlib
import os
from collections import Counter

import numpy as np
import pytest

from small_corpus import corpus, empty_folder, folder  # noqa: F401
from sparkrisk.llm import alignment, catalog

public_tokenizers = pytest.importorskip("public_tokenizers")
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    """Tokens and bytes by the libraries, groups by the set of common ends, one link at a time."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(FIRST)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=SECOND)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in printable}
        letters |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
        self.letters = letters

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, bytes(self.letters[c] for c in self.first.id_to_token(i))) for i in self.first.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode())
             for i in self.second.encode(text) for p in [self.second.id_to_piece(i)]]
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])

    def groups(self, text):
        a, b = self.tokens(text)

        def ends(tokens):
            at = 0
            for i, raw in tokens:
                at += len(raw)
                yield i, at

        ends_a, ends_b = list(ends(a)), list(ends(b))
        common = sorted({e for _, e in ends_a} & {e for _, e in ends_b})
        out, low = [], 0
        for high in common:
            out.append(([i for i, e in ends_a if low < e <= high], [i for i, e in ends_b if low < e <= high]))
            low = high
        return out


def expected(texts):
    plain = Plain()
    groups = [plain.groups(t[:2000] if t else t) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    held = Counter(pair for c in links for pair in c)
    most = {}
    for (x, _), n in held.items():
        most[x] = max(n, most.get(x, 0))
    rows = []
    for g, c in zip(groups, links):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        rows.append((
            sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()), sum(n for p, n in c.items() if held[p] == most[p[0]]),
            sum(n * held[p] for p, n in c.items()), hashlib.sha256(said.encode()).hexdigest() if g else ""))
    return rows


def of(row):
    return tuple(row[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))


def test_table_equals_the_plain_version(spark, corpus):
    texts = [t[:2000] if t else t for t in corpus["text"]] + [
        "<|endoftext|> <s> </s> <0x41> <unk>", "a▁b", " ", "\n\n\t x", "é漢́😀" * 30, " " * 700 + "x", "\x00   z", "don't 1234567"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: of(r) for r in alignment.alignment(docs, FIRST, SECOND).collect()}
    assert got == dict(enumerate(expected(texts)))
    assert got[texts.index("a▁b")] == (0, 0, 0, 0, 0, 0, "")


def test_query_on_the_small_corpus(spark, folder, corpus):
    rows = catalog.QUERIES["op11_run_skipping_alignment"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(corpus["doc_id"])
    assert all(r["n_groups"] <= min(r["n_a"], r["n_b"]) and r["n_best"] <= r["n_links"] <= r["count_sum"] for r in rows)


def test_repeated_rows_and_missing_ids(spark):
    rows = [(1, "ab cd"), (1, "ab cd"), (None, "ab cd"), (None, None), (2, "")]
    got = alignment.alignment(spark.createDataFrame(rows, "doc_id long, text string"), FIRST, SECOND).collect()
    assert sorted((str(r["doc_id"]), r["n_links"] > 0, r["count_sum"] == 3 * r["n_links"]) for r in got) == [
        ("1", True, True), ("1", True, True), ("2", False, True), ("None", False, True), ("None", True, True)]


@pytest.mark.parametrize("seed", range(30))
def test_inner_tokens(seed):
    r = np.random.default_rng(seed)
    size = int(r.integers(1, 400))
    a, b = (np.unique(np.append(r.choice(size, int(r.integers(1, size + 1))), size)).astype(np.int64) for _ in range(2))
    if seed % 3 == 0:  # long stretches that agree
        b = np.unique(np.append(np.delete(a, r.integers(0, len(a), 3)), size)).astype(np.int64)
    inner_a, inner_b = alignment.inner_tokens(a, b)
    assert inner_a == [k for k, x in enumerate(a) if x not in set(b.tolist())]
    assert inner_b == [k for k, x in enumerate(b) if x not in set(a.tolist())]


def test_large_groups_are_counted_without_their_pairs():
    aligner = alignment.Aligner(FIRST, SECOND)
    (n_a, n_b, groups, links, _, pairs, times), = aligner.texts(["é漢́😀" * 400 + " " * 3000])
    assert sum(times) == links and len(set(pairs)) == len(pairs)
