"""Fingerprints against a plain vote over the terms of each text."""

import xxhash

from small_corpus import corpus, folder  # noqa: F401
from sparkrisk.llm import catalog


def plain(text):
    words = [w.decode() for w in (text or "").encode().split()]
    votes, total = [0] * 64, 0
    for before, word in zip([None, *words], words):
        seed = 42 if before is None else xxhash.xxh64_intdigest(before.encode(), 42)
        h = xxhash.xxh64_intdigest(word.encode(), seed)
        total += len(word)
        for bit in range(64):
            votes[bit] += len(word) * (h >> bit & 1)
    return f"{sum(1 << bit for bit in range(64) if 2 * votes[bit] > total):016x}"


def test_every_fingerprint_equals_a_plain_vote(spark, folder, corpus):
    got = {r["doc_id"]: r for r in catalog.QUERIES["op2_simhash_fingerprints"](spark, folder).collect()}
    order = sorted(zip(corpus["doc_id"].tolist(), corpus["text"].tolist()), reverse=True)
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        assert got[i]["fingerprint"] == plain(text)
        assert got[i]["edited_fingerprint"] == plain(text[:len(text) - cut] + following[:cut])
