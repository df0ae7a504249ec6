"""Search by norm buckets against plain scores of all documents, and what it prunes."""

import math
import re
from collections import Counter

import numpy as np

from small_corpus import corpus, empty_folder, folder  # noqa: F401
from sparkrisk.llm import catalog, ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    """docs: (doc_id, text), items: (item_id, text); sorted (item_id, rank, doc_id, score)."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, c.total()) for i, c in held if c]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in held:
            m = 100 - 75 + 75 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:10], 1)]
    return sorted(out, key=str)


def got(table):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in table.collect()), key=str)


def test_query_equals_plain_scores(spark, folder):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = plain(docs, items)
    assert want and got(catalog.QUERIES["op13_norm_bucket_search"](spark, folder)) == want


def test_ties_repeats_and_missing_ids(spark):
    docs = [(k % 7 if k % 5 else None, "alpha beta gamma" if k % 2 else "beta delta") for k in range(40)] + [(50, "rest " * 9)] * 40 + [(60, None), (None, None)]
    items = [(1, "alpha beta"), (1, "alpha beta"), (2, "delta delta rest"), (None, "gamma"), (3, None)]
    result = ranking.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got(result) == plain(docs, items)


def test_several_blocks_of_items(spark, folder, monkeypatch):
    whole = got(catalog.QUERIES["op13_norm_bucket_search"](spark, folder))
    monkeypatch.setattr(ranking, "BLOCK_BYTES", 2000)
    assert got(catalog.QUERIES["op13_norm_bucket_search"](spark, folder)) == whole


def bucket(r, n, size, scale):
    sizes = r.integers(1, 12, n)
    terms = np.concatenate([r.choice(size, k, replace=False) for k in sizes])
    return terms, r.integers(1, 4, len(terms)), np.full(n, 1, np.int64) * scale, sizes


def test_buckets_prune_and_lose_nothing():
    r = np.random.default_rng(4)
    words = [f"w{k}" for k in range(60)]
    queries = ranking.Queries([" ".join(r.choice(words, 6)) for _ in range(25)] + [" ".join(words)])
    queries.weigh(10_000, 400_000, {k: int(10_000 / (k + 2)) for k in range(60)})
    best, every, scored = ranking.Best(np.zeros(26, np.int64)), [[] for _ in range(26)], 0
    for part in range(6):
        terms, times, lengths, sizes = bucket(r, 500, 60, 10 * 3 ** part)
        impacts = queries.impacts(lengths, terms, times, sizes)
        ids = np.arange(500) + 500 * part
        offered = []
        keep = best.offer
        best.offer = lambda q, s, i, m: (offered.append(len(s)), keep(q, s, i, m))
        ranking.search_bucket(queries, best, ids, np.zeros(500, bool), impacts, terms, sizes, queries.norms(impacts, terms, sizes))
        best.offer = keep
        scored += sum(offered)
        ends = np.cumsum(sizes)
        for q, (own, many) in enumerate(zip(queries.terms, queries.times)):
            dense = np.zeros(60, np.int64)
            dense[own] = many * queries.weights[own]
            for d in range(500):
                s = slice(ends[d] - sizes[d], ends[d])
                every[q].append((-int((dense[terms[s]] * impacts[s]).sum()), False, int(ids[d])))
    assert [x[:10] for x in map(sorted, every)] == best.rows
    assert scored < 0.5 * 26 * 3000
