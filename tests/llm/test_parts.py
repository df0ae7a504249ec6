"""Parts of the corpus operators on their own, and rows that a table with a key cannot hold."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrisk.llm import fingerprints, language_models, links, mixing, near_duplicates, pieces, quality_rules, repeated_spans, sharding
from sparkrisk.llm.common import BROADCAST_BYTES, grams, hashed_words, lookup_join

SCHEMA = "doc_id long, text string, source string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


REPEATED = [(1, "a b c d e f", "s"), (1, "a b c d e f", "s"), (None, "a b c d e f", "s"), (None, None, None), (2, None, None), (2, "z", None)]


def test_repeated_rows_and_missing_ids(spark):
    docs = table(spark, REPEATED)
    marks = near_duplicates.near_duplicates(docs).collect()
    assert len(marks) == 6
    assert sorted(str(r["component_id"]) for r in marks) == ["1", "1", "1", "2", "2", "None"]
    assert sorted((str(r["doc_id"]), r["text"]) for r in near_duplicates.keep_one(docs).where("text IS NOT NULL").collect()) == [("1", "a b c d e f"), ("2", "z")]
    assert len(fingerprints.fingerprint_table(docs).collect()) == 6
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == 6 and sum(r["taken"] for r in mixed) <= 19
    shards = sharding.shard_rows(docs).collect()
    assert len(shards) == 6 and len({(r["shard"], r["slot"]) for r in shards}) == 6
    assert len(quality_rules.judge(docs).collect()) == 6
    assert len(repeated_spans.remove_repeated(docs).collect()) == 6
    assert len(language_models.score(docs, docs.select("doc_id")).collect()) == 6


def test_one_row_of_each_group_stays(spark):
    near = "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3
    docs = table(spark, [
        (None, near + "one", "s"), (None, near + "two", "s"), (None, near + "three", "s"),
        (5, "other words that stand alone here in this place", "s"), (5, "other words that stand alone here in this place", "t"),
        (7, "q w e r t y u i o p " * 3 + "z", "s"), (7, "q w e r t y u i o p " * 3 + "x", "s"), (None, "q w e r t y u i o p " * 3 + "v", "s"),
        (8, " \t", "s"), (8, " \t", "s"), (None, None, None)])
    kept = near_duplicates.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["5", "7", "8", "8", "None", "None"]
    assert kept.where("text IS NOT NULL AND doc_id IS NULL").count() == 1
    clashing = docs.withColumns({"text_hash": F.lit(1), "row": F.lit("r"), "best": F.lit(2)})
    assert sorted(near_duplicates.keep_one(clashing).columns) == sorted(clashing.columns)
    assert near_duplicates.keep_one(docs.limit(0)).count() == 0


def test_grams_tell_windows_apart():
    (_, words), = hashed_words(["a b c a b c a"])
    for n in range(1, 8):
        want = [tuple(words[k:k + n]) for k in range(len(words) - n + 1)]
        got = grams(words, n).tolist()
        assert len(got) == len(want) and len(set(got)) == len(set(want))
    assert len(grams(words, 8)) == 0


def test_a_window_and_its_copy_share_an_edge():
    r = random.Random(3)
    text = [str(r.randint(0, 500)) for _ in range(300)]
    (_, one), = hashed_words([" ".join(text)])
    (_, two), = hashed_words([" ".join(["x"] * 77 + text[50:150] + ["y"] * 40)])
    a, b = dict(zip(*[x.tolist() for x in repeated_spans.edges(one)])), dict(zip(*[x.tolist() for x in repeated_spans.edges(two)]))
    for start in range(50, 116):
        own = {p - start: h for p, h in a.items() if start <= p <= start + 35 - repeated_spans.EDGE}
        copy = {p - start - 27: h for p, h in b.items() if start + 27 <= p <= start + 27 + 35 - repeated_spans.EDGE}
        assert own.items() & copy.items()


def test_paths_end_at_branches(spark):
    chain = [(k, k + 1) for k in range(40)]
    arcs = spark.createDataFrame([*chain, (100, 7), (20, 200), (300, 301), (301, 300)], "a long, b long")
    path = {r["edge"]: r["path"] for r in repeated_spans.compact(arcs).collect()}
    assert {path[k] for k in range(1, 7)} == {0}
    assert {path[k] for k in range(8, 21)} == {7}
    assert {path[k] for k in range(22, 41)} == {21}
    assert 7 not in path and 21 not in path and 200 not in path
    assert path[300] == 300 and path[301] == 301


def test_components(spark):
    r = random.Random(1)
    edges = [(k, k + 1) for k in range(60)] + [(1000, r.randint(1001, 1100)) for _ in range(50)] + [(5, 5)]
    got = {x["node"]: x["root"] for x in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(61)) and all(v == 1000 for k, v in got.items() if k >= 1000)
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_likelihood_finds_the_similarity():
    r = np.random.default_rng(2)
    for shared in (0.2, 0.5, 0.8, 0.95):
        pairs = []
        for _ in range(60):
            every = r.integers(0, 1 << 63, 1000, dtype=np.uint64)
            own = int(1000 * (1 - shared) / 2)
            pairs.append((np.unique(every[: 1000 - own]), np.unique(every[own:])))
        a, b = (near_duplicates.registers([p[k] for p in pairs]) for k in (0, 1))
        sizes = [np.array([float(len(p[k])) for p in pairs]) for k in (0, 1)]
        found = near_duplicates.similarity(a, b, *sizes)
        assert abs(found.mean() - shared) < 0.02 and np.abs(found - shared).max() < near_duplicates.MARGIN


def test_sketches_merge():
    r = np.random.default_rng(4)
    a, b = r.integers(0, 1 << 63, 300, dtype=np.uint64), r.integers(0, 1 << 63, 200, dtype=np.uint64)
    one, two, both = near_duplicates.registers([a, b, np.concatenate([a, b])])
    assert (np.maximum(one, two) == both).all()


def test_parities_never_differ_more_than_the_sets():
    r = np.random.default_rng(6)
    for n in (1, 30, 400, 5000):
        a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[n // 5:], r.integers(0, 1 << 63, n // 7, dtype=np.uint64)]))
        unequal = sum(((x ^ y) & ((1 << 64) - 1)).bit_count() for x, y in zip(near_duplicates.parities(a), near_duplicates.parities(b)))
        assert unequal <= len(np.setxor1d(a, b))
        assert n > 400 or unequal >= 0.8 * len(np.setxor1d(a, b))


@pytest.mark.parametrize("radius, blocks", [(0, 1), (3, 6), (5, 8)])
def test_block_tables_find_all_within_the_radius(spark, radius, blocks):
    r = random.Random(9)
    near = [r.getrandbits(64) for _ in range(30)]
    values = near + [v ^ sum(1 << b for b in r.sample(range(64), k)) for v in near for k in range(1, 8)]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    got = {(x["query"], x["fingerprint"]): x["distance"] for x in fingerprints.within(df.limit(1000), df, radius, blocks).collect()}
    want = {(a, b): ((a ^ b) & ((1 << 64) - 1)).bit_count() for a in signed for b in signed}
    assert got == {k: d for k, d in want.items() if d <= radius}


def test_changed_weights_move_rows_only_in_or_out_of_their_subtree(spark):
    tree = sharding.topology(16)
    heavier = [sharding.Shard(s.shard, s.rack, s.region, 3.0 if s.shard == 5 else 1.0) for s in tree]
    rows = spark.range(4000).select(sharding.place(F.col("id"), tree).alias("a"), sharding.place(F.col("id"), heavier).alias("b")).collect()
    moved = [(r["a"], r["b"]) for r in rows if r["a"] != r["b"]]
    assert moved and all(b // 8 == 0 for a, b in moved if a // 8 == 1)
    assert all(b // 4 == 1 for a, b in moved if a // 8 == 0 and a // 4 == 0) and all(b == 5 for a, b in moved if a // 4 == 1)
    share = sum(r["b"] == 5 for r in rows) / len(rows)
    assert 0.13 < share < 0.21
    assert sharding.topology(17)[:16] == tree


def test_lookup_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = spark.range(1000).select((F.col("id") % 3).cast("string").alias("k"), "id")
    small = spark.createDataFrame([("0", 5), ("1", 6)], "k string, v int")
    want = sorted(map(tuple, lookup_join(rows, small, "k").collect()), key=repr)
    monkeypatch.setattr("sparkrisk.llm.common.BROADCAST_BYTES", 0)
    assert BROADCAST_BYTES > 0
    assert sorted(map(tuple, lookup_join(rows, small, "k").collect()), key=repr) == want


def test_codec_equals_the_library_on_random_texts():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model, codec = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Codec(pieces.load(path))
    r = random.Random(1)
    letters, vocabulary = "aabbee  tthhiinn \n\t▁éß.,!?1029<>中文한😀ＺﬁA", list(codec.pieces)
    for k in range(4000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 40))) if k % 2 else "".join(r.choice(vocabulary) for _ in range(r.randint(0, 9)))
        if k % 7 == 0:
            text = " " * r.randint(0, 40) + text + " " * r.randint(0, 40)
        ids = model.encode(text)
        assert codec.encode(text) == ids and codec.decode(ids) == codec.encode_joined(text)[2] == model.decode(ids)
    for ids in ([200, 3, 250], [0, 1, 260, 2], [256, 257], [231, 187, 131, 300]):
        assert codec.decode(ids) == model.decode(ids)


def test_host_prior_shrinks_small_hosts(spark):
    rows = [("big", k < 10) for k in range(100)] + [("small", True)] + [("bad", k < 95) for k in range(100)]
    got = {r["host"]: r["host_kept"] for r in quality_rules.host_verdicts(spark.createDataFrame(rows, "host string, base_failed boolean")).collect()}
    assert got["big"] and not got["bad"]
