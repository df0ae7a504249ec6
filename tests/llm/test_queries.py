"""The registered corpus queries against plain versions, on a small corpus with awkward rows."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from compare import canonical
from small_corpus import corpus, empty_folder, folder  # noqa: F401
from sparkrisk.llm import catalog, personal_data


def rows_of(spark, folder, name):
    return {r["doc_id"]: r for r in catalog.QUERIES[name](spark, folder).collect()}


def words_of(text):
    return (text or "").encode().split()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def texts(corpus):
    return dict(zip(corpus["doc_id"].tolist(), corpus["text"].tolist()))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_empty_tables_give_no_rows(spark, empty_folder, name):
    assert catalog.QUERIES[name](spark, empty_folder).collect() == []


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, folder, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    assert canonical(catalog.QUERIES[name](spark, folder).toPandas()) == canonical(db.sql(catalog.SQL[name]).df())


def test_classifier_scores_every_document(spark, folder, texts):
    got = rows_of(spark, folder, "op1_ftrl_quality")
    assert set(got) == set(texts)
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    got = rows_of(spark, folder, "op1_ftrl_quality")
    labels = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if got[r["doc_id"]]["held_out"]]
    good, bad = ([got[r["doc_id"]]["score"] for r in labels if r["quality"] == q] for q in (1, 0))
    wins = sum((g > b) + (g == b) / 2 for g in good for b in bad)
    assert wins / (len(good) * len(bad)) > 0.97
    assert sum(got[r["doc_id"]]["predicted"] == r["quality"] for r in labels) / len(labels) > 0.93


def test_fingerprints(spark, folder, texts):
    got = rows_of(spark, folder, "op2_simhash_fingerprints")
    order = sorted(texts, reverse=True)
    value = {i: int(r["fingerprint"], 16) for i, r in got.items()}
    by_text = defaultdict(set)
    for k, i in enumerate(order):
        text, following = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        cut = len(text) // 3
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), sha(text[:len(text) - cut] + following[:cut]))
        apart = (value[i] ^ value[order[(k + 1) % len(order)]]).bit_count()
        assert r["near_next"] == pytest.approx(max(0, math.cos(math.pi * apart / 64)))
        apart = (value[i] ^ int(r["edited_fingerprint"], 16)).bit_count()
        assert r["near_edited"] == pytest.approx(max(0, math.cos(math.pi * apart / 64)))
        by_text[text].add(value[i])
        within = sum((value[i] ^ v).bit_count() <= 3 for v in value.values())
        assert r["n_within"] == (within if i % 100 == 0 else None)
    assert all(len(v) == 1 for v in by_text.values())


def test_mix_comes_near_its_targets(spark, folder, texts):
    got = list(catalog.QUERIES["op3_fair_queue_mix"](spark, folder).collect())
    assert sum(r["taken"] for r in got) <= sum(r["size"] for r in got)
    largest = max(r["size"] for r in got)
    taken, target = Counter(), {}
    for r in got:
        assert r["size"] == len(words_of(texts[r["doc_id"]])) and r["taken"] in {e * r["size"] for e in range(4)}
        taken[r["source_size"]] += r["taken"]
        target[r["source_size"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= largest for s in target)


def test_long_repeats_are_removed(spark, folder, texts):
    got = rows_of(spark, folder, "op4_debruijn_substrings")
    words = {i: words_of(t) for i, t in texts.items()}
    seen = Counter(tuple(w[k:k + 35]) for w in words.values() for k in range(len(w) - 34))
    removed = 0
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - 34):
            if seen[tuple(w[k:k + 35])] > 1:
                gone.update(range(k, k + 35))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(w), len(gone), hashlib.sha256(kept).hexdigest())
        removed += len(gone)
    assert removed > 1000


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
            luhn = sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 16 <= len(digits) <= 19 and luhn, "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_personal_data(spark, folder, texts):
    got = rows_of(spark, folder, "op6_boosted_spans")
    for i, text in texts.items():
        base = plain_spans(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        r = got[i]
        assert r["base_sha256"] == sha(joined)
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(x[0] == k for x in base) for k in PLAIN]
        found = r["spans"].split(",") if r["spans"] else []
        assert set(joined.split(",")) - {""} <= set(found)
        order = [(list(PLAIN).index(s.split(":")[0]), int(s.split(":")[1])) for s in found]
        assert order == sorted(order)


def test_personal_data_that_the_base_swallows_is_added(spark):
    folder = "/root/testdata/sf0.01"
    got = rows_of(spark, folder, "op6_boosted_spans")
    added = 0
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        base = {f"{k}:{a}:{b}" for k, a, b in plain_spans(r["text"] or "")}
        for span in set(got[r["doc_id"]]["spans"].split(",")) - base - {""}:
            kind, a, b = span.split(":")
            assert kind == "card" and re.fullmatch("[0-9]{16}", r["text"][int(a):int(b)])
            added += 1
    assert added > 0


def test_written_out_mail_is_added_and_a_wrong_address_is_not(spark):
    mail, address = "For more, write to jane.roe [at] example [dot] org today.", "The host 300.1.2.3 answers."
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(-1, mail), (-2, address), (-3, None), (-4, "")], "doc_id long, text string"))
    got = {r["doc_id"]: r for r in personal_data.detect(docs).where("doc_id < 0").collect()}
    start = mail.index("jane")
    assert got[-1]["spans"] == f"email:{start}:{mail.index(' today')}" and got[-1]["n_email"] == 0
    assert [got[i]["spans"] for i in (-2, -3, -4)] == [""] * 3


def test_thresholds_part_precise_from_imprecise_scores():
    bins = {("ip", 99): (50, 50), ("ip", 60): (100, 99), ("ip", 40): (10, 5), ("ip", 20): (9, 9), ("email", 90): (7, 7), ("card", 99): (100, 50), ("card", 10): (9000, 9000)}
    assert personal_data.calibrated(bins, 0.98) == {"ip": 0.505, "email": 0.45}


def test_very_many_matches_in_one_text(spark):
    """Positions, overlaps and cuts in a text of 20 000 addresses, also behind characters of several bytes."""
    text = "é😀 " + " ".join(f"u{k}@h{k % 97}.example.org 10.0.0.{k % 300}" for k in range(10_000))
    docs = spark.createDataFrame([(1, text, "kept")], "doc_id long, text string, masks string")
    base = plain_spans(text)
    got = personal_data.detect(docs).first()
    assert got["base_sha256"] == sha(",".join(f"{k}:{a}:{b}" for k, a, b in base))
    new = personal_data.redact(docs).first()
    assert new["text"] == plain_redaction(text, base) and new["masks"] == "kept"


def plain_redaction(text, spans):
    """Spans as (kind, start, end); of those that overlap the first is written."""
    out, at = "", 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += text[at:a] + f"[{k.upper()}]"
        at = max(at, b)
    return out + text[at:]


def test_redaction(spark, folder, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in personal_data.redact(docs).collect()}
    found = rows_of(spark, folder, "op6_boosted_spans")
    for i, text in zip(corpus["doc_id"], corpus["text"]):
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in found[i]["spans"].split(",") if s)]
        assert set(plain_spans(text or "")) <= set(spans)
        assert got[i]["text"] == (text if text is None else plain_redaction(text, spans))
        assert text is None or got[i]["n_chars"] == len(got[i]["text"])


def plain_components(texts, size, percent=80):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return sets, {i: find(i) for i in sets}


def test_near_duplicates(spark, folder, texts):
    got = rows_of(spark, folder, "op7_setsketch_near_duplicates")
    sets, component = plain_components(texts, 4)
    for i in texts:
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(sets[i]), component[i], component[i] == i)


def test_language_models(spark, folder, texts):
    got = rows_of(spark, folder, "op8_cross_entropy_difference")
    good = {r["doc_id"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if r["quality"] == 1}
    words, pairs = [Counter(), Counter()], [Counter(), Counter()]
    for i, t in texts.items():
        w = words_of(t)
        for k in (0, 1):
            if k or i in good:
                words[k].update(w)
                words[k][None] += 1
                pairs[k].update(zip([None, *w[:-1]], w))
    size = len(words[1]) - 1
    for i, t in texts.items():
        w, r, losses = words_of(t), got[i], []
        for k in (0, 1):
            n = words[k].total() - words[k][None]
            losses.append(-sum(math.log(
                0.5 * (pairs[k][v, x] / words[k][v] if words[k][v] else 0) + 0.5 * (words[k][x] + 0.5) / (n + 0.5 * size))
                for v, x in zip([None, *w[:-1]], w)))
        assert r["n_tokens"] == len(w)
        if w:
            assert r["target_loss"] == pytest.approx(losses[0] / len(w)) and r["background_loss"] == pytest.approx(losses[1] / len(w))
            assert r["difference"] == pytest.approx((losses[0] - losses[1]) / len(w), abs=1e-6)
        else:
            assert r["target_loss"] is r["background_loss"] is r["difference"] is None


def test_shards(spark, folder, texts):
    got = rows_of(spark, folder, "op9_hash_tree_shards")
    slots = defaultdict(list)
    for i, r in got.items():
        raw = (texts[i] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r["grown_shard"] in (r["shard"], 16) and 0 <= r["shard"] < 16
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_pieces(spark, folder, texts):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = rows_of(spark, folder, "op10_backtracking_pieces")
    for i, t in texts.items():
        ids = model.encode(t or "")
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids)))
