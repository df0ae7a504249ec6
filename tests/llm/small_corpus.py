"""A small corpus with the awkward rows that every operator must take, read from files like the real tables."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

CLASHING = ("host", "n", "cls", "m", "turn", "key", "text_hash", "row", "size", "kept", "range", "place", "bucket", "_salt", "score")


def awkward_texts():
    r = random.Random(5)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(900)]

    def prose(n):
        return " ".join(r.choice(words) for _ in range(n))

    base, passage = prose(220), prose(60)
    near = base.split()
    near[100] = "changed"
    shared = [prose(40) + " " + passage + "\n" + prose(30) for _ in range(3)]
    return [
        None, "", " \t\n\x0b\x0c\r ", "one", "One", "two words", "a b a b a b a b", base, base, base.upper(), " ".join(near), *shared,
        passage, prose(30_000), "x" * 60_000, "the " * 300, ("line one\n" * 5) + "line two", "1" * 5000 + "." + "2" * 50,
        "mail a.b@c.example.org, +1 (017) 555-7713 or 4111 1111 1111 1111, host 10.0.0.300 and 10.0.0.30",
        "cards 4111111111111111 4111111111111111 and 5500005555555559", "a@b.c@d.e x_y@z.q-r.s+1234567890 +12 34",
        "#*$%&|<> #*$%&|<>", "日本語 テキスト 😀 ▁ ﬁ　x", "  two  spaces   \n\n end ", *[prose(r.randint(1, 120)) for _ in range(40)],
    ]


@pytest.fixture(scope="session")
def corpus():
    texts = awkward_texts()
    return pd.DataFrame({
        "doc_id": range(3, 3 + 7 * len(texts), 7), "text": texts,
        "lang": [None if k % 9 == 0 else "en" for k in range(len(texts))],
        "source": [None if k % 11 == 5 else f"s{k % 4 if k % 3 else 0}" for k in range(len(texts))],
        "n_chars": [len(t or "") for t in texts],
    })


@pytest.fixture(scope="session")
def folder(spark, corpus, tmp_path_factory):
    """The corpus as tables, with further columns whose names the operators use themselves."""
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame(corpus, "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumns({c: F.lit(c) for c in CLASHING}).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = pd.DataFrame({"doc_id": corpus["doc_id"], "quality": [int(len(t or "") > 200 and t != "the " * 300) for t in corpus["text"]], "toxic": 0})
    spark.createDataFrame(labels).write.parquet(f"{path}/labels.parquet")
    pages = [(k, f"http://h{k % 3}.example.org/", html, k) for k, html in enumerate(awkward_pages())]
    spark.createDataFrame(pages + [(None, None, None, 0), *pages[-1:]], "page_id long, url string, html string, text long").write.parquet(f"{path}/pages.parquet")
    items = [(k, t, "x") for k, t in enumerate(asked(corpus["text"].tolist()))]
    spark.createDataFrame(items, "item_id long, text string, score string").write.parquet(f"{path}/benchmark.parquet")
    return path


def asked(texts):
    """Texts to search for: passages, whole documents, one term, terms that nothing holds, none at all."""
    whole = [t for t in texts if t and len(t) > 100]
    return [" ".join(whole[0].split()[:40]), whole[-1], "two", "the the THE line", "日本語 テキスト", "qqqq-unknown", "", None, whole[8][:3000]]


def awkward_pages():
    return ["", "plain text only", "<p>" + "one two three " * 40 + "<p>x</p><ul>" + "<li><a href=/a>a</a>" * 9, "<article><p>short</article>"]


@pytest.fixture(scope="session")
def empty_folder(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "pages", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").write.parquet(f"{path}/{name}.parquet")
    return path
