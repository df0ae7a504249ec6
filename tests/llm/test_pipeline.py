"""The pipeline against a plain version of its stages."""

from collections import Counter

from small_corpus import corpus, empty_folder, folder  # noqa: F401
from test_queries import plain_components, plain_spans, rows_of

import corpus_pipeline


def test_stages_and_run(spark, folder, empty_folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    rules = rows_of(spark, folder, "op5_host_rules")
    kept = {i: t for i, t in before.items() if rules[i]["kept"]}
    frame = corpus_pipeline.quality(spark, docs, folder)
    assert frame.columns == columns and {r["doc_id"]: r["text"] for r in frame.collect()} == kept
    _, component = plain_components(kept, 5)
    kept = {i: t for i, t in kept.items() if component[i] == i}
    frame = corpus_pipeline.deduplicate(spark, frame, folder)
    assert frame.columns == columns and {r["doc_id"]: r["text"] for r in frame.collect()} == kept
    frame = corpus_pipeline.redact(spark, frame, folder)
    clean = {r["doc_id"]: r["text"] for r in frame.collect()}
    assert frame.columns == columns and set(clean) == set(kept)
    assert all(clean[i] == t for i, t in kept.items() if not plain_spans(t))
    frame = corpus_pipeline.mix(spark, frame, folder)
    mixed = frame.collect()
    assert frame.columns == columns and all(r["text"] == clean[r["doc_id"]] for r in mixed)
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 3
    words = sum(len(t.split()) for t in clean.values())
    assert words - max(len(t.split()) for t in clean.values()) <= sum(len(r["text"].split()) for r in mixed) <= words
    assert Counter(r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()) == Counter(r["doc_id"] for r in mixed)
    assert corpus_pipeline.run(spark, empty_folder).collect() == []
