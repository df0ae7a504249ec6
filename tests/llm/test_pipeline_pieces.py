"""The last stage of the pipeline against the model's own encoder and decoder."""

from collections import Counter

import public_tokenizers
from small_corpus import corpus, empty_folder, folder  # noqa: F401

import corpus_pipeline


def test_run_encodes_and_decodes_every_row(spark, folder, empty_folder):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.VOCABULARY))
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, folder)
    ids = [(r["doc_id"], model.encode(r["text"] or "")) for r in frame.collect()]
    expected = Counter((i, len(x), tuple(x), model.decode(x)) for i, x in ids)
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert expected and Counter((r["doc_id"], r["n_tokens"], tuple(r["ids"]), r["decoded"]) for r in found.collect()) == expected
    assert corpus_pipeline.run(spark, empty_folder).columns == found.columns
