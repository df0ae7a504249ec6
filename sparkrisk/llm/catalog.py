"""Registered queries of the corpus operators, with SQL where SQL can state them."""

from __future__ import annotations

from sparkrisk.llm import (
    alignment, fingerprints, language_models, main_text, mixing, near_duplicates, personal_data, pieces, quality_classifier, quality_rules,
    ranking, repeated_spans, sharding,
)


def _documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_ftrl_quality(spark, folder):
    return quality_classifier.classify(_documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op2_simhash_fingerprints(spark, folder):
    return fingerprints.fingerprint_table(_documents(spark, folder))


def op3_fair_queue_mix(spark, folder):
    return mixing.mix(_documents(spark, folder))


def op4_debruijn_substrings(spark, folder):
    return repeated_spans.remove_repeated(_documents(spark, folder))


def op5_host_rules(spark, folder):
    return quality_rules.judge(_documents(spark, folder))


def op6_boosted_spans(spark, folder):
    return personal_data.detect(_documents(spark, folder))


def op7_setsketch_near_duplicates(spark, folder):
    return near_duplicates.near_duplicates(_documents(spark, folder), size=4)


def op8_cross_entropy_difference(spark, folder):
    """Documents that labels call good are the target."""
    good = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").select("doc_id")
    return language_models.score(_documents(spark, folder), good)


def op9_hash_tree_shards(spark, folder):
    return sharding.shard_rows(_documents(spark, folder))


def op10_backtracking_pieces(spark, folder, vocabulary="piece_bpe_32k.model"):
    import public_tokenizers

    return pieces.digest_table(_documents(spark, folder), public_tokenizers.path(vocabulary))


def op11_run_skipping_alignment(spark, folder, first="byte_bpe_50k.json", second="piece_bpe_32k.model"):
    import public_tokenizers

    return alignment.alignment(_documents(spark, folder), public_tokenizers.path(first), public_tokenizers.path(second))


def op12_line_block_text(spark, folder):
    return main_text.extract_table(spark.read.parquet(f"{folder}/pages.parquet"))


def op13_norm_bucket_search(spark, folder):
    return ranking.search(_documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


QUERIES = {f.__name__: f for f in (
    op1_ftrl_quality, op2_simhash_fingerprints, op3_fair_queue_mix, op4_debruijn_substrings, op5_host_rules, op6_boosted_spans,
    op7_setsketch_near_duplicates, op8_cross_entropy_difference, op9_hash_tree_shards, op10_backtracking_pieces,
    op11_run_skipping_alignment, op12_line_block_text, op13_norm_bucket_search,
)}
SQL = {"op3_fair_queue_mix": mixing.SQL, "op5_host_rules": quality_rules.SQL, "op13_norm_bucket_search": ranking.SQL}
