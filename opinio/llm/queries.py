"""The registered queries of the corpus operators and their DuckDB SQL where SQL can express them.

Each query applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers

from opinio.llm import audit, bpe, chat, exact, langid, minhash, mix, pack, pq, resample, scoring, shard, suffix
from opinio.llm.common import read
from opinio.llm.oracle import LLM_ORACLE  # noqa: F401


def op8_block_naming(spark, sf_dir):
    return exact.exact_dedup(read(spark, sf_dir, "documents", "doc_id", "text"))


def op1_pq_neardup(spark, sf_dir):
    return pq.near_vectors(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op2_golden_ratio_mix(spark, sf_dir):
    mixed = mix.mix(read(spark, sf_dir, "documents", "doc_id", "source", "text")).documents
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_minhash_bayes(spark, sf_dir):
    found = minhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_masked_pseudo_likelihood(spark, sf_dir):
    return scoring.score(read(spark, sf_dir, "documents", "doc_id", "text"))


def op5_longest_previous_factor(spark, sf_dir):
    return suffix.remove_repeats(read(spark, sf_dir, "documents", "doc_id", "text")).drop("kept")


def op6_label_propagation(spark, sf_dir):
    placed = shard.balanced_shards(read(spark, sf_dir, "documents", "doc_id", "text"))
    return placed.drop("link")


def op7_naive_bayes(spark, sf_dir):
    return langid.identify(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op9_role_repair(spark, sf_dir):
    return chat.repair(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op10_word_bpe(spark, sf_dir):
    vocabulary = bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    return bpe.digests(bpe.bpe(read(spark, sf_dir, "documents", "doc_id", "text"), vocabulary))


def op11_importance_resampling(spark, sf_dir):
    return resample.importance_resample(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "text"))


def op12_filter_audit(spark, sf_dir):
    return audit.filter_audit(read(spark, sf_dir, "documents", "doc_id", "text", "lang"),
                              read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op13_sum_of_squares_packing(spark, sf_dir):
    vocabulary = bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    return pack.digests(pack.pack(read(spark, sf_dir, "documents", "doc_id", "text"), vocabulary))


LLM_QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_pq_neardup": op1_pq_neardup,
    "op2_golden_ratio_mix": op2_golden_ratio_mix,
    "op3_minhash_bayes": op3_minhash_bayes,
    "op4_masked_pseudo_likelihood": op4_masked_pseudo_likelihood,
    "op5_longest_previous_factor": op5_longest_previous_factor,
    "op6_label_propagation": op6_label_propagation,
    "op7_naive_bayes": op7_naive_bayes,
    "op9_role_repair": op9_role_repair,
    "op10_word_bpe": op10_word_bpe,
    "op8_block_naming": op8_block_naming,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_filter_audit": op12_filter_audit,
    "op13_sum_of_squares_packing": op13_sum_of_squares_packing,
}
