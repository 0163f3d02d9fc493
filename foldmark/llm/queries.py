"""The dealt operators as registered queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foldmark.catalog.registry import query
from foldmark.llm import decontamination, licenses, packing, passages, pii, repeats, resampling, sharding, simhash, token_files, topk, toxicity, turn_trie
from foldmark.llm.common import table


@query("op1_bounded_ring")
def op1_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query("op2_uniform_threshold_topk")
def op2_uniform_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings"))


@query("op3_semi_markov_pii")
def op3_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


@query("op4_chain_toxicity")
def op4_chain_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_simhash_multi_index")
def op5_simhash_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op7_suffix_sorted_repeats")
def op7_suffix_sorted_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


@query("op8_rare_token_licenses")
def op8_rare_token_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query("op9_rans_token_files")
def op9_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_rows(table(spark, sf_dir, "documents"))


@query("op10_seeded_alignment_leaks")
def op10_seeded_alignment_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_target_resampling", resampling.ORACLE_SQL)
def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_anchored_passages", passages.ORACLE_SQL)
def op12_anchored_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passage_digests(table(spark, sf_dir, "documents"))


@query("op13_turn_trie", turn_trie.ORACLE_SQL)
def op13_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_trie.trie_nodes(table(spark, sf_dir, "conversations"))
