"""The registered corpus queries: each reads whole tables and calls its operator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import (clusters, lines, mixing, packing, quality_ranker, quality_rules,
                           repeats, secrets, simhash, substrings, token_counts, trie, vectors)
from riskframe.llm.common import materialize, read_table
from riskframe.llm.oracles import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality_rules.evaluate_rules(read_table(spark, sf_dir, "documents"))
    return quality_rules.apply_policy(ledger).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "fail_bits", "policy")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every rule of every policy version rejects, from one evaluation of the rules."""
    ledger = quality_rules.evaluate_rules(read_table(spark, sf_dir, "documents"))
    bits = materialize(ledger.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n_docs")),
                       "failure-masks")
    return reduce(DataFrame.unionByName, [
        quality_rules.ablations(bits, version, weight="n_docs")
        for version in quality_rules.POLICIES])


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    trees = materialize(token_counts.build_trees(read_table(spark, sf_dir, "documents")),
                        "token-trees")
    edits = token_counts.find_edits(trees, token_counts.redactions)
    return token_counts.apply_edits(edits).select(
        "doc_id", "n_tokens_before", "n_edits", "n_reencoded", "n_tokens")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicate_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality_ranker.train_on(docs, read_table(spark, sf_dir, "labels"))
    return quality_ranker.score_documents(docs, model)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains = mixing.domain_of_labels(read_table(spark, sf_dir, "labels"))
    mixed = mixing.fit_mixture(read_table(spark, sf_dir, "documents"), domains, mixing.TARGETS)
    shares = [F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(mixing.TARGETS)]
    missed = [f"missed_{d}" for d in mixing.TARGETS]
    return mixed.select("doc_id", "n_tokens", *shares, "rate", *missed)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeated_spans(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = lines.remove_repeated_lines(
        read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_removed",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(
        F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("found", lambda s: s["kind"] < len(secrets.BASE_RULES))
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.span_digest(base), 256).alias("base_sha256"),
        secrets.span_digest(F.col("found")).alias("spans"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(read_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans",
                       F.sha2("kept", 256).alias("kept_sha256"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clusters.cluster_vectors(read_table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        "centroid_sha256")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "quality_ablations": quality_ablations,
    "op2_token_counts": op2_token_counts,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_simhash": op4_simhash,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_mixing": op6_mixing,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_suffix_array_dedup": op11_suffix_array_dedup,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_prefix_trie": op13_prefix_trie,
}
