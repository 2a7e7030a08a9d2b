"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger stores the measurements
and one failure bit per rule.  A policy is a version name and a mask of the
rules it enforces, so applying a policy, comparing policies and ablating rules
never touch a text again: they are bitwise operations on the ledger.

Defined results: null or empty text has no words, so it fails ``few_words``; texts,
lines and words may be of any length; a measurement equal to a rule's bound passes;
identical rows get identical verdicts and are counted each; null ids are kept; an
empty table gives an empty ledger and no ablations; extra columns of ``docs``,
whatever their names, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.textstats import measure_documents


@dataclass(frozen=True)
class Rule:
    """A named failure condition over the measurements, in integer arithmetic."""

    name: str
    fails: str


#: The bit of a rule is its position; append new rules, never reorder them.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repetitive", "100 * n_repeat_words > 50 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    # One line said twice, as a header and a footer, is no sign of a bad text.
    Rule("duplicate_lines", "n_dup_lines > 1 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule("shouting", "2 * n_upper > word_chars"),
    Rule("exclamations", "2 * n_bangs > n_words"),
    Rule("endless_word", "longest_word > 1000"),
)
BIT = {rule.name: position for position, rule in enumerate(RULES)}


def mask_of(names: list[str] | tuple[str, ...]) -> int:
    return sum(1 << BIT[name] for name in names)


BASE_MASK = mask_of(["few_words", "repetitive"])

#: Versioned policies: the rules each version enforces.
POLICIES = {
    "v1": BASE_MASK,
    "v2": mask_of([rule.name for rule in RULES]),
}
CURRENT_POLICY = "v2"


def evaluate_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger: doc_id, measurements, ``fail_bits`` (bit i set when rule i fails)."""
    bits: Column = F.lit(0).cast("long")
    for position, rule in enumerate(rules):
        bit = F.when(F.expr(rule.fails), F.lit(1 << position)).otherwise(F.lit(0))
        bits = bits.bitwiseOR(bit.cast("long"))
    return measure_documents(docs).withColumn("fail_bits", bits)


def apply_policy(ledger: DataFrame, version: str = CURRENT_POLICY,
                 policies: dict[str, int] = POLICIES) -> DataFrame:
    """Add ``base_failed``, ``kept`` and ``policy`` from stored bits only."""
    bits = F.col("fail_bits")
    return ledger.select(
        "*",
        (bits.bitwiseAND(F.lit(BASE_MASK)) != 0).alias("base_failed"),
        (bits.bitwiseAND(F.lit(policies[version] | BASE_MASK)) == 0).alias("kept"),
        F.lit(version).alias("policy"))


def ablations(ledger: DataFrame, version: str = CURRENT_POLICY,
              policies: dict[str, int] = POLICIES,
              rules: tuple[Rule, ...] = RULES, weight: str | None = None) -> DataFrame:
    """What each rule of a policy does: rows (policy, rule, n_docs, n_failed, n_only,
    n_kept, n_kept_without).

    ``n_only`` counts documents that only this rule rejects.  The ledger is first
    reduced to one row per distinct failure mask (at most 2^rules, combined map-side),
    and the per-rule counts are sums over those masks.  A ledger that is reduced
    already names its column of counts in ``weight``.
    """
    mask = policies[version]
    histogram = (ledger.select(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits"),
                               (F.col(weight) if weight else F.lit(1)).alias("w"))
                 .groupBy("bits").agg(F.sum("w").alias("n")))
    active = [(i, r.name) for i, r in enumerate(rules) if mask >> i & 1]
    per_rule = F.explode(F.array(*[
        F.struct(F.lit(1 << i).cast("long").alias("bit"), F.lit(name).alias("rule"))
        for i, name in active]))
    count_if = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    bits, bit = F.col("bits"), F.col("bit")
    return (histogram.select("bits", "n", per_rule.alias("r")).select("bits", "n", "r.*")
            .groupBy("rule")
            .agg(F.sum("n").alias("n_docs"),
                 count_if(bits.bitwiseAND(bit) != 0).alias("n_failed"),
                 count_if(bits == bit).alias("n_only"),
                 count_if(bits == 0).alias("n_kept"),
                 count_if(bits.bitwiseAND(F.bitwise_not(bit)) == 0).alias("n_kept_without"))
            .select(F.lit(version).alias("policy"), "*"))


def policy_votes(ledger: DataFrame) -> DataFrame:
    """One row: bits that every document fails, that some fail, and document count."""
    return ledger.agg(F.bit_and("fail_bits").alias("failed_by_all"),
                      F.bit_or("fail_bits").alias("failed_by_some"),
                      F.count(F.lit(1)).alias("n_docs"))
