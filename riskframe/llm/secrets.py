"""Secret scan over a trigram inverted index, in DataFrame functions only.

From each rule's regex a Boolean trigram query is derived: an OR of ANDs of
trigrams that every match must contain.  Documents are indexed once (postings:
trigram -> row); a rule's candidates are the rows whose postings meet all
trigrams of one of its alternatives.  Candidates are verified with the regex
itself.  A rule whose regex has no mandatory trigram scans every text.

Postings hold the trigrams that the rule set asks for, on lower-cased text, so
case-insensitive rules use the same index; lower-casing can only add candidates.

Defined results: null text counts as empty and has no spans; repeated rows get
the same spans; a very long text is scanned whole, however many matches it has;
spans are in code points, end exclusive, in order of their start, those that start
together in the rules' order; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import ROW_KEY, materialize, row_key

GRAM = 3
#: Optional parts and small classes are expanded while a rule has fewer alternatives than this.
MOST_ALTERNATIVES = 64


@dataclass(frozen=True)
class SecretRule:
    """A kind of secret: its regex and the least length of ``group`` for a match to count.

    ``plain`` states the same matches for engines without possessive repeats.
    """

    kind: str
    regex: str
    group: int = 0
    least: int = 1
    plain: str = ""


#: The base rules.  A maximal run of 32 or more hex digits is what remains of
#: all hex runs once the shorter ones are dropped, so the regex asks for it directly.
BASE_RULES = (
    SecretRule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                         r"""([A-Za-z0-9+/_.=-]+)""", group=2, least=8),
    SecretRule("access", r"AKIA[A-Z0-9]+", least=16),
    SecretRule("hex", r"[0-9a-f]{32,}"),
)

#: Spans the method adds to the base ones.
ADDED_RULES = (
    # A repeated group must be possessive: Java recurses once a repeat otherwise, and a
    # long header would end the executor.  The words stop where the key's own begin.
    SecretRule("private_key",
               r"-----BEGIN (?:(?!PRIVATE KEY-----)[A-Z]++ )*+PRIVATE KEY-----",
               plain=r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    SecretRule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    SecretRule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}"),
)
RULES = BASE_RULES + ADDED_RULES


def _literal_runs(nodes) -> list[list[str]]:
    """Alternatives of a parsed regex: each a list of literal runs, in lower case.

    A run's text is contiguous in every match; an empty string ends a run.
    """
    found: list[list[str]] = [[""]]
    for kind, value in nodes:
        name = str(kind)
        if name == "LITERAL":
            parts = [[chr(value).lower()]]
        elif name == "SUBPATTERN":
            parts = _literal_runs(value[-1])
        elif name == "BRANCH":
            parts = [runs for branch in value[1] for runs in _literal_runs(branch)]
        elif name == "IN" and len(value) <= 5 and all(str(k) == "LITERAL" for k, _ in value):
            parts = [[c] for c in sorted({chr(v).lower() for _, v in value})]
        elif name == "MAX_REPEAT" and value[:2] == (0, 1):
            parts = [[""], *_literal_runs(value[2])]
        elif name == "MAX_REPEAT" and value[0] >= 1:
            parts = [[*runs, "", ""] for runs in _literal_runs(value[2])]
        else:
            parts = [["", ""]]  # unknown text: the run ends, another begins
        if len(found) * len(parts) > MOST_ALTERNATIVES:
            parts = [["", ""]]
        found = [[*a[:-1], a[-1] + b[0], *b[1:]] for a, b in product(found, parts)]
    return found


def trigram_query(regex: str) -> list[frozenset[str]] | None:
    """The trigrams that a match must contain, as an OR of ANDs; None: scan fully."""
    alternatives = {
        frozenset(run[i:i + GRAM] for run in runs for i in range(len(run) - GRAM + 1))
        for runs in _literal_runs(re._parser.parse(regex))}
    if not all(alternatives):
        return None
    # An alternative that asks for all of another's trigrams and more adds nothing to the OR.
    return sorted((a for a in alternatives if not any(b < a for b in alternatives)), key=sorted)


def trigram_postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The index: (trigram, key_id, key_hash) for the asked trigrams, one row per pair."""
    lowered = docs.select(*row_key(docs), F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[
        F.when(F.col("low").contains(t), F.lit(t)) for t in trigrams]))
    return lowered.select(*ROW_KEY, F.explode(held).alias("trigram")).distinct()


def candidate_rules(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """(key_id, key_hash, rule_bits): the indexed rules each row is a candidate of."""
    wanted = [(i, j, trigram, len(grams))
              for i, rule in enumerate(rules)
              for j, grams in enumerate(trigram_query(rule.regex) or [])
              for trigram in sorted(grams)]
    spark = docs.sparkSession
    terms = spark.createDataFrame(  # a few rows per rule
        wanted, "rule int, alternative int, trigram string, n_terms int")
    postings = trigram_postings(docs, sorted({w[2] for w in wanted}))
    return (postings.join(F.broadcast(terms), "trigram")
            .groupBy(*ROW_KEY, "rule", "alternative")
            .agg(F.count(F.lit(1)).alias("n"), F.first("n_terms").alias("n_terms"))
            .where("n = n_terms")
            .groupBy(*ROW_KEY)
            .agg(F.bit_or(F.expr("shiftleft(1L, rule)")).alias("rule_bits")))


#: Matches of one text are summed up in blocks of this many.
BLOCK = 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spans(text: Column, number: int, rule: SecretRule) -> Column:
    """Spans of a rule's matches, as structs (start, kind, end).

    The texts between matches and the matches themselves alternate, so running
    sums of their lengths are the positions.  The sums are taken over blocks of
    matches first and then inside each block, so that no array grows by one match
    at a time.
    """
    regex = F.lit(rule.regex)
    whole = F.regexp_extract_all(text, regex, F.lit(0))
    told = F.regexp_extract_all(text, regex, F.lit(rule.group)) if rule.group else whole
    pairs = F.arrays_zip(
        F.transform(F.split(text, rule.regex, -1), F.length).alias("gap"),
        F.transform(whole, F.length).alias("size"),
        F.transform(told, F.length).alias("counted"))

    def total(items: Column) -> Column:
        return F.aggregate(items, F.lit(0), lambda s, x: s + x["gap"] + x["size"])

    def in_blocks(found: Column) -> Column:
        n = F.size(found) - 1  # no match follows the last gap
        starts = F.filter(F.sequence(F.lit(0), (n / BLOCK).cast("int")), lambda b: b * BLOCK < n)
        return F.transform(starts, lambda b: F.slice(
            found, b * BLOCK + 1, F.least(F.lit(BLOCK), n - b * BLOCK)))

    def begins(blocks: Column) -> Column:
        return F.aggregate(blocks, F.array(F.lit(0)), lambda known, block: F.concat(
            known, F.array(F.element_at(known, F.lit(-1)) + total(block))))

    def placed(blocks: Column, starts: Column) -> Column:
        def span(block: Column, k: Column, x: Column, i: Column) -> Column:
            start = F.get(starts, k) + total(F.slice(block, F.lit(1), i)) + x["gap"]
            return F.struct(start.alias("start"), F.lit(number).alias("kind"),
                            (start + x["size"]).alias("stop"), x["counted"].alias("counted"))

        return F.flatten(F.transform(blocks, lambda block, k: F.transform(
            block, lambda x, i: span(block, k, x, i))))

    spans = _let(_let(pairs, in_blocks), lambda blocks: _let(
        begins(blocks), lambda starts: placed(blocks, starts)))
    return F.transform(F.filter(spans, lambda s: s["counted"] >= rule.least),
                       lambda s: F.struct(s["start"], s["kind"], s["stop"]))


def find_secrets(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """doc_id and ``found``: array of (start, kind, stop) by start, then rule order.

    ``kind`` is the rule's position in ``rules``.
    """
    # Written first, so that the join can split a key that many equal rows share.
    candidates = materialize(candidate_rules(docs, rules), "secret-candidates")
    rows = (docs.select(F.col("doc_id"), *row_key(docs),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .join(candidates, ROW_KEY, "left"))
    none = F.expr("cast(array() as array<struct<start:int,kind:int,stop:int>>)")
    per_rule = []
    for number, rule in enumerate(rules):
        if trigram_query(rule.regex) is None:
            maybe = F.col("text").rlike(rule.regex)
        else:
            maybe = F.coalesce(F.col("rule_bits"), F.lit(0)).bitwiseAND(
                F.lit(1 << number).cast("long")) != 0
        per_rule.append(F.when(maybe, _spans(F.col("text"), number, rule)).otherwise(none))
    return rows.select("doc_id", F.array_sort(F.concat(*per_rule)).alias("found"))


def span_digest(found: Column, rules: tuple[SecretRule, ...] = RULES) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))))
