"""Edit-aware token counts: a segment tree over each document's pre-tokens.

A document's pre-tokens are cut into leaves.  Two sums are kept over the leaves
in perfect binary trees (arrays, node i above 2i and 2i+1): characters, which
locate a position, and tokens, whose root is the document's count.  An edit
re-encodes only the leaves it touches plus boundary context: scanning restarts
at the leaf that holds the last character able to see the edit, and stops at
the first old leaf boundary behind the edit where a pre-token starts again.
From there on the old pre-tokens stand, because the scan depends only on the
text that follows.  Changed leaves and their ancestors are updated.

Trees are stored beside the text, one row per document, so a batch of edits is
a join on the document (``attach_edits``) or a column, then one map over rows.

Defined results: null text counts as empty (no tokens); edits with null bounds
or outside the text are cut to the text, overlapping ones are taken in order of
their start (ties: end, then replacement) and shortened to what is left; a null
replacement deletes; a very long text has one tree, made by one task from the whole
text; repeated rows are edited alike; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import ROW_KEY, keyed
from riskframe.llm.tokens import LOOKAHEAD, default_vocabulary, encoder, pre_token_ends

LEAF_PRE_TOKENS = 32

TREE_SCHEMA = ("key_id long, key_hash long, doc_id long, text string, "
               "chars array<int>, tokens array<int>")
EDITS = "array<struct<start:int,stop:int,replacement:string>>"


class TokenTree:
    """Pre-token segment tree of one text."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray, encode: Callable):
        self.text, self.chars, self.tokens, self.encode = text, chars, tokens, encode
        self.reencoded = 0

    @classmethod
    def build(cls, text: str, encode: Callable, leaf: int = LEAF_PRE_TOKENS) -> TokenTree:
        ends = list(pre_token_ends(text))
        n_leaves = 1 << max(0, (max(1, -(-len(ends) // leaf)) - 1).bit_length())
        tree = cls(text, np.zeros(2 * n_leaves, np.int32), np.zeros(2 * n_leaves, np.int32),
                   encode)
        groups = [ends[i:i + leaf] for i in range(0, len(ends), leaf)]
        tree._fill(0, 0, groups)
        for node in range(n_leaves - 1, 0, -1):
            tree._pull(node)
        return tree

    @property
    def n_leaves(self) -> int:
        return len(self.chars) // 2

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[1])

    def _pull(self, node: int) -> None:
        for sums in (self.chars, self.tokens):
            sums[node] = sums[2 * node] + sums[2 * node + 1]

    def _fill(self, first: int, start: int, groups: list[list[int]]) -> None:
        """Leaves from ``first`` on get pre-tokens ending at ``groups``, text from ``start``."""
        for leaf, ends in enumerate(groups, self.n_leaves + first):
            self.chars[leaf] = (ends[-1] - start) if ends else 0
            self.tokens[leaf] = self._count(start, ends)
            self.reencoded += len(ends)
            start = ends[-1] if ends else start

    def _count(self, start: int, ends: list[int]) -> int:
        """Tokens of consecutive pre-tokens.

        Blank pre-tokens at the end are counted one by one: cut off from the word
        behind them, they would join into one.
        """
        count, last = 0, len(ends)
        while last and self.text[ends[last - 2] if last > 1 else start:ends[last - 1]].isspace():
            before = ends[last - 2] if last > 1 else start
            count += len(self.encode(self.text[before:ends[last - 1]]))
            last -= 1
        return count + (len(self.encode(self.text[start:ends[last - 1]])) if last else 0)

    def leaf_at(self, position: int) -> tuple[int, int]:
        """The leaf holding a character (the last filled one past the end), and its start."""
        if position >= self.chars[1]:
            position = max(0, int(self.chars[1]) - 1)
        node, start = 1, 0
        while node < self.n_leaves:
            node *= 2
            if position - start >= self.chars[node]:
                start += int(self.chars[node])
                node += 1
        return node - self.n_leaves, start

    def replace(self, start: int, stop: int, replacement: str) -> None:
        """Replace text[start:stop], re-encoding only what the edit can change."""
        first, begin = self.leaf_at(max(0, start - LOOKAHEAD))
        grown = len(replacement) - (stop - start)
        last, boundary = self.leaf_at(stop)
        boundary += int(self.chars[self.n_leaves + last])  # old end of the leaf at ``stop``
        self.text = self.text[:start] + replacement + self.text[stop:]
        ends: list[int] = []
        for end in pre_token_ends(self.text, begin):
            ends.append(end)
            while last + 1 < self.n_leaves and boundary + grown < end:
                last += 1
                boundary += int(self.chars[self.n_leaves + last])
            if end == boundary + grown:
                break
        else:
            last = self.n_leaves - 1  # the scan ran to the end of the text
        n = last - first + 1
        size = max(1, -(-len(ends) // n))
        groups = [ends[i:i + size] for i in range(0, len(ends), size)]
        groups += [[] for _ in range(n - len(groups))]
        self._fill(first, begin, groups)
        nodes = {(self.n_leaves + leaf) // 2 for leaf in range(first, last + 1)}
        while nodes and 0 not in nodes:
            for node in nodes:
                self._pull(node)
            nodes = {node // 2 for node in nodes}


def in_order(edits: list[dict] | None, n_chars: int) -> list[tuple[int, int, str]]:
    """Edits cut to the text, sorted, made disjoint."""
    known = [(max(0, e["start"]), min(n_chars, e["stop"]), e["replacement"] or "")
             for e in edits or () if e["start"] is not None and e["stop"] is not None]
    out, upto = [], 0
    for start, stop, replacement in sorted(known):
        start = max(start, upto)
        if start <= n_chars and stop >= start:
            out.append((start, stop, replacement))
            upto = stop
    return out


def build_trees(docs: DataFrame, vocabulary: str | None = None,
                leaf: int = LEAF_PRE_TOKENS) -> DataFrame:
    """Key, doc_id, text and the two trees of every row; the count is ``tokens[1]``."""
    path = vocabulary or default_vocabulary()

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            trees = [TokenTree.build(raw.decode("utf-8", "replace"), encode, leaf)
                     for raw in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:3] + [pa.array([t.text for t in trees], pa.string()),
                                     pa.array([t.chars for t in trees], pa.list_(pa.int32())),
                                     pa.array([t.tokens for t in trees], pa.list_(pa.int32()))],
                names=["key_id", "key_hash", "doc_id", "text", "chars", "tokens"])

    return keyed(docs).mapInArrow(kernel, TREE_SCHEMA)


def attach_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """Join edits (doc_id, start, stop, replacement) to their documents' trees."""
    per_doc = edits.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "stop", "replacement")).cast(EDITS).alias("edits"))
    return trees.join(per_doc, "doc_id", "left")


def find_edits(trees: DataFrame, finder: Callable[[str], list[tuple[int, int, str]]]) -> DataFrame:
    """Trees with an ``edits`` column that ``finder`` derives from each text."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()),
                                   ("replacement", pa.string())]))
        for batch in batches:
            edits = [[{"start": a, "stop": b, "replacement": r} for a, b, r in finder(text)]
                     for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(edits, kind)],
                                             names=[*batch.schema.names, "edits"])

    columns = ["key_id", "key_hash", "doc_id", "text", "chars", "tokens"]
    return trees.select(*columns).mapInArrow(kernel, f"{TREE_SCHEMA}, edits {EDITS}")


def apply_edits(edited: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """New text and trees after ``edits``, with n_tokens before and after, n_edits and
    n_reencoded (pre-tokens encoded again)."""
    path = vocabulary or default_vocabulary()

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            trees, counts = [], []
            for text, chars, tokens, edits in zip(*(batch.column(c).to_pylist() for c in
                                                    ("text", "chars", "tokens", "edits"))):
                tree = TokenTree(text, np.array(chars, np.int32), np.array(tokens, np.int32),
                                 encode)
                before, todo = tree.n_tokens, in_order(edits, len(text))
                for start, stop, replacement in reversed(todo):  # earlier positions stay valid
                    tree.replace(start, stop, replacement)
                trees.append(tree)
                counts.append((before, tree.n_tokens, len(todo), tree.reencoded))
            columns = list(zip(*counts)) if counts else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("key_id", "key_hash", "doc_id")]
                + [pa.array([t.text for t in trees], pa.string()),
                   pa.array([t.chars for t in trees], pa.list_(pa.int32())),
                   pa.array([t.tokens for t in trees], pa.list_(pa.int32()))]
                + [pa.array(c, pa.int64()) for c in columns],
                names=["key_id", "key_hash", "doc_id", "text", "chars", "tokens",
                       "n_tokens_before", "n_tokens", "n_edits", "n_reencoded"])

    columns = [*ROW_KEY, "doc_id", "text", "chars", "tokens", "edits"]
    return edited.select(*columns).mapInArrow(
        kernel, f"{TREE_SCHEMA}, n_tokens_before long, n_tokens long, n_edits long, "
                "n_reencoded long")


PERSONAL_DATA = re.compile(
    r"(?P<email>[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
    r"|(?P<phone>\+?\d(?:[ .()-]{0,2}\d){6,14})")


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Edits that replace e-mail addresses and telephone numbers by their kind."""
    return [(m.start(), m.end(), f"[{m.lastgroup}]") for m in PERSONAL_DATA.finditer(text)]
