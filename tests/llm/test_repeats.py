"""Repeated byte strings against all windows, and the interval tree against all pairs."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import repeats
from tests.llm import corpora

#: span, core, limit: production, and small ones in which large cores are cut to slices.
SETTINGS = [(400, 200, 4096, (16, 1)), (24, 9, 3, (4, 1)), (12, 5, 1, (1,))]


def plain_repeats(rows, span):
    """(doc_id, n_bytes, n_removed, n_spans, kept) by counting every window."""
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i:i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for row, text in zip(rows, texts):
        gone = np.zeros(len(text) + 1, bool)
        for i in range(len(text) - span + 1):
            if seen[text[i:i + span]] > 1:
                gone[i:i + span] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((row[0], len(text), len(text) - len(kept), spans, kept))
    return out


def small_alphabet():
    """Texts in which windows overlap themselves and each other in every way."""
    rng = random.Random(3)
    blocks = ["".join(rng.choices("ab", k=rng.randrange(5, 40))) for _ in range(8)]
    texts = ["".join(rng.choices(blocks + ["abc", "é", "x" * 50], k=rng.randrange(9)))
             for _ in range(60)]
    texts += ["q" * 90, "qr" * 70, "q" * 23, None, ""] + [texts[0]] * 3
    return [(None if i % 11 == 5 else i, t, None, None, None) for i, t in enumerate(texts)]


def as_tuples(df):
    return sorted(map(repr, (tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)
                             for r in df.collect())))


@pytest.mark.parametrize("span, core, limit, slices", SETTINGS)
def test_repeats_match_all_windows(spark, span, core, limit, slices):
    rows = small_alphabet() if span < 400 else [
        r for r in corpora.awkward_rows() if len(r[1] or "") < 20_000]
    if span == 400:
        page = "one passage that many texts hold, " * 14
        rows += [(900 + i, f"text {i} " * (i % 3 + 1) + page + f" goes on {i} " * i, None, None,
                  None) for i in range(9)]
    docs = corpora.clashing(spark.createDataFrame(rows, corpora.SCHEMA).repartition(4))
    got = as_tuples(repeats.remove_repeats(docs, span, core, limit, slices))
    want = plain_repeats(rows, span)
    assert got == sorted(map(repr, want))
    assert sum(w[2] for w in want) > 500


def test_slices_of_a_passage_in_many_documents(spark):
    """More contexts around one passage than a task sorts, at production lengths."""
    rng = random.Random(8)
    passage = "".join(rng.choices("abcdefgh ", k=650))
    rows = [(i, "".join(rng.choices("abcdefgh ", k=rng.randrange(80))) + passage
             + "".join(rng.choices("abcdefgh ", k=rng.randrange(80))), None, None, None)
            for i in range(40)]
    docs = spark.createDataFrame(rows, corpora.SCHEMA)
    got = as_tuples(repeats.remove_repeats(docs, limit=7))
    assert got == sorted(map(repr, plain_repeats(rows, 400)))


def test_occurrences_are_complete_and_maximal(spark):
    """Each reported group has equal bytes at all its places, and all places of its bytes
    that its anchor's windows reach; no member could be longer with all the others."""
    span, core = 24, 9
    rows = [(i, t, None, None, None) for i, (_, t, *_) in enumerate(small_alphabet())]
    docs = spark.createDataFrame(rows, corpora.SCHEMA)
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    groups = defaultdict(set)
    for r in repeats.repeat_occurrences(docs, span, core).collect():
        assert r.left + r.right >= span
        groups[r.core, r.group_no, r.left, r.right].add((r.key_id, r.at - r.left))
    seen = Counter()
    for text in texts.values():
        seen.update(text[i:i + span] for i in range(len(text) - span + 1))
    told = set()
    for (_, _, left, right), places in groups.items():
        strings = {texts[doc][start:start + left + right] for doc, start in places}
        assert len(strings) == 1 and len(places) > 1
        (string,) = strings
        for i in range(len(string) - span + 1):
            told |= {(doc, start + i) for doc, start in places}
            assert seen[string[i:i + span]] >= len(places)
    want = {(doc, i) for doc, t in texts.items() for i in range(len(t) - span + 1)
            if seen[t[i:i + span]] > 1}
    assert told == want


@pytest.mark.parametrize("seed", range(6))
def test_intervals_match_all_pairs(seed):
    rng = random.Random(seed)
    strings = sorted("".join(rng.choices("ab", k=rng.randrange(7))).encode() for _ in range(40))
    found = set(repeats.intervals(strings, 1))
    prefix = repeats.common_prefix
    want = set()
    for i in range(len(strings)):
        for j in range(i + 1, len(strings)):
            depth = min(prefix(strings[k], strings[k + 1]) for k in range(i, j))
            before = prefix(strings[i - 1], strings[i]) if i else -1
            after = prefix(strings[j], strings[j + 1]) if j + 1 < len(strings) else -1
            if depth >= 1 and before < depth and after < depth:
                want.add((depth, i, j))
    assert found == want


def test_anchors_do_not_depend_on_what_surrounds_a_window():
    rng = random.Random(1)
    text = bytes(rng.choices(b"abcd", k=3000))
    at, far, near = repeats.anchors(text)
    anchor = {int(p) - d: int(p) for p, f, n in zip(at, far, near) for d in range(n, f + 1)}
    assert sorted(anchor) == list(range(len(text) - 399))
    for i in range(0, 2600, 37):
        (alone,), (f,), (n,) = repeats.anchors(text[i:i + 400])
        assert f == n == alone == anchor[i] - i


def test_a_very_long_run_of_one_byte(spark):
    docs = spark.createDataFrame([(1, " " * 300_000, None, None, None),
                                  (2, "\n" * 399, None, None, None)], corpora.SCHEMA)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
           for r in repeats.remove_repeats(docs).collect()}
    assert got == {1: (300_000, 300_000, 1, b""), 2: (399, 0, 0, b"\n" * 399)}


def test_no_documents_no_repeats(spark):
    assert repeats.remove_repeats(corpora.empty(spark)).count() == 0


def test_contexts_that_join_share_a_key(spark):
    """Rows that share an id and a text, also null ids, are occurrences of each other."""
    text = "the very same words " * 30
    rows = [(None, text, None, None, None)] * 3 + [(5, text, None, None, None)] * 2
    docs = spark.createDataFrame(rows, corpora.SCHEMA)
    out = repeats.remove_repeats(docs).select("n_removed", F.length("kept").alias("k")).collect()
    assert [tuple(r) for r in out] == [(len(text), 0)] * 5
