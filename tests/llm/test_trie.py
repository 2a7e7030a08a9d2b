"""The conversation trie against a plain one, and its spilling queue against sorting."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riskframe.llm import trie
from tests.llm import corpora

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: t[0])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 9
        path = tuple(t[1:] for t in own.get(conv - conv % 5, [])[:h] + own[conv][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(conv)
            if d:
                children[path[:d - 1]].add(path[:d])
        ends[path].append(conv)
    saved, leaves, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, ())
        size = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * size + sum(saved[c] for c in below)
        leaves[node] = sum(leaves[c] for c in below) if below else 1
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode())
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None,
                    len(members[node]), len(below), leaves[node], saved[node],
                    digest.hexdigest()))
    return out


def awkward_conversations():
    rng = random.Random(12)
    heads = [[("user", f"hello {i}"), ("assistant", "é" * i), ("user", None)] for i in range(4)]
    rows = []
    for conv in [*range(-7, 60), 1000, 1003, 10 ** 12]:
        turns = rng.choice(heads) * rng.randrange(3)
        turns = turns[:rng.randrange(len(turns) + 1)]
        turns += [(rng.choice(["user", None, "assistant"]), rng.choice(["a", "b", ""]))
                  for _ in range(rng.randrange(5))]
        rows += [(conv, n if n else None, *t) for n, t in enumerate(turns)]
    rows += [(10, n, "user", f"long way {n}") for n in range(20, 150)]
    rows += [(70 + i, n, "user", "the same") for i in range(30) for n in range(6)]
    rows += [(None, 1, "user", "of nobody"), (None, None, None, None)]
    rows += [(200, 1, "user", "x" * 100_000)]
    return rows


def key(rows):
    return sorted(map(repr, rows))


def unique_turns(rows):
    """Rows whose order is defined by the turn alone."""
    seen, out = set(), []
    for row in rows:
        if row[:2] not in seen:
            seen.add(row[:2])
            out.append(row)
    return out


@pytest.mark.parametrize("in_memory", [3, 200_000])
def test_trie_matches_plain(spark, in_memory):
    rows = unique_turns(awkward_conversations())
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    clashing = frame.select("*", *[F.lit("x").alias(c) for c in (
        "depth", "shard", "place", "a", "n_bytes", "n_convs", "carry", "path_a")])
    found = trie.prefix_trie(clashing, in_memory)
    assert key(tuple(r) for r in found.collect()) == key(plain_trie(rows))


def test_given_conversations_match_plain(spark):
    rows = corpora.given_rows("conversations", "conv_id, turn, role, text")
    found = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))
    assert key(tuple(r) for r in found.collect()) == key(plain_trie(rows))


def test_repeated_rows_are_repeated_turns(spark):
    rows = [(5, 1, "user", "again")] * 12 + [(6, 1, "user", "again")] * 12
    found = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert key(tuple(r) for r in found.collect()) == key(plain_trie(rows))


def test_totals_pass_through_many_shards(spark):
    """A caterpillar: each conversation leaves the path of the next smaller one."""
    n = 400
    nodes = [(i, d, i - 1 if d == i and i else (i if d > i else None))
             for i in range(n) for d in (i, i + 1)]
    rows = [(c, d, p, int(d == c + 1 and True), 1) for c, d, p in nodes]
    frame = spark.createDataFrame(
        rows, "conv_id long, depth long, parent_conv_id long, leaf int, saved long")
    got = {(r.conv_id, r.depth): (r.n_children, r.n_leaves, r.saved_tokens)
           for r in trie.subtree_totals(frame.repartition(7)).collect()}
    # Node (i, i) has the leaf (i, i + 1) and, but for the last, the node (i + 1, i + 1).
    want = {(i, i): (2 - (i == n - 1), n - i, 2 * (n - i)) for i in range(n)}
    want |= {(i, i + 1): (0, 1, 1) for i in range(n)}
    assert got == want


@pytest.mark.parametrize("in_memory", [1, 4, 1000])
def test_queue_spills_and_keeps_order(in_memory):
    rng = random.Random(in_memory)
    queue, sent, got = trie.SpillingQueue(in_memory), defaultdict(list), defaultdict(list)
    for level in range(30, -1, -1):
        for node in sorted(rng.sample(range(20), 12)):
            got[level, node] = sorted(queue.pop_all((-level, node)))
            if level:
                target = rng.choice(range(20))
                queue.push((1 - level, target), (node, level))
                sent[level - 1, target].append((node, level))
    # Messages to nodes that never came up are taken by the next key that is larger.
    assert sum(map(len, got.values())) <= sum(map(len, sent.values()))
    for name, values in got.items():
        assert set(values) >= set(sent[name])


def test_ends_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 7)
    rows = [(c, 1, "user", "hi") for c in range(0, 400)]
    found = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(6))
    assert key(tuple(r) for r in found.collect()) == key(plain_trie(rows))


def test_no_conversations_no_nodes(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    nobody = spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)
    assert trie.prefix_trie(nobody).count() == 0
