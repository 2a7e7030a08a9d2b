"""Conversation prefix trie with subtree totals by time-forward processing.

A node is a distinct sequence of first turns; its members are the conversations
that begin with it.  Texts are read once, for two hashes of each turn; a node's
identity is its depth and the two running exclusive-ors of its turns' hashes, each
mixed with its place (128 bits in all).  Members, ends and the smallest member of
every node are grouped counts that combine before they travel.

A node is named by (smallest member, depth), and so is its parent, whose smallest
member is the same or a smaller one.  Sorted by these names, every parent stands
before its children, so ranges of names are shards that split any conversation or
crowd of children, and messages only ever go to the same shard or an earlier one.
Subtree totals are passed up in time-forward order:

1. Within a shard, nodes come in reverse level order from Spark's external sort.
   A node takes the messages addressed to it off a priority queue that spills
   sorted runs to disk, adds its own part, and sends the sum to its parent: into
   the queue if the parent is in the shard, else into a sum per parent outside.
2. Across shards, these sums, grouped by parent, enter the parents' shards like
   messages from children, and only what they add is passed on.  Totals are sums,
   so each round is final for what it carries; rounds end when no message leaves
   its shard, after as many rounds as a path enters shards.

The ids of conversations that end at a node are hashed from chunks of bounded size
in the order of ids, so a node that ends a third of all conversations is read as a
stream of chunks (SHA-256 itself is sequential).

Defined results: null role or text counts as empty; a null turn comes first; turns
of a conversation with equal numbers are ordered by the hash of role and text, so
repeated rows are repeated turns; rows without a conv_id belong to no conversation;
``conv_id % 5`` is the nonnegative remainder; a very long text or conversation is
one turn or one path; a conversation left without turns is a member of the root;
an empty table gives no rows, not even a root; extra columns are ignored, whatever
their names.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import pickle
import tempfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import discard, materialize

GROUP = 5
HEAD = 9
#: Ids hashed as one chunk.
CHUNK = 4096
#: Messages that a queue holds in memory.
IN_MEMORY = 200_000

NODE = ["depth", "path_a", "path_b"]


def head_length(conv_id: Column) -> Column:
    """Turns that a conversation takes from the first of its group."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEAD).cast("int")


def plain_head_length(conv_id: int) -> int:
    return zlib.crc32(str(conv_id).encode()) % HEAD


def sharded(rows: DataFrame, order: list, name: str) -> DataFrame:
    """The rows in ranges of ``order``, written once with the number of their ``shard``."""
    return materialize(rows.repartitionByRange(*order)
                       .withColumn("shard", F.spark_partition_id()), name)


def carried(rows: DataFrame, key: str, value: Column, combine) -> DataFrame:
    """(shard, key, carry): what a key's earlier shards add up to, for keys in several shards.

    At most two rows per shard, so it may be broadcast.
    """
    parts = rows.groupBy(key, "shard").agg(value.alias("part"))
    several = parts.join(parts.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                         .select(key), key)
    before = (Window.partitionBy(key).orderBy("shard")
              .rowsBetween(Window.unboundedPreceding, -1))
    return several.select("shard", key, combine(F.col("part")).over(before).alias("carry"))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), two hashes and n_bytes of every turn."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit("turn"), role, text).alias("b"),
        F.octet_length(text).cast("long").alias("n_bytes"))
    order = [F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    rows = sharded(turns, [F.col("conv_id"), *order], "ordered-turns")
    here = Window.partitionBy("shard", "conv_id").orderBy(*order)
    before = carried(rows, "conv_id", F.count(F.lit(1)), F.sum)
    return (rows.withColumn("here", F.row_number().over(here) - 1)
            .join(F.broadcast(before), ["shard", "conv_id"], "left")
            .select("conv_id", (F.col("here") + F.coalesce("carry", F.lit(0))).alias("place"),
                    "a", "b", "n_bytes"))


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (conv_id, n_turns) and their turns by depth (from 1)."""
    turns = materialize(ordered_turns(conversations), "turns")
    sizes = materialize(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own")),
                        "conversation-sizes")
    base = F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(GROUP))
    heads = sizes.select("conv_id", "n_own", base.alias("base"),
                         head_length(F.col("conv_id")).alias("h"))
    held = sizes.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    plans = materialize(heads.join(held, "base", "left").select(
        "conv_id", "base", "h", "n_own",
        F.least("h", F.coalesce("n_base", F.lit(0))).alias("n_head")), "rebuilding-plans")
    # At most the first few turns of a conversation are lent to others.
    lent = turns.where(F.col("place") < HEAD).withColumnRenamed("conv_id", "base")
    taken = (plans.select("conv_id", "base", "n_head").join(lent, "base")
             .where("place < n_head")
             .select("conv_id", (F.col("place") + 1).alias("depth"), "a", "b", "n_bytes"))
    own = (turns.join(plans.select("conv_id", "h", "n_head"), "conv_id").where("place >= h")
           .select("conv_id", (F.col("place") - F.col("h") + F.col("n_head") + 1).alias("depth"),
                   "a", "b", "n_bytes"))
    n_turns = F.col("n_head") + F.greatest(F.lit(0), F.col("n_own") - F.col("h"))
    return (plans.select("conv_id", n_turns.cast("long").alias("n_turns")),
            taken.unionByName(own))


def conversation_paths(turns: DataFrame) -> DataFrame:
    """conv_id, the node at each depth from 1 on, its parent's hashes, and n_bytes."""
    mixed = turns.select("conv_id", F.col("depth").cast("long").alias("depth"), "n_bytes",
                         F.xxhash64("depth", "a", "b").alias("a"),
                         F.xxhash64(F.lit("node"), "depth", "b", "a").alias("b"))
    rows = sharded(mixed, ["conv_id", "depth"], "rebuilt-turns")
    here = (Window.partitionBy("shard", "conv_id").orderBy("depth")
            .rowsBetween(Window.unboundedPreceding, 0))
    for name in ("a", "b"):
        before = carried(rows, "conv_id", F.bit_xor(name), F.bit_xor)
        before = before.withColumnRenamed("carry", f"carry_{name}")
        rows = rows.join(F.broadcast(before), ["shard", "conv_id"], "left")
    running = rows.withColumns({f"here_{n}": F.bit_xor(n).over(here) for n in ("a", "b")})
    paths = {f"path_{n}": F.col(f"here_{n}").bitwiseXOR(F.coalesce(f"carry_{n}", F.lit(0)))
             for n in ("a", "b")}
    return running.withColumns(paths).select(
        "conv_id", *NODE, "n_bytes",
        F.col("path_a").bitwiseXOR(F.col("a")).alias("parent_a"),
        F.col("path_b").bitwiseXOR(F.col("b")).alias("parent_b"))


def trie_nodes(paths: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per node below the root: identity, conv_id, parent_conv_id, n_convs, n_ends,
    n_bytes of its last text."""
    ends = sizes.select("conv_id", F.col("n_turns").alias("depth"), F.lit(1).alias("end"))
    steps = materialize(paths.join(ends, ["conv_id", "depth"], "left"), "paths")
    nodes = materialize(steps.groupBy(*NODE, "parent_a", "parent_b").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.count("end").alias("n_ends"), F.max("n_bytes").alias("n_bytes")), "nodes")
    # The root's children would all meet in one key, and its name is known.
    first = sizes.agg(F.min("conv_id")).first()[0]
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("path_a").alias("parent_a"),
                           F.col("path_b").alias("parent_b"),
                           F.col("conv_id").alias("parent_conv_id"))
    below = nodes.where("depth > 1").join(parents, ["depth", "parent_a", "parent_b"])
    top = nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(first).cast("long"))
    return top.unionByName(below).drop("parent_a", "parent_b")


# Ends ----------------------------------------------------------------------------

def end_digests(paths: DataFrame, sizes: DataFrame) -> DataFrame:
    """depth, path_a, path_b and the SHA-256 of the ids that end there, for nodes with ends."""
    last = paths.select("conv_id", *NODE).join(
        sizes.select("conv_id", F.col("n_turns").alias("depth")), ["conv_id", "depth"])
    none = sizes.where("n_turns = 0").select("conv_id", F.lit(0).cast("long").alias("depth"),
                                             F.lit(0).cast("long").alias("path_a"),
                                             F.lit(0).cast("long").alias("path_b"))
    rows = sharded(last.unionByName(none), [*NODE, "conv_id"], "ends")
    here = Window.partitionBy("shard", *NODE).orderBy("conv_id")
    chunks = (rows.withColumn("chunk", F.floor((F.row_number().over(here) - 1) / CHUNK))
              .groupBy("shard", *NODE, "chunk")
              .agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"),
                                ",").alias("ids")))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of():
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in (*NODE, "ids")]
                yield from zip(*columns)

        for node, parts in groupby(rows_of(), key=lambda r: r[:3]):
            digest, comma = hashlib.sha256(), b""
            for row in parts:
                digest.update(comma + row[3].encode())
                comma = b","
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], pa.int64()) for x in node] + [pa.array([digest.hexdigest()])],
                names=[*NODE, "ends_sha256"])

    return (chunks.repartition(*NODE).sortWithinPartitions(*NODE, "shard", "chunk")
            .select(*NODE, "ids")
            .mapInArrow(kernel, "depth long, path_a long, path_b long, ends_sha256 string"))


# Time-forward processing ----------------------------------------------------------

@dataclass
class SpillingQueue:
    """A priority queue of (key, values): a heap in memory and sorted runs on disk.

    Runs are unnamed files of the task alone; they vanish with it.
    """

    in_memory: int = IN_MEMORY
    heap: list = field(default_factory=list)
    heads: list = field(default_factory=list)
    n_runs: int = 0

    def push(self, key: tuple, values: tuple) -> None:
        heapq.heappush(self.heap, (key, values))
        if len(self.heap) > self.in_memory:
            run = tempfile.TemporaryFile()
            for item in sorted(self.heap):
                pickle.dump(item, run)
            run.seek(0)
            self.heap = []
            self.n_runs += 1
            self._advance(run, self.n_runs)

    def _advance(self, run, number: int) -> None:
        try:
            key, values = pickle.load(run)
        except EOFError:
            run.close()
            return
        heapq.heappush(self.heads, (key, number, values, run))

    def pop_all(self, key: tuple) -> list[tuple]:
        """Values sent to ``key``; keys are asked for in order, so none is left behind."""
        out = []
        while self.heap and self.heap[0][0] <= key:
            out.append(heapq.heappop(self.heap)[1])
        while self.heads and self.heads[0][0] <= key:
            _, number, values, run = heapq.heappop(self.heads)
            out.append(values)
            self._advance(run, number)
        return out


TOTAL_SCHEMA = ("conv_id long, depth long, n_children long, n_leaves long, saved_tokens long, "
                "outside boolean")


def pass_up(bounds: list[tuple[int, int]], born: int, in_memory: int = IN_MEMORY):
    """The kernel of one round: rows of a shard in reverse level order, messages to a node
    before the node itself, to totals of its nodes and sums for parents outside.

    ``bounds`` has the first name of each shard.  ``born`` is 1 in the first round, in
    which every node reports itself to its parent, and 0 later, when only what messages
    add is passed on.  Rows are (shard, depth, conv_id, parent_conv_id, children,
    leaves, saved, message).
    """
    def told(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[]] * 6
        kinds = [pa.int64()] * 5 + [pa.bool_()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["conv_id", "depth", "n_children", "n_leaves", "saved_tokens", "outside"])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, outside, shard = SpillingQueue(in_memory), {}, None

        def sums_for_others() -> pa.RecordBatch:
            rows = [(*name, *sums, True) for name, sums in outside.items()]
            outside.clear()
            return told(rows)

        for batch in batches:
            out = []
            for at, depth, conv, parent, children, leaves, saved, message in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if at != shard:
                    shard = at
                    yield sums_for_others()
                key = (-depth, conv)
                if message:
                    queue.push(key, (children, leaves, saved))
                    continue
                for c, n, s in queue.pop_all(key):
                    children, leaves, saved = children + c, leaves + n, saved + s
                if born or children or leaves or saved:
                    out.append((conv, depth, children, leaves, saved, False))
                if parent is None or not (born or leaves or saved):
                    continue
                name = (parent, depth - 1)
                if bisect.bisect_right(bounds, name) - 1 == shard:
                    queue.push((1 - depth, parent), (born, leaves, saved))
                else:
                    sums = outside.get(name, (0, 0, 0))
                    outside[name] = (sums[0] + born, sums[1] + leaves, sums[2] + saved)
            yield told(out)
        yield sums_for_others()

    return kernel


def subtree_totals(nodes: DataFrame, in_memory: int = IN_MEMORY) -> DataFrame:
    """conv_id, depth, n_children, n_leaves, saved_tokens of every node of ``nodes``
    (conv_id, depth, parent_conv_id, leaf, saved)."""
    placed = sharded(nodes.select("conv_id", "depth", "parent_conv_id", "leaf", "saved"),
                     ["conv_id", "depth"], "sharded-nodes")
    firsts = {r["shard"]: (r["f"]["conv_id"], r["f"]["depth"]) for r in placed.groupBy("shard").agg(
        F.min(F.struct("conv_id", "depth")).alias("f")).collect()}  # one row per shard
    # Empty shards take the next one's first name: nothing is found in them.
    bounds, after = [], (1 << 63, 0)
    for shard in range(max(firsts, default=-1), -1, -1):
        after = firsts.get(shard, after)
        bounds.append(after)
    bounds.reverse()
    long = lambda c: F.col(c).cast("long")
    zero = F.lit(0).cast("long")

    def scan(rows: DataFrame, kernel) -> DataFrame:
        ready = rows.repartition("shard").sortWithinPartitions(
            "shard", F.col("depth").desc(), "conv_id", F.col("message").desc())
        return materialize(ready.mapInArrow(kernel, TOTAL_SCHEMA), "subtree-totals")

    base = placed.select(
        long("shard").alias("shard"), "depth", "conv_id", "parent_conv_id",
        zero.alias("children"), long("leaf").alias("leaves"), long("saved").alias("saved"),
        F.lit(False).alias("message"))
    found = scan(base, pass_up(bounds, 1, in_memory))
    rounds = [found]
    while True:
        sums = materialize(
            found.where("outside").groupBy("conv_id", "depth").agg(
                *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]),
            "messages")
        if sums.isEmpty():
            break
        mail = materialize(sums.join(placed.select(
            "conv_id", "depth", long("shard").alias("shard")), ["conv_id", "depth"]).select(
            "shard", "depth", "conv_id", F.lit(None).cast("long").alias("parent_conv_id"),
            F.col("n_children").alias("children"), F.col("n_leaves").alias("leaves"),
            F.col("saved_tokens").alias("saved"), F.lit(True).alias("message")), "mail")
        asked = mail.select("shard").distinct()
        idle = base.join(asked, "shard", "left_semi").withColumns(
            {"leaves": zero, "saved": zero})
        found = scan(idle.unionByName(mail), pass_up(bounds, 0, in_memory))
        rounds.append(found)
        discard(sums)
    everything = rounds[0]
    for more in rounds[1:]:
        everything = everything.unionByName(more)
    return everything.where("not outside").groupBy("conv_id", "depth").agg(
        *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])


def prefix_trie(conversations: DataFrame, in_memory: int = IN_MEMORY) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256: one row per node of the rebuilt conversations' trie."""
    sizes, turns = rebuilt_turns(conversations)
    sizes = materialize(sizes, "rebuilt-sizes")
    paths = materialize(conversation_paths(turns), "conversation-paths")
    zero = F.lit(0).cast("long")
    root = (sizes.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                      F.count(F.when(F.col("n_turns") == 0, 1)).alias("n_ends"))
            .where("n_convs > 0")
            .select("conv_id", zero.alias("depth"), zero.alias("path_a"), zero.alias("path_b"),
                    F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_ends",
                    zero.alias("n_bytes")))
    nodes = materialize(trie_nodes(paths, sizes).unionByName(root), "trie-nodes")
    totals = subtree_totals(nodes.select(
        "conv_id", "depth", "parent_conv_id",
        (F.col("n_ends") == F.col("n_convs")).cast("int").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved")), in_memory)
    named = nodes.join(end_digests(paths, sizes), NODE, "left")
    return named.join(totals, ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
