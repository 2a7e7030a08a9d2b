"""Substring dedup on a compacted De Bruijn graph of token k-mers.

The edges of the graph are the ``span``-word k-mers of the texts (50 words),
consecutive edges overlapping in all but one word.  Listing every edge of every
document would shuffle each word many times over, so paths are compacted where
they are made: consecutive edges with the same minimizer (the least hash among
the short word n-grams inside the edge, first on ties) form one path piece.
Equal edges have equal minimizers, wherever they occur, so edges only ever meet
inside one minimizer.  Then, by Spark joins:

1. Path pieces are aggregated per minimizer.  A minimizer seen under one doc_id
   only has no repeated edge and is dropped.
2. A minimizer whose occurrences all carry the same piece is a node of the
   compacted graph.  Nodes that always follow each other are joined into paths by
   pointer doubling; a path keeps the smallest doc_id that holds it, and the
   documents that hold it are found through its first node alone.
3. Where pieces differ (the path branches, or a repeated passage ends there),
   one occurrence of each distinct piece is opened at its source coordinates,
   its edges are hashed from the text and matched across the pieces, and every
   edge gets the smallest doc_id over all pieces that hold it.
4. A path's occurrence is verified by its words' digest against the digest read at
   the path's source coordinates.
5. Each occurrence turns into the stretches of words whose edges also start
   under a smaller doc_id; stretches of a document merge when they are cut.

Pieces and edges are compared by two independent 64-bit hashes of their words.

Defined results: every word of a very long text can be cut; texts with fewer
words than a span are never cut; null text
has no words; a null doc_id neither cuts nor is cut; rows that share a doc_id
do not cut each other; identical rows get identical results; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import ROW_KEY, discard, keyed, materialize

SPAN = 50
#: Words of a minimizer.  39 consecutive minimizer candidates lie in a 50-word edge.
MINIMIZER = 12

#: Odd multipliers of the two polynomial hashes and their inverses modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
CACHED_WORDS = 300_000


class _WordHashes(dict):
    """Word -> 64-bit hash, forgetting everything when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SpanHasher:
    """Hashes of word spans of one text after another, from prefix sums."""

    def __init__(self):
        self.words = _WordHashes()
        self.powers = [np.ones(1, np.uint64) for _ in BASES]
        self.inverses = [np.ones(1, np.uint64) for _ in BASES]

    def _grow(self, n: int) -> None:
        for i, base in enumerate(BASES):
            for table, factor in ((self.powers, base), (self.inverses, pow(base, -1, 1 << 64))):
                steps = np.full(2 * n, factor, np.uint64)
                steps[0] = 1
                table[i] = np.cumprod(steps, dtype=np.uint64)

    def load(self, words: list[bytes]) -> None:
        n = len(words)
        if len(self.powers[0]) <= n:
            self._grow(n + 1)
        hashes = mix(np.fromiter(map(self.words.__getitem__, words), np.uint64, n))
        self.sums = [np.concatenate((np.zeros(1, np.uint64),
                                     np.cumsum(hashes * inverse[:n], dtype=np.uint64)))
                     for inverse in self.inverses]

    def spans(self, which: int, starts: np.ndarray, lengths) -> np.ndarray:
        """Hash number ``which`` of the spans of ``lengths`` words at ``starts``."""
        sums = self.sums[which]
        value = (sums[starts + lengths] - sums[starts]) * self.powers[which][starts]
        return mix(value + np.asarray(lengths).astype(np.uint64))


def path_pieces(hasher: SpanHasher, n_words: int, span: int = SPAN, minimizer: int = MINIMIZER):
    """Pieces of a loaded text's path: (minimizer hash, piece hash, first edge, edges)."""
    edges, width = n_words - span + 1, span - minimizer + 1
    grams = hasher.spans(0, np.arange(n_words - minimizer + 1), minimizer)
    least, reach = grams, 1  # least[i]: the smallest of grams[i:i + reach]
    while 2 * reach <= width:
        least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
    rest = width - reach
    least = np.minimum(least[:edges], least[rest:rest + edges])
    # A piece ends where the minimum changes, or its leftmost place drops out.
    ends = (least[1:] != least[:-1]) | (grams[:edges - 1] == least[:-1])
    starts = np.concatenate(([0], np.flatnonzero(ends) + 1))
    counts = np.diff(np.append(starts, edges))
    return least[starts], hasher.spans(1, starts, counts + span - 1), starts, counts


def piece_table(docs: DataFrame, span: int = SPAN, minimizer: int = MINIMIZER) -> DataFrame:
    """One row per path piece of every text that has an id."""
    schema = ("minimizer long, piece long, key_id long, key_hash long, first int, edges int")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            found, owners = [], []
            for row, raw in enumerate(batch.column(3).to_pylist()):
                words = raw.split()
                if len(words) < span:
                    continue
                hasher.load(words)
                found.append(path_pieces(hasher, len(words), span, minimizer))
                owners.append(np.full(len(found[-1][0]), row))
            if not found:
                continue
            anchors, pieces, firsts, counts = map(np.concatenate, zip(*found))
            take = pa.array(np.concatenate(owners))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors.view(np.int64)), pa.array(pieces.view(np.int64)),
                 batch.column(0).take(take), batch.column(1).take(take),
                 pa.array(firsts, pa.int32()), pa.array(counts, pa.int32())],
                names=["minimizer", "piece", "key_id", "key_hash", "first", "edges"])

    return keyed(docs).where(F.col("doc_id").isNotNull()).mapInArrow(kernel, schema)


def digest(words: list[bytes], start: int, stop: int) -> tuple[int, int]:
    """128-bit digest of a stretch of words, as two signed longs."""
    return struct.unpack("<qq", xxhash.xxh3_128_digest(b" ".join(words[start:stop])))


def path_occurrences(nodes: DataFrame) -> DataFrame:
    """Occurrences of whole nonbranching paths: key columns, first, edges, low.

    ``nodes`` has the occurrences of unbranched pieces, named by their minimizer.
    Node t continues node s when every occurrence of s is followed at once by t and
    every occurrence of t preceded by s.  Such links form chains (a cycle would need a
    text without end); pointer doubling gives each node its chain's first node and the
    edges before it, in as many joins as the longest chain's length has binary digits.
    """
    in_text = Window.partitionBy(*ROW_KEY).orderBy("first")
    upcoming = F.lead("minimizer").over(in_text)
    adjacent = F.lead("first").over(in_text) == F.col("first") + F.col("edges")
    steps = materialize(
        nodes.withColumn("next", F.when(adjacent, upcoming))
        .groupBy("minimizer", "next").agg(F.count(F.lit(1)).alias("n"),
                                          F.first("edges").alias("edges")), "node-steps")
    # A node with one kind of step, none of them into the open, and that step's target.
    out = (steps.groupBy("minimizer")
           .agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("n"),
                F.max("next").alias("next"), F.first("edges").alias("edges")))
    sizes = out.select(F.col("minimizer").alias("next"), F.col("n").alias("n_next"))
    into = (out.where("kinds = 1 and next is not null").join(sizes, "next").where("n = n_next")
            .select(F.col("next").alias("minimizer"), F.col("minimizer").alias("prev"),
                    F.col("edges").alias("before")))
    # Equal counts leave no room for a second predecessor.
    chain = materialize(
        out.select("minimizer", "edges").join(into, "minimizer", "left")
        .select("minimizer", "edges", F.coalesce("prev", "minimizer").alias("head"),
                F.coalesce("before", F.lit(0)).cast("long").alias("before")), "chains")
    while True:
        back = chain.select(F.col("minimizer").alias("head"), F.col("head").alias("head2"),
                            F.col("before").alias("before2"))
        moved = materialize(
            chain.join(back, "head")
            .select("minimizer", "edges", F.col("head2").alias("head"),
                    (F.col("before") + F.col("before2")).alias("before"),
                    (F.col("head") != F.col("head2")).alias("changed")), "chains")
        chain = moved.drop("changed")
        if moved.where("changed").isEmpty():
            break
    paths = materialize(
        chain.groupBy("head").agg(F.sum("edges").alias("path_edges"))
        .withColumnRenamed("head", "minimizer"), "paths")
    return (nodes.drop("edges").join(paths, "minimizer")
            .withColumnRenamed("path_edges", "edges"))


def open_edges(docs: DataFrame, sources: DataFrame, span: int = SPAN) -> DataFrame:
    """What stands at source coordinates: the edges of branching pieces, digests of paths.

    ``sources``: key columns and ``spots``, an array of (minimizer, piece, first,
    edges), with a null piece for a whole path.  Returns (minimizer, piece, number,
    edge_a, edge_b): a piece's edges by number from 0, a path's one digest.
    """
    schema = "minimizer long, piece long, number int, edge_a long, edge_b long"

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            for raw, spots in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = raw.split()
                paths = [s for s in spots if s["piece"] is None]
                found = [digest(words, s["first"], s["first"] + s["edges"] + span - 1)
                         for s in paths]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s["minimizer"] for s in paths], pa.int64()),
                     pa.nulls(len(paths), pa.int64()), pa.nulls(len(paths), pa.int32()),
                     *(pa.array([d[i] for d in found], pa.int64()) for i in (0, 1))],
                    names=["minimizer", "piece", "number", "edge_a", "edge_b"])
                spots = [s for s in spots if s["piece"] is not None]
                if not spots:
                    continue
                hasher.load(words)
                counts = np.array([s["edges"] for s in spots])
                number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                starts = np.repeat([s["first"] for s in spots], counts) + number
                repeat = lambda name: np.repeat(
                    np.array([s[name] for s in spots], np.int64), counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(repeat("minimizer")), pa.array(repeat("piece")),
                     pa.array(number, pa.int32()),
                     *(pa.array(hasher.spans(i, starts, span).view(np.int64)) for i in (0, 1))],
                    names=["minimizer", "piece", "number", "edge_a", "edge_b"])

    return (keyed(docs).join(sources, ROW_KEY).select("raw", "spots")
            .mapInArrow(kernel, schema))


def repeated_stretches(docs: DataFrame, span: int = SPAN,
                       minimizer: int = MINIMIZER) -> DataFrame:
    """Key columns and ``cuts``: word stretches (start, stop) whose spans also start
    under a smaller doc_id, unmerged; those of paths with their source's digest."""
    pieces = materialize(piece_table(docs, span, minimizer), "path-pieces")
    # The tables joined to occurrences are written first: a join whose sides both come
    # straight from a shuffle lets Spark split a key that holds many rows.
    shared = materialize(
        pieces.groupBy("minimizer")
        .agg(F.min("key_id").alias("low"), F.max("key_id").alias("high"),
             F.min("piece").alias("piece_low"), F.max("piece").alias("piece_high"))
        .where("low < high")
        .select("minimizer", "low", (F.col("piece_low") != F.col("piece_high"))
                .alias("branches")), "shared-minimizers")
    occurrences = materialize(pieces.join(shared, "minimizer"), "shared-pieces")
    discard(pieces)

    # Nonbranching paths: every piece of them is repeated as a whole.
    whole = path_occurrences(occurrences.where("not branches").drop("branches", "piece"))
    path_sources = whole.groupBy("minimizer").agg(
        F.min(F.struct("key_id", "key_hash", "first", "edges")).alias("at"))

    # Branching pieces: edges of each distinct one, read where it occurs first.
    branching = occurrences.where("branches")
    place = F.struct("key_id", "key_hash", "first", "edges")
    distinct = materialize(
        branching.groupBy("minimizer", "piece").agg(F.min(place).alias("at"))
        .select("minimizer", "piece", "at.*"), "distinct-pieces")
    spots = distinct.unionByName(path_sources.select(
        "minimizer", F.lit(None).cast("long").alias("piece"), "at.*"))
    sources = spots.groupBy(*ROW_KEY).agg(F.collect_list(F.struct(
        "minimizer", "piece", "first", F.col("edges").cast("int").alias("edges"))).alias("spots"))
    read = materialize(open_edges(docs, sources, span)
                       .dropDuplicates(["minimizer", "piece", "number"]), "source-reads")
    digests = materialize(read.where("piece is null"), "path-digests")
    straight = (whole.where("key_id > low")
                .join(digests, "minimizer")
                .select(*ROW_KEY, F.array(F.struct(
                    F.col("first").alias("start"),
                    (F.col("first") + F.col("edges") + (span - 1)).cast("int").alias("stop"),
                    "edge_a", "edge_b")).alias("cuts")))
    edges = read.where("piece is not null").join(
        distinct.select("minimizer", "piece", F.col("key_id").alias("low")),
        ["minimizer", "piece"])
    edge = ["minimizer", "edge_a", "edge_b"]
    lowest = materialize(
        edges.groupBy(*edge).agg(F.min("low").alias("lowest"), F.max("low").alias("high"))
        .where("lowest < high").select(*edge, "lowest"), "shared-edges")
    told = (edges.join(lowest, edge, "left")
            .select("minimizer", "piece", "number", F.coalesce("lowest", "low").alias("low")))
    verdicts = materialize(
        told.groupBy("minimizer", "piece")
        .agg(F.sort_array(F.collect_list(F.struct("number", "low"))).alias("lows")), "verdicts")
    discard(read)
    first, no_digest = F.col("first"), F.lit(None).cast("long")
    branched = (branching.select("minimizer", "piece", *ROW_KEY, "first")
                .join(verdicts, ["minimizer", "piece"])
                .select(*ROW_KEY, F.transform(
                    F.filter("lows", lambda e: e["low"] < F.col("key_id")),
                    lambda e: F.struct((first + e["number"]).alias("start"),
                                       (first + e["number"] + span).alias("stop"),
                                       no_digest.alias("edge_a"), no_digest.alias("edge_b")))
                    .alias("cuts"))
                .where(F.size("cuts") > 0))
    return (straight.unionByName(branched).groupBy(*ROW_KEY)
            .agg(F.flatten(F.collect_list("cuts")).alias("cuts")))


def cut_words(words: list[bytes], cuts) -> list[bytes]:
    """The words outside all stretches; one that differs from its source does not count."""
    cuts = [c for c in cuts or () if c["edge_a"] is None
            or digest(words, c["start"], c["stop"]) == (c["edge_a"], c["edge_b"])]
    if not cuts:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, [c["start"] for c in cuts], 1)
    np.add.at(depth, [c["stop"] for c in cuts], -1)
    keep = np.cumsum(depth[:-1]) == 0
    return [words[i] for i in np.flatnonzero(keep)]


def remove_repeated_spans(docs: DataFrame, span: int = SPAN,
                          minimizer: int = MINIMIZER) -> DataFrame:
    """doc_id, n_words, n_removed, ``kept`` (the words left, joined by one space)."""
    cuts = repeated_stretches(docs, span, minimizer)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, kept = [], [], []
            for raw, stretches in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = raw.split()
                left = cut_words(words, stretches)
                totals.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"])

    return (keyed(docs).join(cuts, ROW_KEY, "left").select("doc_id", "raw", "cuts")
            .mapInArrow(kernel, "doc_id long, n_words long, n_removed long, kept binary")
            .withColumn("kept", F.col("kept").cast("string")))
