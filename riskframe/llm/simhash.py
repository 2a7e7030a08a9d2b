"""SimHash near-dedup by pigeonhole blocks.

A fingerprint's 64 bits are split into blocks.  Two fingerprints that differ in
at most ``max_bits`` bits agree on at least ``blocks - max_bits`` whole blocks,
so joining on every choice of that many blocks meets every close pair; the
Hamming distance is then verified.

Work is on distinct fingerprints, each with its smallest document, so copies
cost nothing.  A crowd of close fingerprints shares blocks in bulk, and pairing
it off would grow with its square, so linking runs in two steps.  First each
bucket links its fingerprints to a few of its own members (a row per bucket
member, not per pair); components of those links take in whole crowds.  Then
only pairs whose two ends are still in different components are joined on the
blocks and verified.  A pair left out has both ends in one component already,
so components are exactly those of all links.

Defined results: null or wordless text has fingerprint zero, linked like any
other; a bit set in exactly half the hashes is zero; a very long text counts all
its shingles; identical rows share a fingerprint; a null doc_id never names a
component unless the component has no other id; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import ROW_KEY, discard, keyed, materialize, row_key
from riskframe.llm.components import connected_components

BITS = 64
SHINGLE = 4
MAX_BITS = 4
#: 7 blocks of 9 or 10 bits: keys of 3 blocks (27 or more bits), 35 ways to choose them.
BLOCKS = 7
SEED = 42


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles, repeats included; 0 for a text without words."""
    words = raw.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-shingle] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED)
                       for a, b in zip(starts.tolist(), ends[shingle - 1:].tolist())], np.uint64)
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        block = hashes[at:at + 65536]
        set_bits += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1,
                                  bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * set_bits > len(hashes), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """key_id, key_hash, doc_id and ``print`` (the 64 bits as a signed long), per input row."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(raw, shingle) for raw in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:3] + [pa.array(np.array(prints, np.uint64).view(np.int64))],
                names=["key_id", "key_hash", "doc_id", "print"])

    return keyed(docs).mapInArrow(
        kernel, "key_id long, key_hash long, doc_id long, print long")


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """One 64-bit mask (signed) per choice of ``blocks - max_bits`` blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]
    masks = [sum(choice) for choice in combinations(parts, blocks - max_bits)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def close(a: Column, b: Column, max_bits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= max_bits


def link_fingerprints(prints: DataFrame, max_bits: int = MAX_BITS,
                      blocks: int = BLOCKS) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose components are those of all
    pairs within ``max_bits``; every returned pair is within ``max_bits``.

    ``prints`` has one row per fingerprint in column ``print``.
    """
    # A bucket is one number; should two choices meet in one, the distance decides.
    keys = F.explode(F.array(*[
        F.xxhash64(F.lit(i), F.col("print").bitwiseAND(F.lit(mask).cast("long")))
        for i, mask in enumerate(block_masks(blocks, max_bits))]))
    buckets = prints.select("print", keys.alias("bucket"))
    shared = materialize(  # written first, so that the join can split a crowded bucket
        buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("print").alias("low"),
                                      F.max("print").alias("high")).where("low <> high"),
        "shared-blocks")
    near = close(F.col("a"), F.col("b"), max_bits)
    pairs = (shared.where("n = 2").select(F.col("low").alias("a"), F.col("high").alias("b"))
             .where(near))
    # Only buckets of three or more have members that their own row does not name.
    members = materialize(buckets.join(shared.where("n > 2").drop("n"), "bucket"),
                          "block-members")
    pivot = F.explode(F.array("low", "high"))
    stars = materialize(
        members.select(F.col("print").alias("a"), pivot.alias("b")).where("a <> b").where(near)
        .unionByName(pairs).distinct(), "star-links")
    groups = connected_components(stars)

    placed = materialize(
        members.select("bucket", "print")
        .join(groups.select(F.col("node").alias("print"), "root"), "print", "left")
        .select("bucket", "print", F.coalesce("root", "print").alias("root")),
        "placed-members")
    for done in (shared, members):
        discard(done)
    sizes = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    undecided = materialize(sizes.groupBy("bucket")
                            .agg(F.max_by("root", F.struct("n", "root")).alias("main"),
                                 F.count(F.lit(1)).alias("n_groups"))
                            .where("n_groups > 1").drop("n_groups"), "undecided-blocks")
    open_members = placed.join(undecided, "bucket")
    # One end is outside its bucket's largest component, so crowds never pair off.
    left = materialize(open_members.where("root <> main").select(
        "bucket", F.col("print").alias("a"), F.col("root").alias("root_a")), "outer-members")
    right = materialize(open_members.select(
        "bucket", F.col("print").alias("b"), F.col("root").alias("root_b"), "main"),
        "open-members")
    discard(placed)
    across = materialize(
        left.join(right, "bucket").where(F.col("root_a") != F.col("root_b"))
        .where((F.col("root_b") == F.col("main")) | (F.col("a") < F.col("b"))).where(near)
        .select("a", "b").distinct(), "cross-links")
    for done in (undecided, left, right):
        discard(done)
    return stars.unionByName(across)


def near_duplicate_components(docs: DataFrame, shingle: int = SHINGLE,
                              max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """key_id, key_hash, doc_id, print (signed long), root, component_id: a row per input row."""
    signed = materialize(fingerprints(docs, shingle), "fingerprints")
    distinct = materialize(signed.groupBy("print").agg(F.min("doc_id").alias("first_doc")),
                           "distinct-fingerprints")
    groups = connected_components(link_fingerprints(distinct.select("print"), max_bits, blocks))
    rooted = (distinct.join(groups.withColumnRenamed("node", "print"), "print", "left")
              .select("print", "first_doc", F.coalesce("root", "print").alias("root")))
    rooted = materialize(rooted, "rooted-fingerprints")
    names = materialize(  # written first, so that the join can split a large component
        rooted.groupBy("root").agg(F.min("first_doc").alias("component_id")), "component-names")
    labels = rooted.join(names, "root").select("print", "root", "component_id")
    return signed.join(labels, "print")


def hex_fingerprint(column: str = "print") -> Column:
    """16 lowercase hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


def keep_one_per_component(docs: DataFrame, shingle: int = SHINGLE,
                           max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """The rows of ``docs`` with one row left per near-duplicate component.

    The kept row has the component's smallest doc_id (any id before null); of
    rows with that id, the one with the smallest text hash; of equal rows, one.
    Extra columns pass through, but one named key_id, key_hash or copy_number goes.
    """
    docs = docs.drop(*ROW_KEY, "copy_number")
    found = near_duplicate_components(docs, shingle, max_bits, blocks)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "key_id", "key_hash")
    keepers = (found.groupBy("root").agg(F.min(order).alias("k"))
               .select("k.key_id", "k.key_hash"))
    copies = Window.partitionBy(*ROW_KEY).orderBy("key_hash")
    return (docs.select("*", *row_key(docs)).join(keepers, ROW_KEY, "left_semi")
            .withColumn("copy_number", F.row_number().over(copies)).where("copy_number = 1")
            .select(*docs.columns))
