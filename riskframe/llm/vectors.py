"""Embedding near-dedup by collision-counting projections.

Unit vectors are projected on many random lines.  Two vectors whose cosine is
at least the threshold lie within a known distance, so on each line one falls
into a window centred on the other with known probability.  A pair is verified
when its windows collide on at least ``needed`` lines, the largest count that
keeps the wanted recall for a pair exactly at the threshold (a binomial tail).

Three more lines, with wider windows that hardly any such pair misses, are
sorted to find the pairs worth counting.  On the first of them rows are dealt to
stripes of one window's width, so a row's window reaches its own stripe and its
neighbours.  Stripes are cut into blocks of at most ``BLOCK_ROWS`` rows and
compared block against block, so a label or stripe that holds most rows is
spread over many tasks and no task holds more than two blocks.  Inside a task
rows are sorted by their cell on the other two lines, then along the first, so a
query's windows on all three meet in nine runs of the sorted rows; only pairs in
these runs are formed.  Pairs drop out as soon as the lines left cannot bring
them to ``needed``.  A task returns link counts per row and a spanning set of
links, never its pairs.

Work grows with the pairs whose sorted windows collide, about a quarter of a
label's pairs; a line tells vectors apart only by a constant factor,
so that is still the square of a label's distinct vectors (see README).

Defined results: copies of a vector under one label are compared once and
linked to each other; rows with a null label, or a vector that is null, empty,
zero or holds null or non-finite components link with nothing; vectors of
different different length do not link; repeated rows count as copies; a cosine equal to
the threshold links; vectors may be of any length; an empty table gives no rows;
extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskframe.llm.common import materialize
from riskframe.llm.components import connected_components

THRESHOLD = 0.98
LINES = 24
RECALL = 0.999999
#: Half-width of a window in standard deviations of a threshold pair's difference.
REACH = 3.0
#: The same for the sorted lines.
SORTED_REACH = 4.5
SORTED_LINES = 3
BLOCK_ROWS = 2048
SEED = 20240611
PAIRS_AT_ONCE = 1 << 21


def window(threshold: float, reach: float = REACH) -> float:
    """Half-width of the query-centred window on every line."""
    return reach * math.sqrt(2.0 - 2.0 * threshold)


def needed_collisions(lines: int = LINES, reach: float = REACH, recall: float = RECALL) -> int:
    """The largest count that a threshold pair reaches with probability ``recall``."""
    p = math.erf(reach / math.sqrt(2.0))
    tail = 0.0
    for count in range(lines, -1, -1):
        tail += math.comb(lines, count) * p ** count * (1 - p) ** (lines - count)
        if tail >= recall:
            return count
    return 0


def random_lines(dim: int, lines: int = LINES, seed: int = SEED) -> np.ndarray:
    """The sorted lines and ``lines`` counted ones, as columns."""
    return np.random.default_rng([seed, dim]).standard_normal((dim, SORTED_LINES + lines))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) \
        .reshape(len(column), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def sorted_runs(a: np.ndarray, b: np.ndarray, half: float):
    """Where the windows of ``a``'s rows on the sorted lines meet rows of ``b``.

    Returns an order of ``b`` and, for each of the nine cells around a row's own on
    the second and third line and each row of ``a``, the start and size of a run.
    Runs hold every row inside all three windows, and some just outside.
    """
    cells_a, cells_b = (np.floor(x[:, 1:SORTED_LINES] / half).astype(np.int64) for x in (a, b))
    both = np.concatenate([cells_a, cells_b])
    least, spans = both.min(axis=0) - 1, np.ptp(both, axis=0) + 3
    code = lambda cells: (cells[:, 0] - least[0]) * spans[1] + cells[:, 1] - least[1]
    # A cell's rows stand together, apart from the next cell's by more than a window.
    apart = np.abs(a[:, 0]).max() + np.abs(b[:, 0]).max() + 2 * half + 1
    key = code(cells_b) * (2 * apart) + b[:, 0]
    order = np.argsort(key, kind="stable")
    key, reach = key[order], half + 1e-6  # the exact windows are compared afterwards
    around = np.array([(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    centre = np.concatenate([code(cells_a + step) for step in around]) * (2 * apart) \
        + np.tile(a[:, 0], len(around))
    low = np.searchsorted(key, centre - reach, "left")
    return order, low, np.searchsorted(key, centre + reach, "right") - low


def colliding_pairs(a: np.ndarray, b: np.ndarray, sorted_half: float, half: float, needed: int):
    """Row pairs (of ``a``, of ``b``) that share a window on every sorted line and on
    ``needed`` or more of the counted ones."""
    if not len(a) or not len(b):
        return
    total = a.shape[1]
    order, low, sizes = sorted_runs(a, b, sorted_half)
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(0, sizes.sum(), PAIRS_AT_ONCE), "left")
    edges = [0, *sorted(set(cuts[1:].tolist())), len(sizes)]
    for first, last in zip(edges, edges[1:]):
        n = sizes[first:last]
        left = np.repeat(np.arange(first, last) % len(a), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        right = order[np.repeat(low[first:last], n) + step]
        for line in range(SORTED_LINES):
            near = np.abs(a[left, line] - b[right, line]) <= sorted_half
            left, right = left[near], right[near]
        counts = np.zeros(len(left), np.int16)
        for line in range(SORTED_LINES, total):
            counts += np.abs(a[left, line] - b[right, line]) <= half
            alive = counts + (total - 1 - line) >= needed
            if not alive.all():
                left, right, counts = left[alive], right[alive], counts[alive]
        yield left, right


def spanning_links(nodes: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Links (node, smallest reachable node) with the components of all given pairs."""
    labels = np.arange(len(nodes))
    while len(left):
        best = np.minimum(labels[left], labels[right])
        before = labels.copy()
        np.minimum.at(labels, left, best)
        np.minimum.at(labels, right, best)
        labels = labels[labels]
        if (labels == before).all():
            break
    moved = np.flatnonzero(labels != np.arange(len(nodes)))
    return nodes[moved], nodes[labels[moved]]


def compare_blocks(threshold: float, sorted_half: float, half: float, needed: int, lines: int):
    """The task: two blocks (or one with itself) to link counts and spanning links."""

    def kernel(table: pa.Table) -> pa.Table:
        vectors = matrix(table.column("embedding"))
        rows = unit(vectors)
        projected = rows @ random_lines(rows.shape[1], lines)
        node = table.column("node").to_numpy()
        copies = table.column("copies").to_numpy()
        side = table.column("side").to_numpy()
        same = bool((side == 2).any())
        a = np.flatnonzero((side == 0) | (side == 2))
        b = a if same else np.flatnonzero(side == 1)
        links = np.zeros(len(node), np.int64)
        lefts, rights = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i, j in colliding_pairs(projected[a], projected[b], sorted_half, half, needed):
            i, j = a[i], b[j]
            if same:
                i, j = i[i < j], j[i < j]
            for at in range(0, len(i), 1 << 17):
                p, q = i[at:at + (1 << 17)], j[at:at + (1 << 17)]
                linked = np.einsum("ij,ij->i", rows[p], rows[q]) >= threshold
                p, q = p[linked], q[linked]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                lefts.append(p)
                rights.append(q)
        ends, roots = spanning_links(np.arange(len(node)), np.concatenate(lefts),
                                     np.concatenate(rights))
        counted = np.flatnonzero(links)
        return pa.table({
            "a": pa.array(np.concatenate([node[counted], node[ends]])),
            "b": pa.array(np.concatenate([node[counted], node[roots]])),
            "n": pa.array(np.concatenate([links[counted], np.zeros(len(ends), np.int64)]))})

    return kernel


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that can link: label known, every component finite, not all zero."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    nonzero = F.exists("embedding", lambda x: x != 0)
    return vectors.where(F.col("label").isNotNull() & F.coalesce(finite & nonzero, F.lit(False)))


def near_duplicate_vectors(embeddings: DataFrame, threshold: float = THRESHOLD,
                           lines: int = LINES, reach: float = REACH,
                           recall: float = RECALL, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row."""
    half, needed = window(threshold, reach), needed_collisions(lines, reach, recall)
    sorted_half = window(threshold, SORTED_REACH)
    rows = embeddings.select("vec_id", "embedding", "label")
    distinct = (usable(rows).groupBy("label", "embedding")
                .agg(F.min("vec_id").alias("first_vec"), F.count(F.lit(1)).alias("copies"))
                .withColumn("node", F.monotonically_increasing_id()))
    dim_of = F.size("embedding")

    def sorted_line(batches):
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            stripe = np.zeros(len(sizes), np.int64)
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                rows = unit(matrix(batch.column("embedding").take(pa.array(at))))
                stripe[at] = np.floor(rows @ random_lines(int(dim), lines)[:, 0] / sorted_half)
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array(stripe)], names=batch.schema.names + ["stripe"])

    placed = distinct.withColumn("dim", dim_of)
    striped = StructType([*placed.schema.fields, StructField("stripe", LongType())])
    placed = materialize(placed.mapInArrow(sorted_line, striped), "placed-vectors")

    group = ["label", "dim", "stripe"]
    blocks = (placed.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("n_blocks", F.ceil(F.col("n") / block_rows).cast("int")))
    following = blocks.select("label", "dim", (F.col("stripe") - 1).alias("stripe"),
                              F.col("n_blocks").alias("n_next"))
    preceding = blocks.select("label", "dim", (F.col("stripe") + 1).alias("stripe"),
                              F.col("n_blocks").alias("n_before"))
    layout = (blocks.join(following, group, "left").join(preceding, group, "left")
              .select(*group, "n_blocks", F.coalesce("n_next", F.lit(0)).alias("n_next"),
                      F.coalesce("n_before", F.lit(0)).alias("n_before")))
    dealt = placed.join(layout, group).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int"))
    # A row meets the blocks of its own stripe and of the stripes beside it.
    home = F.col("stripe")
    pair = lambda stripe, i, j, nxt, side: F.struct(
        stripe.alias("at"), i.alias("i"), j.alias("j"), F.lit(nxt).alias("next"),
        F.lit(side).cast("int").alias("side"))
    count_to = lambda n, f: F.transform(
        F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), f)
    block = F.col("block")
    places = F.concat(
        F.array(pair(home, block, block, False, 2)),
        F.filter(count_to(F.col("n_blocks"), lambda j: pair(home, block, j, False, 0)),
                 lambda p: p["j"] > p["i"]),
        F.filter(count_to(F.col("n_blocks"), lambda i: pair(home, i, block, False, 1)),
                 lambda p: p["i"] < p["j"]),
        count_to(F.col("n_next"), lambda j: pair(home, block, j, True, 0)),
        count_to(F.col("n_before"), lambda i: pair(home - 1, i, block, True, 1)))
    tasks = dealt.select("label", "dim", "node", "copies", "embedding",
                         F.explode(places).alias("p")).select(
        "label", "dim", "node", "copies", "embedding", "p.*")
    found = materialize(
        tasks.groupBy("label", "dim", "at", "i", "j", "next")
        .applyInArrow(compare_blocks(threshold, sorted_half, half, needed, lines), "a long, b long, n long"),
        "vector-links")

    counts = found.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    groups = connected_components(found.where("a <> b").select("a", "b"))
    known = (placed.select("node", "first_vec", "copies", "label", "embedding")
             .join(counts, "node", "left").join(groups, "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    known = materialize(known, "vector-groups")
    names = materialize(  # written first, so that the join can split a large component
        known.groupBy("root").agg(F.min("first_vec").alias("component_id")), "component-names")
    classes = known.join(names, "root").select(
        "label", "embedding", "component_id",
        (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return (rows.join(classes, ["label", "embedding"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id")))
