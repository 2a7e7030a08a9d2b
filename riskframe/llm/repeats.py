"""Repeated byte strings from an enhanced suffix array over anchors.

Every string of ``span`` bytes (a window) has an anchor that its own bytes name:
the leftmost place, among those where its first ``span - core`` strings of
``core`` bytes start, with the least hash of the next few bytes.  Consecutive
windows share anchors, so an anchor stands for a run of windows: those that begin
``near`` to ``far`` bytes before it.  Equal windows have equal anchors at equal
distances, so two windows only ever meet under the ``core`` bytes that follow
their anchors.  A suffix array over anchors, not over all bytes, therefore has
every repeat; what a suffix lacks of the window on its left is the left context.

1. Anchors are grouped by the hash of their core.  A core seen once is dropped.
   Where all occurrences have the same context (all the run's windows' bytes),
   every window of the run is repeated.
2. The other cores' distinct contexts are read back from their texts and dealt to
   tasks by core.  There the suffixes (what follows the anchor) are sorted, common
   prefixes of neighbours computed, and the tree of common-prefix intervals is
   walked with a stack.  In every interval the left contexts are sorted and walked
   the same way, from right to left: a set of contexts that agree on ``left`` bytes
   before and ``right`` bytes behind the anchor is a maximal repeat if its members
   differ (or end) both in the byte before and the byte behind, and is reported
   with all its members if it is ``span`` bytes or longer.
3. A core with more contexts than a task should hold is cut finer: its windows are
   dealt again by slices of their distance to the anchor, whose cores are longer,
   down to single windows, of which counting is enough.
4. An occurrence's repeated bytes are the union of its context's maximal repeats,
   one stretch around its anchor; a document's stretches merge.

Cores and contexts are compared by two independent 64-bit hashes.

Defined results: null text counts as empty; texts shorter than a window are never
cut and very long ones are cut throughout; rows with equal text are occurrences of
each other, repeated rows too; matches do not cross documents and may overlap
within one; ties between equal bytes need no order, since all occurrences go; an
empty table gives no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import ROW_KEY, discard, keyed, materialize

SPAN = 400
#: Least number of a window's bytes that follow its anchor.
CORE = 200
#: Bytes whose hash names anchors.
GRAM = 8
#: Distinct contexts of one core that a task sorts; larger cores are cut finer.
CONTEXTS = 1024
#: Distances to the anchor in one slice, level by level.
SLICES = (16, 1)

ANCHOR_SCHEMA = ("key_id long, key_hash long, at long, far int, near int, "
                 "core long, context long")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.uint64((1 << 32) - 1)
_UPPER = ~_LOWER
#: Windows of one text whose anchors are sought at once.
WINDOWS_AT_ONCE = 1 << 20


def gram_hashes(raw: bytes, gram: int = GRAM) -> np.ndarray:
    """A hash of the ``gram`` bytes (1, 2, 4 or 8) from every place where they fit."""
    grams = np.frombuffer(raw, np.uint8).astype(np.uint64)
    size = 1
    while size < gram:
        grams = (grams[:-size] << np.uint64(8 * size)) | grams[size:]
        size *= 2
    grams = grams * _MIX
    grams ^= grams >> np.uint64(29)
    grams *= _MIX
    return grams


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """For each full window of ``width`` values the place of its least one, first on ties."""
    # The hash's upper half above the place: the least number is the least hash, then
    # the first place, whatever else a text holds.
    best = (values & _UPPER) | np.arange(len(values), dtype=np.uint64)
    done = 1
    while done < width:  # windows of ``done`` values grow to ``width``
        step = min(done, width - done)
        best = np.minimum(best[:-step], best[step:])
        done += step
    return (best & _LOWER).astype(np.int64)


def anchors(raw: bytes, span: int = SPAN, core: int = CORE):
    """(at, far, near) of a text's anchors, as arrays: windows start ``far`` to ``near``
    bytes before the anchor at ``at``."""
    gram = 1 << (min(GRAM, core).bit_length() - 1)
    found = [(np.zeros(0, np.int64),) * 3]
    for begin in range(0, len(raw) - span + 1, WINDOWS_AT_ONCE):
        n_windows = min(WINDOWS_AT_ONCE, len(raw) - span + 1 - begin)
        part = raw[begin:begin + n_windows + span - core + gram - 1]
        at = least_places(gram_hashes(part, gram), span - core + 1)[:n_windows]
        first = np.flatnonzero(np.diff(at, prepend=-1))
        last = np.append(first[1:], n_windows) - 1
        found.append((at[first] + begin, at[first] - first, at[first] - last))
    return tuple(np.concatenate(column) for column in zip(*found))


def anchored(docs: DataFrame, span: int = SPAN, core: int = CORE) -> DataFrame:
    """The anchors of every text with hashes of their core and context."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            places, sizes, cores, contexts = [anchors(b"")], [0], [], []
            for raw in batch.column(3).to_pylist():
                found = anchors(raw, span, core)
                places.append(found)
                sizes.append(len(found[0]))
                for p, far, near in zip(*(x.tolist() for x in found)):
                    cores.append(digest(raw[p:p + core], 1))
                    # The distance is part of a context: equal bytes, equal windows.
                    contexts.append(digest(raw[p - far:p - near + span], far * 65537 + 2))
            at, far, near = (np.concatenate(column) for column in zip(*places))
            rows = pa.array(np.repeat(np.arange(batch.num_rows), sizes[1:]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(at),
                 pa.array(far.astype(np.int32)), pa.array(near.astype(np.int32)),
                 pa.array(np.array(cores, np.uint64).view(np.int64)),
                 pa.array(np.array(contexts, np.uint64).view(np.int64))],
                names=["key_id", "key_hash", "at", "far", "near", "core", "context"])

    return keyed(docs).mapInArrow(kernel, ANCHOR_SCHEMA)


# The tree of common-prefix intervals ----------------------------------------------

def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def intervals(strings: list[bytes], least: int) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of the common-prefix intervals of sorted ``strings`` that are
    ``least`` or more deep, by one scan with a stack; equal strings are one interval."""
    stack: list[tuple[int, int]] = []  # (depth, first)
    for i in range(1, len(strings) + 1):
        depth = common_prefix(strings[i - 1], strings[i]) if i < len(strings) else -1
        first = i - 1
        while stack and stack[-1][0] > depth:
            deep, first = stack.pop()
            yield deep, first, i - 1
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], counts: list[int],
                    span: int) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, members) of the maximal repeats of ``span`` or more bytes around one
    core: members agree on ``left`` bytes before and ``right`` bytes behind the anchor.

    Bytes outside a context are unknown and count as different.
    """
    for i, n in enumerate(counts):  # contexts that occur more than once
        if n > 1:
            yield len(lefts[i]), len(rights[i]), [i]
    order = sorted(range(len(rights)), key=rights.__getitem__)
    furthest = max(map(len, lefts), default=0)
    backward = [left[::-1] for left in lefts]
    for right, first, last in intervals([rights[i] for i in order], span - furthest):
        inside = sorted(order[first:last + 1], key=backward.__getitem__)
        behind = {i: rights[i][right:right + 1] for i in inside}
        for left, a, b in intervals([backward[i] for i in inside], span - right):
            members = inside[a:b + 1]
            follow = {behind[i] for i in members}
            if len(follow) > 1 or follow == {b""}:  # else a deeper interval has them all
                yield left, right, members


GROUP_SCHEMA = "core long, group_no long, name long, left long, right long"


def core_repeats(span: int, reach_only: bool):
    """The task: contexts sorted by core to maximal repeats with all their members, or,
    with ``reach_only``, to one row per context: the furthest that its repeats go."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        group, out = 0, []
        for core, found in groupby(rows(), key=lambda r: r[0]):
            # As many as the caller's limit, however often each occurs.
            _, names, lefts, rights, counts = map(list, zip(*found))
            reach: dict[int, tuple[int, int]] = {}
            for left, right, members in maximal_repeats(lefts, rights, counts, span):
                if reach_only:
                    for i in members:
                        far = reach.get(i, (0, 0))
                        reach[i] = max(far[0], left), max(far[1], right)
                    continue
                out += [(core, group, names[i], left, right) for i in members]
                group += 1
            out += [(core, -1, names[i], *far) for i, far in reach.items()]
            if len(out) > 10_000:
                yield _group_batch(out)
                out = []
        yield _group_batch(out)

    return kernel


def _group_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                      names=["core", "group_no", "name", "left", "right"])


def sliced(contexts: DataFrame, span: int, width: int) -> DataFrame:
    """Slices of contexts (core, name, before, behind, n): one row for each ``width``
    distances to the anchor, with the core that all windows of the slice share."""
    far, near = F.length("before"), F.lit(span) - F.length("behind")
    low, high = F.col("slice") * width, F.col("slice") * width + (width - 1)
    cut = (contexts.withColumns({"far": far, "near": near})
           .withColumn("slice", F.explode(F.sequence(F.floor(F.col("near") / width).cast("int"),
                                                     F.floor(F.col("far") / width).cast("int"))))
           .withColumns({"first": F.greatest("near", low), "last": F.least("far", high)}))
    before = F.substring("before", F.col("far") - F.col("last") + 1, F.col("last"))
    behind = F.substring("behind", F.lit(1), F.lit(span) - F.col("first"))
    shared = [F.col("slice"), F.substring("before", F.col("far") - low + 1, low),
              F.substring("behind", F.lit(1), F.lit(span) - high)]
    rows = cut.select("name", "n", F.xxhash64(*shared).alias("core"), before.alias("before"),
                      behind.alias("behind"))
    return rows.withColumn("context", F.xxhash64(
        F.lit("context"), F.length("before"), "before", "behind"))


def maximal_groups(contexts: DataFrame, span: int = SPAN, limit: int = CONTEXTS,
                   slices: tuple[int, ...] = SLICES, reach_only: bool = False) -> DataFrame:
    """core, group_no, name, left, right: maximal repeats with all their contexts, or
    how far they reach around each context's anchor, group by group of its slices.

    ``contexts`` (core, name, before, behind, n) has the distinct contexts of each core
    and how often each occurs.  Cores of more than ``limit`` contexts go on to slices of
    the distance to the anchor, level by level; equal slices are one context again.
    """
    level = contexts.select("core", "name", "before", "behind", "n")
    owners, groups = None, []
    for width in (*slices, 0):
        sizes = materialize(level.groupBy("core").agg(
            F.count(F.lit(1)).alias("n_contexts"), F.sum("n").alias("n_rows")), "core-sizes")
        fitting = sizes.where((F.col("n_contexts") <= limit) & (F.col("n_rows") > 1))
        small = level.join(fitting.select("core"), "core")
        found = (small.repartition("core").sortWithinPartitions("core")
                 .select("core", "name", "before", "behind", "n")
                 .mapInArrow(core_repeats(span, reach_only), GROUP_SCHEMA))
        if owners is not None:
            found = (found.withColumnRenamed("name", "slice_name")
                     .join(owners, "slice_name").drop("slice_name"))
        groups.append(materialize(found.select("core", "group_no", "name", "left", "right"),
                                  "repeat-groups"))
        large = sizes.where(F.col("n_contexts") > limit).select("core")
        if not width or large.isEmpty():
            break
        rows = level.join(large, "core").drop("core")
        if owners is not None:
            rows = rows.withColumnRenamed("name", "slice_name").join(owners, "slice_name")
        rows = materialize(sliced(rows, span, width), "slices")
        again = materialize(rows.groupBy("core").agg(F.sum("n").alias("n")).where("n > 1")
                            .select("core"), "repeated-slices")
        rows = materialize(rows.join(again, "core"), "open-slices")
        level = materialize(
            rows.groupBy("core", "context").agg(
                F.first("before").alias("before"), F.first("behind").alias("behind"),
                F.sum("n").alias("n")).withColumn("name", F.monotonically_increasing_id()),
            "slice-contexts")
        owners = materialize(
            rows.select("core", "context", "name").join(
                level.select("core", "context", F.col("name").alias("slice_name")),
                ["core", "context"]).select("slice_name", "name"), "slice-owners")
    out = groups[0]
    for more in groups[1:]:
        out = out.unionByName(more)
    return out


# Documents -------------------------------------------------------------------------

def repeat_occurrences(docs: DataFrame, span: int = SPAN, core: int = CORE,
                       limit: int = CONTEXTS, slices: tuple[int, ...] = SLICES,
                       reach_only: bool = False) -> DataFrame:
    """key_id, key_hash, at, left, right, core, group_no: every occurrence of every
    maximal repeat around an anchor, ``left + right`` bytes from ``at - left`` on.

    A repeat longer than the windows of one anchor is told anchor by anchor.  Groups
    inside groups list their members again; ``reach_only`` tells of each occurrence just
    how far all its groups go, which is what covers its repeated bytes.
    """
    found = materialize(anchored(docs, span, core), "anchors")
    cores = materialize(  # written first, so that the join can split a core of many rows
        found.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("low"),
                                  F.max("context").alias("high")).where("n > 1")
        .select("core", (F.col("low") == F.col("high")).alias("whole")), "repeated-cores")
    rows = materialize(found.join(cores, "core"), "repeated-anchors")
    for done in (found, cores):
        discard(done)

    place = F.struct(*ROW_KEY, "at", "far", "near")
    told = materialize(
        rows.where("not whole").groupBy("core", "context")
        .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("p"))
        .select("core", "context", "n", "p.*")
        .withColumn("name", F.monotonically_increasing_id()), "contexts")
    texts = keyed(docs).select(*ROW_KEY, "raw")
    contexts = (texts.join(told, ROW_KEY)
                .select("core", "name", "n",
                        F.expr("substring(raw, cast(at - far + 1 as int), far)").alias("before"),
                        F.expr(f"substring(raw, cast(at + 1 as int), {span} - near)")
                        .alias("behind"))
                .dropDuplicates(["name"]))  # rows that share a key hold one text
    groups = maximal_groups(materialize(contexts, "context-bytes"), span, limit, slices,
                            reach_only)
    named = materialize(groups.select("name", "group_no", "left", "right",
                                      F.col("core").alias("group_core"))
                        .join(told.select("name", "core", "context"), "name"), "named-groups")
    mixed = rows.where("not whole").join(named, ["core", "context"]).select(
        *ROW_KEY, "at", "left", "right", F.col("group_core").alias("core"), "group_no")
    whole = rows.where("whole").select(
        *ROW_KEY, "at", F.col("far").cast("long").alias("left"),
        (F.lit(span) - F.col("near")).cast("long").alias("right"), "core",
        F.lit(-1).cast("long").alias("group_no"))
    return whole.unionByName(mixed)


def repeated_stretches(occurrences: DataFrame) -> DataFrame:
    """key_id, key_hash, spans: the merged stretches (start, stop) that repeats cover."""
    # Grouped first: rows that share a key have the same cuts.
    cuts = (occurrences.groupBy(*ROW_KEY, (F.col("at") - F.col("left")).alias("start"))
            .agg(F.max(F.col("at") + F.col("right")).alias("stop")))
    before = Window.partitionBy(*ROW_KEY).orderBy("start", "stop")
    reach = F.max("stop").over(before.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("start") > F.col("reach"), F.lit(True)).cast("long")
    return (cuts.withColumn("reach", reach).withColumn("stretch", F.sum(begins).over(before))
            .groupBy(*ROW_KEY, "stretch").agg(F.min("start").alias("start"),
                                              F.max("stop").alias("stop"))
            .groupBy(*ROW_KEY).agg(F.sort_array(F.collect_list(F.struct("start", "stop")))
                                   .alias("spans")))


def remove_repeats(docs: DataFrame, span: int = SPAN, core: int = CORE,
                   limit: int = CONTEXTS, slices: tuple[int, ...] = SLICES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary): texts without repeated bytes."""
    # Written first, so that the join can split a key that many equal rows share.
    stretches = materialize(
        repeated_stretches(repeat_occurrences(docs, span, core, limit, slices, True)),
        "repeated-stretches")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, raw, spans in zip(*(c.to_pylist() for c in batch.columns)):
                kept, at = [], 0
                for part in spans or ():
                    kept.append(raw[at:part["start"]])
                    at = part["stop"]
                kept = b"".join([*kept, raw[at:]])
                out.append((doc_id, len(raw), len(raw) - len(kept), len(spans or ()), kept))
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns[:4]]
                + [pa.array(columns[4], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return (keyed(docs).join(stretches, ROW_KEY, "left").select("doc_id", "raw", "spans")
            .mapInArrow(kernel, "doc_id long, n_bytes long, n_removed long, n_spans long, "
                                "kept binary"))
