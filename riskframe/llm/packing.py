"""Best-fit packing by exact complements.

Documents become token pieces of at most ``capacity`` tokens.  Piece lengths
are bounded, so the packing problem is its length histogram: at most
``capacity`` counts, whatever the corpus.  The plan is made on that histogram:
tables keyed by the sum tell how many combinations of one, two and three
available lengths have it.  For each length, longest first, the gap it leaves is
looked up there; a combination that fills it exactly is consumed as often as its
counts allow, and the tables follow as lengths run out.  What no exact
combination can fill is packed best-fit.  Each plan step uses up at least one length, so the plan has a
few thousand steps at any corpus size.  Spark then deals the pieces of each
length to the plan's slots by their rank among pieces of that length.

Ranks need no sort and no window over a hot length: every tokenising task
numbers its own pieces per length, the pieces are written once, and one
aggregate per (length, task) gives the offsets.

Defined results: null or empty text is the one end-of-text token; a text longer
than ``capacity`` tokens is cut, however long, and no other; repeated rows are
packed as separate documents; pieces of equal length are dealt in any order; a
null id is kept as such; an empty table gives no pieces; extra columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import materialize, text_bytes
from riskframe.llm.tokens import default_vocabulary, encoder

END_OF_TEXT = 0
CAPACITY = 2048

PIECE_SCHEMA = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
                "task int, local_rank long")


def cut(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter."""
    first = n_tokens % capacity or min(n_tokens, capacity)
    starts = [0, *range(first, n_tokens, capacity)]
    return [(s, (first if s == 0 else capacity)) for s in starts]


def tokenize_pieces(docs: DataFrame, capacity: int = CAPACITY,
                    vocabulary: str | None = None) -> DataFrame:
    """One row per piece, with the writing task and the piece's rank there within its length."""
    path = vocabulary or default_vocabulary()

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(raw.decode("utf-8", "replace"))
                ids.append(END_OF_TEXT)
                packed = np.asarray(ids, "<u4")
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    crc = zlib.crc32(packed[start:start + length].tobytes())
                    out.append((doc_id, piece, start, length, crc, task, int(seen[length])))
                    seen[length] += 1
            columns = list(zip(*out)) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i in (1, 5) else pa.int64())
                 for i, c in enumerate(columns)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "local_rank"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        text_bytes().alias("raw"))
            .mapInArrow(kernel, PIECE_SCHEMA))


@dataclass(frozen=True)
class Step:
    """``times`` sequences that hold ``lengths`` in this order."""

    lengths: tuple[int, ...]
    times: int


class SumIndex:
    """How many combinations of one, two and three available lengths have each sum.

    ``singles``, ``pairs`` and ``triples`` are tables keyed by the sum (sums are
    bounded by ``capacity``, so the key is its own hash).  A length counts with
    multiplicity up to three: a pair may hold it twice where two pieces are left.
    When a piece count falls below three, two or one, the combinations that needed
    it leave the tables; ``take`` and ``give`` keep them up to date in one pass over
    the sums, so whether a gap can be filled is one lookup.
    """

    def __init__(self, counts: np.ndarray):
        self.counts = np.zeros_like(counts)
        self.size = len(counts)
        self.singles, self.pairs, self.triples = np.zeros((3, self.size), np.int64)
        for length in np.flatnonzero(counts):
            self.give(int(length), int(counts[length]))

    def _level(self, length: int) -> int:
        return min(3, int(self.counts[length]))

    def _shift(self, table: np.ndarray, by: int, source: np.ndarray, sign: int) -> None:
        """Add the combinations of ``source``, each with ``by`` more in its sum."""
        if by < self.size:
            table[by:] += sign * source[:self.size - by]

    def _copy(self, length: int, level: int, sign: int) -> None:
        """Combinations that hold ``length`` exactly ``level`` times come or go."""
        others = self.singles.copy()
        others[length] = 0
        if level == 3 and 3 * length < self.size:
            self.triples[3 * length] += sign
        elif level == 2:
            if 2 * length < self.size:
                self.pairs[2 * length] += sign
            self._shift(self.triples, 2 * length, others, sign)
        elif level == 1:
            if sign < 0:  # pairs without the length are left when its own have gone
                self._shift(self.pairs, length, others, sign)
            self._shift(self.triples, length, self.pairs, sign)
            if sign > 0:
                self._shift(self.pairs, length, others, sign)
            self.singles[length] += sign

    def take(self, length: int, times: int = 1) -> None:
        before = self._level(length)
        self.counts[length] -= times
        for level in range(before, self._level(length), -1):
            self._copy(length, level, -1)

    def give(self, length: int, times: int = 1) -> None:
        before = self._level(length)
        self.counts[length] += times
        for level in range(before + 1, self._level(length) + 1):
            self._copy(length, level, 1)

    def complement(self, gap: int) -> tuple[int, ...] | None:
        """The fewest, longest available lengths that fill ``gap`` exactly."""
        if self.singles[gap]:
            return (gap,)
        if self.pairs[gap]:
            return self._pair(gap)
        if self.triples[gap]:
            lengths = np.arange(1, gap - 1)
            fits = (self.singles[lengths] > 0) & (self.pairs[gap - lengths] > 0)
            for longest in lengths[fits][::-1].tolist():
                self.take(longest)
                rest = self._pair(gap - longest) if self.pairs[gap - longest] else None
                self.give(longest)
                if rest:
                    return (longest, *rest)
        return None

    def _pair(self, total: int) -> tuple[int, int]:
        """The pair of available lengths with this sum whose longer one is longest."""
        low = np.arange(1, total // 2 + 1)
        fits = (self.singles[low] > 0) & (self.singles[total - low] > 0)
        if total % 2 == 0:
            fits[-1] &= self.counts[total // 2] > 1
        first = int(low[np.argmax(fits)])
        return total - first, first


def _times(counts: np.ndarray, lengths: tuple[int, ...]) -> int:
    return min(int(counts[length]) // lengths.count(length) for length in set(lengths))


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Step]:
    """Packing steps for ``histogram`` (length -> count of pieces below capacity)."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    plan, residual = [], []
    index = SumIndex(counts)
    left = index.counts

    for length in range(capacity, 0, -1):
        while left[length] > 0:
            index.take(length)  # the sequence's own piece is not available to its gap
            rest = index.complement(capacity - length) if length < capacity else ()
            index.give(length)
            if rest is None:
                break
            lengths = (length, *rest)
            times = _times(left, lengths)
            for used in lengths:
                index.take(used, times)
            plan.append(Step(tuple(sorted(lengths, reverse=True)), times))
        if left[length] > 0:  # no exact filling is left: set aside for best fit
            residual.append((length, int(left[length])))
            index.take(length, int(left[length]))

    counts[:] = 0
    for length, n in residual:
        counts[length] = n
    for length, _ in residual:  # longest first
        while counts[length] > 0:
            lengths, gap = [length], capacity - length
            counts[length] -= 1
            while gap > 0 and (fits := np.flatnonzero(counts[:gap + 1])).size:
                best = int(fits[-1])
                n = min(int(counts[best]), gap // best)
                lengths += [best] * n
                counts[best] -= n
                gap -= n * best
            for used in lengths:
                counts[used] += 1
            times = _times(counts, tuple(lengths))
            for used in lengths:
                counts[used] -= times
            plan.append(Step(tuple(sorted(lengths, reverse=True)), times))
    return plan


def slot_table(plan: list[Step], capacity: int) -> dict[str, np.ndarray]:
    """Slots by (length, first rank): where the k-th piece of a length goes.

    ``key`` is sorted; a piece's slot is the last one at or below its own key.
    A step holding a length u times takes ranks in runs of u per sequence.
    """
    next_rank: dict[int, int] = {}
    rows, sequence = [], 0
    for step in plan:
        offsets: dict[int, list[int]] = {}
        at = 0
        for length in step.lengths:
            offsets.setdefault(length, []).append(at)
            at += length
        for length, places in offsets.items():
            first = next_rank.get(length, 0)
            rows.append((length, first, sequence, len(places), places[0]))
            next_rank[length] = first + len(places) * step.times
        sequence += step.times
    rows.sort()
    # Equal lengths stand together within a sequence, so their places are a run.
    names = ("length", "first", "sequence", "per_sequence", "offset")
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return {"n_sequences": np.int64(sequence), **dict(zip(names, columns))}


def assign_slots(ranked: DataFrame, slots: dict[str, np.ndarray]) -> DataFrame:
    """Sequence and offset of each piece from its length and rank."""
    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
              "sequence_id long, offset long")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts = slots["length"], slots["first"]
        bounds = np.searchsorted(lengths, np.arange(int(lengths.max(initial=0)) + 2))
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            slot = np.empty(len(length), np.int64)
            for value in np.unique(length):
                low, high = bounds[value], bounds[value + 1]
                rows = length == value
                slot[rows] = low + np.searchsorted(firsts[low:high], rank[rows], "right") - 1
            within = rank - firsts[slot]
            per = slots["per_sequence"][slot]
            sequence = slots["sequence"][slot] + within // per
            offset = slots["offset"][slot] + within % per * length
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32",
                       "sequence_id", "offset"])

    return ranked.mapInArrow(kernel, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY,
                   vocabulary: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    pieces = materialize(tokenize_pieces(docs, capacity, vocabulary), "pieces")
    per_task = materialize(
        pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in  # at most ``capacity`` rows
                 per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = slot_table(make_plan(histogram, capacity), capacity)
    before = (Window.partitionBy("length").orderBy("task")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_task.select("length", "task",
                              F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = (pieces.join(offsets, ["length", "task"])
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("before") + F.col("local_rank")).alias("rank")))
    return assign_slots(ranked, slots)
