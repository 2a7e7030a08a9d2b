"""Line dedup by overlapping three-line windows.

Lines are the parts of a text between ``\\n``; only lines that hold a word are
counted.  Every three consecutive such lines form a window; windows are hashed
and matched over all documents.  The first occurrence of a window (smallest
doc_id, then position) stays, every later one is removed: the lines its
position covers go, overlapping windows merging into one stretch.  Decisions
are taken on the input, not on what is left.

Defined results: documents with fewer than three lines have no window and stay
as they are; null text stays null; null ids come after all others in the
order; rows that share an id and hold a window at the same line are told apart by
a digest of their text, the smallest first; a repeated row (same id and text) is
its own first occurrence, so equal rows stay equal; texts and lines may be of any
length; an empty table gives no rows; extra columns pass through, but one named
like a column added here (key_id, key_hash, starts, n_lines, n_removed) goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskframe.llm.common import ROW_KEY, materialize, text_bytes

WINDOW_LINES = 3


def row_key(docs: DataFrame) -> list[Column]:
    """``key_id`` and ``key_hash`` of a row up to copies, ordered alike in every engine:
    the hash is the first 60 bits of the md5 of the text, "-" before it if the id is null."""
    text = F.concat(F.when(docs["doc_id"].isNull(), "-").otherwise(""),
                    F.coalesce(docs["text"].cast("string"), F.lit("")))
    digits = F.substring(F.md5(text.cast("binary")), 1, 15)
    return [F.coalesce(docs["doc_id"].cast("long"), F.lit(0)).alias("key_id"),
            F.conv(digits, 16, 10).cast("long").alias("key_hash")]


def filled_lines(lines: list[bytes]) -> list[int]:
    """Positions of the lines that hold a word."""
    return [i for i, line in enumerate(lines) if line.split(None, 1)]


def line_windows(docs: DataFrame, width: int = WINDOW_LINES) -> DataFrame:
    """One row per window: its 128-bit hash, the row's key and its first line's number."""
    schema = "hash_a long, hash_b long, no_id boolean, key_id long, key_hash long, line int"

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, owners, numbers = [], [], []
            for row, raw in enumerate(batch.column(3).to_pylist()):
                lines = raw.split(b"\n")
                filled = [lines[i] for i in filled_lines(lines)]
                n = len(filled) - width + 1
                digests += [xxhash.xxh3_128_digest(b"\n".join(filled[i:i + width]))
                            for i in range(n)]
                owners += [row] * n
                numbers += range(n)
            both = pa.py_buffer(b"".join(digests))
            halves = pa.Array.from_buffers(pa.int64(), 2 * len(digests), [None, both])
            even = pa.array(range(0, 2 * len(digests), 2), pa.int64())
            odd = pa.array(range(1, 2 * len(digests), 2), pa.int64())
            take = pa.array(owners, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [halves.take(even), halves.take(odd), batch.column(2).is_null().take(take),
                 batch.column(0).take(take), batch.column(1).take(take),
                 pa.array(numbers, pa.int32())],
                names=["hash_a", "hash_b", "no_id", "key_id", "key_hash", "line"])

    keyed = docs.select(*row_key(docs), docs["doc_id"].cast("long").alias("doc_id"),
                        text_bytes().alias("raw"))
    return keyed.mapInArrow(kernel, schema)


def later_occurrences(windows: DataFrame) -> DataFrame:
    """key_id, key_hash, ``starts``: the windows of each row that occurred before."""
    place = F.struct("no_id", "key_id", "line", "key_hash")
    hashes = ["hash_a", "hash_b"]
    repeated = materialize(  # written first, so that the join can split a frequent window
        windows.groupBy(*hashes).agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first <> last").drop("last"), "repeated-windows")
    return (windows.join(repeated, hashes).where(place != F.col("first"))
            .groupBy(*ROW_KEY).agg(F.collect_set("line").alias("starts")))


def remove_repeated_lines(docs: DataFrame, width: int = WINDOW_LINES,
                          text_column: str = "text") -> DataFrame:
    """``docs`` with later repeats cut from ``text``, plus n_lines and n_removed (long)."""
    docs = docs.drop(*ROW_KEY, "starts", "n_lines", "n_removed")
    starts = later_occurrences(materialize(line_windows(docs, width), "line-windows"))
    joined = (docs.select("*", *row_key(docs)).join(starts, ROW_KEY, "left")
              .drop(*ROW_KEY))
    names = joined.columns
    at, told = names.index(text_column), names.index("starts")
    fields = [f for f in joined.schema.fields if f.name != "starts"]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, counts, removed = [], [], []
            for text, windows in zip(batch.column(at).to_pylist(),
                                     batch.column(told).to_pylist()):
                lines = (text or "").encode().split(b"\n")
                filled = filled_lines(lines)
                gone = {filled[i] for start in windows or () for i in range(start, start + width)}
                counts.append(len(filled))
                removed.append(len(gone))
                kept.append(text if not gone else b"\n".join(
                    line for i, line in enumerate(lines) if i not in gone).decode())
            columns = [c for i, c in enumerate(batch.columns) if i != told]
            columns[at if at < told else at - 1] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
                names=[f.name for f in fields] + ["n_lines", "n_removed"])

    added = [StructField("n_lines", LongType()), StructField("n_removed", LongType())]
    return joined.mapInArrow(kernel, StructType([*fields, *added]))
