"""Per-document text measurements, computed once per text and shared by rules and models."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import text_bytes

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
UPPER = bytes(range(65, 91))

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_upper", "n_bangs", "longest_word", "n_distinct_words"]


def count_repeat_words(words: list) -> int:
    """Words covered by 3-word windows that occur twice or more, first one included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, upto = 0, 0  # words before ``upto`` are already counted
    for start, window in enumerate(windows):
        if counts[window] > 1:
            covered += start + 3 - max(start, upto)
            upto = start + 3
    return covered


def measure(raw: bytes) -> tuple[int, ...]:
    """The values named by MEASURES for one UTF-8 text."""
    text = raw.decode("utf-8", "replace")
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.split(None, 1)]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in BLANKS),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        count_repeat_words(words),
        len(lines),
        len(raw) - len(raw.translate(None, UPPER)),
        text.count("!"),
        max(map(len, words), default=0),
        len(set(words)),
    )


def measure_documents(docs: DataFrame, id_column: str = "doc_id",
                      text_column: str = "text") -> DataFrame:
    """doc_id and one long column per measure; null text counts as empty."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(raw) for raw in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) if rows else [[]] * len(MEASURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64())] + [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", *MEASURES])

    return (docs.select(F.col(id_column).cast("long").alias("doc_id"),
                        text_bytes(text_column).alias("raw"))
            .mapInArrow(kernel, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)))
