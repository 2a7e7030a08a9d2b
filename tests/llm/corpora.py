"""Small corpora for the corpus operators: the given tables and awkward rows."""

from __future__ import annotations

import random

import duckdb
from pyspark.sql import DataFrame, SparkSession

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_rows() -> list[tuple]:
    """Nulls everywhere, empty and very long texts, ties, repeats, odd white space."""
    rng = random.Random(7)
    words = [f"w{rng.randrange(10_000)}" for _ in range(60_000)]
    passage = " ".join(words[:70])
    page = "\n".join(" ".join(words[i:i + 9]) for i in range(0, 90, 9))
    texts = [
        (1, None), (2, ""), (3, " \t\n\v\f\r "), (4, "one"), (5, "one two three"),
        (6, passage), (7, "before it all " + passage + " and after it"), (8, passage),
        (9, passage.replace(" ", " ", 1)), (10, page), (11, "intro line\n" + page),
        (12, page + "\nlast line\n\n"), (13, " ".join(words)), (14, " ".join(words[:55_000])),
        (15, "same " * 300), (15, "same " * 300), (16, "same " * 299 + "other"),
        (17, "été 你好 \U0001f600 naïve café " * 20),
        (18, "a b c a b c a b c d e f"), (18, "another text under the same id " * 12),
        (None, passage), (None, None), (None, "one two three"),
        (19, "password = hunter2hunter2 token:abc secret: token: abcdefgh"),
        (20, 'API_KEY="' + "Zz9" * 6 + '" AKIA' + "Q7" * 10 + " " + "0123456789abcdef" * 3),
        (21, "\U0001f600 passwd:'" + "x" * 9 + "' AKIA12 deadbeef " + "f" * 32),
        (22, "THE!! QUICK!! " * 40), (23, "re%%% ad$$$ " * 60),
        (24, page.replace("\n", "\n\n")), (25, "x" * 5000), (26, "A\nB\nC\nA\nB\nC\nA\nB\nC"),
        (27, "<|endoftext|> plain <|endoftext|>"), (28, "tab\tone\r\nline two\x0bthree"),
    ]
    return [(i, t, None if n % 5 == 0 else "en", None if n % 7 == 0 else f"src{n % 3}",
             None if t is None else len(t)) for n, (i, t) in enumerate(texts)]


def given_rows(table: str = "documents", columns: str = "*") -> list[tuple]:
    return duckdb.sql(f"SELECT {columns} FROM '{SMALL}/{table}.parquet'").fetchall()


def awkward(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def both(spark: SparkSession) -> tuple[list[tuple], DataFrame]:
    """The given documents (ids moved up) beside the awkward rows."""
    rows = awkward_rows() + [(r[0] + 1000, *r[1:]) for r in
                             given_rows(columns="doc_id, text, lang, source, n_chars")]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def clashing(docs: DataFrame) -> DataFrame:
    """The documents with extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ["n_words", "kept", "fail_bits", "print", "component_id", "n_removed", "n_lines",
             "piece", "length", "start", "spans", "found", "score", "raw", "line", "edges"]
    return docs.select("*", *[F.lit("x").alias(n) for n in names])


def components(nodes, links) -> dict:
    """Smallest reachable node of each node, by plain union-find."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
