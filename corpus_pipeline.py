"""The corpus pipeline: documents to packed training sequences.

Quality classifier, line dedup, SimHash near-dedup, mixing to target weights,
best-fit packing.  Each stage takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and reread as the next stage's ``docs``;
all but the last return the columns of ``documents``.

Every stage takes null, empty and very long texts, null or repeated ids, repeated
rows, an empty table and extra columns of any name (which it leaves behind);
what becomes of such rows is what its operator's module says.

Part of the corpus operators (``riskframe.llm``): it goes when they go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import lines, mixing, packing, quality_ranker, simhash
from riskframe.llm.common import DOCUMENT_COLUMNS, materialize, read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold; the others go."""
    model = quality_ranker.train_on(docs, read_table(spark, sf_dir, "labels"))
    return docs.where(quality_ranker.score_column(model) >= 0.5).select(*DOCUMENT_COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated three-line passages; a text left with no line goes.

    ``n_chars`` is counted anew where lines were cut.
    """
    left = lines.remove_repeated_lines(docs.select(*DOCUMENT_COLUMNS))
    cut = F.col("n_removed") > 0
    return (left.where(~cut | (F.col("n_removed") < F.col("n_lines")))
            .withColumn("n_chars", F.when(cut, F.length("text").cast("long"))
                        .otherwise(F.col("n_chars")))
            .select(*DOCUMENT_COLUMNS))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash near-duplicate group."""
    return simhash.keep_one_per_component(docs.select(*DOCUMENT_COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at the rates that bring domain tokens to their target shares.

    The classifier learns from the labelled rows of the whole documents table; the
    budget keeps clean documents at rate 1 or more, so the surplus domains shrink.
    """
    domains = mixing.domain_of_labels(read_table(spark, sf_dir, "labels"))
    return mixing.thin_to_targets(docs.select(*DOCUMENT_COLUMNS), domains,
                                  train_docs=read_table(spark, sf_dir, "documents"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, placed in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", dedup_lines),
    ("simhash near-dedup", dedup_documents),
    ("mixing to target weights", mix),
    ("best-fit packing", pack),
]

#: SQL cannot express the fitted models, the hash or the tokenizer; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
