"""Shared helpers of the corpus operators: table reads, written intermediates, words.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``; ``bytes.split()``
cuts at exactly that set, so kernels work on UTF-8 bytes and never decode twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import scratch_path

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Spark's setting that deletes a job's shuffle files when the job has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts lineage with files that survive lost executors; also fixes rows whose
    computation is expensive (tokenising, hashing) so later steps reread them.
    The written copy replaces the job's shuffle files, which go when it ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a materialized frame that nothing reads any more.

    Frames computed from it must have been materialized themselves, so that a lost
    executor never has to go back to it.
    """
    sc = df.sparkSession.sparkContext
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def text_bytes(column: str = "text") -> Column:
    """The UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


ROW_KEY = ["key_id", "key_hash"]


def row_key(docs: DataFrame) -> list[Column]:
    """Never-null columns ``key_id`` and ``key_hash`` identifying a row up to copies.

    Ids may be null or repeated; rows with the same id and text get the same
    decision, so joining decisions back on this key is safe.
    """
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("key_id"),
            F.xxhash64(F.col("text").cast("string"), F.col("doc_id").isNull()).alias("key_hash")]


def keyed(docs: DataFrame) -> DataFrame:
    """key_id, key_hash, doc_id, raw: what the kernels read, one row per input row."""
    return docs.select(*row_key(docs), F.col("doc_id").cast("long").alias("doc_id"),
                       text_bytes().alias("raw"))
