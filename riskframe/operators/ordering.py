"""Sorts, ranks, top-k and leaderboards.

``global_rank`` numbers rows in a total order without a single-partition
window: a range-partitioned sort, one written copy that fixes the result, one
count per partition, and a broadcast of those per-partition offsets (bounded
by the number of partitions, not by the data).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import stored


def _as_order(c, ascending: bool) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(c, str):
        return col.asc_nulls_first() if ascending else col.desc_nulls_last()
    return col


def global_rank(df: DataFrame, order, rank_col: str = "rank") -> DataFrame:
    """Add a 1-based position in the total order ``order`` (row_number semantics).

    ``order`` is a list of Columns (with asc/desc) or names.  A unique row id
    is appended as the last sort key so that massive ties in the order columns
    still split across range partitions.  Ties in ``order`` get distinct,
    arbitrary positions, as ``row_number`` gives them.

    One sorted copy is written to the shared scratch folder with each row's
    place in its partition; counts per partition give the offsets.
    """
    keys = [_as_order(c, True) for c in order]
    tagged = stored(df.withColumn("_uid", F.monotonically_increasing_id())
                    .orderBy(*keys, F.col("_uid"))
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_mid", F.monotonically_increasing_id())
                    .drop("_uid"), "ranked")
    per_part = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"),
                                          F.min("_mid").alias("_first"))
    # One row per partition: the window below never sees more rows than that.
    offsets = per_part.withColumn(
        "_offset",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid")
                                    .rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
    ranked = tagged.join(F.broadcast(offsets.select("_pid", "_first", "_offset")), "_pid")
    return ranked.select(*df.columns, (F.col("_offset") + F.col("_mid") - F.col("_first") + 1)
                         .cast("bigint").alias(rank_col))


def rank_small(df: DataFrame, order, rank_col: str = "rank") -> DataFrame:
    """Row number in a total order for a table small by construction (one
    row per model or per feature): a single-partition window is fine there.
    Use ``global_rank`` for anything whose size follows the data."""
    keys = [_as_order(c, True) for c in order]
    return df.withColumn(rank_col, F.row_number().over(Window.orderBy(*keys)).cast("bigint"))


def top_k(df: DataFrame, order, k: int) -> DataFrame:
    """First ``k`` rows of a total order (TakeOrdered: per-partition top-k,
    then a merge of at most k rows per partition)."""
    return df.orderBy(*[_as_order(c, True) for c in order]).limit(k)


def leaderboard(metrics: DataFrame, metric_col: str = "f1", model_col: str = "model",
                rank_col: str = "rank") -> DataFrame:
    """Models by a metric, best first (nulls last, ties by model name).
    One row per model, so the small-table rank applies."""
    return rank_small(metrics, [F.col(metric_col).desc_nulls_last(),
                                F.col(model_col).asc()], rank_col)
