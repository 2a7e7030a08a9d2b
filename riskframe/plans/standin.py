"""Inputs derived from the given tables, for running and checking the jobs.

The analysed study ships no case data.  ``case_table`` derives a coded,
all-text case table from ``lineitem`` with the same shape as the study's raw
input (codes, nulls, malformed numbers, a sentinel date and a learnable
outcome); ``planted_table`` derives a table whose label is a known function of
its features.  Both are plain projections, so they scale with ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.cohort import CohortSpec

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _code3(key: Column, modulus: int) -> Column:
    r = key % modulus
    return (F.when(r == 0, F.lit("1")).when(r == 1, F.lit("2"))
            .when(r == 2, F.lit("9")))


def case_table(lineitem: DataFrame) -> DataFrame:
    """All-text coded case table, one row per lineitem row."""
    o, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    ln, q = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    date_text = F.date_format(F.col("l_shipdate"), "dd/MM/yyyy")
    points = (F.when(p % 5 == 0, 30).otherwise(0) + F.when(s % 7 == 0, 20).otherwise(0)
              + q + (o * 7 + ln * 13) % 40)
    return lineitem.select(
        o.alias("case_order"),
        ln.alias("case_line"),
        F.when(o % 10 < 8, F.lit(5)).otherwise(F.lit(4)).cast("string").alias("CLASSI_FIN"),
        F.when(o % 23 == 0, F.lit(2)).otherwise(F.lit(3)).cast("string").alias("TP_IDADE"),
        F.when(o % 9 == 0, F.lit(None).cast("string")).otherwise(date_text).alias("VACINA_COV"),
        _code3(p, 5).alias("RENAL"),
        _code3(s, 7).alias("DIABETES"),
        _code3(p, 11).alias("ASMA"),
        F.when(s % 3 == 0, F.lit("S")).when(s % 3 == 1, F.lit("N")).alias("FATOR_RISC"),
        F.when(o % 97 == 0, F.lit("NA")).otherwise(q.cast("string")).alias("NU_IDADE_N"),
        F.when(o % 50 == 0, F.lit("I")).when(F.col("l_linestatus") == "O", F.lit("M"))
         .otherwise(F.lit("F")).alias("CS_SEXO"),
        F.when(o % 41 == 0, F.lit("9")).when(points > 60, F.lit("2"))
         .otherwise(F.lit("1")).alias("EVOLUCAO"),
    )


CASE_COLUMNS = ("case_order", "case_line", "CLASSI_FIN", "TP_IDADE", "VACINA_COV",
                "RENAL", "DIABETES", "ASMA", "FATOR_RISC", "NU_IDADE_N", "CS_SEXO",
                "EVOLUCAO")

# The study's cohort rules applied to the derived case table.
CASE_SPEC = CohortSpec(
    date_sentinel="12/02/2000",
    flag_cols=("RENAL", "DIABETES", "ASMA"),
)


def planted_table(lineitem: DataFrame) -> DataFrame:
    """``label`` is feature ``a`` with a tenth of the orders flipped; ``b`` is the
    complement of ``a``, ``d`` is noise.

    The best prediction of every family is the majority label on each side of
    ``a``, which SQL can state; label 0 is the more frequent.  ``fold`` is a
    deterministic fold column.
    """
    a = (F.col("l_quantity") > 30).cast("int")
    flipped = (F.col("l_orderkey") % 10 == 3).cast("int")
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        a.alias("a"),
        (F.lit(1) - a).alias("b"),
        (F.col("l_discount") > 0.05).cast("int").alias("d"),
        (F.col("l_suppkey") % 40).cast("string").alias("code"),
        F.abs(a - flipped).alias("label"),
        F.pmod(F.floor(F.col("l_orderkey") / 10), F.lit(5)).cast("int").alias("fold"),
    )


PLANTED_FEATURES = ("a", "b", "d")

# Fixed scoring rules used as "models" whose predictions SQL can reproduce.
# Each is a SQL expression over the encoded case cohort giving 0.0 / 1.0.
SCORE_RULES = {
    "age_over_35": "CAST(COALESCE(NU_IDADE_N > 35, FALSE) AS DOUBLE)",
    "renal_or_diabetes": "CAST(RENAL + DIABETES >= 1 AS DOUBLE)",
    "points_over_45": "CAST(30 * RENAL + 20 * DIABETES + COALESCE(NU_IDADE_N, 0) > 45 AS DOUBLE)",
}
