"""Registered jobs: one per operator of the inventory, over the given tables.

Each job is ``f(spark, sf_dir) -> DataFrame`` and reads whole tables; each
SQL oracle (where one exists) recomputes the same result independently in
DuckDB.  Doubles are rounded in both so the two engines hash alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators import cohort as coh
from riskframe.operators import metrics as met
from riskframe.plans import oracle_sql as O
from riskframe.plans import standin as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round every double column (engines differ in the last bits)."""
    return df.withColumns({f.name: F.round(f.name, digits) for f in df.schema.fields
                           if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.read_table(spark, sf_dir, "lineitem")


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.case_table(lineitem(spark, sf_dir))


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coh.select_cohort(cases(spark, sf_dir), S.CASE_SPEC)


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.planted_table(lineitem(spark, sf_dir))


COHORT_COLS = "RENAL, DIABETES, ASMA, NU_IDADE_N, CS_SEXO, EVOLUCAO, label"
KEY = "case_order, case_line"


# =========================================================== 2.1 sources

@register("scan_parquet", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_shipdate FROM lineitem""")
def q_scan_parquet(spark, sf_dir):
    from riskframe.sources import files
    return files.scan_parquet(spark, f"{sf_dir}/lineitem.parquet",
                              ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag",
                               "l_shipdate"])


# ============================================ 2.3 projections and filters

@register("project_columns", sql=O.with_cases(
    "SELECT RENAL, DIABETES, ASMA, NU_IDADE_N, CS_SEXO, EVOLUCAO FROM cases"))
def q_project_columns(spark, sf_dir):
    return coh.project_columns(cases(spark, sf_dir), S.CASE_SPEC.selected_cols)


@register("filter_code_eq", sql=O.with_cases(
    f"SELECT {KEY}, CLASSI_FIN FROM cases WHERE TRY_CAST(CLASSI_FIN AS INTEGER) = 5"))
def q_filter_code_eq(spark, sf_dir):
    return coh.filter_code_eq(cases(spark, sf_dir), "CLASSI_FIN", 5) \
        .select("case_order", "case_line", "CLASSI_FIN")


@register("filter_text_ne", sql=O.with_cases(
    f"SELECT {KEY}, VACINA_COV FROM cases WHERE VACINA_COV <> '12/02/2000'"))
def q_filter_text_ne(spark, sf_dir):
    return coh.filter_text_ne(cases(spark, sf_dir), "VACINA_COV", "12/02/2000") \
        .select("case_order", "case_line", "VACINA_COV")


@register("filter_code_in", sql=O.with_cases(
    f"SELECT {KEY}, EVOLUCAO FROM cases WHERE EVOLUCAO = '1' OR EVOLUCAO = '2'"))
def q_filter_code_in(spark, sf_dir):
    return coh.filter_code_in(cases(spark, sf_dir), "EVOLUCAO", ("1", "2")) \
        .select("case_order", "case_line", "EVOLUCAO")


@register("filter_not_null", sql=O.with_cases(
    f"SELECT {KEY}, RENAL FROM cases WHERE RENAL IS NOT NULL"))
def q_filter_not_null(spark, sf_dir):
    return coh.filter_not_null(cases(spark, sf_dir), "RENAL") \
        .select("case_order", "case_line", "RENAL")


@register("filter_eq_ne", sql=O.with_cases(
    f"SELECT {KEY}, CS_SEXO, RENAL FROM cases WHERE CS_SEXO = 'M' AND RENAL <> '9'"))
def q_filter_eq_ne(spark, sf_dir):
    return coh.filter_eq_ne(cases(spark, sf_dir), eq={"CS_SEXO": "M"}, ne={"RENAL": "9"}) \
        .select("case_order", "case_line", "CS_SEXO", "RENAL")


@register("cohort_filter", sql=O.with_cohort("SELECT * FROM filtered"))
def q_cohort_filter(spark, sf_dir):
    return coh.cohort_filter(cases(spark, sf_dir), S.CASE_SPEC)


@register("derive_column", sql=O.with_cases(f"""
SELECT {KEY}, TRY_CAST(NU_IDADE_N AS INTEGER) AS NU_IDADE_N,
       CASE WHEN CS_SEXO = 'M' THEN 1 ELSE 0 END AS is_male FROM cases"""))
def q_derive_column(spark, sf_dir):
    from riskframe.functions import codes as C
    df = cases(spark, sf_dir).select("case_order", "case_line", "NU_IDADE_N", "CS_SEXO")
    return coh.derive_columns(df, {"NU_IDADE_N": C.to_int("NU_IDADE_N"),
                                   "is_male": C.flag_binary("CS_SEXO", "M")}).drop("CS_SEXO")


@register("literal_column", sql=O.with_cohort(
    f"SELECT {COHORT_COLS}, 'logistic' AS model FROM cohort"))
def q_literal_column(spark, sf_dir):
    return coh.literal_column(cohort(spark, sf_dir), "model", "logistic")


@register("rename_all", sql=O.with_cohort("""
SELECT RENAL AS renal, DIABETES AS diabetes, ASMA AS asthma, NU_IDADE_N AS age,
       CS_SEXO AS sex, EVOLUCAO AS outcome, label AS target FROM cohort"""))
def q_rename_all(spark, sf_dir):
    return coh.rename_all(cohort(spark, sf_dir),
                          ["renal", "diabetes", "asthma", "age", "sex", "outcome", "target"])


# ================================================ 2.4 scalar encoders

@register("cast_int", sql=O.with_cases(
    f"SELECT {KEY}, TRY_CAST(NU_IDADE_N AS INTEGER) AS NU_IDADE_N FROM cases"))
def q_cast_int(spark, sf_dir):
    return coh.cast_int(cases(spark, sf_dir).select("case_order", "case_line", "NU_IDADE_N"),
                        ["NU_IDADE_N"])


@register("encode_flags", sql=O.with_cases(f"""
SELECT {KEY}, CASE WHEN RENAL = '1' THEN 1 ELSE 0 END AS RENAL,
       CASE WHEN DIABETES = '1' THEN 1 ELSE 0 END AS DIABETES,
       CASE WHEN ASMA = '1' THEN 1 ELSE 0 END AS ASMA FROM cases"""))
def q_encode_flags(spark, sf_dir):
    df = cases(spark, sf_dir).select("case_order", "case_line", "RENAL", "DIABETES", "ASMA")
    return coh.encode_flags(df, ["RENAL", "DIABETES", "ASMA"])


@register("encode_two_code", sql=O.with_cases(f"""
SELECT {KEY}, CASE WHEN CS_SEXO = 'M' THEN 1 WHEN CS_SEXO = 'F' THEN 0 END AS CS_SEXO
FROM cases"""))
def q_encode_two_code(spark, sf_dir):
    df = cases(spark, sf_dir).select("case_order", "case_line", "CS_SEXO")
    return coh.encode_two_code(df, "CS_SEXO", "M", "F")


@register("encode_ternary", sql=O.with_cases(f"""
SELECT {KEY},
  CASE WHEN RENAL = '1' THEN 1 WHEN RENAL = '2' THEN -1 ELSE 0 END AS RENAL,
  CASE WHEN DIABETES = '1' THEN 1 WHEN DIABETES = '2' THEN -1 ELSE 0 END AS DIABETES,
  CASE WHEN ASMA = '1' THEN 1 WHEN ASMA = '2' THEN -1 ELSE 0 END AS ASMA FROM cases"""))
def q_encode_ternary(spark, sf_dir):
    df = cases(spark, sf_dir).select("case_order", "case_line", "RENAL", "DIABETES", "ASMA")
    return coh.encode_ternary(df, ["RENAL", "DIABETES", "ASMA"])


@register("normalize_codes", sql=O.with_cases(f"""
SELECT {KEY}, CASE WHEN FATOR_RISC = 'S' THEN '1' WHEN FATOR_RISC = 'N' THEN '2'
                   ELSE FATOR_RISC END AS FATOR_RISC FROM cases"""))
def q_normalize_codes(spark, sf_dir):
    df = cases(spark, sf_dir).select("case_order", "case_line", "FATOR_RISC")
    return coh.normalize_codes(df, "FATOR_RISC", {"S": "1", "N": "2"})


@register("fill_unknown", sql=O.with_cases(f"""
SELECT {KEY}, COALESCE(RENAL, '9') AS RENAL, COALESCE(DIABETES, '9') AS DIABETES,
       COALESCE(ASMA, '9') AS ASMA, COALESCE(FATOR_RISC, '9') AS FATOR_RISC,
       COALESCE(VACINA_COV, '9') AS VACINA_COV FROM cases"""))
def q_fill_unknown(spark, sf_dir):
    df = cases(spark, sf_dir).select("case_order", "case_line", "RENAL", "DIABETES", "ASMA",
                                     "FATOR_RISC", "VACINA_COV")
    return coh.fill_unknown(df, "9")


@register("derive_label", sql=O.with_cases(f"""
SELECT {KEY}, EVOLUCAO, CAST(TRY_CAST(EVOLUCAO AS INTEGER) - 1 AS INTEGER) AS label
FROM cases"""))
def q_derive_label(spark, sf_dir):
    df = cases(spark, sf_dir).select("case_order", "case_line", "EVOLUCAO")
    return coh.derive_label(df, "EVOLUCAO", "label", 1)


@register("cohort_encode", sql=O.with_cohort(f"SELECT {COHORT_COLS} FROM cohort"))
def q_cohort_encode(spark, sf_dir):
    return cohort(spark, sf_dir)


# ====================================================== 2.5 aggregations

@register("class_balance", sql=O.with_cohort(
    "SELECT label, count(*) AS n FROM cohort GROUP BY label"))
def q_class_balance(spark, sf_dir):
    return met.class_balance(cohort(spark, sf_dir), "label")


@register("row_count", sql=O.with_cohort("SELECT count(*) AS n FROM cohort"))
def q_row_count(spark, sf_dir):
    return met.row_count(cohort(spark, sf_dir))


@register("distinct_count", sql=O.with_cohort("""
SELECT count(DISTINCT NU_IDADE_N) AS n_distinct,
       CAST(count(DISTINCT NU_IDADE_N)
            + coalesce(max(CASE WHEN NU_IDADE_N IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_distinct_with_null FROM cohort"""))
def q_distinct_count(spark, sf_dir):
    return met.distinct_count(cohort(spark, sf_dir), "NU_IDADE_N")


@register("distinct_values", sql=O.with_cases("SELECT DISTINCT EVOLUCAO FROM cases"))
def q_distinct_values(spark, sf_dir):
    return met.distinct_values(cases(spark, sf_dir), "EVOLUCAO")


@register("pivot_sum", sql="""
SELECT l_returnflag, sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS "F",
       sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS "O"
FROM lineitem GROUP BY l_returnflag""")
def q_pivot_sum(spark, sf_dir):
    return met.pivot_sum(lineitem(spark, sf_dir), "l_returnflag", "l_linestatus",
                         "l_quantity", ["F", "O"])


CORR_COLS = ("RENAL", "DIABETES", "ASMA", "NU_IDADE_N", "CS_SEXO", "label")


def _corr_sql() -> str:
    parts = []
    for a in CORR_COLS:
        for b in CORR_COLS:
            if a == b:
                expr = f"CASE WHEN stddev_samp({a}) > 0 THEN 1.0 END"
            else:
                expr = f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
                         f"ROUND(CAST({expr} AS DOUBLE), 9) AS corr FROM cohort")
    return O.with_cohort(" UNION ALL ".join(parts))


@register("correlation_matrix", sql=_corr_sql())
def q_correlation_matrix(spark, sf_dir):
    return round_doubles(met.correlation_long(cohort(spark, sf_dir), CORR_COLS))


CONFUSION = O.with_cohort(f""", scored AS ({O.scored_union(S.SCORE_RULES)}),
confusion AS (SELECT model, label, prediction, count(*) AS n FROM scored
              GROUP BY model, label, prediction)
""")


def _with_confusion(body: str) -> str:
    return CONFUSION + body


def confusion(spark, sf_dir) -> DataFrame:
    return met.confusion_by_rules(cohort(spark, sf_dir), S.SCORE_RULES, "label")


@register("confusion_matrix", sql=_with_confusion("SELECT * FROM confusion"))
def q_confusion_matrix(spark, sf_dir):
    return confusion(spark, sf_dir)


CLASS_METRICS_SQL = """
, counts AS (
  SELECT model,
    CAST(COALESCE(sum(CASE WHEN label = 0 AND prediction = 0 THEN n END), 0) AS BIGINT) AS tp,
    CAST(COALESCE(sum(CASE WHEN label <> 0 AND prediction = 0 THEN n END), 0) AS BIGINT) AS fp,
    CAST(COALESCE(sum(CASE WHEN label = 0 AND prediction <> 0 THEN n END), 0) AS BIGINT) AS fn,
    CAST(COALESCE(sum(CASE WHEN label <> 0 AND prediction <> 0 THEN n END), 0) AS BIGINT) AS tn
  FROM confusion GROUP BY model),
pr AS (
  SELECT *, CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy,
         CASE WHEN tp + fp = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall
  FROM counts),
class_metrics AS (
  SELECT model, tp, fp, fn, tn, ROUND(accuracy, 9) AS accuracy, ROUND(precision, 9) AS precision,
         ROUND(recall, 9) AS recall,
         ROUND(CASE WHEN precision + recall = 0 THEN NULL
                    ELSE 2.0 * precision * recall / (precision + recall) END, 9) AS f1
  FROM pr)
"""


@register("class_metrics", sql=_with_confusion(CLASS_METRICS_SQL + "SELECT * FROM class_metrics"))
def q_class_metrics(spark, sf_dir):
    return round_doubles(met.class_metrics(confusion(spark, sf_dir), 0.0))


WEIGHTED_SQL = """
, cls AS (
  SELECT model, label AS cls, sum(n) AS support,
         sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp
  FROM confusion GROUP BY model, label),
fpc AS (
  SELECT model, prediction AS cls, sum(n) AS fp FROM confusion
  WHERE label <> prediction GROUP BY model, prediction),
per AS (
  SELECT c.model, c.support, c.tp,
         CASE WHEN c.tp + COALESCE(f.fp, 0) = 0 THEN 0.0
              ELSE CAST(c.tp AS DOUBLE) / (c.tp + COALESCE(f.fp, 0)) END AS p,
         CAST(c.tp AS DOUBLE) / c.support AS r
  FROM cls c LEFT JOIN fpc f ON c.model = f.model AND c.cls = f.cls),
weighted AS (
  SELECT model,
    ROUND(sum(tp) / sum(support), 9) AS accuracy,
    ROUND(sum(p * support) / sum(support), 9) AS weighted_precision,
    ROUND(sum(r * support) / sum(support), 9) AS weighted_recall,
    ROUND(sum(CASE WHEN p + r = 0 THEN 0.0 ELSE 2.0 * p * r / (p + r) END * support)
          / sum(support), 9) AS weighted_f1
  FROM per GROUP BY model)
"""


@register("weighted_metrics", sql=_with_confusion(WEIGHTED_SQL + "SELECT * FROM weighted"))
def q_weighted_metrics(spark, sf_dir):
    return round_doubles(met.weighted_metrics(confusion(spark, sf_dir)))


@register("weighted_f1", sql=_with_confusion(
    WEIGHTED_SQL + "SELECT model, weighted_f1 FROM weighted"))
def q_weighted_f1(spark, sf_dir):
    return round_doubles(met.weighted_metrics(confusion(spark, sf_dir))
                         .select("model", "weighted_f1"))


# ============================================ 2.1 sources (round trips)

def cohort_keyed(spark, sf_dir) -> DataFrame:
    spec = S.CASE_SPEC.with_(extra_cols=("case_order", "case_line"))
    return coh.select_cohort(cases(spark, sf_dir), spec)


@register("scan_csv", sql=O.with_cases(
    "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in S.CASE_COLUMNS)
    + " FROM cases"))
def q_scan_csv(spark, sf_dir):
    from riskframe.session import scratch_path
    from riskframe.sources import files, sinks
    path = sinks.write_csv(cases(spark, sf_dir), scratch_path(spark, "cases-csv"), sep=";")
    return files.scan_csv(spark, path, columns=S.CASE_COLUMNS, sep=";")


@register("scan_json", sql=O.with_cohort(f"SELECT {COHORT_COLS} FROM cohort"))
def q_scan_json(spark, sf_dir):
    from riskframe.session import scratch_path
    from riskframe.sources import files, sinks
    df = cohort(spark, sf_dir)
    path = sinks.write_json(df, scratch_path(spark, "cohort-json"))
    return files.scan_json(spark, path, df.schema)


@register("scan_table", sql=O.with_cohort(f"SELECT {COHORT_COLS} FROM cohort"))
def q_scan_table(spark, sf_dir):
    from riskframe.session import scratch_path
    from riskframe.sources import files, sinks
    df = cohort(spark, sf_dir)
    name = sinks.unique_table_name("cohort")
    sinks.create_table(spark, name, df.schema, scratch_path(spark, name))
    sinks.append_table(df, name)
    return files.scan_table(spark, name)


@register("local_rows", sql=O.with_cohort(
    "SELECT label AS outcome, count(*) AS cases FROM cohort GROUP BY label"))
def q_local_rows(spark, sf_dir):
    from riskframe.sources import files
    # One row per class reaches the driver, then becomes a typed table again.
    rows = met.class_balance(cohort(spark, sf_dir), "label").collect()
    return files.local_rows(spark, [(r["label"], r["n"]) for r in rows],
                            "outcome INT, cases BIGINT")


LISTED_COLUMNS = ("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_shipdate")


@register("feature_list", sql=" UNION ALL ".join(
    f"SELECT {i}::BIGINT AS pos, '{c}' AS feature, count({c}) AS n_known, "
    f"count(DISTINCT {c}) AS n_values FROM lineitem" for i, c in enumerate(LISTED_COLUMNS)))
def q_feature_list(spark, sf_dir):
    """Feature names stored and read back in order, then used on the table's rows."""
    from riskframe.session import scratch_path
    from riskframe.sources import files, sinks
    table = lineitem(spark, sf_dir)
    path = sinks.write_json(files.column_names_frame(spark, table.select(*LISTED_COLUMNS)),
                            scratch_path(spark, "features-json"))
    names = files.feature_list(spark, path)
    spread = F.posexplode(F.array(*[F.struct(F.lit(n).alias("feature"),
                                             F.col(n).cast("string").alias("value"))
                                    for n in names])).alias("pos", "e")
    return (coh.project_columns(table, names).select(spread)
            .groupBy(F.col("pos").cast("bigint").alias("pos"), "e.feature")
            .agg(F.count("e.value").alias("n_known"),
                 F.countDistinct("e.value").alias("n_values")))


# ========================================================== 2.2 sinks

@register("sink_parquet", sql=O.with_cohort(f"SELECT {COHORT_COLS} FROM cohort"))
def q_sink_parquet(spark, sf_dir):
    from riskframe.session import scratch_path
    from riskframe.sources import files, sinks
    path = sinks.write_parquet(cohort(spark, sf_dir), scratch_path(spark, "cohort-parquet"))
    return files.scan_parquet(spark, path)


@register("sink_json", sql=_with_confusion(CLASS_METRICS_SQL + "SELECT * FROM class_metrics"))
def q_sink_json(spark, sf_dir):
    from riskframe.session import scratch_path
    from riskframe.sources import files, sinks
    cm = round_doubles(met.class_metrics(confusion(spark, sf_dir), 0.0))
    path = sinks.write_json(cm, scratch_path(spark, "metrics-json"))
    return files.scan_json(spark, path)  # inferred schema, as the study reads it


@register("table_create", sql=O.with_cohort(
    "SELECT 0::BIGINT AS n_created, count(*) AS n_appended FROM cohort"))
def q_table_create(spark, sf_dir):
    """A managed table: created empty and typed, then filled; both counts, then dropped."""
    from riskframe.sources import files, sinks
    df = cohort(spark, sf_dir)
    name = sinks.create_table(spark, sinks.unique_table_name("cohort_empty"), df.schema)
    try:
        created = files.scan_table(spark, name).count()
        appended = files.scan_table(spark, sinks.append_table(df, name)).count()
    finally:
        sinks.drop_table(spark, name)
    return files.local_rows(spark, [(created, appended)], "n_created BIGINT, n_appended BIGINT")


@register("table_append", sql=_with_confusion(CLASS_METRICS_SQL + """
SELECT model AS "model name", tp, fp, fn, tn, accuracy, precision, recall, f1
FROM class_metrics"""))
def q_table_append(spark, sf_dir):
    from riskframe.session import scratch_path
    from riskframe.sources import files, sinks
    schema = T.StructType([T.StructField("model name", T.StringType())] + [
        T.StructField(c, T.LongType()) for c in ("tp", "fp", "fn", "tn")] + [
        T.StructField(c, T.DoubleType()) for c in ("accuracy", "precision", "recall", "f1")])
    name = sinks.unique_table_name("metrics")
    sinks.create_table(spark, name, schema, scratch_path(spark, name))
    cm = round_doubles(met.class_metrics(confusion(spark, sf_dir), 0.0)) \
        .withColumnRenamed("model", "model name")
    first = sorted(S.SCORE_RULES)[0]
    # Two appends, columns deliberately in another order: matched by name.
    sinks.append_table(cm.where(F.col("model name") == first).select(*reversed(cm.columns)), name)
    sinks.append_table(cm.where(F.col("model name") != first), name)
    return files.scan_table(spark, name)


@register("table_replace", sql=_with_confusion(CLASS_METRICS_SQL + """
SELECT model, tp, fp, fn, tn, accuracy FROM class_metrics"""))
def q_table_replace(spark, sf_dir):
    """A rerun replaces its models' rows: written twice, one model a third time, held once."""
    from riskframe.session import scratch_path
    from riskframe.sources import files, sinks
    cm = round_doubles(met.class_metrics(confusion(spark, sf_dir), 0.0)).select(
        "model", "tp", "fp", "fn", "tn", "accuracy")
    path = scratch_path(spark, "metrics-by-model")
    for rows in (cm.withColumn("tp", F.lit(0).cast("bigint")), cm,
                 cm.where(F.col("model") == sorted(S.SCORE_RULES)[0])):
        sinks.replace_rows(rows, path, ["model"])
    return files.scan_parquet(spark, path).select(cm.columns)


@register("preview_topn", sql=O.with_cohort(
    f"SELECT {COHORT_COLS} FROM cohort ORDER BY "
    + ", ".join(f"{c} NULLS FIRST" for c in COHORT_COLS.split(", ")) + " LIMIT 20"))
def q_preview_topn(spark, sf_dir):
    from riskframe.operators import ordering
    df = cohort(spark, sf_dir)
    return ordering.top_k(df, df.columns, 20)


# ===================================================== 2.7 sorts, top-k

AGE_COUNTS_SQL = ", age_counts AS (SELECT NU_IDADE_N, count(*) AS n FROM cohort GROUP BY NU_IDADE_N) "


def age_counts(spark, sf_dir) -> DataFrame:
    return cohort(spark, sf_dir).groupBy("NU_IDADE_N").agg(F.count(F.lit(1)).alias("n"))


@register("sort_asc", sql=O.with_cohort(f"""
SELECT case_order, case_line, NU_IDADE_N,
       row_number() OVER (ORDER BY NU_IDADE_N NULLS FIRST, case_order, case_line) AS rank
FROM (SELECT case_order, case_line, TRY_CAST(NU_IDADE_N AS INTEGER) AS NU_IDADE_N FROM cases)
"""))
def q_sort_asc(spark, sf_dir):
    from riskframe.functions import codes as C
    from riskframe.operators import ordering
    df = cases(spark, sf_dir).select("case_order", "case_line",
                                     C.to_int("NU_IDADE_N").alias("NU_IDADE_N"))
    return ordering.global_rank(df, ["NU_IDADE_N", "case_order", "case_line"], "rank")


@register("sort_desc", sql=O.with_cohort(AGE_COUNTS_SQL + """
SELECT NU_IDADE_N, n, row_number() OVER (ORDER BY n DESC, NU_IDADE_N NULLS FIRST) AS rank
FROM age_counts"""))
def q_sort_desc(spark, sf_dir):
    from riskframe.operators import ordering
    return ordering.global_rank(age_counts(spark, sf_dir),
                                [F.col("n").desc_nulls_last(), F.col("NU_IDADE_N").asc_nulls_first()],
                                "rank")


@register("top_k", sql=O.with_cohort(AGE_COUNTS_SQL + """
SELECT NU_IDADE_N, n FROM age_counts ORDER BY n DESC, NU_IDADE_N NULLS FIRST LIMIT 10"""))
def q_top_k(spark, sf_dir):
    from riskframe.operators import ordering
    return ordering.top_k(age_counts(spark, sf_dir),
                          [F.col("n").desc_nulls_last(), F.col("NU_IDADE_N").asc_nulls_first()], 10)


@register("leaderboard", sql=_with_confusion(CLASS_METRICS_SQL + """
SELECT *, row_number() OVER (ORDER BY f1 DESC NULLS LAST, model) AS rank FROM class_metrics"""))
def q_leaderboard(spark, sf_dir):
    from riskframe.operators import ordering
    cm = round_doubles(met.class_metrics(confusion(spark, sf_dir), 0.0))
    return ordering.leaderboard(cm, "f1", "model", "rank")


# ============================================ 2.8 sampling, set operations

@register("train_test_split", sql=O.with_cohort("""
, keyed AS (SELECT case_order, case_line FROM cases
            WHERE TRY_CAST(CLASSI_FIN AS INTEGER) = 5 AND VACINA_COV <> '12/02/2000'
              AND (EVOLUCAO = '1' OR EVOLUCAO = '2') AND TRY_CAST(TP_IDADE AS INTEGER) = 3)
SELECT CASE WHEN (case_order + case_line) % 10 < 8 THEN 'train' ELSE 'test' END AS part,
       count(*) AS n
FROM keyed GROUP BY 1"""))
def q_train_test_split(spark, sf_dir):
    from riskframe.operators import sampling
    df = coh.cohort_filter(cases(spark, sf_dir),
                           S.CASE_SPEC.with_(extra_cols=("case_order", "case_line")))
    parts = sampling.key_split(df, [F.col("case_order") + F.col("case_line")], 0.8,
                               buckets=10, hashed=False, part_col="part")
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@register("kfold_assign", sql=O.with_planted(
    "SELECT CAST(l_orderkey % 5 AS INTEGER) AS fold, count(*) AS n FROM planted GROUP BY 1"))
def q_kfold_assign(spark, sf_dir):
    from riskframe.operators import sampling
    df = sampling.assign_folds(planted(spark, sf_dir).drop("fold"), ["l_orderkey"], 5,
                               hashed=False)
    return df.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


UNDERSAMPLE_KEY = "md5(CAST(case_order AS {s}) || '-' || CAST(case_line AS {s}))"


@register("undersample", sql=O.with_cohort(f"""
, keyed AS (
  SELECT case_order, case_line, CAST(TRY_CAST(EVOLUCAO AS INTEGER) - 1 AS INTEGER) AS label,
         {UNDERSAMPLE_KEY.format(s="VARCHAR")} AS h
  FROM cases WHERE TRY_CAST(CLASSI_FIN AS INTEGER) = 5 AND VACINA_COV <> '12/02/2000'
    AND (EVOLUCAO = '1' OR EVOLUCAO = '2') AND TRY_CAST(TP_IDADE AS INTEGER) = 3
    AND (CS_SEXO = 'M' OR CS_SEXO = 'F')),
placed AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h) AS place FROM keyed),
sizes AS (SELECT min(n) AS m FROM (SELECT count(*) AS n FROM keyed GROUP BY label))
SELECT case_order, case_line, label FROM placed, sizes WHERE place <= m"""))
def q_undersample(spark, sf_dir):
    from riskframe.operators import sampling
    # The first 14 hex digits of an md5, as a number spread over 63 bits: an order that
    # SQL can state too.
    digits = F.substring(F.expr(UNDERSAMPLE_KEY.format(s="STRING")), 1, 14)
    order = F.shiftleft(F.conv(digits, 16, 10).cast("long"), 7)
    out = sampling.undersample(cohort_keyed(spark, sf_dir), "label", order=order)
    return out.select("case_order", "case_line", "label")


@register("union_all", sql=O.with_cohort(
    f"SELECT {COHORT_COLS} FROM cohort WHERE label = 1 UNION ALL "
    f"SELECT {COHORT_COLS} FROM cohort WHERE label = 0"))
def q_union_all(spark, sf_dir):
    from riskframe.operators import sampling
    df = cohort(spark, sf_dir)
    return sampling.union_all(df.where("label = 1"), df.where("label = 0"))


# =================================================== 2.9 feature engineering

@register("assemble_vector", sql=O.with_cohort("""
SELECT CAST(RENAL AS DOUBLE) AS RENAL, CAST(DIABETES AS DOUBLE) AS DIABETES,
       CAST(ASMA AS DOUBLE) AS ASMA, CAST(CS_SEXO AS DOUBLE) AS CS_SEXO, label FROM cohort"""))
def q_assemble_vector(spark, sf_dir):
    from riskframe.operators import features as fe
    cols = ["RENAL", "DIABETES", "ASMA", "CS_SEXO"]
    df = fe.assemble(cohort(spark, sf_dir), cols, "features", "error")
    return fe.vector_columns(df, "features", cols, keep=["label"])


@register("assemble_keep", sql=O.with_cohort("""
SELECT CAST(RENAL AS DOUBLE) AS RENAL, COALESCE(CAST(NU_IDADE_N AS DOUBLE), 'NaN'::DOUBLE) AS NU_IDADE_N,
       CAST(CS_SEXO AS DOUBLE) AS CS_SEXO, label FROM cohort"""))
def q_assemble_keep(spark, sf_dir):
    from riskframe.operators import features as fe
    cols = ["RENAL", "NU_IDADE_N", "CS_SEXO"]
    df = fe.assemble(cohort(spark, sf_dir), cols, "features", "keep")
    return fe.vector_columns(df, "features", cols, keep=["label"])


def _index_sql(col: str) -> str:
    return f"""
, {col}_lab AS (SELECT {col} AS v, row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS i
                FROM cases WHERE {col} IS NOT NULL GROUP BY {col}),
{col}_n AS (SELECT count(*) AS k FROM {col}_lab)"""


STRING_INDEX_COLS = ("RENAL", "FATOR_RISC", "CS_SEXO")


@register("string_index", sql=O.with_cases(
    "".join(_index_sql(c) for c in STRING_INDEX_COLS) + f"""
SELECT c.case_order, c.case_line, """ + ", ".join(
        f"CAST(COALESCE((SELECT i FROM {c}_lab WHERE v = c.{c}), (SELECT k FROM {c}_n)) AS DOUBLE)"
        f" AS {c}_idx" for c in STRING_INDEX_COLS) + " FROM cases c"))
def q_string_index(spark, sf_dir):
    from riskframe.operators import features as fe
    df = cases(spark, sf_dir).select("case_order", "case_line", *STRING_INDEX_COLS)
    out = fe.string_index(df, STRING_INDEX_COLS, [f"{c}_idx" for c in STRING_INDEX_COLS], "keep")
    return out.drop(*STRING_INDEX_COLS)


@register("index_label", sql=O.with_cohort("""
, lab AS (SELECT EVOLUCAO AS v, row_number() OVER (ORDER BY count(*) DESC, EVOLUCAO) - 1 AS i
          FROM filtered GROUP BY EVOLUCAO)
SELECT f.EVOLUCAO, CAST(l.i AS DOUBLE) AS label FROM filtered f JOIN lab l ON f.EVOLUCAO = l.v"""))
def q_index_label(spark, sf_dir):
    from riskframe.operators import features as fe
    df = coh.cohort_filter(cases(spark, sf_dir), S.CASE_SPEC).select("EVOLUCAO")
    return fe.index_label(df, "EVOLUCAO", "label")


@register("type_dispatch", sql=O.with_cases(
    "".join(_index_sql(c) for c in ("CLASSI_FIN", "FATOR_RISC")) + """
SELECT c.case_order, c.case_line,
  CAST(COALESCE((SELECT i FROM CLASSI_FIN_lab WHERE v = c.CLASSI_FIN), (SELECT k FROM CLASSI_FIN_n)) AS DOUBLE) AS CLASSI_FIN_vec,
  CAST(COALESCE((SELECT i FROM FATOR_RISC_lab WHERE v = c.FATOR_RISC), (SELECT k FROM FATOR_RISC_n)) AS DOUBLE) AS FATOR_RISC_vec
FROM cases c"""))
def q_type_dispatch(spark, sf_dir):
    from riskframe.operators import features as fe
    df = cases(spark, sf_dir).select("case_order", "case_line", "CLASSI_FIN", "FATOR_RISC")
    strings, others = coh.type_dispatch(df)
    out = fe.string_index(df, strings, [f"{c}_vec" for c in strings], "keep")
    return out.select(*others, *[f"{c}_vec" for c in strings])


@register("vocabulary_index", sql=O.with_cases("""
, train AS (SELECT * FROM cases WHERE case_order % 5 < 4),
vocab AS (SELECT NU_IDADE_N AS v, row_number() OVER (ORDER BY count(*) DESC, NU_IDADE_N) - 1 AS i
          FROM train WHERE NU_IDADE_N IS NOT NULL AND case_order % 7 <> 0 GROUP BY 1)
SELECT c.case_order, c.case_line,
       CAST(COALESCE(i, (SELECT count(*) FROM vocab)) AS DOUBLE) AS idx
FROM cases c LEFT JOIN vocab ON v = c.NU_IDADE_N WHERE case_order % 5 = 4"""))
def q_vocabulary_index(spark, sf_dir):
    """Fitted on one part of the table, saved, loaded and applied to another, whose unseen
    values get the extra index."""
    from pyspark.ml import PipelineModel

    from riskframe.operators import vocabulary as V
    from riskframe.plans import models as M
    from riskframe.session import scratch_path
    from riskframe.sources import sinks
    rows = cases(spark, sf_dir).select("case_order", "case_line", "NU_IDADE_N")
    indexer = V.VocabularyIndexer(inputCols=["NU_IDADE_N"], outputCols=["idx"])
    fitted = M.pipeline(indexer).fit(rows.where("case_order % 5 < 4 and case_order % 7 <> 0"))
    loaded = sinks.load_model(sinks.save_model(fitted, scratch_path(spark, "indexer")),
                              PipelineModel)
    return loaded.transform(rows.where("case_order % 5 = 4")).drop("NU_IDADE_N")


GRID_MODELS = 188


@register("confusion_grid", sql=O.with_cohort(f"""
SELECT 'over_' || t.i AS model, label,
       CAST(30 * RENAL + 20 * DIABETES + COALESCE(NU_IDADE_N, 0) > t.i AS DOUBLE) AS prediction,
       count(*) AS n
FROM cohort, range({GRID_MODELS}) AS t(i) GROUP BY ALL"""))
def q_confusion_grid(spark, sf_dir):
    """Confusion counts of as many models as the study's grids have, in one scan."""
    points = "30 * RENAL + 20 * DIABETES + COALESCE(NU_IDADE_N, 0)"
    rules = {f"over_{i}": f"CAST({points} > {i} AS DOUBLE)" for i in range(GRID_MODELS)}
    return met.confusion_grid(cohort(spark, sf_dir), rules,
                              inputs=("RENAL", "DIABETES", "NU_IDADE_N"))


COPY_COLUMNS = ("l_returnflag", "l_linestatus", "l_quantity", "l_discount")


@register("copy_split", sql=f"""
SELECT {", ".join(COPY_COLUMNS)}, count(*) AS n, count(*) FILTER (h < 'cccccccc') AS n_train
FROM (SELECT *, substr(md5(concat_ws('|', l_returnflag, l_linestatus,
        CAST(l_quantity AS BIGINT), CAST(round(l_discount * 100) AS BIGINT),
        row_number() OVER (PARTITION BY {", ".join(COPY_COLUMNS)}) - 1)), 1, 8) AS h FROM lineitem)
GROUP BY ALL""")
def q_copy_split(spark, sf_dir):
    """Rows without a key: copies are numbered and dealt to the parts one by one."""
    from riskframe.operators import sampling
    rows = lineitem(spark, sf_dir).select(*COPY_COLUMNS)
    text = [F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity").cast("bigint"),
            F.round(F.col("l_discount") * 100).cast("bigint")]
    parts = sampling.copy_split(rows, 0.8, digest_of=text, part_col="part")
    return parts.groupBy(*COPY_COLUMNS).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("part") == "train", 1)).alias("n_train"))


FLAGSHIP = "study"


# ============================================================ 2.10 models

PLANTED_CONFUSION_SQL = O.with_planted("""
SELECT label, CAST(majority AS DOUBLE) AS prediction, count(*) AS n FROM planted GROUP BY 1, 2""")

ALL_KINDS = ("lr", "rf", "gbt", "mlp", "lsvc", "nb", "fm")

# Settings under which each family finds the majority side.  Three iterations of the SVM
# and twenty of the factorization machine are the most that the study's grids ask for.
PLANTED_SETTINGS = {
    "lr": {"maxIter": 20, "regParam": 0.01, "elasticNetParam": 1.0},
    "rf": {"numTrees": 5, "featureSubsetStrategy": "all", "maxDepth": 5, "seed": 1},
    "gbt": {"maxIter": 3, "maxDepth": 5, "seed": 1},
    "mlp": {"layers": [3, 5, 2], "maxIter": 30, "seed": 1},
    "lsvc": {"maxIter": 3, "regParam": 0.01},
    "nb": {},
    "fm": {"maxIter": 20, "stepSize": 0.1, "seed": 1},
}

# Two combinations per family for the searches.  The first of lr, rf and gbt can only
# predict one label everywhere, so their second wins; the others tie.
PLANTED_GRIDS = {
    "lr": {"regParam": [10.0, 0.01]},
    "rf": {"maxDepth": [0, 5]},
    "gbt": {"maxDepth": [0, 5]},
    "mlp": {"layers": [[3, 5, 2], [3, 6, 2]]},
    "lsvc": {"regParam": [0.01, 0.02]},
    "nb": {"smoothing": [1.0, 2.0]},
    "fm": {"regParam": [0.0, 0.0001]},
}
PLANTED_FOLDS = 5
# Fits on patterns are many short jobs: more of them at a time than cores.
SUITE_THREADS = 16

# Parts of a training frame: dealt by key, whatever the cluster.
TRAIN_PARTS, TRAIN_KEY = 8, ("l_orderkey", "l_linenumber")


def assembled(rows: DataFrame) -> DataFrame:
    from riskframe.operators import features as fe
    from riskframe.plans import models as M
    data = fe.assemble(rows, S.PLANTED_FEATURES, "features", "error")
    return M.with_class_count(data, "label", 2)


def planted_assembled(spark, sf_dir) -> DataFrame:
    return assembled(planted(spark, sf_dir))


def training(rows: DataFrame, kind: str) -> DataFrame:
    """A family's training frame: dealt by key before vectors are built, to parts that keep
    their size as the table grows.  Families that count equal rows need no parts."""
    from riskframe.operators import sampling
    from riskframe.plans import models as M
    if kind not in M.COUNTING:
        rows = sampling.deal_rows(rows, sampling.parts_for(rows, TRAIN_PARTS), TRAIN_KEY)
    return assembled(rows)


def planted_training(spark, sf_dir, kind: str = "rf") -> DataFrame:
    return training(planted(spark, sf_dir), kind)


def planted_settings(kind: str) -> dict:
    return dict(PLANTED_SETTINGS[kind])


def fit_planted(spark, sf_dir, kind: str):
    from riskframe.plans import models as M
    return M.fit(kind, planted_training(spark, sf_dir, kind), **planted_settings(kind))


def planted_confusion(model, spark, sf_dir) -> DataFrame:
    scored_rows = model.transform(planted_assembled(spark, sf_dir))
    return met.confusion_counts(scored_rows, model_col=None)


def _fit_query(kind: str):
    def q(spark, sf_dir):
        return planted_confusion(fit_planted(spark, sf_dir, kind), spark, sf_dir)
    q.__name__ = f"q_fit_{kind}"
    return q


for _kind in ALL_KINDS:
    register(f"fit_{_kind}", sql=PLANTED_CONFUSION_SQL)(_fit_query(_kind))


def side_model(spark, sf_dir):
    """Unregularised logistic regression on the one binary feature ``a``."""
    from riskframe.operators import features as fe
    from riskframe.plans import models as M
    data = M.with_class_count(fe.assemble(planted(spark, sf_dir), ["a"]), "label", 2)
    return M.fit("lr", data, regParam=0.0, maxIter=50, tol=1e-10), data


@register("lr_probabilities", sql=O.with_planted("""
SELECT a, count(*) AS n, ROUND(avg(label), 4) AS mean_probability FROM planted GROUP BY a"""))
def q_lr_probabilities(spark, sf_dir):
    """The fitted mean probability on each side is that side's rate of label 1."""
    from riskframe.plans import models as M
    model, data = side_model(spark, sf_dir)
    return M.score(model, data, keep=("a",)).groupBy("a").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(F.col("probability")[1]), 4).alias("mean_probability"))


@register("pipeline_fit", sql=O.with_planted("""
, lab AS (SELECT label, CAST(row_number() OVER (ORDER BY count(*) DESC,
               CASE WHEN label = 1 THEN 'yes' ELSE 'no' END) - 1 AS DOUBLE) AS i
          FROM planted GROUP BY label)
SELECT l.i AS label, m.i AS prediction, count(*) AS n
FROM planted p JOIN lab l ON p.label = l.label JOIN lab m ON p.majority = m.label GROUP BY 1, 2"""))
def q_pipeline_fit(spark, sf_dir):
    """Indexer, assembler and forest on text columns, one of 40 values (over 32 bins)."""
    from riskframe.plans import models as M
    df = planted(spark, sf_dir).select(
        F.when(F.col("a") == 1, F.lit("high")).otherwise(F.lit("low")).alias("a_txt"),
        "code", "d",
        F.when(F.col("label") == 1, F.lit("yes")).otherwise(F.lit("no")).alias("outcome"))
    settings = planted_settings("rf") | {"maxBins": 64}
    model = M.coded_pipeline(df, "outcome", M.make_estimator("rf", **settings)).fit(df)
    return met.confusion_counts(model.transform(df), model_col=None)


def planted_searches(kinds=ALL_KINDS) -> list:
    from riskframe.plans import search as R
    return [R.Search(k, {n: v for n, v in PLANTED_SETTINGS[k].items()
                         if n not in PLANTED_GRIDS[k]}, PLANTED_GRIDS[k]) for k in kinds]


def ledger_path(spark, sf_dir: str, name: str) -> str:
    """A new ledger, or one under ``riskframe.ledger.dir`` where the session names a folder:
    searches of the same rows and settings then go on from each other."""
    import hashlib

    from riskframe.session import scratch_path
    root = spark.conf.get("riskframe.ledger.dir", None)
    if not root:
        return scratch_path(spark, "ledger")
    told = f"{sf_dir} {name} {PLANTED_SETTINGS} {PLANTED_GRIDS} {PLANTED_FOLDS}"
    return f"{root.rstrip('/')}/{name}-{hashlib.md5(told.encode()).hexdigest()[:12]}"


def _suite(spark, sf_dir, train_only: bool = False):
    """Search the seven families with five folds on patterns."""
    from riskframe.plans import search as R
    rows = planted(spark, sf_dir)
    if train_only:
        rows = planted_split(rows)[0]
    data = R.SearchData.of(rows, S.PLANTED_FEATURES)
    try:
        return R.search_families(spark, data, planted_searches(), PLANTED_FOLDS,
                                 ledger_path(spark, sf_dir, "train" if train_only else "all"),
                                 SUITE_THREADS)
    finally:
        data.patterns.unpersist()


def _search(spark, sf_dir, kind: str = "lr", folds: int = PLANTED_FOLDS):
    from riskframe.plans import models as M
    est = M.make_estimator(kind, counts_col=M.COUNTS,
                           **{k: v for k, v in PLANTED_SETTINGS[kind].items()
                              if k not in PLANTED_GRIDS[kind]})
    data = M.counted_training(planted_assembled(spark, sf_dir), "fold")
    try:
        cv = M.cross_validator(M.pipeline(est), M.param_grid(est, PLANTED_GRIDS[kind]), folds,
                               "fold", counts_col=M.COUNTS)
        return cv.fit(data)
    finally:
        data.unpersist()


# The first combination predicts the most frequent label, the second the majority side.
CV_SQL = O.with_planted(", " + O.PLANTED_F1.format(group="fold", source="planted")
                        + ", " + O.CONSTANT_F1 + """,
scores AS (
  SELECT 0 AS combo, 'regParam=10.0' AS params, (SELECT avg(f1) FROM c1_groups) AS f1
  UNION ALL SELECT 1, 'regParam=0.01', (SELECT avg(f1) FROM f1_groups))
SELECT combo, params, ROUND(f1, 6) AS avg_metric{best} FROM scores""")


@register("cross_validate", sql=CV_SQL.format(best=""))
def q_cross_validate(spark, sf_dir):
    from riskframe.plans import models as M
    res = M.grid_results(spark, _search(spark, sf_dir))
    return res.select("combo", "params", F.round("avg_metric", 6).alias("avg_metric"))


@register("grid_results", sql=CV_SQL.format(best=", f1 = max(f1) OVER () AS is_best"))
def q_grid_results(spark, sf_dir):
    from riskframe.plans import models as M
    return M.grid_results(spark, _search(spark, sf_dir)).withColumn(
        "avg_metric", F.round("avg_metric", 6))


# Of lr, rf and gbt the better combination by SQL's own scores; ties go to the first.
BEST_SQL = O.with_planted(", " + O.PLANTED_F1.format(group="fold", source="planted")
                          + ", " + O.CONSTANT_F1 + """,
won AS (SELECT (SELECT avg(f1) FROM f1_groups) > (SELECT avg(f1) FROM c1_groups) AS second)
SELECT model, CASE WHEN second THEN b ELSE a END AS params
FROM won, (VALUES ('lr', 'regParam=10.0', 'regParam=0.01'), ('rf', 'maxDepth=0', 'maxDepth=5'),
  ('gbt', 'maxDepth=0', 'maxDepth=5'), ('mlp', 'layers=[3,5,2]', 'layers=[3,5,2]'),
  ('lsvc', 'regParam=0.01', 'regParam=0.01'), ('nb', 'smoothing=1.0', 'smoothing=1.0'),
  ('fm', 'regParam=0.0', 'regParam=0.0')) AS t(model, a, b)""")


@register("best_params", sql=BEST_SQL)
def q_best_params(spark, sf_dir):
    """The second combination wins for three families, the first of ties for the others."""
    return spark.createDataFrame([(r.name, r.params) for r in _suite(spark, sf_dir)],
                                 "model STRING, params STRING")


# ------------------------------------------- patterns, prefixes, ledger

@register("pattern_counts", sql=O.with_planted("""
SELECT a, b, d, label, fold, CAST(count(*) AS DOUBLE) AS weight FROM planted GROUP BY ALL"""))
def q_pattern_counts(spark, sf_dir):
    from riskframe.plans import patterns as P
    return P.compress(planted(spark, sf_dir), S.PLANTED_FEATURES, "label", ["fold"])


@register("pattern_coefficients", sql=O.with_planted("""
, sides AS (SELECT a, ln(sum(label) / CAST(sum(1 - label) AS DOUBLE)) AS odds FROM planted
            GROUP BY a)
SELECT 'a' AS feature, ROUND((SELECT odds FROM sides WHERE a = 1) - odds, 5) AS coefficient
FROM sides WHERE a = 0
UNION ALL SELECT 'intercept', ROUND(odds, 5) FROM sides WHERE a = 0"""))
def q_pattern_coefficients(spark, sf_dir):
    """Unregularised logistic regression on counted patterns: log odds of the whole table."""
    from riskframe.plans import patterns as P
    counted = P.compress(planted(spark, sf_dir), ["a"])
    model = P.fit_patterns("lr", counted, ["a"], regParam=0.0, maxIter=100, tol=1e-12)
    (slope,), intercept = P.linear_terms(model)
    return spark.createDataFrame([("a", round(slope, 5)), ("intercept", round(intercept, 5))],
                                 "feature STRING, coefficient DOUBLE")


TREE_KINDS = ("rf", "gbt")


@register("search_trees", sql=O.with_planted(", " + O.PLANTED_F1.format(
    group="fold", source="planted") + """,
combos AS (
  SELECT 'rf' AS family, t.i * 5 + d.i AS combo,
         'maxDepth=' || d.v || ', numTrees=' || t.v AS params
  FROM (VALUES (0, 10), (1, 20), (2, 30)) AS t(i, v),
       (VALUES (0, 5), (1, 10), (2, 15), (3, 25), (4, 30)) AS d(i, v)
  UNION ALL
  SELECT 'gbt', t.i * 5 + d.i, 'maxDepth=' || d.v || ', maxIter=' || t.v
  FROM (VALUES (0, 10), (1, 20), (2, 30), (3, 40), (4, 50)) AS t(i, v),
       (VALUES (0, 2), (1, 6), (2, 10), (3, 15), (4, 20)) AS d(i, v))
SELECT family, combo, params, (SELECT ROUND(avg(f1), 9) FROM f1_groups) AS avg_f1,
       combo = 0 AS is_best, CASE family WHEN 'rf' THEN 75 ELSE 125 END::BIGINT AS "numTrains",
       25::BIGINT AS n_fits FROM combos"""))
def q_search_trees(spark, sf_dir):
    """The study's 40 forest and boosting combinations with five folds, from 50 fits."""
    from riskframe.plans import models as M
    from riskframe.plans import search as R
    from riskframe.session import scratch_path
    fixed = {"rf": {"featureSubsetStrategy": "all", "seed": 1}, "gbt": {"seed": 1}}
    searches = [R.Search(k, fixed[k], M.STUDY_GRIDS[k]) for k in TREE_KINDS]
    path = scratch_path(spark, "ledger")
    data = R.SearchData.of(planted(spark, sf_dir), S.PLANTED_FEATURES)
    try:
        R.run_search(spark, data, searches, M.STUDY_FOLDS, path, parallelism=8)
    finally:
        data.patterns.unpersist()
    ledger = R.read_ledger(spark, path)
    times = R.times(ledger).select(F.col("model").alias("family"), "numTrains", "n_fits")
    return round_doubles(R.averages(ledger, M.STUDY_FOLDS).join(times, "family"))


@register("search_resume", sql="""
SELECT * FROM (VALUES (1, 20::BIGINT), (2, 30::BIGINT), (3, 0::BIGINT)) AS t(session, n_fits),
  (SELECT 50::BIGINT AS n_entries, 50::BIGINT AS n_keys FROM lineitem LIMIT 1)""")
def q_search_resume(spark, sf_dir):
    """One search in three sessions: what each fits, and what the ledger then holds."""
    from riskframe.plans import models as M
    from riskframe.plans import search as R
    from riskframe.session import scratch_path
    grid = {k: M.STUDY_GRIDS["lr"][k] for k in ("regParam", "maxIter")}
    searches = [R.Search("lr", {}, grid), R.Search("nb", {}, {})]
    path = scratch_path(spark, "ledger")
    data = R.SearchData.of(planted(spark, sf_dir), S.PLANTED_FEATURES)
    try:
        made = [(i + 1, R.run_search(spark, data, searches, M.STUDY_FOLDS, path, 8, limit))
                for i, limit in enumerate((20, None, None))]
    finally:
        data.patterns.unpersist()
    held = R.read_ledger(spark, path).agg(F.count(F.lit(1)).alias("n_entries"),
                                          F.count_distinct(*R.KEY).alias("n_keys"))
    return spark.createDataFrame(made, "session INT, n_fits BIGINT").join(held)


def _values(*values) -> str:
    return ", ".join(f"('{v}')" for v in values)


HIDDEN_SQL = _values("5", "10", "20", "5,5", "10,10", "20,20", "5,5,5", "10,10,10", "20,20,20")


@register("param_grid", sql=O.with_cohort(f"""
, k AS (SELECT CAST(max(label) + 1 AS INTEGER) AS n FROM cohort)
SELECT 'lr' AS model, 'elasticNetParam=' || e || ', maxIter=' || i || ', regParam=' || r AS params
FROM (VALUES {_values("0.0", "0.25", "0.5", "0.75", "1.0")}) AS a(e),
     (VALUES {_values(1, 2, 3)}) AS b(i), (VALUES {_values("0.01", "0.02", "0.1")}) AS c(r)
UNION ALL SELECT 'rf', 'maxDepth=' || d || ', numTrees=' || t
FROM (VALUES {_values(5, 10, 15, 25, 30)}) AS a(d), (VALUES {_values(10, 20, 30)}) AS b(t)
UNION ALL SELECT 'gbt', 'maxDepth=' || d || ', maxIter=' || i
FROM (VALUES {_values(2, 6, 10, 15, 20)}) AS a(d), (VALUES {_values(10, 20, 30, 40, 50)}) AS b(i)
UNION ALL SELECT 'mlp', 'layers=[5,' || h || ',' || n || '], solver=' || s
FROM (VALUES {HIDDEN_SQL}) AS a(h), (VALUES {_values("l-bfgs", "gd")}) AS b(s), k
UNION ALL SELECT 'lsvc', 'maxIter=' || i || ', regParam=' || r
FROM (VALUES {_values(1, 2, 3)}) AS a(i), (VALUES {_values("0.01", "0.02", "0.1")}) AS b(r)
UNION ALL SELECT 'nb', ''
UNION ALL SELECT 'fm', 'maxIter=' || i || ', regParam=' || r || ', stepSize=' || t
FROM (VALUES {_values(1, 5, 10, 15, 20)}) AS a(i), (VALUES {_values("0.01", "0.02", "0.1")}) AS b(r),
     (VALUES {_values("0.001", "0.005", "0.01", "0.05", "0.1")}) AS c(t)"""))
def q_param_grid(spark, sf_dir):
    from riskframe.operators import features as fe
    from riskframe.plans import models as M
    n_features = len(S.CASE_SPEC.feature_cols)
    n_classes = fe.class_count(cohort(spark, sf_dir), "label")
    rows = [(kind, params) for kind, grid in M.STUDY_GRIDS.items()
            for _, params in M.grid_rows(M.param_grid(M.make_estimator(kind), grid, n_features,
                                                      n_classes))]
    return spark.createDataFrame(rows, "model STRING, params STRING")


def planted_split(rows: DataFrame):
    """Train/test parts of planted rows: an integer-key split (4/5 train)."""
    from riskframe.operators import sampling
    return sampling.key_split(rows, ["l_orderkey"], 0.8, buckets=5, hashed=False)


def planted_parts(spark, sf_dir):
    return planted_split(planted_assembled(spark, sf_dir))


KINDS_SQL = ", ".join(f"('{k}')" for k in ALL_KINDS)


@register("train_times", sql=f"""
SELECT model, 10::BIGINT AS "numTrains", true AS timed FROM (VALUES {KINDS_SQL}) AS t(model)
WHERE (SELECT count(*) FROM lineitem) > 0""")
def q_train_times(spark, sf_dir):
    from riskframe.plans import models as M
    times = M.times_frame(spark, _suite(spark, sf_dir))
    return times.select("model", "numTrains", (F.col("time") > 0).alias("timed"))


@register("train_suite", sql=O.with_planted(", " + O.PLANTED_F1.format(
    group="fold", source="planted") + f"""
SELECT model, 10::BIGINT AS "numTrains", (SELECT ROUND(avg(f1), 6) FROM f1_groups) AS best_cv_f1,
       (SELECT count(*) FROM planted WHERE label <> majority) AS errors
FROM (VALUES {KINDS_SQL}) AS t(model)"""))
def q_train_suite(spark, sf_dir):
    from riskframe.plans import models as M
    results = _suite(spark, sf_dir)
    confusion = suite_confusion(results, planted(spark, sf_dir))
    errors = confusion.groupBy("model").agg(F.sum(F.when(
        F.col("label") != F.col("prediction"), F.col("n")).otherwise(0)).alias("errors"))
    summary = spark.createDataFrame(
        [(r.name, r.num_trains, float(round(r.best_f1, 6))) for r in results],
        "model STRING, numTrains BIGINT, best_cv_f1 DOUBLE")
    return summary.join(errors, "model")


def suite_confusion(results, rows: DataFrame) -> DataFrame:
    """Confusion counts of a suite's refitted pipelines from one scan: a pattern is scored
    once for all its rows."""
    from riskframe.plans import patterns as P
    from riskframe.plans import search as R
    models = {r.name: r.model for r in results}
    scored = R.predictions(models, P.compress(rows, S.PLANTED_FEATURES), ("label", P.WEIGHT))
    return met.confusion_grid(scored, {n: F.col(n) for n in models}, weight_col=P.WEIGHT)


def planted_model_confusion(models: dict, data: DataFrame) -> DataFrame:
    """Confusion counts of many models from one scan: chained predictions, one joint group."""
    from riskframe.plans import models as M
    return met.confusion_by_rules(M.predictions(models, data), {n: F.col(n) for n in models})


PLANTED_METRICS_SQL = O.with_planted(", " + O.PLANTED_F1.format(
    group="1", source="(SELECT * FROM planted WHERE l_orderkey % 5 = 4)") + """,
test AS (SELECT * FROM planted WHERE l_orderkey % 5 = 4),
c AS (SELECT count(*) FILTER (WHERE label = 0 AND majority = 0) AS tp,
             count(*) FILTER (WHERE label <> 0 AND majority = 0) AS fp,
             count(*) FILTER (WHERE label = 0 AND majority <> 0) AS fn,
             count(*) FILTER (WHERE label <> 0 AND majority <> 0) AS tn FROM test),
m AS (SELECT *, CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy,
             CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / (tp + fn) AS recall,
             2.0 * tp / (2 * tp + fp + fn) AS f1, (SELECT f1 FROM f1_groups) AS weighted_f1
      FROM c)
""")


@register("model_comparison", sql=PLANTED_METRICS_SQL + f"""
SELECT model, 10::BIGINT AS "numTrains", true AS timed, tp, fp, fn, tn,
       ROUND(accuracy, 9) AS accuracy, ROUND(precision, 9) AS precision,
       ROUND(recall, 9) AS recall, ROUND(f1, 9) AS f1, ROUND(weighted_f1, 9) AS weighted_f1,
       row_number() OVER (ORDER BY model) AS rank
FROM m, (VALUES {KINDS_SQL}) AS t(model)""")
def q_model_comparison(spark, sf_dir):
    """Seven searched families; the measured times differ between runs, so the check
    sees their relations and the operator's frame keeps the numbers."""
    from riskframe.plans import models as M
    from riskframe.plans import reports as R
    results = _suite(spark, sf_dir, train_only=True)
    confusion = suite_confusion(results, planted_split(planted(spark, sf_dir))[1])
    out = R.model_comparison(confusion, M.times_frame(spark, results), positive=0.0)
    per_fit = F.round(F.col("time") / F.col("numTrains"))
    return round_doubles(out.select(
        "model", "numTrains",
        ((F.col("time") > 0) & (F.col("time_per_model") == per_fit)).alias("timed"),
        "tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "f1", "weighted_f1", "rank"))


@register("join_times", sql=PLANTED_METRICS_SQL + f"""
, times AS (
  SELECT model, CAST(sum(l_quantity) AS BIGINT) AS time, count(*) AS "numTrains"
  FROM lineitem JOIN (VALUES {", ".join(f"({i}, '{k}')" for i, k in enumerate(ALL_KINDS))})
    AS t(i, model) ON l_orderkey % {len(ALL_KINDS)} = i GROUP BY model)
SELECT model, time, "numTrains", ROUND(accuracy, 9) AS accuracy, ROUND(f1, 9) AS f1
FROM m, times""")
def q_join_times(spark, sf_dir):
    """Metrics of seven fitted families with a times table (made from the data, so
    that its numbers can be checked) attached by model."""
    from riskframe.operators import joins
    from riskframe.plans import models as M
    train, test = planted_split(planted(spark, sf_dir))
    models = {k: M.fit(k, training(train, k), **planted_settings(k)) for k in ALL_KINDS}
    names = F.array(*[F.lit(k) for k in ALL_KINDS])
    times = (lineitem(spark, sf_dir)
             .groupBy(names[F.col("l_orderkey") % len(ALL_KINDS)].alias("model"))
             .agg(F.sum("l_quantity").cast("bigint").alias("time"),
                  F.count(F.lit(1)).alias("numTrains")))
    cm = met.class_metrics(planted_model_confusion(models, assembled(test)), 0.0)
    joined = joins.attach_by_key(cm, times, ["model"], "left")
    return round_doubles(joined.select("model", "time", "numTrains", "accuracy", "f1"))


@register("score_batch", sql=O.with_planted("""
SELECT label, CAST(majority AS DOUBLE) AS prediction, count(*) AS n, count(*) AS n_consistent
FROM planted GROUP BY 1, 2"""))
def q_score_batch(spark, sf_dir):
    from riskframe.plans import models as M
    model = fit_planted(spark, sf_dir, "lr")
    out = M.score(model, planted_assembled(spark, sf_dir), keep=("label",))
    consistent = (F.col("probability")[1] > 0.5) == (F.col("prediction") == 1.0)
    return out.groupBy("label", "prediction").agg(
        F.count(F.lit(1)).alias("n"), F.sum(consistent.cast("bigint")).alias("n_consistent"))


@register("model_roundtrip", sql=O.with_planted(f"""
SELECT model, count(*) AS n, 0::BIGINT AS n_changed, count(*) FILTER (label = majority) AS n_right
FROM planted, (VALUES {KINDS_SQL}) AS t(model) GROUP BY model"""))
def q_model_roundtrip(spark, sf_dir):
    """Every family saved and loaded: rows, rows scored differently after, rows scored right."""
    from riskframe.plans import models as M
    from riskframe.session import scratch_path
    from riskframe.sources import sinks
    both = {}
    for kind in ALL_KINDS:
        model = M.pipeline(M.make_estimator(kind, **planted_settings(kind))).fit(
            planted_training(spark, sf_dir, kind))
        both[kind] = model
        both[f"{kind}_loaded"] = sinks.load_model(
            sinks.save_model(model, scratch_path(spark, f"model-{kind}")), type(model))
    scored = M.predictions(both, planted_assembled(spark, sf_dir))
    told = F.explode(F.array(*[F.struct(
        F.lit(k).alias("model"), (F.col(k) != F.col(f"{k}_loaded")).cast("long").alias("changed"),
        (F.col(f"{k}_loaded") == F.col("label")).cast("long").alias("right"))
        for k in ALL_KINDS]))
    return scored.select(told.alias("t")).groupBy("t.model").agg(
        F.count(F.lit(1)).alias("n"), F.sum("t.changed").alias("n_changed"),
        F.sum("t.right").alias("n_right"))


@register("coefficients_by_model", sql=O.with_planted("""
, sides AS (SELECT a, ln(sum(label) / CAST(sum(1 - label) AS DOUBLE)) AS odds FROM planted
            GROUP BY a)
SELECT 'logistic' AS model, 0 AS pos, 'a' AS feature,
       ROUND((SELECT odds FROM sides WHERE a = 1) - odds, 3) AS coefficient
FROM sides WHERE a = 0
UNION ALL SELECT 'logistic', 1, 'intercept', ROUND(odds, 3) FROM sides WHERE a = 0"""))
def q_coefficients_by_model(spark, sf_dir):
    """On one binary feature the coefficients are a log odds and a log odds ratio."""
    from riskframe.plans import models as M
    model, _ = side_model(spark, sf_dir)
    table = M.linear_coefficients(spark, model, ["a"], "logistic")
    return table.select("model", "pos", "feature", F.round("coefficient", 3).alias("coefficient"))


@register("svm_scores", sql=O.with_planted("""
SELECT count(*) AS n, 0::BIGINT AS n_different FROM planted"""))
def q_svm_scores(spark, sf_dir):
    """The SVM's predictions recomputed from its coefficient table."""
    from riskframe.plans import models as M
    from riskframe.plans import reports as R
    model = fit_planted(spark, sf_dir, "lsvc")
    table = M.linear_coefficients(spark, model, list(S.PLANTED_FEATURES), "lsvc")
    scored = R.linear_score(M.predictions({"svm": model}, planted_assembled(spark, sf_dir),
                                          keep=S.PLANTED_FEATURES), table, "lsvc",
                            S.PLANTED_FEATURES, keep=("svm",))
    return scored.agg(F.count(F.lit(1)).alias("n"), F.sum(
        (F.col("svm") != F.col("prediction")).cast("long")).alias("n_different"))


@register("feature_importances", sql="""
SELECT pos, feature, CASE WHEN feature = 'a' THEN 1.0 ELSE 0.0 END::DOUBLE AS importance
FROM (VALUES (0, 'a'), (1, 'd')) AS t(pos, feature) WHERE (SELECT count(*) FROM lineitem) > 0""")
def q_feature_importances(spark, sf_dir):
    """One feature decides the label, so it has all the importance."""
    from riskframe.operators import features as fe
    from riskframe.plans import models as M
    rows = planted(spark, sf_dir).withColumn("label", F.col("a"))
    data = M.with_class_count(fe.assemble(rows, ["a", "d"]), "label", 2)
    return M.feature_importances(spark, M.fit("rf", data, **planted_settings("rf")), ["a", "d"])


@register("fm_factors", sql=O.with_planted("""
SELECT count(*) AS n, 0::BIGINT AS n_different, 3 * 8 AS n_factors FROM planted"""))
def q_fm_factors(spark, sf_dir):
    """The machine's raw scores recomputed from its term table."""
    from riskframe.plans import models as M
    names = list(S.PLANTED_FEATURES)
    model = fit_planted(spark, sf_dir, "fm")
    terms = M.fm_factors(spark, model, names)
    raw = M.score(model, planted_assembled(spark, sf_dir), keep=names)
    vector = F.col("raw_prediction")[1]
    # 3 features x 8 factors: the term table as one struct beside the rows.
    folded = terms.groupBy("term").agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat_ws(":", "feature", F.col("idx").cast("string")), "value"))).alias("m"))
    maps = folded.agg(F.map_from_entries(F.collect_list(F.struct("term", "m"))))
    rows = raw.select(*names, vector.alias("raw")).withColumn("t", maps.scalar())
    at = lambda term, key: F.col("t")[term][key]
    score = at("intercept", "intercept:0")
    for n in names:
        score = score + at("linear", f"{n}:0") * F.col(n)
    for k in range(8):
        linear = sum((at("factor", f"{n}:{k}") * F.col(n) for n in names), F.lit(0.0))
        square = sum((F.pow(at("factor", f"{n}:{k}") * F.col(n), 2) for n in names), F.lit(0.0))
        score = score + 0.5 * (linear * linear - square)
    return rows.select(score.alias("score"), "raw").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.abs(F.col("score") - F.col("raw")) > 1e-9).cast("long")).alias("n_different")) \
        .withColumn("n_factors", F.lit(terms.where("term = 'factor'").count()).cast("int"))


# ------------------------------------------------- the study, end to end

@register("study", sql=PLANTED_METRICS_SQL + f"""
SELECT model, 10::BIGINT AS "numTrains", true AS timed, tp, fp, fn, tn,
       ROUND(accuracy, 9) AS accuracy, ROUND(f1, 9) AS f1, ROUND(weighted_f1, 9) AS weighted_f1,
       0::BIGINT AS n_changed, row_number() OVER (ORDER BY model) AS rank
FROM m, (VALUES {KINDS_SQL}) AS t(model)""")
def q_study(spark, sf_dir):
    from riskframe.plans import study
    out = study.run(planted_assembled(spark, sf_dir).drop("fold"), list(S.PLANTED_FEATURES),
                    split_key="l_orderkey", searches={
                        k: ({n: v for n, v in PLANTED_SETTINGS[k].items()
                             if n not in PLANTED_GRIDS[k]}, PLANTED_GRIDS[k]) for k in ALL_KINDS},
                    partitions=TRAIN_PARTS, partition_key=TRAIN_KEY)
    return round_doubles(out.leaderboard.select(
        "model", "numTrains", (F.col("time") > 0).alias("timed"), "tp", "fp", "fn", "tn",
        "accuracy", "f1", "weighted_f1", "n_changed", "rank"))


# ------------------------------------ Naive Bayes on the case cohort (exact)

NB_FEATURES = ("RENAL", "DIABETES", "ASMA", "NU_IDADE_N", "CS_SEXO")


def nb_cohort_rows(spark, sf_dir) -> DataFrame:
    from riskframe.operators import features as fe
    from riskframe.plans import models as M
    # Rows with an unknown age cannot be assembled; "skip" drops them.
    data = fe.assemble(cohort(spark, sf_dir), NB_FEATURES, "features", "skip")
    return M.with_class_count(data, "label", len(S.CASE_SPEC.outcome_codes))


def nb_cohort_model(spark, sf_dir, smoothing: float = 1.0):
    from riskframe.plans import models as M
    return M.fit("nb", nb_cohort_rows(spark, sf_dir), smoothing=smoothing,
                 modelType="multinomial")


def nb_linear(spark, sf_dir, smoothing: float = 1.0, name: str = "nb") -> DataFrame:
    from riskframe.plans import models as M
    return M.nb_linear_coefficients(spark, nb_cohort_model(spark, sf_dir, smoothing),
                                    list(NB_FEATURES), name)


def _nb_sql() -> str:
    sums = ", ".join(f"sum({c}) AS s_{c}" for c in NB_FEATURES)
    longs = " UNION ALL ".join(f"SELECT label, '{c}' AS feature, s_{c} AS s FROM sums"
                               for c in NB_FEATURES)
    return f"""
, nbrows AS (SELECT * FROM cohort WHERE NU_IDADE_N IS NOT NULL),
sums AS (SELECT label, count(*) AS nc, {sums} FROM nbrows GROUP BY label),
tot AS (SELECT sum(nc) AS n, count(*) AS k FROM sums),
longs AS ({longs}),
den AS (SELECT label, sum(s) AS total FROM longs GROUP BY label),
theta AS (
  SELECT l.label, l.feature, ln(l.s + 1.0) - ln(d.total + {float(len(NB_FEATURES))}) AS theta
  FROM longs l JOIN den d ON l.label = d.label
  UNION ALL
  SELECT label, 'pi' AS feature, ln(nc + 1.0) - ln(n + k * 1.0) AS theta FROM sums, tot),
nbcoef AS (
  SELECT t1.feature, t1.theta - t0.theta AS coefficient
  FROM theta t1 JOIN theta t0 ON t1.feature = t0.feature AND t1.label = 1 AND t0.label = 0)
"""


NB_SQL = _nb_sql()
NB_POS = ", ".join(f"('{c}', {i})" for i, c in enumerate(NB_FEATURES)) + \
    f", ('pi', {len(NB_FEATURES)})"
NB_COEFS = NB_SQL + f""",
coefs AS (
  SELECT CAST(p.pos AS INTEGER) AS pos,
         CASE WHEN c.feature = 'pi' THEN 'intercept' ELSE c.feature END AS feature,
         c.coefficient, 'nb' AS model
  FROM nbcoef c JOIN (VALUES {NB_POS}) AS p(feature, pos) ON c.feature = p.feature)
"""


@register("nb_theta", sql=O.with_cohort(NB_SQL + """
SELECT CAST(label AS INTEGER) AS label, feature, ROUND(theta, 9) AS theta FROM theta"""))
def q_nb_theta(spark, sf_dir):
    from riskframe.plans import models as M
    return round_doubles(M.nb_theta(spark, nb_cohort_model(spark, sf_dir), list(NB_FEATURES)))


@register("coefficient_table", sql=O.with_cohort(NB_COEFS + """
SELECT pos, feature, ROUND(coefficient, 9) AS coefficient, model FROM coefs"""))
def q_coefficient_table(spark, sf_dir):
    return round_doubles(nb_linear(spark, sf_dir))


@register("join_baseline", sql=O.with_cohort(NB_COEFS + """
SELECT c.pos, c.feature, ROUND(c.coefficient, 9) AS coefficient, c.model,
       ROUND(b.coefficient, 9) AS baseline
FROM coefs c JOIN coefs b ON b.model = c.model AND b.feature = 'intercept'
WHERE c.feature <> 'intercept'"""))
def q_join_baseline(spark, sf_dir):
    from riskframe.operators import joins
    return round_doubles(joins.attach_baseline(nb_linear(spark, sf_dir)))


@register("score_linear", sql=O.with_cohort(NB_COEFS + ", w AS (SELECT " + ", ".join(
    f"max(CASE WHEN feature = '{c}' THEN coefficient END) AS w_{c}" for c in NB_FEATURES)
    + ", max(CASE WHEN feature = 'intercept' THEN coefficient END) AS w0 FROM coefs)"
    + """
SELECT r.label, CASE WHEN w.w0 + """ + " + ".join(f"w.w_{c} * r.{c}" for c in NB_FEATURES)
    + """ > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, count(*) AS n
FROM nbrows r, w GROUP BY 1, 2"""))
def q_score_linear(spark, sf_dir):
    from riskframe.plans import reports as R
    # Rows with an unknown age are dropped, as the model's assembler did.
    scored_rows = R.linear_score(cohort(spark, sf_dir), nb_linear(spark, sf_dir), "nb",
                                 NB_FEATURES, handle_invalid="skip")
    return met.confusion_counts(scored_rows, model_col=None)


RISK_SQL = NB_COEFS + """,
base AS (SELECT model, coefficient AS baseline FROM coefs WHERE feature = 'intercept'),
risk AS (
  SELECT c.feature, c.coefficient AS nb,
         100.0 / (1.0 + exp(-b.baseline)) AS baseline_pct,
         ROUND(exp(c.coefficient) * 100.0, 2) AS odds_ratio_pct,
         ROUND(ROUND(exp(c.coefficient) * 100.0, 2) * (100.0 / (1.0 + exp(-b.baseline))) / 100.0, 2)
           AS total_risk_pct,
         100.0 / (1.0 + exp(-(b.baseline + c.coefficient))) AS adjusted_pct,
         row_number() OVER (ORDER BY c.coefficient DESC, c.feature) AS rank
  FROM coefs c JOIN base b ON b.model = c.model WHERE c.feature <> 'intercept')
"""


@register("risk_report", sql=O.with_cohort(RISK_SQL + f"""
, smooth AS (
  SELECT l1.feature, (ln(l1.s + 2.0) - ln(d1.total + {2.0 * len(NB_FEATURES)}))
                     - (ln(l0.s + 2.0) - ln(d0.total + {2.0 * len(NB_FEATURES)})) AS nb_smooth
  FROM longs l1 JOIN longs l0 ON l1.feature = l0.feature AND l1.label = 1 AND l0.label = 0
  JOIN den d1 ON d1.label = 1 JOIN den d0 ON d0.label = 0)
SELECT feature, ROUND(nb, 9) AS nb, ROUND(nb_smooth, 9) AS nb_smooth,
       ROUND(baseline_pct, 9) AS baseline_pct, odds_ratio_pct,
       total_risk_pct, ROUND(adjusted_pct, 9) AS adjusted_pct, rank
FROM risk JOIN smooth USING (feature)"""))
def q_risk_report(spark, sf_dir):
    """Two models side by side, the first one's risk."""
    from riskframe.operators import sampling
    from riskframe.plans import reports as R
    coefs = sampling.union_all(nb_linear(spark, sf_dir),
                               nb_linear(spark, sf_dir, 2.0, "nb_smooth"))
    return round_doubles(R.risk_report(coefs, "nb", ["nb", "nb_smooth"]))


@register("sigmoid_percent", sql=O.with_cohort(RISK_SQL + """
SELECT DISTINCT ROUND(baseline_pct, 9) AS baseline_pct FROM risk"""))
def q_sigmoid_percent(spark, sf_dir):
    from riskframe.plans import reports as R
    return round_doubles(R.risk_report(nb_linear(spark, sf_dir), "nb", ["nb"])
                         .select("baseline_pct").distinct())


@register("odds_ratio_percent", sql=O.with_cohort(RISK_SQL + """
SELECT feature, odds_ratio_pct FROM risk"""))
def q_odds_ratio_percent(spark, sf_dir):
    from riskframe.plans import reports as R
    return R.risk_report(nb_linear(spark, sf_dir), "nb", ["nb"]).select("feature", "odds_ratio_pct")


@register("total_risk", sql=O.with_cohort(RISK_SQL + """
SELECT feature, total_risk_pct FROM risk"""))
def q_total_risk(spark, sf_dir):
    from riskframe.plans import reports as R
    return R.risk_report(nb_linear(spark, sf_dir), "nb", ["nb"]).select("feature", "total_risk_pct")


@register("time_per_model", sql="""
SELECT l_returnflag, CAST(sum(l_quantity) AS BIGINT) AS time, count(*) AS numTrains,
       CAST(ROUND(sum(l_quantity) / count(*)) AS BIGINT) AS time_per_model
FROM lineitem GROUP BY l_returnflag""")
def q_time_per_model(spark, sf_dir):
    from riskframe.functions import codes as C
    agg = lineitem(spark, sf_dir).groupBy("l_returnflag").agg(
        F.sum("l_quantity").cast("bigint").alias("time"), F.count(F.lit(1)).alias("numTrains"))
    return agg.withColumn("time_per_model", C.ratio_rounded("time", "numTrains"))
