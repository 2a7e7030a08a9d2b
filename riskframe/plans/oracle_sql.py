"""Independent SQL building blocks for the DuckDB oracle.

These re-state, in plain SQL over the given tables, what the DataFrame
operators compute.  They are only used to check results.
"""

# The derived case table (same rows as ``standin.case_table``).
CASES = """
SELECT l_orderkey AS case_order, l_linenumber AS case_line,
  CAST(CASE WHEN l_orderkey % 10 < 8 THEN 5 ELSE 4 END AS VARCHAR) AS CLASSI_FIN,
  CAST(CASE WHEN l_orderkey % 23 = 0 THEN 2 ELSE 3 END AS VARCHAR) AS TP_IDADE,
  CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE lpad(CAST(day(l_shipdate) AS VARCHAR),2,'0') || '/' || lpad(CAST(month(l_shipdate) AS VARCHAR),2,'0') || '/' || CAST(year(l_shipdate) AS VARCHAR) END AS VACINA_COV,
  CASE l_partkey % 5  WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '9' ELSE NULL END AS RENAL,
  CASE l_suppkey % 7  WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '9' ELSE NULL END AS DIABETES,
  CASE l_partkey % 11 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '9' ELSE NULL END AS ASMA,
  CASE l_suppkey % 3  WHEN 0 THEN 'S' WHEN 1 THEN 'N' ELSE NULL END AS FATOR_RISC,
  CASE WHEN l_orderkey % 97 = 0 THEN 'NA' ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS NU_IDADE_N,
  CASE WHEN l_orderkey % 50 = 0 THEN 'I' WHEN l_linestatus = 'O' THEN 'M' ELSE 'F' END AS CS_SEXO,
  CASE WHEN l_orderkey % 41 = 0 THEN '9'
       WHEN CASE WHEN l_partkey % 5 = 0 THEN 30 ELSE 0 END + CASE WHEN l_suppkey % 7 = 0 THEN 20 ELSE 0 END
            + CAST(l_quantity AS INT) + (l_orderkey * 7 + l_linenumber * 13) % 40 > 60 THEN '2' ELSE '1' END AS EVOLUCAO
FROM lineitem
"""

# Cohort rows before encoding (filters + the study projection).
FILTERED = """
SELECT RENAL, DIABETES, ASMA, NU_IDADE_N, CS_SEXO, EVOLUCAO FROM cases
WHERE TRY_CAST(CLASSI_FIN AS INTEGER) = 5
  AND VACINA_COV <> '12/02/2000'
  AND (EVOLUCAO = '1' OR EVOLUCAO = '2')
  AND TRY_CAST(TP_IDADE AS INTEGER) = 3
"""

# Encoded cohort.
COHORT = """
SELECT CASE WHEN RENAL = '1' THEN 1 ELSE 0 END AS RENAL,
       CASE WHEN DIABETES = '1' THEN 1 ELSE 0 END AS DIABETES,
       CASE WHEN ASMA = '1' THEN 1 ELSE 0 END AS ASMA,
       TRY_CAST(NU_IDADE_N AS INTEGER) AS NU_IDADE_N,
       CASE WHEN CS_SEXO = 'M' THEN 1 WHEN CS_SEXO = 'F' THEN 0 END AS CS_SEXO,
       EVOLUCAO,
       CAST(TRY_CAST(EVOLUCAO AS INTEGER) - 1 AS INTEGER) AS label
FROM filtered
WHERE CS_SEXO = 'M' OR CS_SEXO = 'F'
"""

PLANTED = """
SELECT *, max_by(label, n_side) OVER (PARTITION BY a) AS majority FROM (
  SELECT *, count(*) OVER (PARTITION BY a, label) AS n_side FROM (
    SELECT l_orderkey, l_linenumber, CAST(l_quantity > 30 AS INTEGER) AS a,
           1 - CAST(l_quantity > 30 AS INTEGER) AS b, CAST(l_discount > 0.05 AS INTEGER) AS d,
           CAST(CAST(l_quantity > 30 AS INTEGER) <> CAST(l_orderkey % 10 = 3 AS INTEGER)
                AS INTEGER) AS label,
           CAST((l_orderkey // 10) % 5 AS INTEGER) AS fold
    FROM lineitem))
"""

# Support-weighted F1 of predicting the majority side, per group of ``planted``.
PLANTED_F1 = """
f1_cells AS (SELECT {group} AS g, label, majority, count(*) AS n FROM {source}
             GROUP BY 1, 2, 3),
f1_classes AS (
  SELECT g, label, sum(n) AS support, sum(CASE WHEN label = majority THEN n ELSE 0 END) AS tp,
         (SELECT sum(n) FROM f1_cells p WHERE p.g = c.g AND p.majority = c.label) AS predicted
  FROM f1_cells c GROUP BY g, label),
f1_groups AS (
  SELECT g, sum(2.0 * tp / (support + coalesce(predicted, 0)) * support) / sum(support) AS f1
  FROM f1_classes GROUP BY g)
"""


#: The same of predicting the most frequent label everywhere, as ``c1_groups``.
CONSTANT_F1 = PLANTED_F1.format(group="fold", source="""(
  SELECT fold, label, (SELECT label FROM planted GROUP BY label ORDER BY count(*) DESC, label
                       LIMIT 1) AS majority FROM planted)""").replace("f1_", "c1_")


def with_cohort(body: str) -> str:
    """Prefix a query with the cases / filtered / cohort CTEs."""
    return (f"WITH cases AS ({CASES}), filtered AS ({FILTERED}), "
            f"cohort AS ({COHORT}) {body}")


def with_cases(body: str) -> str:
    return f"WITH cases AS ({CASES}) {body}"


def with_planted(body: str) -> str:
    return f"WITH planted AS ({PLANTED}) {body}"


def scored_union(rules: dict[str, str], source: str = "cohort") -> str:
    """Long-form scored rows ``(model, label, prediction)`` for fixed rules."""
    parts = [f"SELECT '{name}' AS model, label, {expr} AS prediction FROM {source}"
             for name, expr in rules.items()]
    return " UNION ALL ".join(parts)
