"""Cohort selection and code encoding (projections, filters, encoders).

The analysed study reads an all-text case table, keeps one diagnosis, drops a
sentinel date, keeps two outcome codes and one age unit, then encodes the
comorbidity flags, age and sex as integers and derives ``label`` from the
outcome code.  Every column name and code is a parameter of ``CohortSpec``;
the defaults are the study's own configuration.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions import codes as C

# The study's cohort configuration (column names and codes).
STUDY_FLAG_COLUMNS = (
    "PUERPERA", "CARDIOPATI", "HEMATOLOGI", "SIND_DOWN", "HEPATICA", "ASMA",
    "DIABETES", "NEUROLOGIC", "PNEUMOPATI", "IMUNODEPRE", "RENAL", "OBESIDADE",
)
STUDY_DIAGNOSIS = ("CLASSI_FIN", 5)
STUDY_DATE_SENTINEL = ("VACINA_COV", "12/02/2021")
STUDY_OUTCOME = ("EVOLUCAO", ("1", "2"))
STUDY_AGE_UNIT = ("TP_IDADE", 3)
STUDY_AGE_COLUMN = "NU_IDADE_N"
STUDY_SEX = ("CS_SEXO", "M", "F")


@dataclass(frozen=True)
class CohortSpec:
    diagnosis_col: str | None = STUDY_DIAGNOSIS[0]
    diagnosis_code: int = STUDY_DIAGNOSIS[1]
    date_col: str | None = STUDY_DATE_SENTINEL[0]
    date_sentinel: str = STUDY_DATE_SENTINEL[1]
    outcome_col: str = STUDY_OUTCOME[0]
    outcome_codes: tuple[str, ...] = STUDY_OUTCOME[1]
    age_unit_col: str | None = STUDY_AGE_UNIT[0]
    age_unit_code: int = STUDY_AGE_UNIT[1]
    flag_cols: tuple[str, ...] = STUDY_FLAG_COLUMNS
    flag_yes: str = "1"
    age_col: str | None = STUDY_AGE_COLUMN
    sex_col: str | None = STUDY_SEX[0]
    sex_one: str = STUDY_SEX[1]
    sex_zero: str = STUDY_SEX[2]
    label_col: str = "label"
    label_offset: int = 1
    clean_codes: bool = False
    extra_cols: tuple[str, ...] = field(default_factory=tuple)

    @property
    def feature_cols(self) -> list[str]:
        """Feature columns in vector order (flags, age, sex)."""
        cols = list(self.flag_cols)
        if self.age_col:
            cols.append(self.age_col)
        if self.sex_col:
            cols.append(self.sex_col)
        return cols

    @property
    def selected_cols(self) -> list[str]:
        return list(self.extra_cols) + self.feature_cols + [self.outcome_col]

    def with_(self, **kw) -> "CohortSpec":
        return replace(self, **kw)


# ------------------------------------------------------------ projections

def project_columns(df: DataFrame, cols) -> DataFrame:
    """Select a dynamic column list (pruned down to the scan)."""
    return df.select(*[F.col(c) for c in cols])


def features_minus_target(columns, target: str) -> list[str]:
    """Column list without the target column, order kept."""
    return [c for c in columns if c != target]


def derive_columns(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Replace or add many columns in one projection (not a withColumn fold)."""
    return df.withColumns(exprs)


def literal_column(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def rename_all(df: DataFrame, names) -> DataFrame:
    return df.toDF(*names)


# ---------------------------------------------------------------- filters

def filter_code_eq(df: DataFrame, col: str, code: int, clean: bool = False) -> DataFrame:
    """Rows whose text code parses to ``code``.

    ``isNotNull`` is redundant for the result but is pushed to the scan,
    which the cast comparison itself is not.  Where codes are known to be
    ``clean`` (no padding, signs or leading zeros) they are compared as text,
    and the equality itself is pushed.
    """
    if clean:
        return df.where(F.col(col) == F.lit(str(code)))
    return df.where(F.col(col).isNotNull() & C.code_equals(col, code))


def filter_text_ne(df: DataFrame, col: str, text: str) -> DataFrame:
    """``col <> text``; null rows are dropped too (three-valued logic)."""
    return df.where(C.text_not_equal(col, text))


def filter_code_in(df: DataFrame, col: str, codes) -> DataFrame:
    return df.where(C.code_in(col, codes))


def filter_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull())


def filter_eq_ne(df: DataFrame, eq: dict[str, object] | None = None,
                 ne: dict[str, object] | None = None) -> DataFrame:
    """Conjunction of column equalities and inequalities with literals."""
    cond = F.lit(True)
    for c, v in (eq or {}).items():
        cond = cond & (F.col(c) == F.lit(v))
    for c, v in (ne or {}).items():
        cond = cond & (F.col(c) != F.lit(v))
    return df.where(cond)


def cohort_filter(df: DataFrame, spec: CohortSpec = CohortSpec()) -> DataFrame:
    """Chained cohort filters, then the study's column projection."""
    out = df
    if spec.diagnosis_col:
        out = filter_code_eq(out, spec.diagnosis_col, spec.diagnosis_code, spec.clean_codes)
    if spec.date_col:
        out = filter_text_ne(out, spec.date_col, spec.date_sentinel)
    out = filter_code_in(out, spec.outcome_col, spec.outcome_codes)
    if spec.age_unit_col:
        out = filter_code_eq(out, spec.age_unit_col, spec.age_unit_code, spec.clean_codes)
    return project_columns(out, spec.selected_cols)


# --------------------------------------------------------------- encoders

def encode_flags(df: DataFrame, cols, yes: str = "1") -> DataFrame:
    return df.withColumns({c: C.flag_binary(c, yes) for c in cols})


def encode_two_code(df: DataFrame, col: str, one: str = "M", zero: str = "F") -> DataFrame:
    return df.withColumn(col, C.two_code(col, one, zero))


def encode_ternary(df: DataFrame, cols, yes: str = "1", no: str = "2") -> DataFrame:
    return df.withColumns({c: C.ternary(c, yes, no) for c in cols})


def normalize_codes(df: DataFrame, col: str, mapping: dict[str, str]) -> DataFrame:
    return df.withColumn(col, C.normalize_codes(col, mapping))


def fill_unknown(df: DataFrame, value: str = "9", subset=None) -> DataFrame:
    """Fill nulls of the string columns (all, or ``subset``) with a code."""
    return df.fillna(value, subset=list(subset) if subset else None)


def cast_int(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: C.to_int(c) for c in cols})


def derive_label(df: DataFrame, outcome_col: str, label_col: str = "label",
                 offset: int = 1) -> DataFrame:
    return df.withColumn(label_col, C.label_from_code(outcome_col, offset))


def encoder_spec(spec: CohortSpec) -> dict[str, Column]:
    """Name-dispatched encoders for every feature column of the cohort."""
    exprs: dict[str, Column] = {c: C.flag_binary(c, spec.flag_yes) for c in spec.flag_cols}
    if spec.age_col:
        exprs[spec.age_col] = C.to_int(spec.age_col)
    if spec.sex_col:
        exprs[spec.sex_col] = C.two_code(spec.sex_col, spec.sex_one, spec.sex_zero)
    return exprs


def cohort_encode(df: DataFrame, spec: CohortSpec = CohortSpec()) -> DataFrame:
    """Encode a filtered cohort: one projection for all encoders, drop rows
    whose sex code is unknown, derive the integer label."""
    out = df.withColumns(encoder_spec(spec))
    if spec.sex_col:
        out = out.where(F.col(spec.sex_col).isNotNull())
    return derive_label(out, spec.outcome_col, spec.label_col, spec.label_offset)


def select_cohort(df: DataFrame, spec: CohortSpec = CohortSpec()) -> DataFrame:
    """``cohort_filter`` followed by ``cohort_encode``."""
    return cohort_encode(cohort_filter(df, spec), spec)


# ------------------------------------------------------ schema dispatch

def type_dispatch(df: DataFrame, exclude=()) -> tuple[list[str], list[str]]:
    """Split columns into (string columns, other columns) by data type."""
    strings, others = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        (strings if isinstance(f.dataType, T.StringType) else others).append(f.name)
    return strings, others
