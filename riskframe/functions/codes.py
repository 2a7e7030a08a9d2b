"""Column-expression builders for coded text columns and risk arithmetic.

All builders return ``pyspark.sql.Column`` objects made of built-in
functions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- parsing

def to_int(c: ColumnOrName) -> Column:
    """String to int; malformed text becomes null (ANSI-safe ``try_cast``)."""
    return _col(c).try_cast("int")


def code_equals(c: ColumnOrName, code: int) -> Column:
    """Numeric equality on a text code (``'5'``, ``' 5 '`` match 5)."""
    return to_int(c) == F.lit(code)


def text_not_equal(c: ColumnOrName, text: str) -> Column:
    """Three-valued ``<>``: null rows do not pass a filter on it."""
    return _col(c) != F.lit(text)


def code_in(c: ColumnOrName, codes) -> Column:
    return _col(c).isin(list(codes))


# --------------------------------------------------------------- encoders

def flag_binary(c: ColumnOrName, yes: str = "1") -> Column:
    """``yes`` -> 1; every other value, null included -> 0."""
    return F.when(_col(c) == F.lit(yes), F.lit(1)).otherwise(F.lit(0))


def two_code(c: ColumnOrName, one: str = "M", zero: str = "F") -> Column:
    """``one`` -> 1, ``zero`` -> 0, anything else (and null) -> null."""
    return (
        F.when(_col(c) == F.lit(one), F.lit(1))
        .when(_col(c) == F.lit(zero), F.lit(0))
        .otherwise(F.lit(None).cast("int"))
    )


def ternary(c: ColumnOrName, yes: str = "1", no: str = "2") -> Column:
    """``yes`` -> 1, ``no`` -> -1, anything else (and null) -> 0."""
    return (
        F.when(_col(c) == F.lit(yes), F.lit(1))
        .when(_col(c) == F.lit(no), F.lit(-1))
        .otherwise(F.lit(0))
    )


def normalize_codes(c: ColumnOrName, mapping: dict[str, str]) -> Column:
    """Replace listed codes, keep all others (null stays null)."""
    col = _col(c)
    out = None
    for src, dst in mapping.items():
        out = (F.when(col == F.lit(src), F.lit(dst)) if out is None
               else out.when(col == F.lit(src), F.lit(dst)))
    return col if out is None else out.otherwise(col)


def label_from_code(c: ColumnOrName, offset: int = 1) -> Column:
    """Outcome code minus ``offset`` as int (``'1'`` -> 0, ``'2'`` -> 1)."""
    return (to_int(c) - F.lit(offset)).cast("int")


# ------------------------------------------------------------- arithmetic

def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Division that yields null for a zero denominator (0/0 precision)."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def ratio_rounded(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Round ``num / den`` to a whole number (time per trained model)."""
    return F.round(safe_div(num, den)).cast("bigint")


def sigmoid_percent(x: ColumnOrName) -> Column:
    """Logistic of a log-odds value, in percent.

    ``100 / (1 + exp(-x))`` equals ``e^x / (e^x + 1) * 100`` and does not
    overflow for large positive x.
    """
    return F.lit(100.0) / (F.lit(1.0) + F.exp(-_col(x)))


def odds_ratio_percent(x: ColumnOrName, digits: int = 2) -> Column:
    """Odds ratio of a coefficient in percent, rounded: ``round(e^x*100, 2)``."""
    return F.round(F.exp(_col(x)) * F.lit(100.0), digits)


def total_risk(odds_pct: ColumnOrName, baseline_pct: ColumnOrName, digits: int = 2) -> Column:
    """Odds-ratio percent scaled by the baseline percent: ``round(a*b/100, 2)``.

    Multiplies a probability by an odds ratio, as the analysed report does; the
    result can exceed 100.  ``adjusted_probability`` is the coherent variant.
    """
    return F.round(_col(odds_pct) * _col(baseline_pct) / F.lit(100.0), digits)


def adjusted_probability(intercept: ColumnOrName, coef: ColumnOrName) -> Column:
    """Probability in percent with one coefficient switched on."""
    return sigmoid_percent(_col(intercept) + _col(coef))

