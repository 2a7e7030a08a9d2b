"""riskframe: binary-outcome analysis of coded record tables on Spark.

Every operator is a function ``f(df, ...params) -> DataFrame`` built from the
DataFrame API and Spark ML, so Catalyst plans it and executors run it.

Subpackages
-----------
sources    readers and writers (CSV / Parquet / JSON / catalog tables, models)
functions  column-expression builders (code encoders, risk arithmetic)
operators  DataFrame operators: cohort, features, sampling, metrics, joins, ordering
plans      composed jobs: classifiers, cross-validation, reports, stand-in inputs
"""

from riskframe.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
