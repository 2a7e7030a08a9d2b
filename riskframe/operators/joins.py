"""Joins that replace the study's driver-side lookups.

No side is forced to broadcast: Spark broadcasts one whose size in bytes is
known to be small, at planning time or by AQE at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def attach_by_key(left: DataFrame, right: DataFrame, keys, how: str = "left") -> DataFrame:
    """Equi-join ``right`` (e.g. training times) onto ``left`` (e.g. metrics)."""
    return left.join(right, list(keys), how)


def attach_baseline(coefs: DataFrame, baseline_feature: str = "intercept",
                    feature_col: str = "feature", value_col: str = "coefficient",
                    model_col: str = "model", baseline_col: str = "baseline") -> DataFrame:
    """Attach each model's baseline term (its intercept row) to that model's
    other rows: an equi-join on the model, not a cross join."""
    base = (coefs.where(F.col(feature_col) == F.lit(baseline_feature))
                 .select(model_col, F.col(value_col).alias(baseline_col)))
    rest = coefs.where(F.col(feature_col) != F.lit(baseline_feature))
    return rest.join(base, [model_col], "left")


def coefficient_table(spark, names, coefficients, intercept=None, model: str | None = None,
                      intercept_name: str = "intercept") -> DataFrame:
    """Name a coefficient vector by position: ``(pos, feature, coefficient[, model])``.

    The vector and names are driver-side model attributes (one entry per
    feature); their lengths must agree.
    """
    names, values = list(names), [float(v) for v in coefficients]
    if len(names) != len(values):
        raise ValueError(f"{len(names)} names for {len(values)} coefficients")
    rows = list(zip(range(len(names)), names, values))
    if intercept is not None:
        rows.append((len(names), intercept_name, float(intercept)))
    df = spark.createDataFrame(rows, "pos INT, feature STRING, coefficient DOUBLE")
    return df.withColumn("model", F.lit(model)) if model is not None else df
