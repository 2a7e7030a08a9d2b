"""Reports: linear scoring from a coefficient table, the odds-ratio risk
table, and the model comparison leaderboard.

Inputs are small tables (one row per feature or per model) except the
scored rows, which are reduced to confusion counts before anything else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import codes as C
from riskframe.operators import metrics as met
from riskframe.operators.joins import attach_baseline, attach_by_key
from riskframe.operators.ordering import rank_small

def linear_score(df: DataFrame, coefs: DataFrame, model: str, features,
                 feature_col: str = "feature", value_col: str = "coefficient",
                 intercept_name: str = "intercept", threshold: float = 0.5,
                 keep=("label",), handle_invalid: str = "error") -> DataFrame:
    """Score rows with a linear log-odds model given as a coefficient table.

    ``features`` names the model's columns in ``df``.  Their values form one
    array per row; the table's coefficients, put in the same order, form one
    array in a scalar subquery, and the score is their dot product plus the
    intercept: one plan for any number of features, nothing read to the driver.
    A null feature fails the job (``error``), drops the row (``skip``) or gives
    a null score (``keep``), as the assembler's settings do; a feature without
    a coefficient fails the job.
    """
    names = list(features)
    table = coefs.where(F.col("model") == F.lit(model))
    terms = F.map_from_entries(F.collect_list(F.struct(F.col(feature_col), F.col(value_col))))
    known = F.array(*[F.lit(n) for n in names])
    weights = table.agg(terms.alias("t")).select(
        F.struct(F.coalesce(F.col("t")[intercept_name], F.lit(0.0)).alias("intercept"),
                 F.transform(known, lambda n: F.coalesce(F.element_at("t", n), F.raise_error(
                     F.concat(F.lit("no coefficient of "), n)).cast("double"))).alias("w")))
    values = F.array(*[F.col(c).cast("double") for c in names])
    missing = F.exists(values, lambda x: x.isNull())
    rows = df.where(~missing) if handle_invalid == "skip" else df
    rows = rows.select(*keep, values.alias("_x")).withColumn("_m", weights.scalar())
    logit = F.col("_m.intercept") + F.aggregate(
        F.zip_with("_x", F.col("_m.w"), lambda x, w: x * w), F.lit(0.0), lambda a, b: a + b)
    if handle_invalid == "error":
        logit = F.when(F.exists("_x", lambda x: x.isNull()),
                       F.raise_error(F.lit("null in a feature")).cast("double")).otherwise(logit)
    prob = F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))
    return (rows.select(*keep, prob.alias("probability"))
            .withColumn("prediction", (F.col("probability") > F.lit(threshold)).cast("double")))


def with_reference_profile(coefs: DataFrame, profile: dict, feature_col: str = "feature",
                           value_col: str = "coefficient",
                           intercept_name: str = "intercept") -> DataFrame:
    """Move each model's baseline from "all features 0" to a reference profile.

    The intercept row becomes ``intercept + sum(coef_j * profile_j)`` (for
    example the log-odds of a given age and sex with no comorbidity); the
    other rows are unchanged.  One row per feature: small tables throughout.
    """
    spark = coefs.sparkSession
    prof = spark.createDataFrame([(k, float(v)) for k, v in profile.items()],
                                 f"{feature_col} STRING, _value DOUBLE")
    shift = (coefs.join(prof, [feature_col])
                  .groupBy("model").agg(F.sum(F.col(value_col) * F.col("_value")).alias("_shift")))
    is_base = F.col(feature_col) == F.lit(intercept_name)
    return (coefs.join(shift, ["model"], "left")
                 .withColumn(value_col, F.when(is_base, F.col(value_col)
                                               + F.coalesce(F.col("_shift"), F.lit(0.0)))
                             .otherwise(F.col(value_col)))
                 .drop("_shift"))


def risk_report(coefs: DataFrame, reference_model: str, models=None,
                feature_col: str = "feature", value_col: str = "coefficient",
                intercept_name: str = "intercept", reference_profile: dict | None = None
                ) -> DataFrame:
    """Odds-ratio risk table from linear coefficients (long form in).

    One row per non-intercept feature: the coefficient of each model side by
    side (pivot), and for ``reference_model``:

    * ``baseline_pct``    logistic of the intercept, in percent
    * ``odds_ratio_pct``  ``round(e^coef * 100, 2)``
    * ``total_risk_pct``  ``round(odds_ratio_pct * baseline_pct / 100, 2)`` (the
      study's formula; it scales a probability by an odds ratio)
    * ``adjusted_pct``    logistic of intercept + coefficient, in percent
    * ``rank``            by the reference coefficient, largest first

    ``reference_profile`` (feature -> value) sets the baseline to that
    profile instead of all-zero features (``with_reference_profile``).
    """
    models = list(models) if models is not None else [reference_model]
    if reference_profile:
        coefs = with_reference_profile(coefs, reference_profile, feature_col, value_col,
                                       intercept_name)
    wide = met.pivot_sum(coefs, feature_col, "model", value_col, models)
    ref = attach_baseline(coefs.where(F.col("model") == F.lit(reference_model)),
                          intercept_name, feature_col, value_col, "model", "baseline")
    baseline_pct = C.sigmoid_percent("baseline")
    odds = C.odds_ratio_percent(value_col)
    ref = ref.select(
        feature_col,
        F.col(value_col).alias("_coef"),
        baseline_pct.alias("baseline_pct"),
        odds.alias("odds_ratio_pct"),
        C.total_risk(odds, baseline_pct).alias("total_risk_pct"),
        C.adjusted_probability("baseline", value_col).alias("adjusted_pct"),
    )
    report = attach_by_key(ref, wide, [feature_col], "left")
    return rank_small(report, [F.col("_coef").desc_nulls_last(), F.col(feature_col).asc()],
                      "rank").drop("_coef")


def model_comparison(confusion: DataFrame, times: DataFrame, positive: float = 0.0) -> DataFrame:
    """Leaderboard of models: training time, fits, ms per fit, class metrics
    of ``positive`` and weighted F1, ranked by F1 (best first).

    ``confusion`` is ``(model, label, prediction, n)`` of every model's test rows.
    """
    summary = met.metrics_summary(confusion, positive) \
        .drop("weighted_precision", "weighted_recall")
    joined = attach_by_key(summary, times, ["model"], "left")
    joined = joined.withColumn("time_per_model", C.ratio_rounded("time", "numTrains"))
    return rank_small(joined, [F.col("f1").desc_nulls_last(), F.col("model").asc()], "rank")
