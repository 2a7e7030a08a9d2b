"""Training on distinct patterns: equal (features, label) rows become one weighted row.

Coded features have few values, so however long the table, its rows fall into a
bounded number of patterns (twelve flags, age and sex: some hundred thousand at
most).  One grouped count, combined before it travels, replaces the table; every
estimator with a ``weightCol`` then iterates on the patterns, whatever the rows.

A weighted fit is not the unweighted one by itself:

* Spark's standard deviations of weighted rows are those of reliability weights, not
  of counts, and penalties are scaled by them.  Linear families are therefore fitted
  without Spark's standardization on features scaled by the counts' own deviations,
  which is the penalty of the uncompressed fit.
* A forest bags rows, so a bag would hold or miss a whole pattern.  ``parts`` deals a
  pattern's count to several rows, so that bags vary its weight instead.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import ElementwiseProduct, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.plans import models as M

WEIGHT = "weight"
#: Families whose estimators take weights.
WEIGHTED = ("lr", "rf", "gbt", "lsvc", "nb")
#: Families whose penalty is scaled by the features' deviations.
SCALED = ("lr", "lsvc")
#: Rows that a forest's pattern is dealt to.
BAG_PARTS = 64


def compress(df: DataFrame, features, label_col: str = "label", keys=(),
             weight_col: str = WEIGHT) -> DataFrame:
    """One row per distinct (keys, features, label), with the number of its rows.

    Nulls group together.  ``keys`` are columns that must stay apart, such as a fold.
    """
    return df.groupBy(*keys, *features, label_col).agg(
        F.count(F.lit(1)).cast("double").alias(weight_col))


def deal(patterns: DataFrame, parts: int, weight_col: str = WEIGHT) -> DataFrame:
    """Each pattern as up to ``parts`` rows that share its count in whole rows."""
    n = F.col(weight_col)
    rows = F.least(F.lit(parts), n.cast("long")).cast("int")
    part = F.explode(F.sequence(F.lit(0), F.greatest(rows - 1, F.lit(0))))
    whole = F.floor(n / rows)
    return (patterns.select("*", part.alias("_part"))
            .withColumn(weight_col, (whole + (F.col("_part") < n - whole * rows).cast("int"))
                        .cast("double")).drop("_part"))


def count_deviations(patterns: DataFrame, features, weight_col: str = WEIGHT) -> list[float]:
    """Sample standard deviation of each feature over the rows that the counts stand for."""
    n = F.sum(weight_col)
    means = patterns.agg(*[(F.sum(F.col(c) * F.col(weight_col)) / n).alias(c) for c in features])
    mean = means.first()
    squares = patterns.agg(n.alias("_n"), *[F.sum(
        F.col(weight_col) * F.pow(F.col(c) - F.lit(mean[c]), 2)).alias(c) for c in features]).first()
    return [math.sqrt(squares[c] / (squares["_n"] - 1)) if squares["_n"] and squares["_n"] > 1
            else 0.0 for c in features]


def pattern_pipeline(kind: str, patterns: DataFrame, features, label_col: str = "label",
                     weight_col: str = WEIGHT, **fixed) -> Pipeline:
    """The unfitted stages: assembler, scaling where the family's penalty needs it, classifier.

    A feature without variation gets the factor 0, so its coefficient is 0 as in the
    uncompressed fit.
    """
    if kind not in WEIGHTED:
        raise ValueError(f"{kind} takes no weights: fit it on the rows")
    scaled = kind in SCALED and fixed.get("standardization", True)
    stages = [VectorAssembler(inputCols=list(features),
                              outputCol="assembled" if scaled else "features")]
    if scaled:
        fixed = {**fixed, "standardization": False}
        factors = [1 / s if s else 0.0 for s in count_deviations(patterns, features, weight_col)]
        stages.append(ElementwiseProduct(scalingVec=Vectors.dense(factors),
                                         inputCol="assembled", outputCol="features"))
    classifier = M.make_estimator(kind, "features", label_col, weightCol=weight_col, **fixed)
    return Pipeline(stages=[*stages, classifier])


def fit_patterns(kind: str, patterns: DataFrame, features, label_col: str = "label",
                 weight_col: str = WEIGHT, **fixed) -> PipelineModel:
    """Fit one family on patterns; the model reads plain feature columns."""
    data = M.with_class_count(patterns, label_col, 2)
    if kind == "rf" and fixed.get("bootstrap", True):
        data = deal(data, BAG_PARTS, weight_col)
    return pattern_pipeline(kind, patterns, features, label_col, weight_col, **fixed).fit(data)


def linear_terms(model: PipelineModel) -> tuple[list[float], float]:
    """Coefficients and intercept of a linear pattern model on the plain features' scale."""
    classifier = model.stages[-1]
    factors = [1.0] * len(classifier.coefficients)
    for stage in model.stages:
        if isinstance(stage, ElementwiseProduct):
            factors = list(stage.getScalingVec())
    return [float(c) * float(f) for c, f in zip(classifier.coefficients, factors)], \
        float(classifier.intercept)
