"""Classifiers, parameter grids, cross-validated search, scoring, model attributes.

Spark ML does the distributed work (tree aggregation of gradients, split
statistics).  What this module adds is the study's workflow as parameters:
which estimators, which grids, how folds are formed, what is timed, and the
model attributes turned into long-form DataFrames.

Scale notes
-----------
* The assembled training frame is persisted once (memory and disk) and
  reused by every fold; ``CrossValidator`` holds the parts of one fold beside
  it, shared by that fold's combinations, and releases them before the next.
* Folds come from a fold column (``foldCol``), a pure function of the row,
  instead of k random samples of the input.
* ``partitions`` is the caller's choice, never the cluster's width: the same
  rows in the same parts give the same model anywhere.
* Where folds come from a column, equal rows are counted once and searches run
  on the counts (``counted``).
* Model attributes (coefficients, importances, theta, factors) are sized by
  the number of features, never by the number of rows.
"""

from __future__ import annotations

import itertools
import time
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.joins import coefficient_table
from riskframe.operators.sampling import deal_rows
from riskframe.plans import counted as C

ESTIMATORS = {
    "lr": lambda: LogisticRegression(family="binomial"),
    "rf": RandomForestClassifier,
    "gbt": GBTClassifier,
    "mlp": C.CountedMLP,
    "lsvc": LinearSVC,
    "nb": NaiveBayes,
    "fm": C.CountedFM,
}
# On counted rows.
WEIGHTED_ESTIMATORS = {
    **ESTIMATORS,
    "lr": lambda: C.CountedLR(family="binomial"),
    "rf": C.CountedRF,
    "lsvc": C.CountedSVC,
}
# Families that count equal rows themselves.
COUNTING = ("mlp", "fm")

# The study's search grids.  MLP "hidden" lists the hidden
# layers; input and output sizes are added from the data.
STUDY_GRIDS = {
    "lr": {"regParam": [0.01, 0.02, 0.1], "elasticNetParam": [0.0, 0.25, 0.5, 0.75, 1.0],
           "maxIter": [1, 2, 3]},
    "rf": {"numTrees": [10, 20, 30], "maxDepth": [5, 10, 15, 25, 30]},
    "gbt": {"maxIter": [10, 20, 30, 40, 50], "maxDepth": [2, 6, 10, 15, 20]},
    "mlp": {"hidden": [[5], [10], [20], [5, 5], [10, 10], [20, 20], [5, 5, 5], [10, 10, 10],
                       [20, 20, 20]],
            "solver": ["l-bfgs", "gd"]},
    "lsvc": {"maxIter": [1, 2, 3], "regParam": [0.01, 0.02, 0.1]},
    "nb": {},
    "fm": {"maxIter": [1, 5, 10, 15, 20], "regParam": [0.01, 0.02, 0.1],
           "stepSize": [0.001, 0.005, 0.01, 0.05, 0.1]},
}
STUDY_FOLDS = 5

# Concurrent fits of one fold, unless the caller says otherwise.
PARALLELISM = 4
SEED = 4711
#: The column with a counted row's number of rows.
COUNTS = "weight"


@dataclass
class ModelSpec:
    """One family to train: estimator kind, fixed settings, grid."""
    kind: str
    fixed: dict = field(default_factory=dict)
    grid: dict = field(default_factory=dict)
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or self.kind


def make_estimator(kind: str, features_col: str = "features", label_col: str = "label",
                   counts_col: str | None = None, **fixed):
    """``counts_col``: rows have been counted (``counted.count_rows``), this many each."""
    est = (WEIGHTED_ESTIMATORS if counts_col else ESTIMATORS)[kind]()
    est.setFeaturesCol(features_col).setLabelCol(label_col)
    if counts_col and kind in COUNTING:
        est.counts_col = counts_col
    elif counts_col:
        est.setWeightCol(counts_col)
    if fixed:
        est.setParams(**fixed)
    return est


def param_grid(estimator, grid: dict, n_features: int | None = None,
               n_classes: int | None = None):
    """Cartesian product of ``grid`` as ParamMaps (empty grid -> one empty map).

    For the perceptron, ``hidden`` entries become full ``layers`` lists
    ``[n_features, *hidden, n_classes]``.
    """
    builder = ParamGridBuilder()
    for name, values in grid.items():
        if name == "hidden":
            layers = [[n_features, *h, n_classes] for h in values]
            builder = builder.addGrid(estimator.layers, layers)
        else:
            builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def grid_rows(grid_maps) -> list[tuple[int, str]]:
    """``(combo, "name=value, ...")`` for each ParamMap, names sorted."""
    return [(i, settings_text({p.name: v for p, v in pm.items()}))
            for i, pm in enumerate(grid_maps)]


def settings_text(settings: dict) -> str:
    """``"name=value, ..."``, names sorted."""
    return ", ".join(f"{k}={_fmt(v)}" for k, v in sorted(settings.items()))


def _fmt(v) -> str:
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(str(x) for x in v) + "]"
    return str(v)


def pipeline(*stages) -> Pipeline:
    return Pipeline(stages=list(stages))


def coded_pipeline(df: DataFrame, outcome_col: str, classifier, label_col: str = "label",
                   features_col: str = "features", suffix: str = "_vec",
                   nominal: bool = True) -> Pipeline:
    """``[indexer, assembler, classifier]`` built from the frame's schema.

    String columns are indexed (by frequency, unseen and null values to an
    extra index), the outcome becomes ``label`` the same way, every other
    column passes through; the assembler keeps nulls as NaN.  Feature order
    follows the frame's column order.  Vocabularies stay tables; ``nominal`` marks
    the features as categories for trees, for columns of codes.
    """
    from riskframe.operators.cohort import features_minus_target, type_dispatch
    from riskframe.operators.features import assembler
    from riskframe.operators.vocabulary import VocabularyIndexer

    strings, _ = type_dispatch(df, exclude=(outcome_col,))
    indexer = VocabularyIndexer(inputCols=strings + [outcome_col], handleInvalid="keep",
                                outputCols=[f"{c}{suffix}" for c in strings] + [label_col],
                                nominal=nominal)
    features = [f"{c}{suffix}" if c in strings else c
                for c in features_minus_target(df.columns, outcome_col)]
    classifier.setFeaturesCol(features_col).setLabelCol(label_col)
    return pipeline(indexer, assembler(features, features_col, "keep"), classifier)


def f1_evaluator(label_col: str = "label", metric: str = "f1",
                 counts_col: str | None = None) -> MulticlassClassificationEvaluator:
    """The study's objective: support-weighted F1."""
    evaluator = MulticlassClassificationEvaluator(labelCol=label_col, metricName=metric)
    return evaluator.setWeightCol(counts_col) if counts_col else evaluator


def with_class_count(df: DataFrame, label_col: str = "label", num_classes: int = 2) -> DataFrame:
    """Record the number of classes in the label's ML attribute metadata (as
    StringIndexer does), so estimators read it instead of scanning the data
    for the largest label.  The study's outcome is binary by construction."""
    meta = {"ml_attr": {"type": "nominal", "name": label_col, "num_vals": int(num_classes)}}
    return df.withColumn(label_col, F.col(label_col).alias(label_col, metadata=meta))


def persist_training(df: DataFrame, partitions: int | None = None, key_cols=None) -> DataFrame:
    """A training frame that several fits reuse: dealt to ``partitions`` parts by
    a hash of ``key_cols`` (default: all columns) when given, persisted in memory
    then disk, and filled, so that no fit's time includes it."""
    if partitions:
        df = deal_rows(df, partitions, key_cols or df.columns)
    data = df.persist(StorageLevel.MEMORY_AND_DISK)
    data.write.format("noop").mode("overwrite").save()
    return data


def counted_training(df: DataFrame, fold_col: str, features_col: str = "features",
                     label_col: str = "label", num_classes: int = 2) -> DataFrame:
    """A training frame's distinct (fold, features, label) rows with their number, persisted."""
    counted = C.count_rows(df, features_col, label_col, [fold_col], COUNTS)
    return persist_training(with_class_count(counted, label_col, num_classes))


def fit(kind: str, df: DataFrame, features_col: str = "features", label_col: str = "label",
        **fixed):
    """Fit one classifier.  The estimator keeps the one decoded copy it iterates on."""
    return make_estimator(kind, features_col, label_col, **fixed).fit(df)


def cross_validator(estimator, grid_maps, num_folds: int = STUDY_FOLDS,
                    fold_col: str | None = None, seed: int = SEED,
                    parallelism: int = PARALLELISM, label_col: str = "label",
                    counts_col: str | None = None) -> CrossValidator:
    """Spark's search on weighted F1.  With ``fold_col`` a null or out-of-range fold
    fails the job and an empty fold raises, so no row is left out unnoticed."""
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid_maps,
                        evaluator=f1_evaluator(label_col, counts_col=counts_col),
                        numFolds=num_folds, parallelism=parallelism, seed=seed)
    if fold_col:
        cv.setFoldCol(fold_col)
    return cv


@dataclass
class FitResult:
    name: str
    model: object
    millis: int
    num_trains: int
    grid: list


def timed_fit(name: str, cv: CrossValidator, df: DataFrame) -> FitResult:
    """Fit a cross-validator and time it.

    ``num_trains`` counts combinations x folds; the final refit on all rows
    is inside the time but not in the count, as in the study.
    """
    start = time.perf_counter()
    model = cv.fit(df)
    millis = int(round((time.perf_counter() - start) * 1000))
    grid = cv.getEstimatorParamMaps()
    return FitResult(name, model, millis, len(grid) * cv.getNumFolds(), grid)


def train_suite(df: DataFrame, specs, features_col: str = "features", label_col: str = "label",
                num_folds: int = STUDY_FOLDS, fold_col: str | None = None,
                parallelism: int = PARALLELISM, n_features: int | None = None,
                n_classes: int = 2, partitions: int | None = None,
                key_cols=None) -> list[FitResult]:
    """Train each family with its grid, one family after another.

    Each family is a one-stage pipeline, searched with k-fold CV on
    weighted F1.  ``df`` should already hold the assembled features; it is
    persisted and filled before the first clock starts.  Where a fold column tells
    the folds, equal rows of a fold are counted once and every family is fitted on
    the counts; folds drawn at random need the rows, dealt to ``partitions``.
    """
    counts = COUNTS if fold_col else None
    data = counted_training(df, fold_col, features_col, label_col, n_classes) if fold_col \
        else persist_training(df, partitions, key_cols)
    try:
        results = []
        for spec in specs:
            fixed = dict(spec.fixed)
            if "hidden" in fixed:
                fixed["layers"] = [n_features, *fixed.pop("hidden"), n_classes]
            est = make_estimator(spec.kind, features_col, label_col, counts, **fixed)
            # Grid maps name the classifier's params; the one-stage pipeline
            # hands them to its stage.
            maps = param_grid(est, spec.grid, n_features, n_classes)
            cv = cross_validator(pipeline(est), maps, num_folds, fold_col,
                                 parallelism=parallelism, label_col=label_col,
                                 counts_col=counts)
            results.append(timed_fit(spec.label, cv, data))
        return results
    finally:
        data.unpersist()


def times_frame(spark: SparkSession, results) -> DataFrame:
    """``(model, time, numTrains)`` with time in milliseconds."""
    return spark.createDataFrame([(r.name, r.millis, r.num_trains) for r in results],
                                 "model STRING, time BIGINT, numTrains BIGINT")


def grid_results(spark: SparkSession, cv_model) -> DataFrame:
    """``(combo, params, avg_metric, is_best)``; the first best combo wins ties."""
    maps = cv_model.getEstimatorParamMaps()
    metrics = list(cv_model.avgMetrics)
    best = max(range(len(metrics)), key=lambda i: (metrics[i], -i))
    rows = [(i, p, float(metrics[i]), i == best) for i, p in grid_rows(maps)]
    return spark.createDataFrame(rows, "combo INT, params STRING, avg_metric DOUBLE, is_best BOOLEAN")


def best_stage(cv_model):
    """The fitted classifier inside the best pipeline."""
    best = getattr(cv_model, "bestModel", cv_model)
    return best.stages[-1] if hasattr(best, "stages") else best


def best_params(spark: SparkSession, cv_model, names) -> DataFrame:
    """Chosen hyper-parameters of the best model as one row."""
    m = best_stage(cv_model)
    values = [m.getOrDefault(m.getParam(n)) for n in names]
    fields = ", ".join(f"{n} {_sql_type(v)}" for n, v in zip(names, values))
    return spark.createDataFrame([tuple(values)], fields)


def best_settings(spark: SparkSession, results) -> DataFrame:
    """``(model, params)``: each family's searched parameters as its best model has them."""
    rows = []
    for r in results:
        m = best_stage(r.model)
        names = sorted({p.name for combo in r.grid for p in combo})
        rows.append((r.name, ", ".join(
            f"{n}={_fmt(m.getOrDefault(m.getParam(n)))}" for n in names)))
    return spark.createDataFrame(rows, "model STRING, params STRING")


def predictions(models: dict, df: DataFrame, keep=("label",)) -> DataFrame:
    """One scan for many models: ``keep`` and a prediction column per model name."""
    out = df
    for name, model in models.items():
        stage = best_stage(model).copy().setPredictionCol(name)
        for switch in ("setRawPredictionCol", "setProbabilityCol"):
            if hasattr(stage, switch):
                getattr(stage, switch)("")
        out = stage.transform(out)
    return out.select(*keep, *models)


def _sql_type(v) -> str:
    if isinstance(v, bool):
        return "BOOLEAN"
    if isinstance(v, int):
        return "INT"
    if isinstance(v, float):
        return "DOUBLE"
    if isinstance(v, (list, tuple)):
        return "ARRAY<INT>"
    return "STRING"


def score(model, df: DataFrame, keep=("label",)) -> DataFrame:
    """Batch scoring; vectors come out as arrays so any engine can read them."""
    out = model.transform(df)
    cols = [*keep, "prediction"]
    if "probability" in out.columns:
        cols.append(vector_to_array("probability").alias("probability"))
    if "rawPrediction" in out.columns:
        cols.append(vector_to_array("rawPrediction").alias("raw_prediction"))
    return out.select(*cols)


def linear_coefficients(spark: SparkSession, model, names, model_name: str) -> DataFrame:
    """Coefficients and intercept of a linear model (logistic, SVM) by name."""
    return coefficient_table(spark, names, model.coefficients.toArray(), model.intercept,
                             model_name)


def convergence(spark: SparkSession, fitted: dict) -> DataFrame:
    """``(model, iterations, max_iter, at_limit)`` for iterative linear models
    (logistic regression, linear SVM): ``at_limit`` flags a fit that stopped
    at ``maxIter`` rather than converging, whose coefficients depend on it."""
    rows = []
    for name, m in fitted.items():
        iters = m.summary.totalIterations if m.hasSummary else None
        max_iter = m.getOrDefault(m.getParam("maxIter"))
        rows.append((name, iters, max_iter, iters is not None and iters >= max_iter))
    return spark.createDataFrame(rows, "model STRING, iterations INT, max_iter INT, "
                                       "at_limit BOOLEAN")


def feature_importances(spark: SparkSession, model, names) -> DataFrame:
    """Tree-ensemble importances by name: ``(pos, feature, importance)``."""
    values = model.featureImportances.toArray()
    return spark.createDataFrame(
        [(i, n, float(v)) for i, (n, v) in enumerate(zip(names, values, strict=True))],
        "pos INT, feature STRING, importance DOUBLE")


def nb_theta(spark: SparkSession, model, names) -> DataFrame:
    """Naive Bayes log conditional probabilities, long form
    ``(label, feature, theta)`` plus a ``pi`` row (class log prior) per label."""
    theta = model.theta.toArray()
    pi = model.pi.toArray()
    rows = []
    for c in range(theta.shape[0]):
        rows.extend((c, n, float(theta[c, j])) for j, n in enumerate(names))
        rows.append((c, "pi", float(pi[c])))
    return spark.createDataFrame(rows, "label INT, feature STRING, theta DOUBLE")


def nb_linear_coefficients(spark: SparkSession, model, names, model_name: str = "nb") -> DataFrame:
    """A two-class multinomial Naive Bayes as a linear log-odds model:
    coefficient_j = theta[1, j] - theta[0, j], intercept = pi[1] - pi[0]."""
    theta, pi = model.theta.toArray(), model.pi.toArray()
    if theta.shape[0] != 2:
        raise ValueError("log-odds form needs exactly two classes")
    return coefficient_table(spark, names, theta[1] - theta[0], pi[1] - pi[0], model_name)


def fm_factors(spark: SparkSession, model, names) -> DataFrame:
    """Factorisation machine terms, long form ``(feature, term, idx, value)``:
    ``factor`` rows (one per latent dimension), ``linear`` rows, one intercept."""
    factors = model.factors.toArray()
    linear = model.linear.toArray()
    rows = []
    for j, n in enumerate(names):
        rows.extend((n, "factor", k, float(factors[j, k])) for k in range(factors.shape[1]))
        rows.append((n, "linear", 0, float(linear[j])))
    rows.append(("intercept", "intercept", 0, float(model.intercept)))
    return spark.createDataFrame(rows, "feature STRING, term STRING, idx INT, value DOUBLE")


def grid_size(grid: dict) -> int:
    return len(list(itertools.product(*grid.values()))) if grid else 1
