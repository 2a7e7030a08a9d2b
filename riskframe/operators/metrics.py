"""Aggregations: counts, distincts, pivots, correlations, confusion metrics.

Classification metrics are computed from confusion counts, so the large
input is read once and reduced by a partial + final hash aggregate to at most
(models x classes x classes) rows; everything after that is tiny.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.codes import safe_div


def _expr(rule) -> Column:
    return F.expr(rule) if isinstance(rule, str) else rule


# ------------------------------------------------------------ basic counts

def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def class_balance(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of ``col``: without null (SQL ``count(DISTINCT)``) and
    with null counted as one value (``select(col).distinct().count()``)."""
    return df.agg(
        F.countDistinct(col).alias("n_distinct"),
        (F.countDistinct(col) + F.coalesce(F.max(F.col(col).isNull().cast("int")), F.lit(0)))
        .cast("bigint").alias("n_distinct_with_null"),
    )


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def pivot_sum(df: DataFrame, group_col: str, pivot_col: str, value_col: str,
              pivot_values=None) -> DataFrame:
    """``groupBy(group).pivot(pivot, values).sum(value)``.

    Giving ``pivot_values`` skips the extra job that collects distinct values.
    """
    grouped = df.groupBy(group_col)
    grouped = grouped.pivot(pivot_col, list(pivot_values)) if pivot_values is not None \
        else grouped.pivot(pivot_col)
    return grouped.agg(F.sum(value_col))


def _known(col: str) -> Column:
    """A column as double, null where it is null or NaN."""
    return F.nullif(F.col(col).cast("double"), F.lit(float("nan")))


def pair_vectors(df: DataFrame, cols, shifts) -> DataFrame:
    """``v``: one vector ``[x, x^2, known]`` per row, ``x`` the columns less their
    shifts and zero where unknown, and a row of zeros, which adds nothing to sums
    and gives an empty table its width."""
    value = [_known(c) for c in cols]
    shifted = [v - F.lit(m) for v, m in zip(value, shifts)]
    rows = df.select(array_to_vector(F.array(
        *[F.coalesce(x, F.lit(0.0)) for x in shifted],
        *[F.coalesce(x * x, F.lit(0.0)) for x in shifted],
        *[v.isNotNull().cast("double") for v in value])).alias("v"))
    zeros = F.array_repeat(F.lit(0.0), 3 * len(value))
    return rows.unionAll(df.sparkSession.range(1).select(array_to_vector(zeros).alias("v")))


def correlation_long(df: DataFrame, cols) -> DataFrame:
    """Pearson correlation of every column pair, long form ``(col_a, col_b, corr)``.

    Pairwise-complete like a pandas ``corr()``: a pair ignores rows where
    either side is null or NaN; the diagonal is 1.0 when the column has any
    variance, and a pair with a constant side has no correlation (null).

    Columns are shifted by their means (a first aggregate, so that sums of
    squares do not cancel).  The blocks of the Gram matrix of ``pair_vectors``
    are the pair sums, added up in one JVM buffer of (3 columns)^2 / 2 numbers per task.
    Two jobs run here, when the function is called; only the matrix reaches
    the driver.
    """
    cols = list(cols)
    p = len(cols)
    means = [m or 0.0 for m in df.agg(*[F.avg(_known(c)).alias(f"m{i}")
                                        for i, c in enumerate(cols)]).first()]
    vectors = MLUtils.convertVectorColumnsFromML(pair_vectors(df, cols, means), "v")
    gram = RowMatrix(vectors, numCols=3 * p).computeGramianMatrix().toArray()
    x, square, known = (slice(i * p, (i + 1) * p) for i in range(3))
    n, total = gram[known, known], gram[x, known]  # total[a, b]: sum of a where b is known
    with np.errstate(divide="ignore", invalid="ignore"):
        left = gram[square, known] - total ** 2 / n
        # What is left of a constant column is the rounding of its mean.
        left[~(left > n * (1e-15 * np.array(means)[:, None]) ** 2)] = np.nan
        corr = (gram[x, x] - total * total.T / n) / np.sqrt(left * left.T)
    for i in range(p):
        corr[i, i] = 1.0 if left[i, i] > 0 else np.nan
    return df.sparkSession.createDataFrame(
        [(a, b, None if np.isnan(corr[i, j]) else float(corr[i, j]))
         for i, a in enumerate(cols) for j, b in enumerate(cols)],
        "col_a string, col_b string, corr double")


# ------------------------------------------------------------- confusion

def confusion_by_rules(df: DataFrame, rules: dict, label_col: str = "label") -> DataFrame:
    """Confusion counts ``(model, label, prediction, n)`` of several scoring
    rules in one pass, reducing before exploding.

    Rows are first grouped by (label, prediction of every rule), which keeps
    at most classes x (distinct predictions)^rules groups; only that small
    joint table is spread into one row per model and summed.
    """
    names = list(rules)
    preds = [_expr(rules[n]).cast("double").alias(f"_p{i}") for i, n in enumerate(names)]
    joint = (df.select(F.col(label_col).alias("label"), *preds)
               .groupBy("label", *[f"_p{i}" for i in range(len(names))])
               .agg(F.count(F.lit(1)).alias("_n")))
    entries = [F.struct(F.lit(n).alias("model"), F.col(f"_p{i}").alias("prediction"))
               for i, n in enumerate(names)]
    spread = joint.select("label", "_n", F.explode(F.array(*entries)).alias("s"))
    return (spread.groupBy(F.col("s.model").alias("model"), "label",
                           F.col("s.prediction").alias("prediction"))
                  .agg(F.sum("_n").alias("n")))


def cell_vectors(df: DataFrame, predictions_col: str, n_models: int, label_col: str = "label",
                 n_classes: int = 2, weight_col: str | None = None) -> DataFrame:
    """One row, one column ``cells``: the confusion cells of many models, as one vector; no
    row where there are no labelled rows.

    Each row's predictions (an array, one per model) become a one-hot vector of models x
    classes x classes cells, and vectors are summed: a buffer per task, whatever the
    number of models or of distinct combinations of their predictions.
    """
    place = F.col(label_col).cast("int") * n_classes
    hot = F.flatten(F.transform(F.col(predictions_col), lambda p: F.transform(
        F.sequence(F.lit(0), F.lit(n_classes * n_classes - 1)),
        lambda cell: (cell == place + p.cast("int")).cast("double"))))
    rows = df.where(F.col(label_col).isNotNull()).select(
        array_to_vector(hot).alias("cells"),
        (F.col(weight_col) if weight_col else F.lit(1.0)).cast("double").alias("weight"))
    # One group, so that no rows give no sum instead of a sum of nothing, which raises.
    return rows.groupBy(F.lit(0).alias("all_rows")).agg(
        Summarizer.sum(F.col("cells"), F.col("weight")).alias("cells")).select("cells")


def confusion_vector(df: DataFrame, predictions_col: str, n_models: int,
                     label_col: str = "label", n_classes: int = 2,
                     weight_col: str | None = None) -> list[list[list[float]]]:
    """Confusion matrices (rows: labels) of many models from one scan; no rows give zeros."""
    found = cell_vectors(df, predictions_col, n_models, label_col, n_classes, weight_col).first()
    size = n_classes * n_classes
    flat = found[0].toArray().tolist() if found else [0.0] * (n_models * size)
    return [[flat[m * size + a * n_classes:m * size + (a + 1) * n_classes]
             for a in range(n_classes)] for m in range(n_models)]


def confusion_grid(df: DataFrame, rules: dict, label_col: str = "label",
                   n_classes: int = 2, weight_col: str | None = None,
                   inputs=None) -> DataFrame:
    """``(model, label, prediction, n)`` of any number of models from one scan.

    ``rules`` maps a model to its prediction (a column or SQL expression).  Where
    ``confusion_by_rules`` groups by all predictions at once, this adds one vector per
    task, so it suits a whole grid of models.  Empty cells are left out.  Where the rules
    read few-valued columns, name them as ``inputs``: rows equal in them and the label are
    counted first and each rule is evaluated once for all of them.
    """
    names = list(rules)
    if inputs:
        n = F.sum(weight_col) if weight_col else F.count(F.lit(1))
        df = df.groupBy(label_col, *inputs).agg(n.alias("_n"))
        weight_col = "_n"
    told = df.select(
        F.col(label_col).alias("label"),
        (F.col(weight_col) if weight_col else F.lit(1.0)).alias("weight"),
        F.array(*[_expr(rules[n]).cast("double") for n in names]).alias("told"))
    cells = cell_vectors(told, "told", len(names), "label", n_classes, "weight")
    size = n_classes * n_classes
    spread = cells.select(F.posexplode(vector_to_array("cells")).alias("at", "n"))
    return spread.where("n > 0").select(
        F.get(F.array(*[F.lit(n) for n in names]), F.floor(F.col("at") / size).cast("int"))
        .alias("model"),
        F.floor(F.col("at") % size / n_classes).cast("int").alias("label"),
        (F.col("at") % n_classes).cast("double").alias("prediction"),
        F.col("n").cast("bigint").alias("n"))


def confusion_counts(scored: DataFrame, label_col: str = "label",
                     prediction_col: str = "prediction",
                     model_col: str | None = "model") -> DataFrame:
    """Confusion matrix in long form: ``([model], label, prediction, n)``.

    Row = actual label, column = predicted label, as Spark ML's matrix.
    """
    keys = ([model_col] if model_col else []) + [label_col, prediction_col]
    out = scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if label_col != "label" or prediction_col != "prediction":
        out = out.withColumnsRenamed({label_col: "label", prediction_col: "prediction"})
    return out


def class_metrics(confusion: DataFrame, positive: float = 0.0,
                  model_col: str = "model") -> DataFrame:
    """tp/fp/fn/tn and accuracy, precision, recall, F1 of one class.

    ``positive`` defaults to class 0 as in the study (0 = recovered).  A zero
    denominator gives null instead of NaN.
    """
    lab, pred, n = F.col("label").cast("double"), F.col("prediction").cast("double"), F.col("n")
    pos = F.lit(float(positive))

    def cnt(cond):
        return F.coalesce(F.sum(F.when(cond, n)), F.lit(0)).cast("bigint")

    keys = [model_col] if model_col else []
    counts = confusion.groupBy(*keys).agg(
        cnt((lab == pos) & (pred == pos)).alias("tp"),
        cnt((lab != pos) & (pred == pos)).alias("fp"),
        cnt((lab == pos) & (pred != pos)).alias("fn"),
        cnt((lab != pos) & (pred != pos)).alias("tn"),
    )
    precision = safe_div("tp", F.col("tp") + F.col("fp"))
    recall = safe_div("tp", F.col("tp") + F.col("fn"))
    return counts.select(
        *keys, "tp", "fp", "fn", "tn",
        safe_div(F.col("tp") + F.col("tn"),
                 F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        safe_div(F.lit(2.0) * precision * recall, precision + recall).alias("f1"),
    )


def per_class_counts(confusion: DataFrame, model_col: str = "model") -> DataFrame:
    """Per (model, class): support, true positives, false positives.

    Each confusion cell feeds its actual class (support, tp) and its predicted
    class (fp), so no join is needed.
    """
    lab, pred, n = F.col("label").cast("double"), F.col("prediction").cast("double"), F.col("n")
    keys = [model_col] if model_col else []
    exploded = confusion.select(
        *keys,
        F.explode(F.array(
            F.struct(lab.alias("cls"), n.alias("support"),
                     F.when(lab == pred, n).otherwise(F.lit(0)).alias("tp"),
                     F.lit(0).cast("bigint").alias("fp")),
            F.struct(pred.alias("cls"), F.lit(0).cast("bigint").alias("support"),
                     F.lit(0).cast("bigint").alias("tp"),
                     F.when(lab != pred, n).otherwise(F.lit(0)).alias("fp")),
        )).alias("e"))
    return (exploded.groupBy(*keys, F.col("e.cls").alias("cls"))
            .agg(F.sum("e.support").alias("support"), F.sum("e.tp").alias("tp"),
                 F.sum("e.fp").alias("fp")))


def weighted_metrics(confusion: DataFrame, model_col: str = "model") -> DataFrame:
    """Spark ML's multiclass summary in one pass over confusion counts.

    ``accuracy``, ``weighted_precision``, ``weighted_recall`` and
    ``weighted_f1`` (the evaluator's default ``f1``): per-class values weighted
    by class support; a 0/0 per-class precision or F-measure counts as 0.
    Classes are those present in the label column.
    """
    keys = [model_col] if model_col else []
    pc = per_class_counts(confusion, model_col).where(F.col("support") > 0)
    tp, fp, sup = (F.col(c).cast("double") for c in ("tp", "fp", "support"))
    p = F.when(tp + fp == 0, F.lit(0.0)).otherwise(tp / (tp + fp))
    r = tp / sup
    per = pc.select(*keys, "support", "tp", p.alias("p"), r.alias("r"))
    f = F.when(F.col("p") + F.col("r") == 0, F.lit(0.0)) \
        .otherwise(F.lit(2.0) * F.col("p") * F.col("r") / (F.col("p") + F.col("r")))
    total = F.sum(F.col("support").cast("double"))
    return per.groupBy(*keys).agg(
        (F.sum(F.col("tp").cast("double")) / total).alias("accuracy"),
        (F.sum(F.col("p") * F.col("support")) / total).alias("weighted_precision"),
        (F.sum(F.col("r") * F.col("support")) / total).alias("weighted_recall"),
        (F.sum(f * F.col("support")) / total).alias("weighted_f1"),
    )


def metrics_summary(confusion: DataFrame, positive: float = 0.0,
                    model_col: str = "model") -> DataFrame:
    """``class_metrics`` of ``positive`` and ``weighted_metrics`` together, from
    one aggregation over the per-class counts, so a consumer that needs both
    reads the confusion counts (and the rows behind them) once.

    For the positive class: tp and fp are its per-class counts, fn is its
    support minus tp, tn is everything else.
    """
    keys = [model_col] if model_col else []
    pc = per_class_counts(confusion, model_col)
    tp, fp, sup = (F.col(c).cast("double") for c in ("tp", "fp", "support"))
    p = F.when(tp + fp == 0, F.lit(0.0)).otherwise(tp / (tp + fp))
    r = F.when(sup == 0, F.lit(0.0)).otherwise(tp / sup)
    f = F.when(p + r == 0, F.lit(0.0)).otherwise(F.lit(2.0) * p * r / (p + r))
    is_pos = F.col("cls") == F.lit(float(positive))
    has_support = F.col("support") > 0

    def pos_sum(c):
        return F.coalesce(F.sum(F.when(is_pos, F.col(c))), F.lit(0)).cast("bigint")

    total = F.sum(F.col("support").cast("double"))
    agg = pc.groupBy(*keys).agg(
        pos_sum("tp").alias("tp"), pos_sum("fp").alias("fp"),
        (pos_sum("support") - pos_sum("tp")).alias("fn"),
        F.sum("support").cast("bigint").alias("_total"),
        (F.sum(F.col("tp").cast("double")) / total).alias("accuracy"),
        (F.sum(F.when(has_support, p * sup)) / total).alias("weighted_precision"),
        (F.sum(F.when(has_support, r * sup)) / total).alias("weighted_recall"),
        (F.sum(F.when(has_support, f * sup)) / total).alias("weighted_f1"),
    )
    tn = F.col("_total") - F.col("tp") - F.col("fp") - F.col("fn")
    precision = safe_div("tp", F.col("tp") + F.col("fp"))
    recall = safe_div("tp", F.col("tp") + F.col("fn"))
    return agg.select(
        *keys, "tp", "fp", "fn", tn.alias("tn"), "accuracy",
        precision.alias("precision"), recall.alias("recall"),
        safe_div(F.lit(2.0) * precision * recall, precision + recall).alias("f1"),
        "weighted_precision", "weighted_recall", "weighted_f1",
    )
