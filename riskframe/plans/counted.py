"""Fits on counted rows: equal (features, label) rows become one row with their number.

``LogisticRegression``, ``LinearSVC`` and the forest take weights, but read them as
reliabilities (``CountedLR``, ``CountedSVC``) or bag them whole (``CountedRF``); the
perceptron and the factorization machine take none (``CountedMLP``, ``CountedFM``).  The
classes here keep Spark's parameters, starting weights and models, and give the fit of the
rows that the counts stand for.

The last two minimise Spark's own objective, the mean loss over all rows: every evaluation
is one Spark job that sums loss and gradient over blocks of counted rows.  Without equal
rows the blocks hold the rows themselves, so memory per task stays bounded either way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import (
    FMClassificationModel,
    FMClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Counted rows in one part, and in one block of a part.
PART_ROWS = 200_000
BLOCK_ROWS = 20_000


def count_rows(df: DataFrame, features_col: str = "features", label_col: str = "label",
               keys=(), weight_col: str = "weight", counts: str | None = None) -> DataFrame:
    """One row per distinct (keys, features, label) with the number of its rows, or the sum
    of ``counts`` where the rows have been counted before."""
    n = F.sum(counts) if counts else F.count(F.lit(1))
    return (df.groupBy(*keys, label_col, vector_to_array(features_col).alias("_values"))
            .agg(n.cast("double").alias(weight_col))
            .withColumn(features_col, array_to_vector("_values")).drop("_values"))


def in_parts(counted: DataFrame) -> DataFrame:
    """Persisted, in as many parts as its number of rows asks for."""
    held = counted.persist(StorageLevel.MEMORY_AND_DISK)
    return held.coalesce(max(1, -(-held.count() // PART_ROWS)))


# Spark's estimators that take weights -----------------------------------------------

def deviation_factor(df: DataFrame, weight_col: str) -> float:
    """Spark's deviations of weighted rows over those of the rows that they stand for.

    Weighted sums of squares are divided by W - sum(w^2) / W instead of W - 1, for
    every feature alike.
    """
    w = F.col(weight_col)
    total, squares = df.agg(F.sum(w), F.sum(w * w)).first()
    if not total or total <= 1 or total * total <= squares:
        return 1.0
    return float(np.sqrt((total - 1) / (total - squares / total)))


class CountedLR(LogisticRegression):
    """Logistic regression whose penalty is that of the counted rows."""

    def _fit(self, dataset):
        if not (self.isSet("weightCol") and self.getStandardization() and self.getRegParam()):
            return super()._fit(dataset)
        c = deviation_factor(dataset, self.getWeightCol())
        mix, reg = self.getElasticNetParam(), self.getRegParam()
        l1, l2 = reg * mix / c, reg * (1 - mix) / c ** 2
        plain = LogisticRegression._fit(
            self.copy({self.regParam: l1 + l2, self.elasticNetParam: l1 / (l1 + l2)}), dataset)
        return self._copyValues(plain)


class CountedSVC(LinearSVC):
    """Linear SVM whose penalty is that of the counted rows."""

    def _fit(self, dataset):
        if not (self.isSet("weightCol") and self.getStandardization() and self.getRegParam()):
            return super()._fit(dataset)
        c = deviation_factor(dataset, self.getWeightCol())
        return self._copyValues(LinearSVC._fit(
            self.copy({self.regParam: self.getRegParam() / c ** 2}), dataset))


class CountedRF(RandomForestClassifier):
    """Forest whose bags hold parts of a counted row's rows."""

    def _fit(self, dataset):
        if self.isSet("weightCol") and self.getBootstrap():
            from riskframe.plans.patterns import BAG_PARTS, deal
            dataset = deal(dataset, BAG_PARTS, self.getWeightCol())
        return super()._fit(dataset)


# Estimators without weights ---------------------------------------------------------

Block = tuple[np.ndarray, np.ndarray, np.ndarray]  # features, labels, counts
Sums = tuple[float, np.ndarray]  # loss, gradient


def _block(rows: list) -> Block:
    x, y, n = zip(*rows)
    return np.array(x, float), np.array(y, float), np.array(n, float)


def _blocks(rows: Iterable) -> Iterator[Block]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == BLOCK_ROWS:
            yield _block(held)
            held = []
    if held:
        yield _block(held)


class _Counted:
    """Equal rows counted once, then one job per evaluation of the mean loss."""

    #: A column with counts, where the rows have been counted before.
    counts_col: str | None = None

    def _counted(self, dataset: DataFrame) -> DataFrame:
        return count_rows(dataset, self.getFeaturesCol(), self.getLabelCol(),
                          counts=self.counts_col)

    def _mean_loss(self, blocks: RDD, sums: Callable[[Block, np.ndarray], Sums]):
        total = blocks.map(lambda b: float(b[2].sum())).sum()

        def evaluate(w: np.ndarray) -> Sums:
            loss, gradient = blocks.map(lambda b: sums(b, w)).treeReduce(
                lambda a, b: (a[0] + b[0], a[1] + b[1]))
            return loss / total, gradient / total

        return evaluate

    def _minimised(self, dataset: DataFrame, minimise: Callable) -> object:
        counted = self._counted(dataset)
        held = in_parts(counted)
        blocks = held.select(vector_to_array(self.getFeaturesCol()),
                             F.col(self.getLabelCol()).cast("double"), "weight") \
            .rdd.mapPartitions(_blocks).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return minimise(held, blocks)
        finally:
            blocks.unpersist()
            counted.unpersist()


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def _converged(old: np.ndarray, new: np.ndarray, tol: float) -> bool:
    return np.linalg.norm(old - new) < tol * max(np.linalg.norm(new), 1.0)


def descend(evaluate: Callable, w: np.ndarray, steps: int, size: float, reg: float,
            tol: float, shrink: bool = True) -> np.ndarray:
    """Gradient steps as Spark's ``gd``: those of factorization machines shrink with the
    root of their number, the perceptron's are all alike."""
    for i in range(1, steps + 1):
        step, old = size / np.sqrt(i) if shrink else size, w
        w = w * (1 - step * reg) - step * evaluate(w)[1]
        if _converged(old, w, tol):
            break
    return w


def adam(evaluate: Callable, w: np.ndarray, steps: int, size: float, reg: float,
         tol: float) -> np.ndarray:
    """Adam with decoupled decay, as Spark's ``adamW``."""
    m = v = np.zeros_like(w)
    for i in range(1, steps + 1):
        g, old = evaluate(w)[1], w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - size * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.999 ** i)) + 1e-8) - reg * w
        if _converged(old, w, tol):
            break
    return w


def lbfgs(evaluate: Callable, w: np.ndarray, steps: int, tol: float,
          memory: int = 10) -> np.ndarray:
    """Limited-memory BFGS with a bracketing search for the weak Wolfe conditions."""
    loss, g = evaluate(w)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, told = g.copy(), []
        for s, y in reversed(pairs):
            a = s @ q / (s @ y)
            q -= a * y
            told.append(a)
        if pairs:
            s, y = pairs[-1]
            q *= s @ y / (y @ y)
        for (s, y), a in zip(pairs, reversed(told)):
            q += (a - y @ q / (s @ y)) * s
        slope = -(g @ q)
        if slope >= 0:
            break
        low, high, t = 0.0, np.inf, 1.0 if pairs else 1 / np.linalg.norm(g)
        for _ in range(20):
            new = w - t * q
            new_loss, new_g = evaluate(new)
            if not new_loss <= loss + 1e-4 * t * slope:
                high = t
            elif -(new_g @ q) < 0.9 * slope:
                low = t
            else:
                break
            t = (low + high) / 2 if np.isfinite(high) else 2 * t
        if not new_loss < loss:
            break
        s, y = new - w, new_g - g
        if s @ y > 1e-12 * (y @ y):
            pairs = [*pairs, (s, y)][-memory:]
        gain = loss - new_loss
        w, loss, g = new, new_loss, new_g
        if gain <= tol * max(abs(loss), 1e-6) or np.linalg.norm(g) <= 1e-12:
            break
    return w


def fm_sums(k: int, linear: bool, intercept: bool) -> Callable[[Block, np.ndarray], Sums]:
    """Logistic loss and gradient of a factorization machine of ``k`` factors."""
    def sums(block: Block, w: np.ndarray) -> Sums:
        x, y, n = block
        d = x.shape[1]
        v = w[:d * k].reshape(d, k)
        s, squares = x @ v, x * x
        raw = 0.5 * (s * s - squares @ (v * v)).sum(axis=1)
        if linear:
            raw = raw + x @ w[d * k:d * k + d]
        if intercept:
            raw = raw + w[-1]
        off = n * (_sigmoid(raw) - y)
        parts = [((x * off[:, None]).T @ s - v * (off @ squares)[:, None]).ravel()]
        if linear:
            parts.append(off @ x)
        if intercept:
            parts.append(np.array([off.sum()]))
        return float(n @ (np.logaddexp(0, raw) - y * raw)), np.concatenate(parts)
    return sums


class CountedFM(_Counted, FMClassifier):
    """Factorization machine fitted on counted rows.

    Steps on samples of the rows (``miniBatchFraction`` under 1) are left to Spark.
    """

    def _fit(self, dataset):
        if self.getMiniBatchFraction() < 1:
            if self.counts_col:
                raise ValueError("counted rows cannot be sampled: fit on the rows")
            return super()._fit(dataset)
        return self._minimised(dataset, self._train)

    def _train(self, held: DataFrame, blocks: RDD):
        start = FMClassifier._fit(self.copy({self.maxIter: 0}), held)  # Spark's first weights
        d, k = start.numFeatures, self.getFactorSize()
        linear, intercept = self.getFitLinear(), self.getFitIntercept()
        w = np.concatenate([start.factors.toArray().ravel(),
                            start.linear.toArray() if linear else [],
                            [start.intercept] if intercept else []])
        step = adam if self.getSolver() == "adamW" else descend
        w = step(self._mean_loss(blocks, fm_sums(k, linear, intercept)), w, self.getMaxIter(),
                 self.getStepSize(), self.getRegParam(), self.getTol())
        java = JavaWrapper._new_java_obj(
            "org.apache.spark.ml.classification.FMClassificationModel", self.uid,
            float(w[-1]) if intercept else 0.0,
            _java(held, Vectors.dense(w[d * k:d * k + d] if linear else np.zeros(d))),
            _java(held, DenseMatrix(d, k, w[:d * k].reshape(d, k).ravel("F").tolist())))
        return self._copyValues(FMClassificationModel(java))


def _java(df: DataFrame, value):
    from pyspark.ml.common import _py2java
    return _py2java(df.sparkSession.sparkContext, value)


def mlp_sums(layers: list[int]) -> Callable[[Block, np.ndarray], Sums]:
    """Cross-entropy and gradient of sigmoid layers under a softmax."""
    def sums(block: Block, w: np.ndarray) -> Sums:
        x, y, n = block
        told, mats, at = [x], [], 0
        for i, (a, b) in enumerate(zip(layers, layers[1:])):
            mats.append(w[at:at + a * b].reshape(a, b))  # Spark: column-major, b x a
            z = told[-1] @ mats[-1] + w[at + a * b:at + a * b + b]
            at += a * b + b
            told.append(_sigmoid(z) if i < len(layers) - 2 else z)
        z = told[-1] - told[-1].max(axis=1, keepdims=True)
        logs = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
        own = np.eye(layers[-1])[y.astype(int)]
        loss = -float(n @ (logs * own).sum(axis=1))
        delta, parts = n[:, None] * (np.exp(logs) - own), []
        for i in range(len(mats) - 1, -1, -1):
            parts.insert(0, np.concatenate([(told[i].T @ delta).ravel(), delta.sum(axis=0)]))
            if i:
                delta = (delta @ mats[i].T) * told[i] * (1 - told[i])
        return loss, np.concatenate(parts)
    return sums


class CountedMLP(_Counted, MultilayerPerceptronClassifier):
    """Perceptron fitted on counted rows."""

    def _fit(self, dataset):
        return self._minimised(dataset, self._train)

    def _train(self, held: DataFrame, blocks: RDD):
        at = lambda **more: MultilayerPerceptronClassifier._fit(
            self.copy({self.maxIter: 0, **{self.getParam(k): v for k, v in more.items()}}), held)
        w = at().weights.toArray()  # Spark's first weights
        evaluate = self._mean_loss(blocks, mlp_sums(list(self.getLayers())))
        if self.getSolver() == "gd":
            w = descend(evaluate, w, self.getMaxIter(), self.getStepSize(), 0.0, self.getTol(),
                        shrink=False)
        else:
            w = lbfgs(evaluate, w, self.getMaxIter(), self.getTol())
        return self._copyValues(at(initialWeights=Vectors.dense(w)))
