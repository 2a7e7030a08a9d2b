"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is a linear function of features of its whole text.  For
a preference pair (better, worse) the Bradley-Terry model gives the better one
the odds exp(strength difference), so the weights minimise the logistic loss of
feature differences.  The score is the logistic of the strength minus a
threshold, the quantile of labelled strengths at the share of bad labels: as
many labelled documents of the training fold fall below 0.5 as are marked bad.

The weights are fitted on a bounded sample of labelled rows (``max_labelled``,
chosen by a hash of the id), which reaches the documents by a broadcast.  The
threshold is of all labelled rows of the training fold: one map over the texts
leaves ids and strengths, labels are joined to those, and a distributed sort
ranks them.  Scoring reads every text, one map over rows.  No text is shuffled.

Defined results: null or empty text is scored like any other, and so is a very
long one, by features of all of it; a strength at the threshold scores 0.5; a
repeated id counts once for the threshold, with its lowest strength and label; without labelled
rows of both classes every score is 0.5; held-out rows and rows with a null
label never train; repeated rows get equal scores; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import materialize, text_bytes
from riskframe.llm.textstats import MEASURES, measure
from riskframe.operators.ordering import global_rank

MAX_LABELLED = 12_000
PARTNERS = 8
RIDGE = 1e-3
STEPS = 25
SEED = 90210
HASH_RANGE = 1 << 20


def features(raw: bytes) -> list[float]:
    """Scale-free features of one text."""
    m = dict(zip(MEASURES, measure(raw)))
    n, chars, lines = max(1, m["n_words"]), max(1, m["word_chars"]), max(1, m["n_lines"])
    size = max(1, len(raw))
    digits = sum(raw.count(d) for d in b"0123456789")
    stops = raw.count(b".") + raw.count(b",")
    ratios = [
        min(1.0, m["n_symbols"] / n / 3), m["n_dup_lines"] / lines, m["n_repeat_words"] / n,
        1 - m["n_distinct_words"] / n, m["n_upper"] / chars, min(1.0, m["n_bangs"] / n),
        min(1.0, digits / size * 4), min(1.0, stops / n), min(1.0, lines / n),
        min(1.0, raw.count(b"|") / n),
    ]
    return [np.log1p(m["n_words"]) / 10, float(m["n_words"] == 0), min(2.0, chars / n / 10),
            min(2.0, np.log1p(m["longest_word"]) / 5), *ratios, *np.sqrt(ratios)]


N_FEATURES = len(features(b""))


@dataclass(frozen=True)
class Ranker:
    """Weights over centred features and the strength at which a score is 0.5."""

    centre: np.ndarray
    weights: np.ndarray
    threshold: float

    def strengths(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.centre) @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        strength = self.strengths(rows) - self.threshold
        return 1 / (1 + np.exp(-np.clip(strength, -700, 700)))


def is_held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Rows kept from training: crc32 of the id as text, modulo ``folds``."""
    code = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(code % folds == fold, F.lit(False))


def training_labels(labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id and label (0 or 1) of the rows that may train."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)
                         & ~is_held_out(F.col("doc_id")))
            .select("doc_id", F.col(label).cast("int").alias("label")))


def labelled_features(docs: DataFrame, labels: DataFrame, label: str = "quality",
                      max_labelled: int = MAX_LABELLED) -> pd.DataFrame:
    """doc_id, label and features of at most about ``max_labelled`` training rows."""
    known = training_labels(labels, label)
    total = known.count()
    share = min(HASH_RANGE, int(HASH_RANGE * max_labelled / max(1, total)))
    sample = (known.where(F.pmod(F.xxhash64("doc_id"), F.lit(HASH_RANGE)) < share)
              .dropDuplicates(["doc_id"]))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(raw) for raw in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))],
                names=["doc_id", "label", "features"])

    # Broadcast: at most ``max_labelled`` ids, whatever the corpus.
    joined = docs.select("doc_id", text_bytes().alias("raw")).join(F.broadcast(sample), "doc_id")
    return (joined.select("doc_id", "label", "raw")
            .mapInArrow(kernel, "doc_id long, label int, features array<double>")
            .dropDuplicates(["doc_id"]).toPandas()
            .sort_values("doc_id", ignore_index=True))


def preference_pairs(good: np.ndarray, bad: np.ndarray, partners: int = PARTNERS,
                     seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Rows of which the first is to rank above the second.

    Every row of the rarer class meets several partners, every other row at least one.
    """
    rng = np.random.default_rng(seed)
    n = max(len(good), len(bad), partners * min(len(good), len(bad)))
    pick = lambda ids: rng.permutation(np.resize(ids, n))
    return pick(good), pick(bad)


def fit_ranker(sample: pd.DataFrame, partners: int = PARTNERS, ridge: float = RIDGE,
               steps: int = STEPS, seed: int = SEED) -> Ranker:
    """Bradley-Terry weights by Newton's method on preference pairs of the sample."""
    rows = np.array(sample["features"].tolist(), np.float64).reshape(-1, N_FEATURES)
    label = sample["label"].to_numpy()
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return Ranker(np.zeros(N_FEATURES), np.zeros(N_FEATURES), 0.0)
    preferred, other = preference_pairs(good, bad, partners, seed)
    differences, n = rows[preferred] - rows[other], len(preferred)
    weights = np.zeros(N_FEATURES)
    for _ in range(steps):
        lost = 1 / (1 + np.exp(np.clip(differences @ weights, -500, 500)))
        gradient = differences.T @ lost / n - ridge * weights
        curvature = (differences * (lost * (1 - lost))[:, None]).T @ differences / n
        step = np.linalg.solve(curvature + ridge * np.eye(N_FEATURES), gradient)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    centre = rows.mean(axis=0)
    strength = (rows - centre) @ weights
    return Ranker(centre, weights, float(np.quantile(strength, len(bad) / len(label))))


def score_column(model: Ranker, text_column: str = "text") -> Column:
    """The score of each row's text."""
    @F.pandas_udf("double")
    def score(raws: pd.Series) -> pd.Series:
        rows = np.array([features(raw) for raw in raws], np.float64).reshape(-1, N_FEATURES)
        return pd.Series(model.scores(rows))

    return score(text_bytes(text_column))


def labelled_threshold(docs: DataFrame, labels: DataFrame, model: Ranker,
                       label: str = "quality") -> float:
    """The quantile of all labelled strengths of the training fold at its share of bad labels.

    A repeated id counts once, with its lowest strength and label.
    """
    @F.pandas_udf("double")
    def strength(raws: pd.Series) -> pd.Series:
        rows = np.array([features(raw) for raw in raws], np.float64).reshape(-1, N_FEATURES)
        return pd.Series(model.strengths(rows))

    known = training_labels(labels, label).groupBy("doc_id").agg(F.min("label").alias("label"))
    # Written before the join, so that ids and strengths travel and no text does.
    told = materialize(docs.where(F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
                       .select("doc_id", strength(text_bytes()).alias("strength")), "strengths")
    both = materialize(told.groupBy("doc_id").agg(F.min("strength").alias("strength"))
                       .join(known, "doc_id"), "labelled-strengths")
    n, bad = both.agg(F.count(F.lit(1)), F.sum(1 - F.col("label"))).first()
    if not n:
        return model.threshold
    place = bad / n * (n - 1)
    low = int(place)
    near = sorted(r["strength"] for r in global_rank(both.select("strength"), ["strength"])
                  .where(F.col("rank").isin(low + 1, low + 2)).collect())
    return near[0] + (place - low) * (near[-1] - near[0])


def train_on(docs: DataFrame, labels: DataFrame, label: str = "quality", **how) -> Ranker:
    """Weights from the bounded sample, the threshold from all labelled training rows."""
    model = fit_ranker(labelled_features(docs, labels, label, **how))
    if not model.weights.any():
        return model
    return replace(model, threshold=labelled_threshold(docs, labels, model, label))


def score_documents(docs: DataFrame, model: Ranker) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document."""
    return (docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"),
                        score_column(model).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)))
