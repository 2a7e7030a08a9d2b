"""Mixing to target weights with soft domain membership.

A classifier fitted on a labelled table gives every document posteriors over
the domains; domain k then holds sum over documents of rate * tokens *
posterior_k expected tokens.  Nonnegative rates are fitted by projected least
squares so that these totals meet the targets, as near as can be to rate 1 for
every document (distances between rates weighted by tokens, so a rate depends
on what a document is, not on its length).

Those rates are ``1 - posterior . g`` cut at zero, with one number of ``g`` per
domain, and ``g`` is found by Newton steps on the dual: each pass is one
aggregate over the posteriors' table that sums, for a handful of lengths of the
step, the domains' totals and their curvature (domains x domains numbers).  No
rates are shuffled or collected.  Passes end when every total is within
``TOLERANCE`` of its target; targets that no rates reach raise ``TargetsNotMet``
with what is missing, and in the pipeline warn of it and take the nearest step.

The classifier's features are the distinct token ids of a text and its look, so
a text is tokenised once, for its length and its domain.

Defined results: null or empty text has one token at least and posteriors like
any other; a very long text is one document, read whole; a domain missing from
the labelled table gets no posterior, and the rates then come as near to its
target as they can, with the miss told in ``missed_<domain>``; equal posteriors
get equal rates; repeated rows count as often as they occur; without labelled
rows every domain is equally likely; an empty table gives no rows; extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import keyed, materialize, row_key, text_bytes
from riskframe.llm.tokens import default_vocabulary, encoder

MAX_LABELLED = 12_000
VOCABULARY = 4096
LEAST_DOCUMENTS = 5
PASSES = 40
TOLERANCE = 1e-4
#: Parts of a Newton step that one pass tries.
TRIED = np.array([1, 0.5, 0.25, 0.125, 0.05, 0.01])
HASH_RANGE = 1 << 20
UPPER = bytes(range(65, 91))

#: Target shares of expected tokens by domain.
TARGETS = {"clean": 0.98, "low": 0.01, "toxic": 0.01}


def domain_of_labels(labels: DataFrame) -> DataFrame:
    """doc_id and domain of the labelled table: toxic before low before clean."""
    return labels.where(F.col("doc_id").isNotNull()).select(
        "doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low")
        .when((F.col("toxic") == 0) & (F.col("quality") == 1), "clean").alias("domain")
    ).where("domain is not null").dropDuplicates(["doc_id"])


def shape(raw: bytes, n_tokens: int, n_distinct: int) -> list[float]:
    """Features of a text's look, beside its tokens."""
    n, size = max(1, n_tokens), max(1, len(raw))
    return [float(np.log1p(n_tokens)) / 10, 1 - n_distinct / n, n / size,
            (size - len(raw.translate(None, UPPER))) / size,
            min(1.0, sum(map(raw.count, b"#*$%&|<>")) / n), min(1.0, raw.count(b"!") / n)]


N_SHAPE = len(shape(b"", 0, 0))


def token_features(raw: bytes) -> tuple[int, np.ndarray, list[float]]:
    """Number of tokens, distinct token ids in order, and shape of one text."""
    ids = encoder(default_vocabulary())(raw.decode("utf-8", "replace"))
    distinct = np.unique(np.asarray(ids, np.int64))
    return len(ids), distinct, shape(raw, len(ids), len(distinct))


@dataclass(frozen=True)
class DomainModel:
    """Linear scores per domain over token ids and shape features."""

    domains: tuple[str, ...]
    weights: np.ndarray  # token ids x domains; zero outside the vocabulary
    look: np.ndarray  # shape features x domains
    intercepts: np.ndarray

    def posteriors(self, raw: bytes) -> tuple[np.ndarray, int]:
        """Domain probabilities and number of tokens of one text."""
        n_tokens, distinct, look = token_features(raw)
        known = distinct[:np.searchsorted(distinct, len(self.weights))]
        scores = self.intercepts + self.weights[known].sum(axis=0) + look @ self.look
        odds = np.exp(scores - scores.max())
        return odds / odds.sum(), n_tokens


def fit_domain_model(docs: DataFrame, labelled: DataFrame, domains: tuple[str, ...],
                     max_labelled: int = MAX_LABELLED, vocabulary: int = VOCABULARY) -> DomainModel:
    """Multinomial logistic regression on a bounded sample of labelled documents."""
    total = labelled.count()
    share = min(HASH_RANGE, int(HASH_RANGE * max_labelled / max(1, total)))
    sample = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(HASH_RANGE)) < share) \
        .where(F.col("domain").isin(*domains))
    # Broadcast: at most about ``max_labelled`` ids, whatever the corpus.
    rows = materialize(docs.select("doc_id", text_bytes().alias("raw"))
                       .join(F.broadcast(sample), "doc_id").select("raw", "domain"), "labelled")

    def token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, domain in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n_tokens, distinct, look = token_features(raw)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([distinct], pa.list_(pa.int64())),
                     pa.array([look], pa.list_(pa.float64())), pa.array([domain])],
                    names=["ids", "look", "domain"])

    told = materialize(rows.mapInArrow(token_rows, "ids array<long>, look array<double>, "
                                                   "domain string"), "domain-tokens")
    sizes = {r["domain"]: r["n"] for r in
             told.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = (told.select(F.explode("ids").alias("id"), "domain")
              .groupBy("id").agg(F.count(F.lit(1)).alias("n"), *[
                  F.count(F.when(F.col("domain") == d, 1)).alias(f"n_{i}")
                  for i, d in enumerate(domains)]).where(F.col("n") >= LEAST_DOCUMENTS))
    # Tokens by how far their share in one domain is from that in the others, in
    # standard errors.
    total, gaps = sum(sizes.values()), [F.lit(0.0)]
    for i, d in enumerate(domains):
        inside, outside = sizes.get(d, 0), total - sizes.get(d, 0)
        if inside and outside:
            share = F.col("n") / total
            error = F.sqrt(share * (1 - share + 1 / total) * (1 / inside + 1 / outside))
            gaps.append(F.abs(F.col(f"n_{i}") / inside
                              - (F.col("n") - F.col(f"n_{i}")) / outside) / error)
    telling = F.greatest(*gaps, F.lit(0.0))
    common = counts.orderBy(telling.desc(), "id").limit(vocabulary).collect()
    ids = sorted(r["id"] for r in common)
    present = sorted(sizes)
    weights = np.zeros((ids[-1] + 1 if ids else 0, len(domains)))
    look = np.zeros((N_SHAPE, len(domains)))
    if len(present) < 2:
        scores = np.array([0.0 if not present or d in present else -60.0 for d in domains])
        return DomainModel(domains, weights, look, scores)

    n = len(ids) + N_SHAPE
    place = {token: i for i, token in enumerate(ids)}

    @F.udf(VectorUDT())
    def sparse(found, shown):
        at = [place[i] for i in found if i in place]
        return Vectors.sparse(n, at + list(range(len(ids), n)), [1.0] * len(at) + shown)

    # The sample is bounded, so one row-at-a-time function builds its sparse vectors.
    code = F.array_position(F.array(*[F.lit(d) for d in present]), F.col("domain")) - 1
    train = materialize(told.select(sparse("ids", "look").alias("features"),
                                    code.cast("double").alias("label")), "domain-features")
    model = LogisticRegression(family="multinomial", maxIter=60, regParam=2e-5,
                               standardization=False).fit(train)
    intercepts = np.full(len(domains), -60.0)
    for i, domain in enumerate(present):
        fitted = model.coefficientMatrix.toArray()[i]
        weights[ids, domains.index(domain)] = fitted[:len(ids)]
        look[:, domains.index(domain)] = fitted[len(ids):]
        intercepts[domains.index(domain)] = model.interceptVector[i]
    return DomainModel(domains, weights, look, intercepts)


def _told_columns(told: list[tuple[np.ndarray, int]]) -> list[pa.Array]:
    return [pa.array([max(1, n) for _, n in told], pa.int64()),
            pa.array([p.tolist() for p, _ in told], pa.list_(pa.float64()))]


def domain_posteriors(docs: DataFrame, model: DomainModel) -> DataFrame:
    """key_id, key_hash, doc_id, n_tokens (at least 1), posterior (array), per row."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [model.posteriors(raw) for raw in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:3] + _told_columns(told),
                names=["key_id", "key_hash", "doc_id", "n_tokens", "posterior"])

    return keyed(docs).mapInArrow(kernel, "key_id long, key_hash long, doc_id long, "
                                          "n_tokens long, posterior array<double>")


def rates_after(posteriors: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Rates of rows with these posteriors after all projected steps."""
    rates = np.ones(len(posteriors))
    for step in steps:
        rates = np.maximum(0.0, rates - posteriors @ step)
    return rates


def _posterior_rows(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("posterior")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class TargetsNotMet(ValueError):
    """No rates were found that meet the targets; ``steps`` come nearest to them."""

    def __init__(self, steps: np.ndarray, residual: np.ndarray, budget: float):
        shares = ", ".join(f"{share:+.3g}" for share in residual / max(budget, 1.0))
        super().__init__(f"targets not met: domain totals miss them by {shares} of the budget")
        self.steps, self.residual, self.budget = steps, residual, budget


def domain_totals(members: DataFrame, states: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per state (a row): expected tokens per domain, their curvature, and the tokens'
    squared rates, of rates ``1 - posterior . state`` cut at zero."""
    n_states, n_domains = states.shape
    width = n_domains + n_domains ** 2 + 1

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((n_states, width))
        for batch in batches:
            if not batch.num_rows:
                continue
            posteriors = _posterior_rows(batch)
            tokens = batch.column("n_tokens").to_numpy().astype(np.float64)
            for i, state in enumerate(states):
                rates = rates_after(posteriors, state[None])
                moving = posteriors * (tokens * (rates > 0))[:, None]
                sums[i] += np.concatenate([(rates * tokens) @ posteriors,
                                           (moving.T @ posteriors).ravel(),
                                           [tokens @ rates ** 2]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(n_states * width), pa.int32()), pa.array(sums.ravel())],
            names=["place", "value"])

    rows = (members.select("n_tokens", "posterior").mapInArrow(kernel, "place int, value double")
            .groupBy("place").agg(F.sum("value")).collect())
    totals = np.zeros(n_states * width)
    for place, value in rows:
        totals[place] = value
    totals = totals.reshape(n_states, width)
    return (totals[:, :n_domains],
            totals[:, n_domains:-1].reshape(n_states, n_domains, n_domains), totals[:, -1])


def fit_rate_steps(members: DataFrame, shares: list[float], anchor: int | None = None,
                   passes: int = PASSES, tolerance: float = TOLERANCE) -> np.ndarray:
    """The step from rate 1 that brings domain totals to the target shares.

    The token budget is all tokens.  With ``anchor`` it is the budget in which that
    domain's share is what it holds now, and no domain is asked for more than it
    holds: surplus domains shrink, and no rare document is repeated for another's sake.

    Raises ``TargetsNotMet``, with the nearest step found, when the totals are not
    within ``tolerance`` of the budget after ``passes``.
    """
    weights = np.array(shares, np.float64) / sum(shares)
    n = len(weights)
    state = np.zeros(n)
    held, curvature, _ = (x[0] for x in domain_totals(members, state[None]))
    budget = held.sum() if anchor is None else held[anchor] / weights[anchor]
    wanted = budget * weights if anchor is None else np.minimum(budget * weights, held)
    near = tolerance * max(budget, 1.0)
    best, least = state, held - wanted
    for _ in range(passes):
        residual = held - wanted
        if np.abs(residual).max() < np.abs(least).max():
            best, least = state, residual
        if np.abs(residual).max() <= near:
            break
        # Domains that no moving token belongs to are left alone by the ridge.
        ridge = 1e-12 * max(np.trace(curvature), budget) * np.eye(n)
        tried = state + TRIED[:, None] * np.linalg.solve(curvature + ridge, residual)
        helds, curvatures, squared = domain_totals(members, tried)
        # The dual of the least squares falls on the way to the targets.
        pick = int(np.argmin(squared / 2 + tried @ wanted))
        if np.abs(helds[0] - wanted).max() <= np.abs(residual).max() / 2:
            pick = 0
        state, held, curvature = tried[pick], helds[pick], curvatures[pick]
    residual = held - wanted
    if np.abs(residual).max() > near:
        if np.abs(residual).max() < np.abs(least).max():
            best, least = state, residual
        raise TargetsNotMet(best[None], least, budget)
    return state[None]


def rate_column(steps: np.ndarray, posterior: str = "posterior") -> Column:
    """The rate of each row from its posteriors."""
    rate = F.lit(1.0)
    for step in steps:
        down = [F.col(posterior)[i] * F.lit(float(g)) for i, g in enumerate(step)]
        rate = F.greatest(F.lit(0.0), rate - sum(down[1:], down[0]))
    return rate


def fit_mixture(docs: DataFrame, labelled: DataFrame, targets: dict[str, float],
                anchor: str | None = None, train_docs: DataFrame | None = None) -> DataFrame:
    """Posteriors and fitted rate of every document of ``docs``.

    ``missed_<domain>``: by how much of the budget its expected tokens miss the
    target; zero where every target is met to within the tolerance.
    """
    domains = tuple(targets)
    model = fit_domain_model(docs if train_docs is None else train_docs, labelled, domains)
    members = materialize(domain_posteriors(docs, model), "domain-posteriors")
    missed = np.zeros(len(domains))
    try:
        steps = fit_rate_steps(members, list(targets.values()),
                               None if anchor is None else domains.index(anchor))
    except TargetsNotMet as nearest:
        steps, missed = nearest.steps, nearest.residual / max(nearest.budget, 1.0)
    return members.select("*", rate_column(steps).alias("rate"), *[
        F.lit(float(share)).alias(f"missed_{d}") for d, share in zip(domains, missed)])


def thin_to_targets(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS,
                    anchor: str = "clean", train_docs: DataFrame | None = None,
                    seed: int = 17) -> DataFrame:
    """The rows of ``docs`` drawn at their rates, none more than once.

    A row is drawn when a uniform number made from its key's hash is below its rate,
    so equal rows are drawn alike and a rerun draws the same rows.  Each text is
    classified once: its row is written beside its posteriors and drawn from there.
    """
    domains = tuple(targets)
    model = fit_domain_model(docs if train_docs is None else train_docs, labelled, domains)
    uniform = F.pmod(F.xxhash64(*row_key(docs), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
                       uniform.alias("uniform"), F.lit(0).cast("long").alias("n_tokens"),
                       F.array().cast("array<double>").alias("posterior"))
    at = docs.columns.index("text")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).field(at).cast(pa.string()).cast(pa.binary()).to_pylist()
            told = [model.posteriors(raw or b"") for raw in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *_told_columns(told)],
                names=["row", "uniform", "n_tokens", "posterior"])

    members = materialize(rows.mapInArrow(kernel, rows.schema), "classified-documents")
    try:
        steps = fit_rate_steps(members, list(targets.values()), domains.index(anchor))
    except TargetsNotMet as missed:
        warnings.warn(str(missed), stacklevel=2)
        steps = missed.steps
    return members.where(F.col("uniform") < rate_column(steps)).select("row.*")
