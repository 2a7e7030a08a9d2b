"""Integer k-means against a plain loop over all centroids."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import clusters
from tests.llm import corpora

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_clusters(rows, count=40, rounds=5, dim=64):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in e]) for i, e, *_ in rows
            if e is not None and len(e) == dim
            and all(x is not None and math.isfinite(x) for x in e)]
    name = lambda v: hashlib.sha256(f"2:{v[0]}".encode()).hexdigest()
    cents = [e for _, e in sorted(kept, key=lambda v: (v[0] is None, name(v), v))[:count]]

    def nearest(e):
        return min((sum((a - b) ** 2 for a, b in zip(e, c)), k) for k, c in enumerate(cents))

    for _ in range(rounds):
        groups = {}
        for _, e in kept:
            groups.setdefault(nearest(e)[1], []).append(e)
        cents = [[sum(col) // len(groups[k]) for col in zip(*groups[k])] if k in groups else c
                 for k, c in enumerate(cents)]
    told = [(i, *nearest(e)[::-1]) for i, e in kept]
    inertia = {}
    for _, k, d in told:
        inertia[k] = inertia.get(k, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return [(i, k, d, inertia[k], sum(inertia.values()), digest[k]) for i, k, d in told]


def awkward_vectors(n=70, dim=64):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(dim)], 0) for i in range(n)]
    rows += [(n, None, 1), (n + 1, [0.5] * (dim - 1), 1), (n + 2, [], 1),
             (n + 3, [None] + [0.5] * (dim - 1), 1), (n + 4, [float("nan")] * dim, 1),
             (n + 5, [float("inf")] + [0.0] * (dim - 1), None), (n + 6, [0.0] * dim, 2),
             (n + 7, [300.25] * dim, 2)]
    rows += [rows[3], rows[3], (4, rows[5][1], 0), (None, rows[6][1], 0), (n + 8, [0.0] * dim, 3)]
    return rows


def as_tuples(df):
    return sorted(tuple(r) for r in df.na.fill({"vec_id": -1}).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect())


@pytest.mark.parametrize("count, rounds, leading", [(40, 5, 16), (3, 2, 1), (200, 1, 64)])
def test_clusters_match_plain_rounds(spark, count, rounds, leading):
    rows = awkward_vectors()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    clashing = frame.select("*", *[F.lit("x").alias(c) for c in (
        "whole", "leading", "residual", "cluster", "distance", "told")])
    found = clusters.cluster_vectors(clashing, count, rounds, leading=leading)
    want = plain_clusters(rows, count, rounds)
    assert as_tuples(found) == sorted((-1 if w[0] is None else w[0], *w[1:]) for w in want)


def test_given_vectors_match_plain_rounds(spark):
    rows = corpora.given_rows("embeddings", "vec_id, embedding, label")
    frame = spark.createDataFrame(rows, SCHEMA)
    assert as_tuples(clusters.cluster_vectors(frame)) == sorted(plain_clusters(rows))


def test_bounds_never_rule_out_the_nearest_and_do_rule_out_most():
    rng = np.random.default_rng(6)
    spread = rng.standard_normal((64, 64)) @ np.diag(2.0 ** -np.arange(64)) * 200
    centres = rng.standard_normal((40, 64)) @ spread.T
    whole = np.floor(centres[rng.integers(0, 40, 4000)]
                     + rng.standard_normal((4000, 64)) @ spread.T * 0.2).astype(np.int64)
    axes = np.linalg.eigh(np.cov(whole.T))[1][:, ::-1]
    cents = clusters.Centroids.of(np.floor(centres).astype(np.int64), axes)
    number, distance, verified = cents.nearest(whole, *clusters.rotate(whole, axes, 16))
    apart = whole[:, None, :] - cents.whole[None]
    exact = (apart ** 2).sum(axis=2)
    assert (number == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert verified < 4000 * 40 / 4


def test_large_components_count_as_the_largest_and_none_crashes(spark):
    rows = [(i, [(-1.0) ** i * 3e38] * 64, 0) for i in range(4)] + [(9, [0.0] * 64, 0)]
    out = clusters.cluster_vectors(spark.createDataFrame(rows, SCHEMA), 2, 3).collect()
    assert len(out) == 5 and all(0 <= r.distance < 1 << 62 and r.inertia > 0 for r in out)


def test_no_vectors_no_clusters(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert clusters.cluster_vectors(empty).count() == 0
    unusable = spark.createDataFrame([(1, None, 0), (2, [1.0], 0)], SCHEMA)
    assert clusters.cluster_vectors(unusable).count() == 0
