"""Embedding near-dedup against all pairs, and its recall calibration."""

import math

import numpy as np

from riskframe.llm import vectors
from tests.llm import corpora

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, threshold=0.98):
    usable = [i for i, (_, e, label) in enumerate(rows)
              if label is not None and e and all(x is not None and math.isfinite(x) for x in e)
              and any(e)]
    links, count = [], [0] * len(rows)
    for n, i in enumerate(usable):
        x = np.array(rows[i][1], np.float64)
        for j in usable[n + 1:]:
            if rows[i][2] != rows[j][2] or len(rows[j][1]) != len(x):
                continue
            y = np.array(rows[j][1], np.float64)
            if x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                links.append((i, j))
                count[i] += 1
                count[j] += 1
    roots = corpora.components(range(len(rows)), links)
    least = {}
    for i, r in roots.items():
        ids = [v for v in (least.get(r), rows[i][0]) if v is not None]
        least[r] = min(ids) if ids else None
    return [(rows[i][0], count[i], least[roots[i]]) for i in range(len(rows))]


def planted_rows(n=500, dim=48, seed=11):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((40, dim))
    rows = []
    for i in range(n):
        noise = rng.standard_normal(dim) * rng.choice([0, 0.05, 0.1, 0.15, 0.3])
        x = np.float32((centres[rng.integers(0, 40)] + noise) * rng.choice([1, 0.01, 50]))
        rows.append((i, x.tolist(), int(rng.choice([0, 0, 0, 1, 2]))))
    unit = np.zeros(dim, np.float32)
    odd = [(900, None, 0), (901, [], 0), (902, [0.0] * dim, 0), (903, [None] * dim, 0),
           (904, [float("nan")] * dim, 0), (905, [float("inf")] + [1.0] * (dim - 1), 0),
           (906, rows[0][1], None), (907, rows[1][1], rows[1][2]), (907, rows[1][1], rows[1][2]),
           (None, rows[2][1], rows[2][2]), (908, [1.0, 2.0], 0), (909, [2.0, 4.0], 0),
           (910, (unit + 1).tolist(), 1), (911, (-(unit + 1)).tolist(), 1)]
    return rows + odd


def results(df):
    return sorted(map(repr, ((r.vec_id, r.n_links, r.component_id) for r in df.collect())))


def test_links_and_components_match_all_pairs(spark):
    rows = planted_rows()
    frame = spark.createDataFrame(rows, SCHEMA)
    found = vectors.near_duplicate_vectors(frame)
    assert results(found) == sorted(map(repr, plain(rows)))
    assert found.where("kept and vec_id <> component_id").count() == 0


def test_many_small_blocks_give_the_same_result(spark):
    rows = planted_rows(seed=12)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert results(vectors.near_duplicate_vectors(frame, block_rows=16)) == \
        sorted(map(repr, plain(rows)))


def test_given_vectors_match_all_pairs(spark):
    rows = corpora.given_rows("embeddings", "vec_id, embedding, label")
    frame = spark.read.parquet(f"{corpora.SMALL}/embeddings.parquet")
    assert results(vectors.near_duplicate_vectors(frame)) == sorted(map(repr, plain(rows)))


def test_recall_at_the_threshold():
    """Pairs exactly at the threshold collide often enough; unrelated ones do not."""
    rng = np.random.default_rng(0)
    x = vectors.unit(rng.standard_normal((4000, 64)))
    away = rng.standard_normal((4000, 64))
    away = vectors.unit(away - (away * x).sum(1, keepdims=True) * x)
    at = vectors.THRESHOLD
    y = at * x + math.sqrt(1 - at * at) * away
    lines = vectors.random_lines(64)

    def found(a, b):
        apart = np.abs(a @ lines - b @ lines)
        first = vectors.SORTED_LINES
        counted = (apart[:, first:] <= vectors.window(at)).sum(axis=1)
        return (apart[:, :first] <= vectors.window(at, vectors.SORTED_REACH)).all(axis=1) \
            & (counted >= vectors.needed_collisions())

    assert found(x, y).mean() >= 0.9995
    assert found(x, away).mean() < 0.001


def test_pairs_are_those_that_collide(monkeypatch):
    """The sweep over sorted runs with its early drops equals counting every pair."""
    rng = np.random.default_rng(8)
    first = vectors.SORTED_LINES
    a = rng.standard_normal((300, first + 24))
    b = rng.standard_normal((200, first + 24)) * 0.6
    b[:40] = a[:40]
    apart = np.abs(a[:, None, :] - b[None, :, :])
    want = (apart[..., :first] <= 0.9).all(axis=2) & ((apart[..., first:] <= 0.6).sum(axis=2) >= 9)
    for at_once in (1 << 21, 50):
        monkeypatch.setattr(vectors, "PAIRS_AT_ONCE", at_once)
        got = [(int(i), int(j)) for left, right in vectors.colliding_pairs(a, b, 0.9, 0.6, 9)
               for i, j in zip(left, right)]
        assert len(got) == len(set(got)) > 50
        assert set(got) == set(map(tuple, np.argwhere(want).tolist()))


def test_sorted_lines_leave_a_part_of_the_pairs():
    rows = vectors.unit(np.random.default_rng(4).standard_normal((3000, 64)))
    on_lines = rows @ vectors.random_lines(64)
    _, _, sizes = vectors.sorted_runs(on_lines, on_lines,
                                      vectors.window(vectors.THRESHOLD, vectors.SORTED_REACH))
    assert sizes.sum() < 0.3 * len(rows) ** 2


def test_no_vectors(spark):
    assert vectors.near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_extra_columns_are_ignored(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(planted_rows(60), SCHEMA)
    extra = frame.select("*", F.lit(1).alias("n_links"), F.lit(2).alias("node"))
    assert results(vectors.near_duplicate_vectors(extra)) == \
        results(vectors.near_duplicate_vectors(frame))
