"""Every pipeline stage, and all of them in a row, against plain Python over the same models."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskframe.llm import mixing, quality_ranker, tokens
from riskframe.llm.common import materialize, read_table, row_key
from tests.llm import corpora
from tests.llm.test_documents import plain_lines, plain_print

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_quality(spark, rows, docs, sf_dir):
    ranker = quality_ranker.train_on(docs, read_table(spark, sf_dir, "labels"))
    scores = ranker.scores(np.array([quality_ranker.features((r[1] or "").encode())
                                     for r in rows]))
    return [r for r, s in zip(rows, scores) if s >= 0.5]


def plain_line_dedup(spark, rows, docs, sf_dir):
    out = []
    for row, (_, n_lines, n_removed, text) in zip(rows, plain_lines(rows)):
        if n_removed == 0:
            out.append(row)
        elif n_removed < n_lines:
            out.append((row[0], text, row[2], row[3], len(text)))
    return out


def plain_near_dedup(spark, rows, docs, sf_dir):
    prints = [plain_print(r[1]) for r in rows]
    distinct = sorted(set(prints))
    roots = corpora.components(distinct, [
        (a, b) for i, a in enumerate(distinct) for b in distinct[i:] if (a ^ b).bit_count() <= 4])
    best = {}
    for row, p in zip(rows, prints):
        place = (row[0] is None, row[0] or 0)
        best[roots[p]] = min(best.get(roots[p], (place, row)), (place, row),
                             key=lambda x: x[0])
    return [row for _, row in best.values()]


def plain_mix(spark, rows, docs, sf_dir):
    domains = mixing.domain_of_labels(read_table(spark, sf_dir, "labels"))
    model = mixing.fit_domain_model(read_table(spark, sf_dir, "documents"), domains,
                                    tuple(mixing.TARGETS))
    told = [model.posteriors((r[1] or "").encode()) for r in rows]
    posterior = np.array([p for p, _ in told])
    n_tokens = np.array([max(1, n) for _, n in told], float)
    shares = np.array(list(mixing.TARGETS.values()))
    budget = (n_tokens @ posterior)[0] / (shares[0] / shares.sum())
    wanted = np.minimum(budget * shares / shares.sum(), n_tokens @ posterior)
    members = spark.createDataFrame([(int(n), p.tolist()) for n, p in zip(n_tokens, posterior)],
                                    "n_tokens long, posterior array<double>")
    try:
        steps = mixing.fit_rate_steps(members, shares.tolist(), 0)
    except mixing.TargetsNotMet as nearest:  # nothing to compare the rates with
        rates = mixing.rates_after(posterior, nearest.steps)
    else:
        # The least squares' dual by plain scaled gradient steps, to the end.
        dual = np.zeros(len(shares))
        for _ in range(200_000):
            best = np.maximum(0, 1 - posterior @ dual)
            over = (best * n_tokens) @ posterior - wanted
            if np.abs(over).max() <= 1e-9 * budget:
                break
            dual += over / ((n_tokens * (best > 0)) @ posterior)
        rates = mixing.rates_after(posterior, steps)
        assert np.abs((rates * n_tokens) @ posterior - wanted).max() <= mixing.TOLERANCE * budget
        assert n_tokens @ np.abs(rates - best) <= 0.01 * n_tokens.sum()
    uniform = {(r.doc_id, r.text): r.u for r in docs.select(
        "doc_id", "text", (F.pmod(F.xxhash64(*row_key(docs), F.lit(17)), F.lit(1 << 30))
                           / float(1 << 30)).alias("u")).collect()}
    return [r for r, rate in zip(rows, rates) if uniform[(r[0], r[1])] < rate]


PLAIN = [plain_quality, plain_line_dedup, plain_near_dedup, plain_mix]


def as_rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def pieces_of(rows):
    encode = tokens.encoder(tokens.default_vocabulary())
    for doc_id, text, *_ in rows:
        ids = encode(text or "") + [0]
        first = len(ids) % 2048 or min(len(ids), 2048)
        cuts = [0, *range(first, len(ids), 2048), len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            yield doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())


@pytest.mark.parametrize("awkward", [True, False])
def test_each_stage_on_what_the_last_one_left(spark, awkward):
    sf_dir = corpora.SMALL
    docs = corpora.both(spark)[1] if awkward else read_table(spark, sf_dir, "documents")
    docs = materialize(docs.select(*COLUMNS), "stage-input")
    for (name, stage), plain in zip(corpus_pipeline.STAGES, PLAIN):
        rows = as_rows(docs)
        want = plain(spark, rows, docs, sf_dir)
        docs = materialize(stage(spark, docs, sf_dir), "stage-output")
        assert docs.columns == COLUMNS
        assert sorted(map(repr, as_rows(docs))) == sorted(map(repr, want)), name
    rows = as_rows(docs)
    name, pack = corpus_pipeline.STAGES[-1]
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
           for r in pack(spark, docs, sf_dir).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, pieces_of(rows)))
    if not awkward:
        ran = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
               for r in corpus_pipeline.run(spark, sf_dir).collect()]
        assert sorted(ran) == sorted(got)
