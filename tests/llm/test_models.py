"""Token trees, the quality ranker, mixing and the pipeline."""

import math
import random
import zlib

import numpy as np
import pandas as pd
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from riskframe.llm import mixing, quality_ranker, token_counts, tokens
from riskframe.llm import queries as Q
from riskframe.llm.common import read_table
from tests.llm import corpora


@pytest.fixture(scope="module")
def encode():
    return tokens.encoder(tokens.default_vocabulary())


# Token counts ------------------------------------------------------------------

ALPHABET = ["a", "b", "'", "'s", "re", " ", "  ", "\n", "\n\n", "\t", "7", "42", "!", "...",
            "é", "你", "\U0001f600", " ", "word", " word", "'ll", "-", "\r\n", "٣"]


def test_ids_equal_the_other_library(encode):
    import public_tokenizers
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(2)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randrange(60))) for _ in range(2000)]
    texts += [r[1] or "" for r in corpora.awkward_rows()]
    texts += [t for (t,) in corpora.given_rows(columns="text")]
    for text in texts:
        assert encode(text) == other.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("unit, times", [(" ", 2_000_000), ("\n", 2_000_000), ("\t", 2_000_000),
                                         ("word", 500_000), ("\n\n\nfour words\n \n", 60_000),
                                         ("don't <|endoftext|>  stop ", 30_000)])
def test_ids_of_very_long_texts(encode, unit, times):
    import public_tokenizers
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = "begin " + unit * times + "x end"
    assert encode(text) == other.encode(text, add_special_tokens=False).ids


def test_parts_of_long_texts_change_no_ids(encode):
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choices(ALPHABET + ["<|endoftext|>"], k=rng.randrange(80)))
        ids = []
        for start, stop, alone in tokens.parts(text, rng.choice([1, 3, 10])):
            ids += encode(text[start:stop])
        assert ids == encode(text)


ADDED = ["<|endoftext|>", "<|endoftext|", "<|endo", "ftext|>", "|>", "<", ">", "   ", "a", " b", "!"]


def test_ids_equal_the_tokenizer_as_loaded():
    import public_tokenizers
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = tokens.encoder(tokens.default_vocabulary())
    assert encode("hello <|endoftext|> world") == [31373, 220, 50256, 995]
    rng = random.Random(5)
    texts = ["".join(rng.choices(ALPHABET + ADDED, k=rng.randrange(40))) for _ in range(2000)]
    texts += [r[1] or "" for r in corpora.awkward_rows()]
    texts += [t for (t,) in corpora.given_rows(columns="text")]
    assert sum(tokens.ADDED in t for t in texts) > 500
    for text in texts:
        assert encode(text) == other.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(4))
def test_edits_that_make_and_break_added_tokens(seed):
    import public_tokenizers
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = tokens.encoder(tokens.default_vocabulary())
    rng = random.Random(seed)
    for _ in range(150):
        text = "".join(rng.choices(ADDED, k=rng.randrange(20)))
        tree = token_counts.TokenTree.build(text, encode, leaf=rng.choice([1, 2, 5]))
        for _ in range(6):
            start = rng.randint(0, len(tree.text))
            stop = min(len(tree.text), start + rng.choice([0, 1, 2, 9]))
            tree.replace(start, stop, "".join(rng.choices(ADDED, k=rng.choice([0, 0, 1, 3]))))
            assert tree.n_tokens == len(other.encode(tree.text, add_special_tokens=False).ids)


def leaves_hold(tree, encode):
    """Every leaf's characters are whole pre-tokens and its tokens their count."""
    starts = {m.start() for m in tokens.find_pre_tokens(tree.text)} | {len(tree.text)}
    at = 0
    for leaf in range(tree.n_leaves, 2 * tree.n_leaves):
        assert at in starts
        at += tree.chars[leaf]
    assert at == len(tree.text) == tree.chars[1]
    assert tree.n_tokens == len(encode(tree.text))


@pytest.mark.parametrize("seed", range(6))
def test_edited_trees_equal_fresh_counts(encode, seed):
    rng = random.Random(seed)
    for _ in range(120):
        text = "".join(rng.choices(ALPHABET, k=rng.randrange(80)))
        tree = token_counts.TokenTree.build(text, encode, leaf=rng.choice([1, 2, 5]))
        leaves_hold(tree, encode)
        for _ in range(6):
            start = rng.randint(0, len(tree.text))
            stop = min(len(tree.text), start + rng.choice([0, 1, 2, 9]))
            new = "".join(rng.choices(ALPHABET, k=rng.choice([0, 0, 1, 3, 12])))
            want = tree.text[:start] + new + tree.text[stop:]
            tree.replace(start, stop, new)
            assert tree.text == want
            leaves_hold(tree, encode)


def test_an_edit_reencodes_its_neighbourhood_only(encode):
    text = " ".join(f"word{i}" for i in range(20_000))
    tree = token_counts.TokenTree.build(text, encode)
    whole, tree.reencoded = tree.reencoded, 0
    tree.replace(50_000, 50_010, "something else")
    assert tree.n_tokens == len(encode(tree.text))
    assert 0 < tree.reencoded <= 4 * token_counts.LEAF_PRE_TOKENS < whole // 100


def test_edits_through_spark(spark, encode):
    rows, docs = corpora.both(spark)
    rows += [(9000, "mail someone@example.org or call +49 170 1234567, thanks", None, None, None)]
    docs = spark.createDataFrame(rows, corpora.SCHEMA)
    trees = token_counts.build_trees(corpora.clashing(docs))
    done = token_counts.apply_edits(token_counts.find_edits(trees, token_counts.redactions))
    want = []
    for doc_id, text, *_ in rows:
        text, found = text or "", token_counts.redactions(text or "")
        edited = text
        for start, stop, new in reversed(found):
            edited = edited[:start] + new + edited[stop:]
        want.append((doc_id, len(encode(text)), len(encode(edited)), len(found), edited))
    got = [(r.doc_id, r.n_tokens_before, r.n_tokens, r.n_edits, r.text) for r in done.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert sum(w[3] for w in want) >= 2


def test_attached_edits_and_their_order(spark, encode):
    docs = spark.createDataFrame([(1, "abcdef ghi", None, None, None), (2, None, None, None, None)],
                                 corpora.SCHEMA)
    edits = spark.createDataFrame(
        [(1, 8, 99, "X"), (1, 0, 2, None), (1, 1, 4, "yy"), (1, None, 3, "no"), (2, 0, 0, "new"),
         (3, 0, 1, "nobody"), (None, 0, 1, "none")],
        "doc_id long, start int, stop int, replacement string")
    trees = token_counts.build_trees(docs)
    done = token_counts.apply_edits(token_counts.attach_edits(trees, edits)).collect()
    assert {(r.doc_id, r.text, r.n_edits) for r in done} == {(1, "yyef gX", 3), (2, "new", 1)}
    assert all(r.n_tokens == len(encode(r.text)) == r.tokens[1] for r in done)


def test_no_documents_no_trees(spark):
    trees = token_counts.build_trees(corpora.empty(spark))
    assert token_counts.apply_edits(
        token_counts.find_edits(trees, token_counts.redactions)).count() == 0


# Quality ranker ----------------------------------------------------------------

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def ranker(spark):
    return quality_ranker.train_on(read_table(spark, MEDIUM, "documents"),
                                   read_table(spark, MEDIUM, "labels"))


def test_scores_tell_held_out_labels(spark, ranker):
    scored = quality_ranker.score_documents(read_table(spark, MEDIUM, "documents"), ranker)
    labels = read_table(spark, MEDIUM, "labels").select("doc_id", "quality")
    held = scored.where("held_out").join(labels, "doc_id").toPandas()
    assert len(held) > 60
    assert (held.predicted == held.quality).mean() > 0.97
    good, bad = held.score[held.quality == 1], held.score[held.quality == 0]
    assert (good.to_numpy()[:, None] > bad.to_numpy()[None, :]).mean() > 0.99


def test_held_out_rows_never_train(spark, ranker):
    docs, labels = read_table(spark, MEDIUM, "documents"), read_table(spark, MEDIUM, "labels")
    sample = quality_ranker.labelled_features(docs, labels)
    assert all(zlib.crc32(str(i).encode()) % 3 != 1 for i in sample.doc_id)
    held = quality_ranker.is_held_out(F.col("doc_id"))
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    again = quality_ranker.train_on(docs, flipped)
    assert np.array_equal(again.weights, ranker.weights) and again.threshold == ranker.threshold


def test_threshold_is_the_share_of_bad_labels(spark, ranker):
    sample = quality_ranker.labelled_features(read_table(spark, MEDIUM, "documents"),
                                              read_table(spark, MEDIUM, "labels"))
    scores = ranker.scores(np.array(sample.features.tolist()))
    assert (scores < 0.5).mean() == pytest.approx((sample.label == 0).mean(), abs=0.01)


def test_threshold_covers_labelled_rows_outside_the_sample(spark):
    docs, labels = read_table(spark, MEDIUM, "documents"), read_table(spark, MEDIUM, "labels")
    everything = quality_ranker.labelled_features(docs, labels)
    sample = quality_ranker.labelled_features(docs, labels, max_labelled=120)
    assert 0 < len(sample) < len(everything)
    model = quality_ranker.train_on(docs, labels, max_labelled=120)
    assert np.array_equal(model.weights, quality_ranker.fit_ranker(sample).weights)
    strengths = model.strengths(np.array(everything.features.tolist()))
    assert model.threshold == pytest.approx(
        np.quantile(strengths, (everything.label == 0).mean()), abs=1e-9)


def test_awkward_rows_get_scores(spark, ranker):
    rows, docs = corpora.both(spark)
    scored = quality_ranker.score_documents(corpora.clashing(docs), ranker).toPandas()
    assert len(scored) == len(rows) and scored.score.between(0, 1).all()
    assert (scored.predicted == (scored.score >= 0.5)).all()
    assert quality_ranker.score_documents(corpora.empty(spark), ranker).count() == 0


def test_weights_minimise_the_pairwise_loss(spark, ranker):
    """Newton's weights against accelerated gradient descent on the same pairs."""
    sample = quality_ranker.labelled_features(read_table(spark, MEDIUM, "documents"),
                                              read_table(spark, MEDIUM, "labels"))
    rows, label = np.array(sample.features.tolist()), sample.label.to_numpy()
    a, b = quality_ranker.preference_pairs(np.flatnonzero(label == 1), np.flatnonzero(label == 0))
    assert (label[a] == 1).all() and (label[b] == 0).all()
    assert set(a) | set(b) == set(range(len(label)))
    apart, ridge = rows[a] - rows[b], quality_ranker.RIDGE

    def loss(w):
        return np.logaddexp(0, -apart @ w).mean() + ridge / 2 * w @ w

    def slope(w):
        return -apart.T @ (1 / (1 + np.exp(np.clip(apart @ w, -500, 500)))) / len(apart) + ridge * w

    steep = np.linalg.eigvalsh(apart.T @ apart / len(apart))[-1] / 4 + ridge
    push = (math.sqrt(steep) - math.sqrt(ridge)) / (math.sqrt(steep) + math.sqrt(ridge))
    w = ahead = np.zeros(rows.shape[1])
    for _ in range(40_000):
        after = ahead - slope(ahead) / steep
        w, ahead = after, after + push * (after - w)
        if np.abs(slope(w)).max() < 1e-10:
            break
    assert np.abs(slope(ranker.weights)).max() < 1e-8
    assert loss(ranker.weights) == pytest.approx(loss(w), rel=1e-6)
    assert np.allclose(ranker.weights, w, atol=1e-3 * np.abs(w).max())


def test_one_class_only_scores_half(spark):
    sample = pd.DataFrame({"doc_id": [1, 2], "label": [1, 1],
                           "features": [quality_ranker.features(b"a"),
                                        quality_ranker.features(b"")]})
    model = quality_ranker.fit_ranker(sample)
    assert (model.scores(np.array(sample.features.tolist())) == 0.5).all()
    none = quality_ranker.fit_ranker(sample.head(0))
    assert none.threshold == 0.0


# Mixing ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def mixture(spark):
    docs = read_table(spark, MEDIUM, "documents")
    domains = mixing.domain_of_labels(read_table(spark, MEDIUM, "labels"))
    return mixing.fit_mixture(docs, domains, mixing.TARGETS).toPandas(), domains.toPandas()


def test_expected_totals_meet_targets(mixture):
    rows, _ = mixture
    posterior = np.array(rows.posterior.tolist())
    held = (rows.rate * rows.n_tokens).to_numpy() @ posterior
    budget = rows.n_tokens.sum()
    assert np.abs(held / budget - np.array(list(mixing.TARGETS.values()))).max() < 2e-3
    assert (rows.rate >= 0).all() and np.allclose(posterior.sum(axis=1), 1)


def test_posteriors_tell_domains(mixture):
    rows, domains = mixture
    both = rows.merge(domains, on="doc_id")
    guess = np.array(list(mixing.TARGETS))[np.array(both.posterior.tolist()).argmax(axis=1)]
    assert (guess == both.domain).mean() > 0.985


def test_mixing_counts_tokens_of_the_given_tokenizer(mixture, spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows, _ = mixture
    want = [(r.doc_id, max(1, len(other.encode(r.text or "", add_special_tokens=False).ids)))
            for r in read_table(spark, MEDIUM, "documents").select("doc_id", "text").collect()]
    assert sorted(zip(rows.doc_id, rows.n_tokens)) == sorted(want)


def test_steps_match_plain_projected_gradient(spark):
    """Against the same least squares solved densely: rates move along posteriors only."""
    rng = np.random.default_rng(4)
    posterior = rng.dirichlet([0.3, 0.3, 0.3], 400)
    n_tokens = rng.integers(1, 900, 400)
    frame = spark.createDataFrame(
        [(i, 0, i, int(t), p.tolist()) for i, (t, p) in enumerate(zip(n_tokens, posterior))],
        "key_id long, key_hash long, doc_id long, n_tokens long, posterior array<double>")
    steps = mixing.fit_rate_steps(frame, [0.7, 0.2, 0.1], passes=200, tolerance=1e-7)
    rates = mixing.rates_after(posterior, steps)
    held = (rates * n_tokens) @ posterior
    assert held / n_tokens.sum() == pytest.approx([0.7, 0.2, 0.1], abs=1e-6)
    got = {r.doc_id: r.rate for r in
           frame.select("doc_id", mixing.rate_column(steps).alias("rate")).collect()}
    assert np.allclose([got[i] for i in range(400)], rates)


@pytest.mark.parametrize("softness", [1.0, 1.6])
def test_soft_posteriors_meet_targets_in_production_passes(spark, softness):
    """Labels harder than the fixtures': domains overlap, and the targets are far off."""
    rng = np.random.default_rng(8)
    domain = rng.choice(3, 20_000, p=[0.78, 0.12, 0.10])
    scores = 2.5 * np.eye(3)[domain] + rng.normal(0, softness, (20_000, 3))
    posterior = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
    n_tokens = rng.integers(50, 900, 20_000)
    frame = spark.createDataFrame(pd.DataFrame(
        {"key_id": 0, "key_hash": 0, "doc_id": 0, "n_tokens": n_tokens,
         "posterior": posterior.tolist()}))
    steps = mixing.fit_rate_steps(frame, list(mixing.TARGETS.values()))
    rates = mixing.rates_after(posterior, steps)
    held = (rates * n_tokens) @ posterior / n_tokens.sum()
    assert (rates >= 0).all()
    assert np.abs(held - list(mixing.TARGETS.values())).max() <= mixing.TOLERANCE


def test_targets_out_of_reach_raise_with_what_is_missing(spark):
    frame = spark.createDataFrame([(0, 0, i, 10, [0.6, 0.4]) for i in range(9)],
                                  "key_id long, key_hash long, doc_id long, n_tokens long, "
                                  "posterior array<double>")
    with pytest.raises(mixing.TargetsNotMet) as missed:
        mixing.fit_rate_steps(frame, [0.9, 0.1])
    held = (mixing.rates_after(np.array([[0.6, 0.4]] * 9), missed.value.steps) * 10).sum() \
        * np.array([0.6, 0.4])
    assert held - 90 * np.array([0.9, 0.1]) == pytest.approx(missed.value.residual)


def test_mixing_without_labels_or_documents(spark):
    docs = corpora.awkward(spark)
    none = spark.createDataFrame([], "doc_id long, domain string")
    rows = mixing.fit_mixture(corpora.clashing(docs), none, {"a": 0.5, "b": 0.5}).collect()
    assert len(rows) == docs.count()
    assert all(r.posterior == [0.5, 0.5] and r.rate == pytest.approx(1) for r in rows)
    assert mixing.fit_mixture(corpora.empty(spark), none, {"a": 0.5, "b": 0.5}).count() == 0
    assert mixing.thin_to_targets(corpora.empty(spark), none, {"a": 1.0}, "a").count() == 0


@pytest.mark.parametrize("which", ["quality is null", "toxic = 0", "quality = 1"])
def test_registered_mixing_on_labels_that_lack_domains(spark, tmp_path, which):
    """No label at all, no toxic one, or no low one: rates for every row, misses told."""
    for table in ("documents", "labels"):
        rows = read_table(spark, corpora.SMALL, table)
        (rows.where(which) if table == "labels" else rows).write.parquet(
            f"{tmp_path}/{table}.parquet")
    rows = Q.op6_mixing(spark, str(tmp_path)).collect()
    assert len(rows) == read_table(spark, corpora.SMALL, "documents").count()
    assert all(r.rate >= 0 for r in rows)
    held = np.array([[r.n_tokens * r.rate * r[f"p_{d}"] for d in mixing.TARGETS] for r in rows])
    budget = sum(r.n_tokens for r in rows)
    gap = held.sum(axis=0) / budget - np.array(list(mixing.TARGETS.values()))
    told = np.array([rows[0][f"missed_{d}"] for d in mixing.TARGETS])
    assert np.abs(gap - told).max() <= mixing.TOLERANCE
    assert np.abs(told).max() > mixing.TOLERANCE


# Pipeline ----------------------------------------------------------------------

def test_stages_keep_columns_and_clean_documents(spark):
    docs = read_table(spark, MEDIUM, "documents")
    labels = read_table(spark, MEDIUM, "labels").toPandas().set_index("doc_id")
    clean = set(labels.index[(labels.quality == 1) & (labels.toxic == 0)])
    toxic = set(labels.index[labels.toxic == 1])
    from riskframe.llm.common import materialize

    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = materialize(stage(spark, docs, MEDIUM), "stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= before and docs.count() == len(after)
        if "dedup" not in name:
            assert len(after & clean) >= 0.995 * len(before & clean)
        if "mixing" in name:
            assert len(after & toxic) <= 0.3 * len(before & toxic)
    packed = corpus_pipeline.run(spark, MEDIUM)
    assert packed.select("doc_id").distinct().count() == len(after)


def test_stages_take_awkward_and_no_documents(spark):
    awkward = corpora.clashing(corpora.awkward(spark)).withColumns(
        {c: F.lit(1) for c in ("key_id", "key_hash", "starts", "copy_number", "rate")})
    ids = {r.doc_id for r in awkward.collect()}
    for docs in (awkward, corpora.empty(spark)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, corpora.SMALL)
            rows = out.collect()
            assert {r.doc_id for r in rows} <= ids
            if name != "best-fit packing":
                assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
                assert len(rows) <= n
            else:
                assert (len(rows) >= n) and (n > 0 or not rows)


def test_pre_token_pattern_is_the_public_one():
    import public_tokenizers

    assert public_tokenizers.PATTERN == tokens.PRE_TOKEN
    assert regex.compile(tokens.PRE_TOKEN).findall("it's  7 o'clock") == \
        ["it", "'s", " ", " 7", " o", "'", "clock"]
