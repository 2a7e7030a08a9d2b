"""Pattern training, prefix search, the ledger, vector-valued confusion counts."""

import itertools

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from riskframe.operators import features as fe
from riskframe.operators import metrics as met
from riskframe.plans import models as M
from riskframe.plans import patterns as P
from riskframe.plans import queries as Q
from riskframe.plans import search as R
from riskframe.session import scratch_path
from tests.conftest import SMALL

COLUMNS = ["a", "d", "e"]


@pytest.fixture(scope="module")
def rows(spark):
    """The label depends on all three features; e has many values."""
    e = F.pmod(F.col("l_suppkey"), F.lit(9)).cast("double")
    noise = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(100)) < 25
    told = (2 * F.col("a") + 3 * F.col("d") + F.col("e") > 6) != noise
    table = Q.planted(spark, SMALL).join(
        Q.lineitem(spark, SMALL).select("l_orderkey", "l_linenumber", "l_suppkey"),
        ["l_orderkey", "l_linenumber"])
    return table.withColumn("e", e).withColumn("label", told.cast("int")).select(
        *COLUMNS, "label", "fold").persist()


@pytest.fixture(scope="module")
def data(rows):
    return R.SearchData.of(rows, COLUMNS)


def test_patterns_count_all_rows_and_dealing_keeps_counts(spark, rows):
    patterns = P.compress(rows, COLUMNS, "label", ["fold"])
    n = rows.count()
    assert patterns.agg(F.sum("weight")).first()[0] == n
    assert patterns.count() == rows.distinct().count() < 400
    dealt = P.deal(patterns, 5)
    assert dealt.agg(F.sum("weight")).first()[0] == n
    assert dealt.where("weight < 1 or weight <> floor(weight)").count() == 0
    empty = P.compress(rows.limit(0), COLUMNS)
    assert empty.count() == P.deal(empty, 5).count() == 0
    nulls = spark.createDataFrame([(None, 1), (None, 1), (2.0, 0)], "a double, label int")
    assert sorted(r.weight for r in P.compress(nulls, ["a"]).collect()) == [1.0, 2.0]


@pytest.mark.parametrize("settings", [
    {"regParam": 0.0}, {"regParam": 0.05}, {"regParam": 0.02, "elasticNetParam": 0.5},
    {"regParam": 0.05, "standardization": False}])
def test_logistic_coefficients_equal_those_of_all_rows(rows, settings):
    settings = {**settings, "maxIter": 500, "tol": 1e-13}
    plain = M.fit("lr", M.with_class_count(fe.assemble(rows, COLUMNS)), **settings)
    slopes, intercept = P.linear_terms(
        P.fit_patterns("lr", P.compress(rows, COLUMNS), COLUMNS, **settings))
    assert slopes == pytest.approx(plain.coefficients.toArray().tolist(), abs=1e-6)
    assert intercept == pytest.approx(plain.intercept, abs=1e-6)


def test_naive_bayes_theta_equals_that_of_all_rows(rows):
    plain = M.fit("nb", fe.assemble(rows, COLUMNS))
    model = P.fit_patterns("nb", P.compress(rows, COLUMNS), COLUMNS).stages[-1]
    assert abs(model.theta.toArray() - plain.theta.toArray()).max() < 1e-9
    assert abs(model.pi.toArray() - plain.pi.toArray()).max() < 1e-9


def test_svm_predicts_like_that_of_all_rows(rows):
    settings = {"regParam": 0.01, "maxIter": 30}
    plain = M.fit("lsvc", M.with_class_count(fe.assemble(rows, COLUMNS)), **settings)
    model = P.fit_patterns("lsvc", P.compress(rows, COLUMNS), COLUMNS, **settings)
    points = rows.select(*COLUMNS).distinct()
    slopes, intercept = P.linear_terms(model)
    for r in points.collect():
        margin = sum(s * r[c] for s, c in zip(slopes, COLUMNS)) + intercept
        other = sum(s * r[c] for s, c in zip(plain.coefficients, COLUMNS)) + plain.intercept
        assert margin * other > 0 or abs(margin - other) < 0.05


def f1_of(model, frame):
    return MulticlassClassificationEvaluator(metricName="f1").evaluate(
        model.transform(frame).withColumn("label", F.col("label").cast("double")))


@pytest.mark.parametrize("kind, settings", [
    ("rf", {"numTrees": 20, "maxDepth": 5, "seed": 3}), ("gbt", {"maxIter": 5, "seed": 3})])
def test_tree_quality_on_patterns(rows, kind, settings):
    plain = M.pipeline(fe.assembler(COLUMNS), M.make_estimator(kind, **settings)).fit(rows)
    model = P.fit_patterns(kind, P.compress(rows, COLUMNS), COLUMNS, **settings)
    assert f1_of(model, rows) == pytest.approx(f1_of(plain, rows), abs=0.01)


def test_families_without_weights_are_refused(rows):
    with pytest.raises(ValueError, match="takes no weights"):
        P.fit_patterns("fm", P.compress(rows, COLUMNS), COLUMNS)


def test_prefixes_equal_separate_fits(data):
    """Boosting and the whole forest exactly; another bag of trees within 0.01."""
    held = data.part("gbt", 0, True)
    for family, lengths, exact in (("gbt", [1, 3, 8], True), ("rf", [10, 20, 30], False)):
        name = R.LENGTH[family]
        settings = {"maxDepth": 5, "seed": 5}
        if family == "rf":
            settings["featureSubsetStrategy"] = "all"
        unit = R.Unit(family, 0, tuple(sorted(settings.items())),
                      tuple((i, str(k), k) for i, k in enumerate(lengths)))
        told = {row[1]: row[4] for row in R.fit_unit(data, unit)}
        for i, k in enumerate(lengths):
            model = data.fit(family, {**settings, name: k}, 0)
            cells = met.confusion_vector(
                model.transform(held).withColumn("p", F.array("prediction")), "p", 1,
                weight_col=P.WEIGHT)[0]
            alone = R.weighted_f1(cells)
            assert told[i] == pytest.approx(alone, abs=1e-12 if exact or k == max(lengths) else 0.01)


def test_units_share_fits_over_lengths():
    searches = [R.Search(k, {}, M.STUDY_GRIDS[k]) for k in ("rf", "gbt", "nb", "lr")]
    todo = {(f, c, k) for f, c, _, k in R.plan_rows(searches, 5)}
    assert len(todo) == 5 * (15 + 25 + 1 + 45)
    found = R.units(searches, todo)
    assert sum(len(u.lengths) for u in found) == len(todo)
    assert len(found) == 5 * (5 + 5 + 1 + 45)


def test_a_stopped_search_goes_on_and_repeats_no_fit(spark, data):
    searches = [R.Search("nb", {}, {"smoothing": [0.5, 1.0, 2.0]}),
                R.Search("gbt", {"seed": 1, "maxDepth": 2}, {"maxIter": [1, 2]})]
    folds, whole, path = 5, scratch_path(spark, "whole"), scratch_path(spark, "stopped")
    assert R.run_search(spark, data, searches, folds, whole) == 20
    calls = itertools.count()
    fitted = []

    def lost_driver(found, unit):
        if next(calls) >= 7:
            raise RuntimeError("driver lost")
        fitted.append(unit.name)
        return R.fit_unit(found, unit)

    with pytest.raises(RuntimeError, match="driver lost"):
        R.run_search(spark, data, searches, folds, path, 1, fit=lost_driver)
    assert 0 < R.read_ledger(spark, path).select("unit", "fold").distinct().count() <= 7

    def counted(found, unit):
        fitted.append(unit.name)
        return R.fit_unit(found, unit)

    before = {r.unit for r in R.read_ledger(spark, path).collect()}
    again = len(fitted)
    R.run_search(spark, data, searches, folds, path, 2, fit=counted)
    assert not before & set(fitted[again:])
    assert len(before) + len(set(fitted[again:])) == 20
    assert R.run_search(spark, data, searches, folds, path, fit=counted) == 0
    for frame in (R.averages, lambda ledger, folds: R.times(ledger).select("model", "numTrains")):
        one, other = (sorted(map(repr, (tuple(round(x, 12) if isinstance(x, float) else x
                                              for x in r) for r in frame(
            R.read_ledger(spark, p), folds).collect()))) for p in (whole, path))
        assert one == other


def test_an_unfinished_combination_is_not_averaged(spark, data):
    searches = [R.Search("nb", {}, {"smoothing": [1.0]})]
    path = scratch_path(spark, "partial")
    R.run_search(spark, data, searches, 5, path, max_units=3)
    assert R.averages(R.read_ledger(spark, path), 5).count() == 0
    assert R.open_entries(spark, searches, 5, path).count() == 2


def test_confusion_grid_equals_grouping_by_rules(spark, rows):
    rules = {f"m{i}": f"CAST(e + a > {i} AS DOUBLE)" for i in range(9)}
    key = lambda df: sorted(map(repr, df.select("model", "label", "prediction", "n").collect()))
    assert key(met.confusion_grid(rows, rules)) == key(met.confusion_by_rules(rows, rules))
    assert met.confusion_grid(rows.limit(0), rules).count() == 0
    unlabelled = rows.withColumn("label", F.lit(None).cast("int"))
    assert met.confusion_grid(unlabelled, rules).count() == 0


def test_confusion_grid_groups_by_nothing(rows):
    rules = {f"m{i}": f"CAST(e > {i} / 20.0 AS DOUBLE)" for i in range(188)}
    plan = met.confusion_grid(rows, rules)._jdf.queryExecution().executedPlan().toString()
    groups = [line for line in plan.splitlines() if "HashAggregate(keys=" in line]
    assert groups and all("keys=[0" in g for g in groups)


def test_weighted_f1_equals_the_evaluator(spark, rows):
    scored = rows.withColumn("prediction", F.col("a").cast("double")) \
        .withColumn("label", F.col("label").cast("double"))
    cells = met.confusion_vector(scored.withColumn("p", F.array("prediction")), "p", 1)[0]
    want = MulticlassClassificationEvaluator(metricName="f1").evaluate(scored)
    assert R.weighted_f1(cells) == pytest.approx(want, abs=1e-12)
