"""Fits on counted rows against Spark's fits on the rows; parts and grids at size."""

import pytest
from pyspark.ml.classification import FMClassifier, MultilayerPerceptronClassifier
from pyspark.sql import functions as F

from riskframe.operators import features as fe
from riskframe.operators import metrics as met
from riskframe.operators import sampling
from riskframe.plans import counted as C
from riskframe.plans import models as M
from riskframe.plans import queries as Q
from riskframe.plans import search as R
from tests.conftest import SMALL

COLUMNS = ["a", "d", "e"]


@pytest.fixture(scope="module")
def rows(spark):
    """The label depends on all three features and is noisy; e has many values."""
    e = F.pmod(F.col("l_suppkey"), F.lit(9)).cast("double")
    noise = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(100)) < 25
    told = (2 * F.col("a") + 3 * F.col("d") + F.col("e") > 6) != noise
    table = Q.planted(spark, SMALL).join(
        Q.lineitem(spark, SMALL).select("l_orderkey", "l_linenumber", "l_suppkey"),
        ["l_orderkey", "l_linenumber"])
    table = table.withColumn("e", e).withColumn("label", told.cast("int"))
    return M.with_class_count(fe.assemble(table, COLUMNS)).select(
        *COLUMNS, "features", "label", "fold").persist()


def jobs_rows(spark, action):
    """What ``action`` gives, and how many RDDs it leaves persisted."""
    held = lambda: spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    before = held()
    return action(), held() - before


@pytest.mark.parametrize("settings", [
    {"maxIter": 8, "stepSize": 0.1, "regParam": 0.02, "seed": 1},
    {"maxIter": 5, "solver": "gd", "regParam": 0.1, "seed": 2, "fitLinear": False}])
def test_machine_equals_that_of_all_rows(spark, rows, settings):
    plain = FMClassifier(**settings).fit(rows)
    counts = C.count_rows(rows)
    assert counts.count() < 100
    once = M.make_estimator("fm", counts_col="weight", **settings)
    for model, left in (jobs_rows(spark, lambda: M.fit("fm", rows, **settings)),
                        jobs_rows(spark, lambda: once.fit(counts))):
        assert left == 0
        assert abs(model.factors.toArray() - plain.factors.toArray()).max() < 1e-9
        assert abs(model.linear.toArray() - plain.linear.toArray()).max() < 1e-9
        assert model.intercept == pytest.approx(plain.intercept, abs=1e-9)


def test_perceptron_equals_that_of_all_rows(rows):
    settings = {"layers": [3, 4, 2], "solver": "gd", "maxIter": 4, "stepSize": 0.3, "seed": 1}
    # Spark averages over blocks of rows: blocks of one row are the mean over rows.
    plain = MultilayerPerceptronClassifier(**settings, blockSize=1).fit(rows)
    model = M.fit("mlp", rows, **settings)
    assert abs(model.weights.toArray() - plain.weights.toArray()).max() < 1e-9


@pytest.mark.parametrize("kind, settings", [
    ("lr", {"regParam": 0.05, "elasticNetParam": 0.5, "maxIter": 300, "tol": 1e-12}),
    ("lsvc", {"regParam": 0.05, "maxIter": 200, "tol": 1e-10})])
def test_penalties_on_counts_equal_those_of_all_rows(rows, kind, settings):
    plain = M.fit(kind, rows, **settings)
    model = M.make_estimator(kind, counts_col="weight", **settings).fit(C.count_rows(rows))
    assert model.coefficients.toArray().tolist() == pytest.approx(
        plain.coefficients.toArray().tolist(), abs=1e-4)
    assert model.getRegParam() == settings["regParam"]


def test_search_on_counts_equals_search_on_rows(rows):
    settings = {"maxIter": 20}
    found = []
    for data, counts in ((rows, None), (M.counted_training(rows, "fold"), M.COUNTS)):
        est = M.make_estimator("lr", counts_col=counts, **settings)
        maps = M.param_grid(est, {"regParam": [0.0, 0.3]})
        found.append(M.cross_validator(M.pipeline(est), maps, 5, "fold", counts_col=counts)
                     .fit(data).avgMetrics)
    assert found[0] == pytest.approx(found[1], abs=1e-9)


def test_no_family_searches_the_rows(rows):
    data = R.SearchData.of(rows, COLUMNS)
    for kind in Q.ALL_KINDS:
        assert data.part(kind, None, False).count() == data.patterns.count() < rows.count()


def test_parts_grow_with_the_rows(spark):
    n = 3 * sampling.PART_ROWS + 1
    assert sampling.parts_for(spark.range(n), 2) == 4
    assert sampling.parts_for(spark.range(10), 8) == 8


def test_grid_scores_equal_inputs_once(rows):
    rules = {f"m{i}": f"CAST(e + a > {i} AS DOUBLE)" for i in range(9)}
    key = lambda df: sorted(map(repr, df.select("model", "label", "prediction", "n").collect()))
    found = met.confusion_grid(rows, rules, inputs=("e", "a"))
    assert key(found) == key(met.confusion_grid(rows, rules))
    some = rows.withColumn("w", F.col("fold").cast("double"))
    assert key(met.confusion_grid(some, rules, weight_col="w", inputs=("e", "a"))) == \
        key(met.confusion_grid(some, rules, weight_col="w"))
    assert met.confusion_grid(rows.limit(0), rules, inputs=("e", "a")).count() == 0
