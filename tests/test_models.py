import math

import pytest
from pyspark.sql import functions as F

from riskframe.operators import features as fe
from riskframe.plans import models as M
from riskframe.plans import queries as Q
from tests.conftest import SMALL


def test_study_grid_sizes(spark):
    sizes = {k: M.grid_size(g) for k, g in M.STUDY_GRIDS.items()}
    assert sizes == {"lr": 45, "rf": 15, "gbt": 25, "mlp": 18, "lsvc": 9, "nb": 1, "fm": 75}
    est = M.make_estimator("mlp")
    maps = M.param_grid(est, M.STUDY_GRIDS["mlp"], 14, 2)
    assert len(maps) == 18
    assert M.grid_rows(maps)[0] == (0, "layers=[14,5,2], solver=l-bfgs")
    assert M.param_grid(M.make_estimator("nb"), {}) == [{}]


def test_naive_bayes_closed_form(spark):
    rows = Q.nb_cohort_rows(spark, SMALL)
    model = M.fit("nb", rows)
    pdf = rows.select(*Q.NB_FEATURES, "label").toPandas()
    n, classes = len(pdf), sorted(pdf["label"].unique())
    theta, pi = model.theta.toArray(), model.pi.toArray()
    for c in classes:
        part = pdf[pdf["label"] == c]
        assert pi[c] == pytest.approx(math.log(len(part) + 1) - math.log(n + len(classes)))
        sums = part[list(Q.NB_FEATURES)].sum()
        for j, f in enumerate(Q.NB_FEATURES):
            expect = math.log(sums[f] + 1) - math.log(sums.sum() + len(Q.NB_FEATURES))
            assert theta[c, j] == pytest.approx(expect, abs=1e-12)


def test_logistic_mean_probability_equals_base_rate(spark):
    # Unregularised logistic regression with an intercept: the fitted mean
    # probability equals the observed rate of label 1.
    df = Q.cohort(spark, SMALL)
    data = fe.assemble(df, ["RENAL", "DIABETES", "ASMA", "CS_SEXO"])
    model = M.fit("lr", data, regParam=0.0, maxIter=100, tol=1e-10)
    scored = M.score(model, data)
    mean_p = scored.agg(F.avg(F.col("probability")[1])).first()[0]
    rate = df.agg(F.avg("label")).first()[0]
    assert mean_p == pytest.approx(rate, abs=1e-4)


def test_linear_svc_has_no_probability(spark):
    model = Q.fit_planted(spark, SMALL, "lsvc")
    cols = M.score(model, Q.planted_assembled(spark, SMALL)).columns
    assert "probability" not in cols and "raw_prediction" in cols


@pytest.mark.parametrize("kind", ["rf", "gbt"])
def test_trees_recover_threshold_from_raw_column(spark, kind):
    df = Q.planted(spark, SMALL).join(
        Q.lineitem(spark, SMALL).select("l_orderkey", "l_quantity").dropDuplicates(["l_orderkey"]),
        "l_orderkey")
    df = df.withColumn("label", (F.col("l_quantity") > 25).cast("int"))
    data = fe.assemble(df, ["l_quantity"])
    model = M.fit(kind, data, seed=1, **({"numTrees": 5} if kind == "rf" else {"maxIter": 3}))
    wrong = model.transform(data).where(F.col("prediction") != F.col("label")).count()
    assert wrong == 0


def test_train_suite_counts_and_times(spark):
    data = Q.planted_assembled(spark, SMALL)
    specs = [M.ModelSpec("nb"), M.ModelSpec("lr", {"maxIter": 10}, {"regParam": [0.0, 0.1]})]
    res = M.train_suite(data, specs, num_folds=5, fold_col="fold", n_features=3)
    assert [(r.name, r.num_trains) for r in res] == [("nb", 5), ("lr", 10)]
    assert all(r.millis > 0 for r in res)
    times = M.times_frame(spark, res)
    assert times.columns == ["model", "time", "numTrains"]


def test_importances_and_factors_shapes(spark):
    names = list(Q.S.PLANTED_FEATURES)
    rf = Q.fit_planted(spark, SMALL, "rf")
    imp = M.feature_importances(spark, rf, names).collect()
    assert [r["feature"] for r in imp] == names
    assert sum(r["importance"] for r in imp) == pytest.approx(1.0)
    fm = M.make_estimator("fm", maxIter=5, seed=1).fit(Q.planted_assembled(spark, SMALL))
    fac = M.fm_factors(spark, fm, names)
    assert fac.where("term = 'factor'").count() == 3 * 8


def test_invalid_feature_rows_counts_skipped(spark):
    df = Q.cohort(spark, SMALL)
    cols = ["RENAL", "NU_IDADE_N", "CS_SEXO"]
    r = fe.invalid_feature_rows(df, cols).first()
    kept = fe.assemble(df, cols, "features", "skip").count()
    assert r["n_rows"] - r["n_invalid"] == kept and r["n_invalid"] > 0


def test_assembler_error_mode_fails_on_null(spark):
    df = spark.createDataFrame([(1, None)], "a INT, b INT")
    with pytest.raises(Exception, match="(?i)null|invalid|skip|keep"):
        fe.assemble(df, ["a", "b"], "features", "error").collect()


def test_convergence_flags_iteration_limit(spark):
    lr = Q.fit_planted(spark, SMALL, "lr")
    out = {r["model"]: r for r in M.convergence(spark, {"lr": lr}).collect()}
    assert out["lr"]["max_iter"] == 20
    assert out["lr"]["at_limit"] == (out["lr"]["iterations"] >= 20)


def test_cv_matches_fold_by_fold_fits_and_releases_memory(spark):
    data = Q.planted_assembled(spark, SMALL).where(F.col("d") == 1)
    est = M.make_estimator("lr", maxIter=5)
    maps = M.param_grid(est, {"regParam": [0.0, 0.3]})
    persisted_before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    cv = M.cross_validator(M.pipeline(est), maps, 5, "fold").fit(data)
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == persisted_before
    ev = M.f1_evaluator()
    for i, pm in enumerate(maps):
        scores = [ev.evaluate(est.fit(data.where(F.col("fold") != f), pm)
                              .transform(data.where(F.col("fold") == f))) for f in range(5)]
        assert cv.avgMetrics[i] == pytest.approx(sum(scores) / 5, abs=1e-12)


@pytest.mark.parametrize("folds, message", [
    ("nullif(l_orderkey % 3, 0)", "(?i)fold number"),
    ("l_orderkey % 5", "(?i)fold number"),
    ("0", "(?i)empty")])
def test_cv_raises_on_rows_it_would_leave_out(spark, folds, message):
    data = Q.planted_assembled(spark, SMALL).withColumn(
        "fold", F.expr(f"cast({folds} as int)"))
    est = M.make_estimator("nb")
    with pytest.raises(Exception, match=message):
        M.cross_validator(est, [{}], 3, "fold").fit(data)


def test_forest_does_not_depend_on_input_partitions(spark):
    names = list(Q.S.PLANTED_FEATURES)
    found = []
    for parts in (2, 9):
        data = M.persist_training(Q.planted_assembled(spark, SMALL).repartition(parts),
                                  Q.TRAIN_PARTS, Q.TRAIN_KEY)
        model = M.make_estimator("rf", numTrees=5, seed=1).fit(data)
        found.append([r["importance"] for r in M.feature_importances(spark, model, names)
                      .collect()])
        data.unpersist()
    assert found[0] == pytest.approx(found[1], abs=0.05)


def test_string_index_of_many_values(spark):
    df = spark.range(0, 30_000).select(F.concat(F.lit("v"), F.col("id") % 9000).alias("c"))
    df = df.unionByName(spark.createDataFrame([(None,), ("v7",), ("v8",), ("v8",)], "c STRING"))
    out = fe.string_index(df, ["c"], ["i"]).groupBy("c", "i").count().collect()
    counts = {r["c"]: r["count"] for r in out}
    order = sorted((v for v in counts if v is not None), key=lambda v: (-counts[v], v))
    assert {r["c"]: r["i"] for r in out} == \
        {**{v: float(i) for i, v in enumerate(order)}, None: float(len(order))}
    assert fe.string_index(df, ["c"], ["i"], "skip").count() == 30_003
    with pytest.raises(Exception, match="null in c"):
        fe.string_index(df, ["c"], ["i"], "error").collect()
