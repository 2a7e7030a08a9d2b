import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from riskframe.operators import metrics as met


def scored(spark, pairs):
    return spark.createDataFrame([(float(l), float(p)) for l, p in pairs],
                                 "label DOUBLE, prediction DOUBLE")


def test_weighted_metrics_match_evaluator(spark):
    rnd = random.Random(3)
    pairs = [(rnd.randint(0, 2), rnd.randint(0, 2)) for _ in range(500)]
    df = scored(spark, pairs)
    got = met.weighted_metrics(met.confusion_counts(df, model_col=None), model_col=None).first()
    ev = MulticlassClassificationEvaluator()
    for ours, theirs in [("weighted_f1", "f1"), ("accuracy", "accuracy"),
                         ("weighted_precision", "weightedPrecision"),
                         ("weighted_recall", "weightedRecall")]:
        assert got[ours] == pytest.approx(ev.evaluate(df, {ev.metricName: theirs}), abs=1e-12)


def test_weighted_metrics_class_never_predicted(spark):
    df = scored(spark, [(0, 0), (0, 0), (1, 0)])
    got = met.weighted_metrics(met.confusion_counts(df, model_col=None), model_col=None).first()
    ev = MulticlassClassificationEvaluator()
    assert got["weighted_f1"] == pytest.approx(ev.evaluate(df), abs=1e-12)
    assert got["weighted_precision"] == pytest.approx(
        ev.evaluate(df, {ev.metricName: "weightedPrecision"}), abs=1e-12)


def test_class_metrics_positive_zero(spark):
    # actual 0 predicted 0: 3, actual 1 predicted 0: 1, actual 0 predicted 1: 2, 1/1: 4
    pairs = [(0, 0)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(1, 1)] * 4
    r = met.class_metrics(met.confusion_counts(scored(spark, pairs), model_col=None),
                          0.0, model_col=None).first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (3, 1, 2, 4)
    assert r["accuracy"] == pytest.approx(0.7)
    assert r["precision"] == pytest.approx(0.75)
    assert r["recall"] == pytest.approx(0.6)
    assert r["f1"] == pytest.approx(2 * 0.75 * 0.6 / 1.35)


def test_class_metrics_zero_support_is_null(spark):
    r = met.class_metrics(met.confusion_counts(scored(spark, [(1, 1), (1, 1)]), model_col=None),
                          0.0, model_col=None).first()
    assert r["precision"] is None and r["recall"] is None and r["f1"] is None
    assert r["accuracy"] == 1.0


def test_confusion_is_order_free(spark):
    pairs = [(0, 1), (1, 1), (0, 0), (1, 0), (1, 1)]
    a = sorted(map(tuple, met.confusion_counts(scored(spark, pairs), model_col=None).collect()))
    b = sorted(map(tuple, met.confusion_counts(scored(spark, pairs[::-1]),
                                               model_col=None).collect()))
    assert a == b


def scored_long(df, rules):
    """Every row scored by every rule, the slow way."""
    entries = F.array(*[F.struct(F.lit(n).alias("model"), F.expr(r).cast("double").alias("p"))
                        for n, r in rules.items()])
    return df.select("label", F.explode(entries).alias("s")).select(
        "s.model", "label", F.col("s.p").alias("prediction"))


def test_distinct_count_null_semantics(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "x INT")
    r = met.distinct_count(df, "x").first()
    assert (r["n_distinct"], r["n_distinct_with_null"]) == (2, 3)
    assert df.select("x").distinct().count() == 3
    none = met.distinct_count(df.where("false"), "x").first()
    assert (none["n_distinct"], none["n_distinct_with_null"]) == (0, 0)


def test_correlation_pairwise_complete(spark):
    import pandas as pd
    rows = [(1.0, 2.0, None), (2.0, 4.5, 1.0), (3.0, 5.5, 0.0), (4.0, 9.0, 2.0), (5.0, 9.5, 2.5)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE")
    got = {(r["col_a"], r["col_b"]): r["corr"]
           for r in met.correlation_long(df, ["a", "b", "c"]).collect()}
    expect = pd.DataFrame(rows, columns=["a", "b", "c"]).corr()
    for a in "abc":
        for b in "abc":
            assert got[(a, b)] == pytest.approx(expect.loc[a, b], abs=1e-12)


def test_correlation_of_large_means_constants_and_no_rows(spark):
    rows = [(1e9 + (i % 7), 1e9 + (i % 7) * 2 + (i % 3), 0.1, None) for i in range(300)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE").repartition(5)
    import pandas as pd
    expect = pd.DataFrame([(i % 7, (i % 7) * 2 + (i % 3)) for i in range(300)]).corr()
    got = {(r["col_a"], r["col_b"]): r["corr"]
           for r in met.correlation_long(df, "abcd").collect()}
    assert got[("a", "b")] == pytest.approx(expect.iloc[0, 1], abs=1e-9)
    assert got[("a", "a")] == 1.0
    assert all(v is None for k, v in got.items() if set(k) & set("cd"))
    none = met.correlation_long(df.where("false"), "ab").collect()
    assert all(r["corr"] is None for r in none)


def test_pivot_sum(spark):
    df = spark.createDataFrame([("x", "lr", 1.0), ("x", "svm", 2.0), ("y", "lr", 3.0)],
                               "feature STRING, model STRING, coefficient DOUBLE")
    got = {r["feature"]: (r["lr"], r["svm"])
           for r in met.pivot_sum(df, "feature", "model", "coefficient", ["lr", "svm"]).collect()}
    assert got == {"x": (1.0, 2.0), "y": (3.0, None)}


def test_confusion_by_rules_equals_exploded_scoring(spark):
    rnd = random.Random(9)
    rows = [(rnd.randint(0, 1), rnd.randint(0, 90), rnd.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "label INT, age INT, flag INT")
    rules = {"old": "CAST(age > 40 AS DOUBLE)", "flag": "CAST(flag AS DOUBLE)",
             "both": "CAST(age > 60 AND flag = 1 AS DOUBLE)"}
    fast = sorted(map(tuple, met.confusion_by_rules(df, rules).collect()))
    slow = sorted(map(tuple, met.confusion_counts(scored_long(df, rules)).collect()))
    assert fast == slow


def test_metrics_summary_equals_separate_metrics(spark):
    rnd = random.Random(5)
    rows = [(m, float(rnd.randint(0, 1)), float(rnd.randint(0, 1)))
            for m in ("a", "b") for _ in range(300)]
    rows += [("c", 1.0, 1.0)] * 5          # class 0 never seen: 0/0 precision
    df = spark.createDataFrame(rows, "model STRING, label DOUBLE, prediction DOUBLE")
    conf = met.confusion_counts(df)
    both = {r["model"]: r for r in met.metrics_summary(conf, 0.0).collect()}
    cm = {r["model"]: r for r in met.class_metrics(conf, 0.0).collect()}
    wm = {r["model"]: r for r in met.weighted_metrics(conf).collect()}
    for m in ("a", "b", "c"):
        for k in ("tp", "fp", "fn", "tn", "precision", "recall", "f1"):
            assert both[m][k] == (pytest.approx(cm[m][k]) if cm[m][k] is not None else None), (m, k)
        for k in ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1"):
            assert both[m][k] == pytest.approx(wm[m][k]), (m, k)


def test_correlation_many_columns_and_constant(spark):
    # 8 columns = 28 pairs; a constant column has no correlation, not even with itself.
    import pandas as pd
    cols = [f"c{i}" for i in range(8)]
    rows = [tuple(float((r * (i + 3)) % (i + 5)) if i else 7.0 for i in range(8))
            for r in range(40)]
    rows[3] = (7.0, None, *rows[3][2:])
    df = spark.createDataFrame(rows, ", ".join(f"{c} DOUBLE" for c in cols))
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in met.correlation_long(df, cols).collect()}
    assert len(got) == 64
    expect = pd.DataFrame(rows, columns=cols).corr()
    for a in cols:
        for b in cols:
            e = expect.loc[a, b]
            if math.isnan(e):
                assert got[(a, b)] is None
            else:
                assert got[(a, b)] == pytest.approx(e, abs=1e-12)
