"""Golden values of the study's risk table (intercept and coefficients as
published with it) and the report operators."""

import math

import pytest

from riskframe.operators import metrics as met
from riskframe.operators.joins import coefficient_table
from riskframe.plans import reports as R

# The published logistic coefficients and their rounded
# odds-ratio and total-risk percentages.
INTERCEPT = -0.9615349252132588
BASELINE_PCT = 27.65709825488868
GOLDEN = [
    ("RENAL", 0.4947658046512724, 164.01, 45.36),
    ("PUERPERA", 0.4554332099218894, 157.69, 43.61),
    ("IMUNODEPRE", 0.44086903459070775, 155.41, 42.98),
    ("HEPATICA", 0.43111209550372803, 153.9, 42.56),
    ("DIABETES", 0.3855162684195613, 147.04, 40.67),
    ("HEMATOLOGI", 0.3315345906093188, 139.31, 38.53),
    ("OBESIDADE", 0.30353342237041214, 135.46, 37.46),
    ("ASMA", 0.20758009401090677, 123.07, 34.04),
    ("NEUROLOGIC", 0.19574036293390837, 121.62, 33.64),
    ("PNEUMOPATI", 0.12989092233370036, 113.87, 31.49),
    ("SIND_DOWN", -0.14507414792834297, 86.5, 23.92),
    ("CARDIOPATI", -0.3530147635129998, 70.26, 19.43),
]


def golden_coefs(spark):
    names = [g[0] for g in GOLDEN]
    return coefficient_table(spark, names, [g[1] for g in GOLDEN], INTERCEPT, "logistic")


def test_risk_report_golden(spark):
    report = R.risk_report(golden_coefs(spark), "logistic").orderBy("rank").collect()
    assert [r["feature"] for r in report] == [g[0] for g in GOLDEN]
    for r, (name, coef, odds, total) in zip(report, GOLDEN):
        assert r["baseline_pct"] == pytest.approx(BASELINE_PCT, abs=1e-12)
        assert r["logistic"] == coef
        assert r["odds_ratio_pct"] == odds
        assert r["total_risk_pct"] == total
        assert 0 < r["adjusted_pct"] < 100


def test_coefficient_table_length_mismatch(spark):
    with pytest.raises(ValueError):
        coefficient_table(spark, ["a", "b"], [1.0], 0.0, "m")


def test_linear_score_matches_formula(spark):
    import math
    coefs = coefficient_table(spark, ["x", "y"], [0.5, -1.0], 0.25, "m")
    df = spark.createDataFrame([(0, 1, 0), (1, 0, 1), (1, 2, 3)], "label INT, x INT, y INT")
    got = R.linear_score(df, coefs, "m", ["x", "y"], keep=("x", "y")).collect()
    assert len(got) == 3
    for r in got:
        p = 1 / (1 + math.exp(-(0.25 + 0.5 * r["x"] - r["y"])))
        assert r["probability"] == pytest.approx(p)
        assert r["prediction"] == (1.0 if p > 0.5 else 0.0)


def test_model_comparison_ranks_and_time_per_model(spark):
    scored_rows = spark.createDataFrame(
        [("a", 0, 0.0), ("a", 1, 1.0), ("b", 0, 1.0), ("b", 1, 1.0)],
        "model STRING, label INT, prediction DOUBLE")
    times = spark.createDataFrame([("a", 1000, 3), ("b", 10, 4)],
                                  "model STRING, time BIGINT, numTrains BIGINT")
    confusion = met.confusion_counts(scored_rows)
    out = {r["model"]: r for r in R.model_comparison(confusion, times).collect()}
    assert out["a"]["rank"] == 1 and out["a"]["f1"] == 1.0
    assert out["a"]["time_per_model"] == 333 and out["b"]["time_per_model"] == 3
    assert out["b"]["f1"] is None and out["b"]["rank"] == 2


def test_linear_score_of_many_features(spark):
    from pyspark.sql import functions as F
    n = 300
    names = [f"x{i}" for i in range(n)]
    coefs = coefficient_table(spark, names, [0.01 * (i % 7 - 3) for i in range(n)], -0.5, "w")
    df = spark.range(0, 20).select(
        "id", *[((F.col("id") + i) % 3).alias(c) for i, c in enumerate(names)])
    got = R.linear_score(df, coefs, "w", names, keep=("id",)).collect()
    assert len(got) == 20
    for r in got:
        z = -0.5 + sum(0.01 * (j % 7 - 3) * ((r["id"] + j) % 3) for j in range(n))
        assert r["probability"] == pytest.approx(1 / (1 + math.exp(-z)))


def test_linear_score_null_features(spark):
    coefs = coefficient_table(spark, ["x"], [2.0], 0.0, "m")
    df = spark.createDataFrame([(1, 1.0), (2, None)], "id INT, x DOUBLE")
    kept = R.linear_score(df, coefs, "m", ["x"], keep=("id",), handle_invalid="keep").collect()
    assert {r["id"]: r["prediction"] for r in kept} == {1: 1.0, 2: None}
    skipped = R.linear_score(df, coefs, "m", ["x"], keep=("id",), handle_invalid="skip")
    assert [r["id"] for r in skipped.collect()] == [1]
    with pytest.raises(Exception, match="null in a feature"):
        R.linear_score(df, coefs, "m", ["x"], keep=("id",)).collect()
    with pytest.raises(Exception, match="no coefficient of y"):
        R.linear_score(df.withColumnRenamed("x", "y"), coefs, "m", ["y"], keep=("id",)).collect()


def test_reference_profile_moves_baseline(spark):
    coefs = coefficient_table(spark, ["age", "male", "renal"], [0.05, 0.3, 0.5], -3.0, "lr")
    base = R.risk_report(coefs, "lr").first()["baseline_pct"]
    moved = R.risk_report(coefs, "lr", reference_profile={"age": 60, "male": 1}).collect()
    expect = 100 / (1 + math.exp(-(-3.0 + 0.05 * 60 + 0.3)))
    assert all(r["baseline_pct"] == pytest.approx(expect) for r in moved)
    assert base == pytest.approx(100 / (1 + math.exp(3.0)))
    renal = [r for r in moved if r["feature"] == "renal"][0]
    assert renal["odds_ratio_pct"] == round(math.exp(0.5) * 100, 2)
