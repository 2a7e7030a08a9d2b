"""The fitted string index, copies without a key, rerunnable appends."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from riskframe.operators import sampling
from riskframe.operators import vocabulary as V
from riskframe.plans import models as M
from riskframe.session import scratch_path
from riskframe.sources import sinks

TRAIN = [("b",), ("a",), ("b",), ("c",), (None,), ("",)]
OTHER = [("a",), ("z",), (None,), ("b",), ("",)]


def test_index_equals_sparks_on_a_second_table(spark):
    train, other = (spark.createDataFrame(r, "v string") for r in (TRAIN, OTHER))
    for rule in ("keep", "skip"):
        ours = V.VocabularyIndexer(inputCols=["v"], outputCols=["i"], handleInvalid=rule)
        theirs = StringIndexer(inputCols=["v"], outputCols=["i"], handleInvalid=rule)
        got, want = (sorted(map(repr, x.fit(train).transform(other).collect()))
                     for x in (ours, theirs))
        assert got == want
    strict = V.VocabularyIndexer(inputCols=["v"], outputCols=["i"], handleInvalid="error")
    with pytest.raises(Exception, match="value without an index in v"):
        strict.fit(train).transform(other).collect()
    assert strict.fit(train).transform(train.where("v is not null")).count() == 5


def test_index_of_no_rows(spark):
    empty = spark.createDataFrame([], "v string")
    model = V.VocabularyIndexer(inputCols=["v"], outputCols=["i"]).fit(empty)
    rows = model.transform(spark.createDataFrame(OTHER, "v string")).collect()
    assert {r.i for r in rows} == {0.0}


def test_saved_index_works_in_a_pipeline(spark):
    rows = spark.createDataFrame([(c, n, "yes" if c in "ab" else "no")
                                  for n in range(40) for c in "abcd"],
                                 "code string, n int, outcome string")
    model = M.coded_pipeline(rows, "outcome", M.make_estimator(
        "rf", numTrees=3, seed=1, featureSubsetStrategy="all")).fit(rows)
    loaded = sinks.load_model(sinks.save_model(model, scratch_path(spark, "coded")),
                              PipelineModel)
    unseen = rows.unionByName(spark.createDataFrame([("zzz", 1, "yes")], rows.schema))
    one, other = (sorted(map(repr, m.transform(unseen).select("code", "n", "prediction")
                             .collect())) for m in (model, loaded))
    assert one == other and len(one) == 161
    assert loaded.stages[0].getHandleInvalid() == "keep"


def test_a_million_values_stay_off_the_driver(spark):
    rows = spark.range(1_000_000).select(F.concat(F.lit("value "), "id").alias("v"))
    model = V.VocabularyIndexer(inputCols=["v"], outputCols=["i"]).fit(rows)
    out = model.transform(rows.limit(1000).unionByName(
        spark.createDataFrame([("never seen",)], "v string")))
    assert model.sizes() == {"v": 1_000_000}
    assert out.where("i = 1000000").count() == 1
    assert out.count() == 1001


def test_copies_are_dealt_one_by_one_and_stay_put(spark):
    rows = spark.createDataFrame([("x", None)] * 5000 + [("y", 1)] * 5000 + [("z", 2)],
                                 "a string, b int")
    train, test = sampling.copy_split(rows, 0.8)
    counts = {r.a: r.n for r in train.groupBy("a").agg(F.count(F.lit(1)).alias("n")).collect()}
    for value in "xy":  # 4000 expected, standard deviation 28
        assert abs(counts[value] - 4000) < 150
    assert train.count() + test.count() == 10_001
    key = lambda df: sorted(map(repr, df.groupBy("a", "b").count().collect()))
    again, _ = sampling.copy_split(rows.repartition(7).orderBy(F.rand(3)), 0.8)
    assert key(train) == key(again)
    assert train.unionByName(test).exceptAll(rows).count() == 0
    assert sampling.copy_split(rows.limit(0))[0].count() == 0


def test_copy_numbers_beyond_a_block(spark, monkeypatch):
    monkeypatch.setattr(sampling, "COPY_BLOCK", 7)
    rows = spark.createDataFrame([("x",)] * 50 + [(None,)] * 8, "a string")
    found = sampling.number_copies(rows).groupBy("a").agg(
        F.sort_array(F.collect_list("copy")).alias("c")).collect()
    assert {r.a: list(r.c) for r in found} == {"x": list(range(50)), None: list(range(8))}


def test_a_rerun_replaces_its_rows(spark):
    path = scratch_path(spark, "by-model")
    rows = spark.createDataFrame([("m1", 1), ("m1", 2), ("m2", 3)], "model string, v int")
    for df in (rows, rows, rows.where("model = 'm2'").withColumn("v", F.lit(9))):
        sinks.replace_rows(df, path, ["model"])
    got = sorted((r.model, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("m1", 1), ("m1", 2), ("m2", 9)]
