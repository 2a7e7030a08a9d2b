from pyspark.sql import functions as F

from riskframe.operators import sampling


def test_random_split_disjoint_and_complete(spark):
    df = spark.range(0, 2000)
    a, b = sampling.random_split(df, (0.8, 0.2), seed=5)
    ids_a = {r.id for r in a.collect()}
    ids_b = {r.id for r in b.collect()}
    assert not ids_a & ids_b and len(ids_a | ids_b) == 2000
    a2, _ = sampling.random_split(df, (0.8, 0.2), seed=5)
    assert ids_a == {r.id for r in a2.collect()}


def test_key_split_is_a_function_of_the_key(spark):
    df = spark.range(0, 3000).withColumn("k", F.col("id") % 1000)
    train, test = sampling.key_split(df, ["k"], 0.8)
    tr = {r.k for r in train.collect()}
    te = {r.k for r in test.collect()}
    assert not tr & te and len(tr | te) == 1000
    assert 0.7 < train.count() / 3000 < 0.9
    shuffled = df.orderBy(F.rand(1)).repartition(3)
    assert {r.k for r in sampling.key_split(shuffled, ["k"], 0.8)[0].collect()} == tr


def test_assign_folds_range(spark):
    df = sampling.assign_folds(spark.range(0, 1000), ["id"], 5)
    counts = {r["fold"]: r["count"] for r in df.groupBy("fold").count().collect()}
    assert set(counts) == set(range(5)) and sum(counts.values()) == 1000


def test_undersample_exact(spark):
    df = spark.range(0, 1000).select("id", (F.col("id") % 10 < 3).cast("int").alias("label"))
    out = sampling.undersample(df, "label", seed=3)
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts == {0: 300, 1: 300}
    again = sampling.undersample(df, "label", seed=3)
    assert sorted(r.id for r in out.collect()) == sorted(r.id for r in again.collect())


def test_undersample_with_duplicate_rows(spark):
    df = spark.createDataFrame([(0,)] * 50 + [(1,)] * 7, "label INT")
    out = sampling.undersample(df, "label")
    assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == {0: 7, 1: 7}


def test_union_all_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n INT, s STRING")
    b = spark.createDataFrame([("y", 2)], "s STRING, n INT")
    assert sorted(tuple(r) for r in sampling.union_all(a, b).collect()) == [(1, "x"), (2, "y")]


def test_undersample_keeps_the_smallest_hashes(spark):
    df = spark.range(0, 5000, numPartitions=4).select(
        "id", (F.col("id") % 7 < 5).cast("int").alias("label"))
    h = F.xxhash64(F.col("id"), F.col("label"), F.lit(11))
    m = df.where("label = 0").count()
    expect = {r.id for r in df.where("label = 1").orderBy(h).limit(m).collect()}
    out = sampling.undersample(df, "label", seed=11)
    assert {r.id for r in out.where("label = 1").collect()} == expect
    assert out.where("label = 0").count() == m


def test_undersample_null_class_and_no_rows(spark):
    df = spark.createDataFrame([(None, i) for i in range(9)] + [(1, i) for i in range(4)],
                               "label INT, x INT")
    out = sampling.undersample(df, "label")
    assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == \
        {None: 4, 1: 4}
    assert sampling.undersample(df.where("false"), "label").count() == 0


def test_undersample_a_million_identical_rows(spark):
    df = spark.range(0, 1_000_000, numPartitions=8).select(
        F.lit(0).alias("label"), F.lit("same").alias("s")).unionByName(
        spark.range(0, 1500).select(F.lit(1).alias("label"), F.lit("x").alias("s")))
    out = sampling.undersample(df, "label")
    assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == \
        {0: 1500, 1: 1500}


def test_split_for_training_deals_by_key_and_persists(spark):
    df = spark.range(0, 1000, numPartitions=1)
    train, test = sampling.split_for_training(df, 0.8, seed=3, partitions=6)
    assert train.rdd.getNumPartitions() == test.rdd.getNumPartitions() == 6
    assert train.storageLevel.useMemory and test.storageLevel.useDisk
    assert train.count() + test.count() == 1000
    train.unpersist()
    test.unpersist()
