from pyspark.sql import functions as F

from riskframe.operators import ordering


def test_global_rank_is_a_dense_total_order(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        (F.col("id") % 13).alias("k"), (F.col("id") * 7919 % 1000).alias("v"))
    out = ordering.global_rank(df, ["k", F.col("v").desc()], "rank").collect()
    ranks = sorted(r["rank"] for r in out)
    assert ranks == list(range(1, 5001))
    ordered = [(r["k"], -r["v"]) for r in sorted(out, key=lambda r: r["rank"])]
    assert ordered == sorted(ordered)


def test_global_rank_massive_ties_split(spark):
    # Every row has the same key; the unique row id still spreads the sort.
    df = spark.range(0, 3000, numPartitions=5).select(F.lit(1).alias("k"), "id")
    out = ordering.global_rank(df, ["k"], "rank")
    assert sorted(r["rank"] for r in out.collect()) == list(range(1, 3001))


def test_global_rank_nulls_first_ascending(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "x INT")
    out = sorted(ordering.global_rank(df, ["x"]).collect(), key=lambda r: r["rank"])
    assert [r["x"] for r in out] == [None, 1, 2]


def test_global_rank_empty(spark):
    df = spark.createDataFrame([], "x INT")
    assert ordering.global_rank(df, ["x"]).count() == 0


def test_top_k_with_tie_break(spark):
    df = spark.createDataFrame([(1, "b"), (3, "a"), (3, "c"), (2, "d")], "n INT, m STRING")
    got = ordering.top_k(df, [F.col("n").desc(), F.col("m").asc()], 2).collect()
    assert [(r["n"], r["m"]) for r in got] == [(3, "a"), (3, "c")]


def test_leaderboard_nulls_last(spark):
    df = spark.createDataFrame([("x", None), ("y", 0.5), ("z", 0.9)], "model STRING, f1 DOUBLE")
    got = {r["model"]: r["rank"] for r in ordering.leaderboard(df).collect()}
    assert got == {"z": 1, "y": 2, "x": 3}
