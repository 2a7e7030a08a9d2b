"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import discard, materialize


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; ``root`` is the component's smallest node.

    Each round is two grouped minima and two joins on the nodes and is written
    to the shared folder; the rounds end when a round changes nothing, after a
    number of rounds logarithmic in the longest path.  The minima are written
    before they are joined, so that Spark can split a node that holds many of the
    edges.  Self-loops and repeated edges are allowed; no edges give no rows.
    """
    loops = edges.where(F.col(a) == F.col(b)).select(F.col(a).alias("node"))
    current = materialize(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "edges")
    before = _signature(current)
    while before[0]:
        both = (current.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
                .unionByName(current.select(F.col("lo").alias("u"), F.col("hi").alias("v"))))
        nearest = materialize(both.groupBy("u").agg(F.min("v").alias("v0"))
                              .select("u", F.least("u", "v0").alias("m")), "least-neighbours")
        large = materialize(both.join(nearest, "u").where("v > u").select(
            F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), "large-stars")
        least = materialize(large.groupBy("hi").agg(F.min("lo").alias("m")), "least-neighbours")
        moved = (large.join(least, "hi").where("lo <> m")
                 .select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
        last, current = current, materialize(
            least.select("hi", F.col("m").alias("lo")).unionByName(moved).distinct(), "edges")
        for done in (last, nearest, large, least):
            discard(done)
        after = _signature(current)
        if after == before:
            break
        before = after
    members = current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    roots = current.select(F.col("lo").alias("node")).unionByName(loops).distinct() \
        .join(members, "node", "left_anti").select("node", F.col("node").alias("root"))
    return members.unionByName(roots)
