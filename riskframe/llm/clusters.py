"""k-means in integers, with PCA-rotated filtering of centroids.

Vectors become integer vectors once; distances that decide anything are exact
integers.  Most centroids are ruled out before any such distance is computed:

1. The covariance of all vectors (one aggregate of sums and products, dim x dim
   numbers) gives an orthogonal rotation whose leading axes hold most variance.
2. Beside each integer vector are stored its ``leading`` first rotated
   coordinates and the norm of the rest, its residual.
3. For a centroid rotated alike, the squared distance of the leading parts plus
   the squared difference of the residual norms is at most the squared distance
   of the whole vectors.  The exact distance to the centroid with the least
   bound caps what can win; centroids whose bound, less a margin for rounding,
   lies above it are ruled out, and the survivors are verified in integers.

A round is one pass over the stored vectors that returns, per task, the sums and
counts of each centroid's vectors; only those sums (centroids x (dim + 1)
numbers) and the centroids reach the driver.

Defined results: vectors that are null, of another length, or hold null or
non-finite components are left out; components beyond 2**19 in size count as
2**19, so that a squared distance fits a long; equal distances go to the smaller
centroid number; equal vec_ids are ordered by their components when the first
centroids are chosen, null ids come last; repeated rows count as often as they
occur; with fewer vectors than centroids there are as many centroids as vectors;
an empty table gives no rows; extra columns are ignored, whatever their names;
the table has no texts, so long texts do not occur.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import materialize

DIM = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
SEED = 2
#: Rotated coordinates that are stored and compared first.
LEADING = 16
LARGEST = 1 << 27
#: Candidate pairs verified at once.
PAIRS_AT_ONCE = 1 << 16

MEMBER_SCHEMA = "vec_id long, whole array<long>, leading array<double>, residual double"


def integer_vectors(rows: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """vec_id and ``whole`` (floor of scale times each component) of the usable vectors."""
    double = F.transform("embedding", lambda x: x.cast("double"))
    usable = (F.size("embedding") == dim) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    bound = float(LARGEST)
    whole = F.transform(double, lambda x: F.floor(F.greatest(
        F.lit(-bound), F.least(F.lit(bound), x * F.lit(float(scale))))).cast("long"))
    return rows.where(F.coalesce(usable, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole.alias("whole"))


def first_centroids(vectors: DataFrame, count: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The vectors of the ids with the smallest hashes, in the order of the hashes."""
    told = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    best = (vectors.orderBy(told.asc_nulls_last(), "vec_id", "whole").limit(count)
            .select("whole").collect())  # at most ``count`` rows
    return np.array([r["whole"] for r in best], np.int64)


def _wholes(batch: pa.RecordBatch, column: str = "whole") -> np.ndarray:
    values = batch.column(column)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def principal_axes(vectors: DataFrame, dim: int = DIM) -> np.ndarray:
    """Orthonormal axes as columns, those of most variance first."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((dim + 1, dim + 1))
        for batch in batches:
            rows = np.ones((batch.num_rows, dim + 1))
            rows[:, :dim] = _wholes(batch).reshape(-1, dim)
            sums += rows.T @ rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(sums.size), pa.int32()), pa.array(sums.ravel())],
            names=["place", "value"])

    sums = np.zeros((dim + 1) ** 2)
    for place, value in (vectors.select("whole").mapInArrow(kernel, "place int, value double")
                         .groupBy("place").agg(F.sum("value")).collect()):
        sums[place] = value
    sums = sums.reshape(dim + 1, dim + 1)
    n = max(1.0, sums[-1, -1])
    mean = sums[-1, :dim] / n
    _, axes = np.linalg.eigh(sums[:dim, :dim] / n - np.outer(mean, mean))
    return np.ascontiguousarray(axes[:, ::-1])


def rotate(whole: np.ndarray, axes: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading rotated coordinates and the norm of the others."""
    turned = whole.astype(np.float64) @ axes
    rest = turned[:, leading:]
    return turned[:, :leading], np.sqrt(np.einsum("ij,ij->i", rest, rest))


def rotated(vectors: DataFrame, axes: np.ndarray, leading: int = LEADING) -> DataFrame:
    """The vectors with their leading coordinates and residual norm."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, residual = rotate(_wholes(batch).reshape(-1, len(axes)), axes, leading)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("whole"),
                 pa.array(list(first), pa.list_(pa.float64())), pa.array(residual)],
                names=["vec_id", "whole", "leading", "residual"])

    return vectors.select("vec_id", "whole").mapInArrow(kernel, MEMBER_SCHEMA)


@dataclass(frozen=True)
class Centroids:
    """Integer centroids beside their rotated parts."""

    whole: np.ndarray
    leading: np.ndarray
    residual: np.ndarray

    @classmethod
    def of(cls, whole: np.ndarray, axes: np.ndarray, leading: int = LEADING) -> Centroids:
        return cls(whole, *rotate(whole, axes, leading))

    def nearest(self, whole: np.ndarray, leading: np.ndarray, residual: np.ndarray):
        """Number of and exact squared distance to the nearest centroid of each row, and
        how many distances were verified."""
        gaps = ((leading ** 2).sum(axis=1)[:, None] + (self.leading ** 2).sum(axis=1)
                - 2 * leading @ self.leading.T)
        bounds = gaps + (residual[:, None] - self.residual) ** 2
        # What rounding can have added to a bound, from the sizes that went into it.
        size = ((leading ** 2).sum(axis=1) + residual ** 2)[:, None] \
            + (self.leading ** 2).sum(axis=1) + self.residual ** 2
        bounds -= 1e-11 * size + 1e-6
        guess = bounds.argmin(axis=1)
        cap = self._exact(whole, np.arange(len(whole)), guess)
        rows, cents = np.nonzero(bounds <= cap[:, None])
        exact = self._exact(whole, rows, cents)
        order = np.lexsort((cents, exact, rows))  # every row has its guess among its pairs
        first = order[np.flatnonzero(np.diff(rows[order], prepend=-1))]
        return cents[first], exact[first], len(rows)

    def _exact(self, whole: np.ndarray, rows: np.ndarray, cents: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows), np.int64)
        for at in range(0, len(rows), PAIRS_AT_ONCE):
            part = slice(at, at + PAIRS_AT_ONCE)
            apart = whole[rows[part]] - self.whole[cents[part]]
            out[part] = np.einsum("ij,ij->i", apart, apart)
        return out


def _read(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = batch.num_rows
    return (_wholes(batch).reshape(n, dim), _wholes(batch, "leading").reshape(n, -1),
            batch.column("residual").to_numpy())


def next_centroids(members: DataFrame, centroids: Centroids) -> np.ndarray:
    """Floors of the means of each centroid's vectors; a centroid without vectors stays."""
    count, dim = centroids.whole.shape

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((count, dim + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                whole, leading, residual = _read(batch, dim)
                nearest, _, _ = centroids.nearest(whole, leading, residual)
                np.add.at(sums, nearest, np.column_stack(
                    [whole, np.ones(len(whole), np.int64)]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(sums.size), pa.int32()), pa.array(sums.ravel())],
            names=["place", "value"])

    sums = [[0] * (dim + 1) for _ in range(count)]
    total = F.sum(F.col("value").cast("decimal(38,0)"))
    for place, value in (members.drop("vec_id").mapInArrow(kernel, "place int, value long")
                         .groupBy("place").agg(total).collect()):
        sums[place // (dim + 1)][place % (dim + 1)] = int(value)
    return np.array([[x // row[-1] for x in row[:-1]] if row[-1] else old.tolist()
                     for row, old in zip(sums, centroids.whole)], np.int64).reshape(count, dim)


def assigned(members: DataFrame, centroids: Centroids) -> DataFrame:
    """vec_id, cluster, distance and n_verified (exact distances computed) per vector."""
    dim = centroids.whole.shape[1]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = distance = np.zeros(0, np.int64)
            if batch.num_rows:
                cluster, distance, _ = centroids.nearest(*_read(batch, dim))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)],
                names=["vec_id", "cluster", "distance"])

    return members.mapInArrow(kernel, "vec_id long, cluster int, distance long")


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(rows: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS,
                    dim: int = DIM, scale: int = SCALE, leading: int = LEADING,
                    seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid (array), centroid_sha256."""
    vectors = materialize(integer_vectors(rows, dim, scale), "integer-vectors")
    start = first_centroids(vectors, count, seed)
    schema = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
              "centroid array<long>, centroid_sha256 string")
    if not len(start):
        return rows.sparkSession.createDataFrame([], schema)
    axes = principal_axes(vectors, dim)
    members = materialize(rotated(vectors, axes, leading), "rotated-vectors")
    centroids = Centroids.of(start, axes, leading)
    for _ in range(rounds):
        centroids = Centroids.of(next_centroids(members, centroids), axes, leading)
    final = materialize(assigned(members, centroids), "clusters")
    inertia = {r["cluster"]: int(r["s"]) for r in final.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # a row a cluster
    largest = (1 << 63) - 1
    told = F.array(*[F.struct(
        F.lit(min(inertia.get(i, 0), largest)).cast("long").alias("cluster_inertia"),
        F.array(*[F.lit(int(x)).cast("long") for x in centroid]).alias("centroid"),
        F.lit(centroid_digest(centroid)).alias("centroid_sha256"))
        for i, centroid in enumerate(centroids.whole)])
    whole = F.lit(min(sum(inertia.values()), largest)).cast("long")
    return final.withColumn("told", F.get(told, F.col("cluster"))).select(
        "vec_id", "cluster", "distance", "told.cluster_inertia", whole.alias("inertia"),
        "told.centroid", "told.centroid_sha256")
