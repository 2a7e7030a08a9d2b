"""Train/test splits, fold assignment, undersampling, unions.

Splits that must be reproducible are derived from a key (a pure function of
the row), so reruns, lost executors and re-ordered inputs give the same parts;
``random_split`` keeps Spark's seeded Bernoulli split.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.ordering import global_rank
from riskframe.session import stored


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 4711) -> list[DataFrame]:
    """Seeded random split (``randomSplit``); parts are disjoint and cover all rows."""
    return df.randomSplit(list(weights), seed)


def bucket_of(key_cols, buckets: int, hashed: bool = True, seed: int = 42) -> Column:
    """Bucket in ``[0, buckets)``: a hash of the key columns, or the plain
    integer key (``hashed=False``) when the key is already well mixed."""
    cols = [F.col(c) if isinstance(c, str) else c for c in key_cols]
    if hashed:
        return F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(buckets)).cast("int")
    if len(cols) != 1:
        raise ValueError("an unhashed bucket needs exactly one integer key")
    return F.pmod(cols[0], F.lit(buckets)).cast("int")


def key_split(df: DataFrame, key_cols, train_fraction: float = 0.8, buckets: int = 100,
              hashed: bool = True, part_col: str | None = None):
    """Deterministic split on a key.  Returns (train, test), or one frame with
    a ``part_col`` of 'train' / 'test' when ``part_col`` is given."""
    cut = int(round(train_fraction * buckets))
    is_train = bucket_of(key_cols, buckets, hashed) < F.lit(cut)
    if part_col:
        return df.withColumn(part_col, F.when(is_train, F.lit("train")).otherwise(F.lit("test")))
    return df.where(is_train), df.where(~is_train)


def assign_folds(df: DataFrame, key_cols, k: int, fold_col: str = "fold",
                 hashed: bool = True) -> DataFrame:
    """Deterministic fold column in ``[0, k)`` for cross-validation."""
    return df.withColumn(fold_col, bucket_of(key_cols, k, hashed))


def split_for_training(df: DataFrame, train_fraction: float = 0.8, seed: int = 4711,
                       key_cols=None, persist: bool = True, partitions: int | None = None):
    """Train/test parts ready for repeated passes: a seeded random split (or a
    key split when ``key_cols`` is given), dealt by ``deal_rows`` when a number
    of partitions is given, and persisted (memory, then disk)."""
    if key_cols:
        parts = key_split(df, key_cols, train_fraction)
    else:
        parts = random_split(df, (train_fraction, 1.0 - train_fraction), seed)
    if partitions:
        parts = [deal_rows(p, partitions, key_cols or df.columns) for p in parts]
    if persist:
        parts = [p.persist(StorageLevel.MEMORY_AND_DISK) for p in parts]
    return parts[0], parts[1]


def deal_rows(df: DataFrame, partitions: int, key_cols) -> DataFrame:
    """``df`` in exactly ``partitions`` parts by a hash of ``key_cols``.

    The same rows form the same parts whatever the cluster, so fits that draw
    per partition (random forests) do not change with its width.
    """
    return df.repartition(partitions, *key_cols)


#: Rows that one part of a training frame is to hold.
PART_ROWS = 1_000_000


def parts_for(df: DataFrame, least: int) -> int:
    """Parts of a training frame: ``least`` or, of a longer one, as many as its rows ask
    for, so that no task's part grows with the table.  A function of the rows, not of the
    cluster."""
    return max(least, -(-df.count() // PART_ROWS))


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


#: Copies numbered by one task at a time.
COPY_BLOCK = 1 << 16


def number_copies(df: DataFrame, number_col: str = "copy") -> DataFrame:
    """``df`` with a number (from 0) that tells the copies of equal rows apart.

    Equal rows are counted, combined before they travel, and written out again from
    their count in blocks that are dealt to all tasks, so a row that holds a third of
    the table is no task's own.  Numbers depend on the rows alone, not on their order.
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg((F.count(F.lit(1)) - 1).alias("_last"))
    blocks = counted.select(*columns, "_last", F.explode(F.sequence(
        F.lit(0), F.floor(F.col("_last") / COPY_BLOCK))).alias("_block"))
    first = F.col("_block") * COPY_BLOCK
    return (blocks.repartition(*columns, "_block")
            .select(*columns, F.explode(F.sequence(first, F.least(
                first + (COPY_BLOCK - 1), F.col("_last")))).alias(number_col)))


def copy_split(df: DataFrame, train_fraction: float = 0.8, digest_of=None,
               part_col: str | None = None):
    """Train/test split of a table without a key: copies of a row are dealt one by one.

    A row's part is a function of an md5 over its columns (or the expressions
    ``digest_of``) and its copy's number, so the parts of a table hold the same rows
    however it is ordered, partitioned or rerun.  Returns (train, test), or one frame
    with ``part_col``.
    """
    numbered = number_copies(df, "_copy")
    told = digest_of or [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in df.columns]
    digest = F.substring(F.md5(F.concat_ws("|", *[x.cast("string") for x in told],
                                           F.col("_copy").cast("string"))), 1, 8)
    is_train = digest < F.lit(f"{round(train_fraction * 0xFFFFFFFF):08x}")
    if part_col:
        return numbered.withColumn(part_col, F.when(is_train, F.lit("train"))
                                   .otherwise(F.lit("test"))).drop("_copy")
    return numbered.where(is_train).drop("_copy"), numbered.where(~is_train).drop("_copy")


HASH_BUCKETS = 1 << 16


def undersample(df: DataFrame, label_col: str = "label", seed: int = 7,
                order: Column | None = None) -> DataFrame:
    """Exact undersampling: every class keeps as many rows as the smallest one.

    Each class keeps its ``m`` rows with the smallest ``order`` (a 64-bit number;
    default: a seeded hash of the whole row), so the choice is reproducible;
    equal ones are told apart by all
    columns, and equal rows are interchangeable.  A histogram of the hash's top
    16 bits per class (at most 65,536 rows a class, cumulated in a window
    partitioned by class) names the bucket in which each class reaches ``m``:
    rows of lower buckets stay by a filter, and only the cut buckets of all
    classes, read in one pass, are ranked by ``global_rank``, which splits a
    bucket full of identical rows too.
    """
    columns = df.columns
    if order is None:
        order = F.xxhash64(*[F.col(c) for c in columns], F.lit(seed))
    tagged = df.withColumn("_h", order).withColumn(
        "_b", (F.shiftright(F.col("_h"), 48) + F.lit(HASH_BUCKETS // 2)).cast("int"))
    label = F.col(label_col)
    histogram = tagged.groupBy(label.alias("_label"), "_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("_label").orderBy("_b")
    sums = stored(histogram, "hash-histogram").withColumn("_upto", F.sum("_n").over(upto))
    least = sums.groupBy("_label").agg(F.max("_upto").alias("_size")).agg(
        F.min("_size").alias("_m"))
    # One row per class: the first bucket at which its running count reaches m.
    cuts = (sums.where(F.col("_upto") >= least.scalar())
            .groupBy("_label").agg(F.min("_b").alias("_cut"),
                                   F.min("_upto").alias("_reached"),
                                   F.min_by("_n", "_b").alias("_in_cut")))
    cuts = stored(cuts.select("_label", "_cut", (least.scalar() - F.col("_reached")
                                                 + F.col("_in_cut")).alias("_need")), "cuts")
    placed = tagged.join(cuts, label.eqNullSafe(F.col("_label")))
    below = placed.where("_b < _cut").select(*columns)
    edge = stored(placed.where("_b = _cut").select(*columns, "_h", "_label", "_need"),
                  "cut-buckets")
    ranked = global_rank(edge, ["_label", "_h", *columns], "_rank")
    first = ranked.groupBy(F.col("_label").alias("_of")).agg(F.min("_rank").alias("_first"))
    chosen = (ranked.join(first, F.col("_label").eqNullSafe(F.col("_of")))
              .where("_rank - _first < _need").select(*columns))
    return below.unionByName(chosen)
