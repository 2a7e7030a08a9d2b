"""Grid search with folds that shares fits and survives a lost driver.

* **Prefixes.**  A boosted or bagged ensemble holds every shorter one: the first k of
  its trees are the ensemble that stops at k (exactly for boosting, as another bag of
  trees for a forest).  Combinations that differ only in the number of trees share one
  fit; all its prefixes are scored in one scan of the fold, as one vector of confusion
  cells that is summed.
* **Ledger.**  Results go to a Parquet table keyed by family, combination and fold,
  appended as each fit ends.  A search starts by taking the table's rows off its plan,
  so a search that was stopped goes on where it ended and repeats no fit.
* **Patterns.**  Families train on distinct patterns (``patterns.compress``): those that
  take weights, and the perceptron and the factorization machine in ``counted``.

The plan, the ledger and the summary hold one row per combination and fold.
"""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.metrics import confusion_vector
from riskframe.plans import models as M
from riskframe.plans import patterns as P

#: The parameter that counts an ensemble's trees.
LENGTH = {"rf": "numTrees", "gbt": "maxIter"}
LEDGER = ("family STRING, combo INT, params STRING, fold INT, f1 DOUBLE, millis BIGINT, "
          "unit STRING")
KEY = ["family", "combo", "fold"]
#: Families that train on patterns.
PATTERNED = (*P.WEIGHTED, *M.COUNTING)


@dataclass(frozen=True)
class Search:
    """One family: fixed settings and grid (name -> values)."""

    family: str
    fixed: dict
    grid: dict

    def combinations(self) -> list[dict]:
        """Settings of each combination, in the grid's own order."""
        names = list(self.grid)
        return [dict(zip(names, values)) for values in itertools.product(*self.grid.values())]


@dataclass(frozen=True)
class Unit:
    """One fit: the combinations of one fold that differ only in the number of trees."""

    family: str
    fold: int
    settings: tuple  # fixed and shared settings, as sorted items
    lengths: tuple  # (combo, params, number of trees or None)

    @property
    def name(self) -> str:
        return f"{self.family}/{self.fold}/" + M.settings_text(dict(self.settings))


def plan_rows(searches: list[Search], folds: int) -> list[tuple[str, int, str, int]]:
    """(family, combo, params, fold) of a whole search."""
    return [(s.family, i, M.settings_text(combo), fold) for s in searches
            for i, combo in enumerate(s.combinations()) for fold in range(folds)]


def units(searches: list[Search], todo: set[tuple[str, int, int]]) -> list[Unit]:
    """The fits that the open (family, combo, fold) entries need."""
    found: dict[tuple, list] = {}
    for s in searches:
        length_name = LENGTH.get(s.family)
        for i, combo in enumerate(s.combinations()):
            settings = {**s.fixed, **combo}
            length = settings.pop(length_name, None) if length_name else None
            if length is None:  # an ensemble of the default number of trees, or no ensemble
                settings = {**s.fixed, **combo}
            shared = tuple(sorted((k, tuple(v) if isinstance(v, list) else v)
                                  for k, v in settings.items()))
            for _, _, fold in (t for t in todo if t[:2] == (s.family, i)):
                found.setdefault((s.family, fold, shared), []).append(
                    (i, M.settings_text(combo), length))
    return [Unit(family, fold, shared, tuple(sorted(lengths)))
            for (family, fold, shared), lengths in sorted(found.items(), key=repr)]


# Prefixes ---------------------------------------------------------------------------

def _shares(counts: Column) -> Column:
    """Counts as parts of their sum; none of nothing."""
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    return F.transform(counts, lambda x: F.when(total != 0, x / total).otherwise(0.0))


def tree_votes(model, df: DataFrame) -> tuple[DataFrame, list[Column], bool]:
    """``df`` with what each tree says, and that as arrays: a weighted margin (boosting, the
    flag is true) or its share of each class (forest)."""
    trees = list(model.trees)
    boosted = not hasattr(trees[0], "setRawPredictionCol")
    told = []
    for i, (tree, weight) in enumerate(zip(trees, model.treeWeights)):
        name = f"_tree{i}"
        if boosted:
            tree.setPredictionCol(name)
            told.append(F.array(F.col(name) * F.lit(float(weight))))
        else:
            tree.setRawPredictionCol(name).setPredictionCol("").setProbabilityCol("")
            told.append(_shares(vector_to_array(name)))
        df = tree.transform(df)
    return df, told, boosted


def prefix_predictions(model, df: DataFrame, lengths: list[int], column: str) -> DataFrame:
    """``df`` with an array of predictions: those of the model's first k trees, per k."""
    voted, told, boosted = tree_votes(model, df)
    told = voted.select("*", F.array(*told).alias("_told_by_tree"))

    def first(k: int) -> Column:
        sums = F.aggregate(F.slice("_told_by_tree", 1, k),
                           F.array(*[F.lit(0.0)] * (1 if boosted else 2)),
                           lambda s, x: F.zip_with(s, x, lambda a, b: a + b))
        yes = sums[0] > 0 if boosted else sums[1] > sums[0]
        return F.when(yes, 1.0).otherwise(0.0)

    return told.select(*df.columns, F.array(*[first(k) for k in lengths]).alias(column))


def weighted_f1(cells: list[list[float]]) -> float:
    """Support-weighted F1 of a confusion matrix (rows: labels); an empty one has none."""
    total = sum(map(sum, cells))
    score = 0.0
    for c, row in enumerate(cells):
        support, predicted = sum(row), sum(r[c] for r in cells)
        if support + predicted:
            score += 2 * row[c] / (support + predicted) * support
    return score / total if total else float("nan")


# Search -----------------------------------------------------------------------------

@dataclass
class SearchData:
    """Training rows as feature columns, label and fold, and as patterns with counts."""

    rows: DataFrame
    patterns: DataFrame
    features: list[str]
    label: str = "label"
    fold: str = "fold"

    @classmethod
    def of(cls, rows: DataFrame, features, label: str = "label", fold: str = "fold",
           partitions: int = 1) -> SearchData:
        """Patterns are counted once, in few parts, and persisted."""
        rows = rows.select(*features, label, fold)
        counted = P.compress(rows, features, label, [fold]).coalesce(partitions)
        data = cls(rows, M.persist_training(counted), list(features), label, fold)
        return data

    def part(self, family: str, fold: int | None, inside: bool) -> DataFrame:
        """The rows (or patterns) of one fold, or those of all others."""
        frame = self.patterns if family in PATTERNED else self.rows.withColumn(
            P.WEIGHT, F.lit(1.0))
        if fold is None:
            return frame
        return frame.where(F.col(self.fold) == fold if inside else F.col(self.fold) != fold)

    def fit(self, family: str, settings: dict, fold: int | None):
        train = self.part(family, fold, False)
        settings = {k: list(v) if isinstance(v, tuple) else v for k, v in settings.items()}
        if "hidden" in settings:
            settings["layers"] = [len(self.features), *settings.pop("hidden"), 2]
        if family in P.WEIGHTED:
            # The same for every fold and combination, so fits differ in their rows only.
            return P.fit_patterns(family, train, self.features, self.label, **settings)
        from riskframe.operators.features import assembler

        stages = M.pipeline(assembler(self.features, "features", "error"),
                            M.make_estimator(family, "features", self.label,
                                             P.WEIGHT if family in PATTERNED else None,
                                             **settings))
        return stages.fit(M.with_class_count(train, self.label))


def fit_unit(data: SearchData, unit: Unit) -> list[tuple]:
    """Fit once, score every length on the fold: the unit's ledger rows."""
    start = time.perf_counter()
    settings, lengths = dict(unit.settings), [k for _, _, k in unit.lengths]
    ensemble = unit.family in LENGTH and None not in lengths
    if ensemble:
        settings[LENGTH[unit.family]] = max(lengths)
    model = data.fit(unit.family, settings, unit.fold)
    held = data.part(unit.family, unit.fold, True)
    if ensemble:
        for stage in model.stages[:-1]:
            held = stage.transform(held)
        scored = prefix_predictions(model.stages[-1], held, lengths, "_told")
    else:
        scored = model.transform(held).withColumn("_told", F.array("prediction"))
    cells = confusion_vector(scored, "_told", len(lengths), data.label, weight_col=P.WEIGHT)
    millis = int(round((time.perf_counter() - start) * 1000))
    return [(unit.family, combo, params, unit.fold, weighted_f1(matrix), millis, unit.name)
            for (combo, params, _), matrix in zip(unit.lengths, cells)]


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows; none where nothing has been written yet."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(place):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def open_entries(spark: SparkSession, searches: list[Search], folds: int, path: str) -> DataFrame:
    """The planned (family, combo, params, fold) rows that the ledger does not have."""
    planned = spark.createDataFrame(plan_rows(searches, folds),
                                    "family STRING, combo INT, params STRING, fold INT")
    return planned.join(read_ledger(spark, path).select(*KEY, "params"), [*KEY, "params"],
                        "left_anti")


def run_search(spark: SparkSession, data: SearchData, searches: list[Search], folds: int,
               path: str, parallelism: int = M.PARALLELISM, max_units: int | None = None,
               fit: Callable = fit_unit) -> int:
    """Work off what the ledger at ``path`` lacks of a search; returns the fits made.

    Fits run on ``parallelism`` threads; each one's rows are appended when it ends, so a
    driver that is lost loses the fits under way and no others.  ``max_units`` ends a
    session after so many fits.
    """
    todo = {(r.family, r.combo, r.fold)
            for r in open_entries(spark, searches, folds, path).collect()}
    work = units(searches, todo)[:max_units]

    def done() -> Iterator[list[tuple]]:
        with ThreadPool(max(1, min(parallelism, len(work)))) as pool:
            yield from pool.imap_unordered(
                inheritable_thread_target(spark)(lambda unit: fit(data, unit)), work)

    for rows in done() if work else ():
        spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").parquet(path)
    return len(work)


def averages(ledger: DataFrame, folds: int) -> DataFrame:
    """(family, combo, params, avg_f1, is_best) of combinations whose folds are all there;
    of equal averages the first combination of a family is its best."""
    found = (ledger.groupBy("family", "combo", "params")
             .agg(F.avg("f1").alias("avg_f1"), F.count(F.lit(1)).alias("n"))
             .where(F.col("n") == folds).drop("n"))
    # Folds are added up in no fixed order: averages closer than this are equal.
    top = found.groupBy("family").agg(F.max("avg_f1").alias("top"))
    best = (found.join(top, "family").where(F.col("avg_f1") >= F.col("top") - 1e-12)
            .groupBy("family").agg(F.min("combo").alias("best")))
    return found.join(best, "family").select(
        "family", "combo", "params", "avg_f1", (F.col("combo") == F.col("best")).alias("is_best"))


def times(ledger: DataFrame) -> DataFrame:
    """(model, time, numTrains): seconds of fits made, entries searched.  A fit shared by
    several combinations is timed once."""
    shared = ledger.groupBy("family", "unit", "fold").agg(
        F.max("millis").alias("millis"), F.count(F.lit(1)).alias("n"))
    return shared.groupBy(F.col("family").alias("model")).agg(
        F.sum("millis").alias("time"), F.sum("n").alias("numTrains"),
        F.count(F.lit(1)).alias("n_fits"))


@dataclass
class SearchResult:
    """One family's search: the best combination refitted on all rows, and its time."""

    name: str
    model: object
    millis: int
    num_trains: int
    best_f1: float
    params: str


def search_families(spark: SparkSession, data: SearchData, searches: list[Search], folds: int,
                    path: str, parallelism: int = M.PARALLELISM) -> list[SearchResult]:
    """Family after family: search, then refit the best on all rows, inside its time.

    ``num_trains`` counts combinations x folds, as in the study, whatever number of
    fits they shared.
    """
    results = []
    for s in searches:
        start = time.perf_counter()
        run_search(spark, data, [s], folds, path, parallelism)
        ledger = read_ledger(spark, path).where(F.col("family") == s.family)
        best = averages(ledger, folds).where("is_best").first()
        model = data.fit(s.family, {**s.fixed, **s.combinations()[best.combo]}, None)
        millis = int(round((time.perf_counter() - start) * 1000))
        results.append(SearchResult(s.family, model, millis, len(s.combinations()) * folds,
                                    best.avg_f1, best.params))
    return results


def predictions(models: dict, df: DataFrame, keep=("label",)) -> DataFrame:
    """One scan for many whole pipelines: ``keep`` and a prediction column per model."""
    out = df
    for name, model in models.items():
        before = out.columns
        out = model.transform(out).select(*before, F.col("prediction").alias(name))
    return out.select(*keep, *models)
