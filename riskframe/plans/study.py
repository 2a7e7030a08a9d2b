"""The study as one job: split, search every family, store, reload, score, report.

Stages hand over through files and tables under the shared scratch folder, as
the study's separate training and evaluation programs do: feature names,
training and test rows, one saved model per family, times, then the tables
``metrics`` and ``coefficients`` that reports read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import metrics as met
from riskframe.operators import sampling
from riskframe.plans import models as M
from riskframe.plans import reports as R
from riskframe.session import scratch_path
from riskframe.sources import files, sinks


@dataclass
class StudyResult:
    """Frames read back from what the run stored."""

    leaderboard: DataFrame
    coefficients: DataFrame
    risk: DataFrame
    best: DataFrame


def run(rows: DataFrame, features: list[str], split_key: str, searches: dict,
        folds: int = M.STUDY_FOLDS, train_fraction: float = 0.8,
        partitions: int | None = None, partition_key=None, positive: float = 0.0) -> StudyResult:
    """Train on a key split of ``rows`` (features assembled, label present) and report.

    ``searches`` maps a family to its (fixed settings, grid).  Folds are a
    function of the split key.  ``n_changed`` in the leaderboard counts test
    rows on which a reloaded model disagrees with the one in memory.
    """
    spark = rows.sparkSession
    place = lambda name: scratch_path(spark, f"study-{name}")
    names = files.local_rows(spark, files.with_position(features), "pos INT, value STRING")
    feature_path = sinks.write_json(names, place("features"))
    keyed = rows.withColumn("fold", F.pmod(F.floor(F.col(split_key) / 5), F.lit(folds))
                            .cast("int"))
    train, test = sampling.key_split(keyed, [split_key], train_fraction, buckets=5, hashed=False)
    train = files.scan_parquet(spark, sinks.write_parquet(train, place("training")))
    test = files.scan_parquet(spark, sinks.write_parquet(test, place("test")))

    specs = [M.ModelSpec(kind, dict(fixed), grid) for kind, (fixed, grid) in searches.items()]
    results = M.train_suite(M.with_class_count(train), specs, num_folds=folds, fold_col="fold",
                            n_features=len(features), partitions=partitions,
                            key_cols=partition_key)
    times = files.scan_parquet(
        spark, sinks.write_parquet(M.times_frame(spark, results), place("times")))
    fitted = {r.name: r.model for r in results}
    loaded = {name: sinks.load_model(sinks.save_model(model, place(f"model-{name}")),
                                     CrossValidatorModel) for name, model in fitted.items()}

    # One scan of the test rows scores every model, before and after the reload.
    after = {f"{name}_loaded": model for name, model in loaded.items()}
    scored = M.predictions({**fitted, **after}, test)
    confusion = met.confusion_by_rules(scored, {n: F.col(f"{n}_loaded") for n in loaded})
    changed = scored.agg(*[F.sum((F.col(n) != F.col(f"{n}_loaded")).cast("long")).alias(n)
                           for n in loaded])
    changed = changed.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("model"), F.col(n).alias("n_changed")) for n in loaded])))
    board = R.model_comparison(confusion, times, positive).join(changed, "model")
    metrics = sinks.unique_table_name("metrics")
    sinks.create_table(spark, metrics, board.schema, place(metrics))
    sinks.append_table(board, metrics)

    order = files.feature_list(spark, feature_path)
    linear = {"lr": "logistic", "lsvc": "lsvc"}
    tables = [M.linear_coefficients(spark, M.best_stage(loaded[kind]), order, label)
              for kind, label in linear.items() if kind in loaded]
    coefficients = sinks.unique_table_name("coefficients")
    sinks.create_table(spark, coefficients, tables[0].schema, place(coefficients))
    for table in tables:
        sinks.append_table(table, coefficients)
    stored = files.scan_table(spark, coefficients)
    reference = next(label for kind, label in linear.items() if kind in loaded)
    models = [label for kind, label in linear.items() if kind in loaded]
    return StudyResult(files.scan_table(spark, metrics), stored,
                       R.risk_report(stored, reference, models), M.best_settings(spark, results))
