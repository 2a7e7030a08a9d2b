"""String indexing as a fitted pipeline stage whose vocabulary is a table.

``VocabularyIndexer`` counts the values of its columns and ranks them by frequency
(ties alphabetical) into a Parquet table; ``VocabularyModel`` joins other tables with
it.  Neither collects a vocabulary, so columns of millions of values are fine.  Values
that the fitted table does not have, and nulls, go to the extra index (``keep``), drop
their row (``skip``) or fail the job (``error``).

Saving a model writes its parameters and a copy of the vocabulary; both sides take part
in saved pipelines.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasHandleInvalid, HasInputCols, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.features import frequency_index

VOCABULARY = "column STRING, value STRING, idx BIGINT, n_values BIGINT"


class _Columns(HasInputCols, HasOutputCols, HasHandleInvalid):
    """``nominal``: mark the outputs as categories of known number, as trees want them."""

    nominal = Param(Params._dummy(), "nominal", "mark outputs as nominal attributes",
                    TypeConverters.toBoolean)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(handleInvalid="keep", nominal=False)


class VocabularyIndexer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the frequency index of text columns."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, handleInvalid="keep", nominal=False):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> VocabularyModel:
        cols = self.getInputCols()
        text = dataset.select(*[F.col(c).cast("string").alias(c) for c in cols])
        model = VocabularyModel(frequency_index(text, cols))
        return self._copyValues(model)


class VocabularyModel(Model, _Columns, MLReadable, MLWritable):
    """Joins tables with a fitted vocabulary (column, value, idx, n_values)."""

    def __init__(self, vocabulary: DataFrame | None = None):
        super().__init__()
        self.vocabulary = vocabulary

    def sizes(self) -> dict[str, int]:
        """Number of values of each column: one row per column."""
        rows = self.vocabulary.groupBy("column").agg(F.max("n_values").alias("n")).collect()
        return {r["column"]: r["n"] for r in rows}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sizes, out = self.sizes(), dataset
        rule = self.getHandleInvalid()
        for name, index in zip(self.getInputCols(), self.getOutputCols()):
            values = self.vocabulary.where(F.col("column") == name).select(
                F.col("value").alias("_value"), F.col("idx").cast("double").alias("_idx"))
            out = out.join(values, F.col(name).cast("string") == F.col("_value"), "left")
            n = sizes.get(name, 0)
            found = F.col("_idx")
            if rule == "skip":
                out = out.where(found.isNotNull())
            else:
                found = F.coalesce(found, F.lit(float(n)) if rule == "keep" else F.raise_error(
                    F.lit(f"value without an index in {name}")).cast("double"))
            meta = {"ml_attr": {"type": "nominal", "name": index,
                                "num_vals": n + (rule == "keep")}}
            out = out.withColumn(index, found.alias(index, metadata=meta)
                                 if self.getOrDefault("nominal") else found)
            out = out.drop("_value", "_idx")
        return out

    def copy(self, extra=None) -> VocabularyModel:
        other = super().copy(extra)
        other.vocabulary = self.vocabulary
        return other

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, instance: VocabularyModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.vocabulary.write.parquet(f"{path}/vocabulary")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> VocabularyModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(self.sparkSession.read.schema(VOCABULARY).parquet(f"{path}/vocabulary"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
