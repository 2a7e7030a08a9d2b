"""Feature engineering with Spark ML transformers."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators.ordering import global_rank
from riskframe.session import stored


def assembler(input_cols, output_col: str = "features",
              handle_invalid: str = "error") -> VectorAssembler:
    """``error``: a null feature fails the job; ``keep``: null -> NaN;
    ``skip``: the row is dropped."""
    return VectorAssembler(inputCols=list(input_cols), outputCol=output_col,
                           handleInvalid=handle_invalid)


def assemble(df: DataFrame, input_cols, output_col: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    return assembler(input_cols, output_col, handle_invalid).transform(df)


def invalid_feature_rows(df: DataFrame, input_cols) -> DataFrame:
    """How many rows an assembler with ``skip`` drops (a null or NaN in any
    feature), next to the total: ``(n_rows, n_invalid)`` in one pass."""
    bad = None
    for c in input_cols:
        cond = F.col(c).isNull()
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            cond = cond | F.isnan(c)
        bad = cond if bad is None else bad | cond
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count(F.when(bad, F.lit(1))).alias("n_invalid"))


def vector_columns(df: DataFrame, vector_col: str, names, keep=()) -> DataFrame:
    """Spread a vector column into one double column per slot."""
    arr = vector_to_array(F.col(vector_col))
    return df.select(*keep, *[arr[i].alias(n) for i, n in enumerate(names)])


def string_indexer(input_cols, output_cols, handle_invalid: str = "keep") -> StringIndexer:
    """Pipeline stage: index by frequency, most frequent first, ties alphabetical;
    with ``keep`` unseen values and nulls map to the extra index ``numLabels``.
    The fitted stage carries its vocabulary, so it suits columns of codes; for
    columns of very many values use ``string_index``."""
    return StringIndexer(inputCols=list(input_cols), outputCols=list(output_cols),
                         handleInvalid=handle_invalid, stringOrderType="frequencyDesc")


def frequency_index(df: DataFrame, cols) -> DataFrame:
    """``(column, value, idx, n_values)``: each column's values by frequency.

    Most frequent first, ties alphabetical, from 0.  Counts of all columns come
    from one grouped pass; positions are ranks of that vocabulary table, so no
    column's vocabulary is gathered in one place.
    """
    entries = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))
                                  for c in cols]))
    counts = (df.select(entries.alias("e")).select("e.*").where("value is not null")
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    ranked = global_rank(counts, [F.col("column"), F.col("n").desc(), F.col("value")], "place")
    spans = ranked.groupBy("column").agg(F.min("place").alias("first"),
                                         F.count(F.lit(1)).alias("n_values"))
    return stored(ranked.join(spans, "column").select(
        "column", "value", (F.col("place") - F.col("first")).alias("idx"), "n_values"),
        "vocabulary")


def string_index(df: DataFrame, input_cols, output_cols=None,
                 handle_invalid: str = "keep") -> DataFrame:
    """Index text columns by frequency, as joins with their vocabularies.

    Nulls get the extra index ``number of values`` with ``keep``, drop their
    row with ``skip`` and fail the job with ``error``.
    """
    input_cols = list(input_cols)
    output_cols = output_cols or [f"{c}_idx" for c in input_cols]
    vocabulary = frequency_index(df, input_cols)
    sizes = vocabulary.groupBy("column").agg(F.first("n_values").alias("n")).agg(
        F.map_from_entries(F.collect_list(F.struct("column", "n"))))  # one entry per column
    out = df
    for name, index in zip(input_cols, output_cols):
        values = vocabulary.where(F.col("column") == name).select(
            F.col("value").alias("_value"), F.col("idx").cast("double").alias(index))
        out = out.join(values, F.col(name) == F.col("_value"), "left").drop("_value")
        if handle_invalid == "skip":
            out = out.where(F.col(index).isNotNull())
        else:
            extra = F.coalesce(sizes.scalar()[name], F.lit(0)).cast("double") \
                if handle_invalid == "keep" else F.raise_error(F.lit(f"null in {name}"))
            out = out.withColumn(index, F.coalesce(F.col(index), extra.cast("double")))
    return out


def index_label(df: DataFrame, col: str, label_col: str = "label") -> DataFrame:
    """Outcome text -> ``label`` by frequency (most frequent = 0.0)."""
    return string_index(df, [col], [label_col], "error")


def class_count(df: DataFrame, label_col: str = "label") -> int:
    """Number of output classes for a network: max label + 1."""
    return int(df.agg(F.max(label_col)).first()[0]) + 1
