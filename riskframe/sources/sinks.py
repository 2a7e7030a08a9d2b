"""Writers: Parquet / JSON / CSV files, catalog tables, models.

Tables are managed by the session's warehouse unless the caller names a path
(the jobs put theirs under the shared scratch root).
"""

from __future__ import annotations

import re
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def write_csv(df: DataFrame, path: str, sep: str = ";", header: bool = True,
              mode: str = "overwrite") -> str:
    df.write.mode(mode).option("sep", sep).option("header", str(header).lower()).csv(path)
    return path


def unique_table_name(prefix: str) -> str:
    return f"{re.sub(r'[^A-Za-z0-9_]', '_', prefix)}_{uuid.uuid4().hex[:10]}"


def create_table(spark: SparkSession, name: str, schema: T.StructType,
                 path: str | None = None) -> str:
    """Create or replace an empty, typed table (``CREATE TABLE`` from a
    zero-row frame): managed by the catalog's warehouse, or external at
    ``path``.  Column names may contain spaces."""
    writer = spark.createDataFrame([], schema).write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return name


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove a table from the catalog; a managed one goes with its files."""
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def append_table(df: DataFrame, name: str) -> str:
    """Append rows by column name.  Numeric widening (bigint -> int column)
    follows the store-assignment rules; a missing column is an error."""
    df.write.mode("append").saveAsTable(name)
    return name


def replace_rows(df: DataFrame, path: str, by: list[str]) -> str:
    """Append rows such that a rerun does not double them: whatever the table at ``path``
    holds under the values of ``by`` that occur in ``df`` gives way to ``df``'s rows.

    The table is partitioned by those columns and the write swaps whole partitions when
    it commits; rows of other values are not read or touched.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))
    return path


def cache(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Persist a frame that several jobs reuse (spills instead of recomputing)."""
    return df.persist(level)


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str, kind=None):
    """Load a saved model; ``kind`` defaults to a cross-validated model."""
    if kind is None:
        from pyspark.ml.tuning import CrossValidatorModel as kind
    return kind.load(path)
