"""Readers: delimited text, Parquet, JSON lines, catalog tables, local rows.

Schemas are given explicitly where the format would otherwise infer them,
which saves Spark the extra pass over the data that inference costs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def string_schema(columns) -> T.StructType:
    """All-text, nullable schema (what a header-only CSV read yields)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def scan_csv(spark: SparkSession, path: str, columns=None, sep: str = ";",
             header: bool = True) -> DataFrame:
    """Delimited text with a header, every column a string.

    With ``columns`` the schema is fixed up front; without, Spark reads the
    header (one small job) and still types every column as string.
    """
    reader = spark.read.option("header", str(header).lower()).option("sep", sep)
    if columns is not None:
        reader = reader.schema(string_schema(columns)).option("enforceSchema", "false")
    return reader.csv(path)


def scan_parquet(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """Parquet; a column list is pruned down to the scan's ReadSchema."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns is not None else df


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines; pass a schema to skip the inference pass."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def local_rows(spark: SparkSession, rows, schema: T.StructType | str) -> DataFrame:
    """Typed, named table from a bounded list of driver-side rows."""
    return spark.createDataFrame(list(rows), schema)


def feature_list(spark: SparkSession, path: str) -> list[str]:
    """Feature names in their stored order.

    Names are stored as ``(pos, value)``; sorting by ``pos`` restores the
    order a multi-file JSON read does not keep.
    """
    df = scan_json(spark, path, "pos INT, value STRING").orderBy("pos")
    return [r["value"] for r in df.select("value").collect()]


def feature_frame(spark: SparkSession, path: str) -> DataFrame:
    return scan_json(spark, path, "pos INT, value STRING").select("pos", "value")


def with_position(names) -> list[tuple[int, str]]:
    return [(i, n) for i, n in enumerate(names)]


def vector_attribute_names(df: DataFrame, vector_col: str = "features") -> list[str] | None:
    """Slot names a VectorAssembler recorded in the column metadata."""
    meta = df.schema[vector_col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs")
    if not attrs:
        return None
    slots = []
    for group in attrs.values():
        slots.extend((a["idx"], a["name"]) for a in group)
    return [n for _, n in sorted(slots)]


def column_names_frame(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``(pos, value)`` rows naming the columns of ``df`` in schema order."""
    return local_rows(spark, with_position(df.columns), "pos INT, value STRING")


__all__ = [
    "string_schema", "scan_csv", "scan_parquet", "scan_json", "scan_table",
    "local_rows", "feature_list", "feature_frame", "with_position",
    "vector_attribute_names", "column_names_frame",
]
