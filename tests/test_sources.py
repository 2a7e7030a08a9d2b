import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from riskframe.session import scratch_path
from riskframe.sources import files, sinks


def test_csv_reads_all_strings(spark):
    df = spark.createDataFrame([(1, None, "a;b")], "n INT, s STRING, t STRING")
    path = sinks.write_csv(df, scratch_path(spark, "csv"), sep=";")
    back = files.scan_csv(spark, path, columns=["n", "s", "t"], sep=";").first()
    assert tuple(back) == ("1", None, "a;b")
    assert all(isinstance(f.dataType, T.StringType)
               for f in files.scan_csv(spark, path, sep=";").schema.fields)


def test_feature_names_keep_their_order(spark):
    names = [f"feature_{i}" for i in range(14)]
    frame = files.local_rows(spark, files.with_position(names), "pos INT, value STRING")
    path = sinks.write_json(frame.repartition(14), scratch_path(spark, "features"))
    assert files.feature_list(spark, path) == names


def test_table_append_by_name_and_width(spark):
    schema = T.StructType([T.StructField("modelo", T.StringType()),
                           T.StructField("tempo de treino", T.IntegerType())])
    name = sinks.create_table(spark, sinks.unique_table_name("metrics"), schema)
    assert files.scan_table(spark, name).count() == 0
    row = spark.createDataFrame([(5, "nb")], "`tempo de treino` BIGINT, modelo STRING")
    sinks.append_table(row, name)
    assert tuple(files.scan_table(spark, name).first()) == ("nb", 5)
    with pytest.raises(AnalysisException):
        sinks.append_table(spark.createDataFrame([("x",)], "modelo STRING"), name)


def test_vector_metadata_names(spark):
    from riskframe.operators import features as fe
    df = spark.createDataFrame([(1, 2.0)], "a INT, b DOUBLE")
    out = fe.assemble(df, ["a", "b"])
    assert files.vector_attribute_names(out, "features") == ["a", "b"]


def test_clear_scratch_deletes_what_was_written(spark, monkeypatch):
    from riskframe import session
    monkeypatch.setattr(session, "_handed_out", [])
    path = sinks.write_parquet(spark.range(3), scratch_path(spark, "gone"))
    assert files.scan_parquet(spark, path).count() == 3
    assert session.clear_scratch(spark) == 1
    with pytest.raises(AnalysisException):
        files.scan_parquet(spark, path).count()
