import pytest
from pyspark.sql.types import BooleanType, LongType, StructField, StructType, VarcharType

from quarry.operators.conform import SchemaMismatch, conform, empty_like, schema_diff
from quarry.operators.quality import (QualityError, check_row_count, enforce_key_constraint,
                                      key_constraint_report, row_count_gate)

TARGET = StructType([StructField("id", LongType()), StructField("label_pipeline", VarcharType(5)),
                     StructField("active", BooleanType())])


def test_conform_reorders_and_casts(spark):
    df = spark.createDataFrame([("true", "abcdefgh", "12")], "ACTIVE string, label_pipeline string, id string")
    out = conform(df, TARGET)
    assert out.columns == ["id", "label_pipeline", "active"]
    assert tuple(out.first()) == (12, "abcde", True)  # varchar width cuts instead of failing


def test_conform_extra_and_missing(spark):
    df = spark.createDataFrame([(1, "x", True, True)], "id bigint, label_pipeline string, active boolean, archived boolean")
    with pytest.raises(SchemaMismatch, match="archived"):
        conform(df, TARGET)
    assert conform(df, TARGET, on_extra="drop").columns == ["id", "label_pipeline", "active"]
    assert conform(df, TARGET, on_extra="evolve").columns == ["id", "label_pipeline", "active", "archived"]
    short = spark.createDataFrame([(1,)], "id bigint")
    with pytest.raises(SchemaMismatch, match="label_pipeline"):
        conform(short, TARGET)
    assert conform(short, TARGET, on_missing="null").first().active is None


def test_empty_like_and_diff(spark):
    e = empty_like(spark, StructType([StructField("id", LongType()), StructField("v", VarcharType(9))]))
    assert e.count() == 0 and e.columns == ["id", "v"]
    df = spark.createDataFrame([(1, 2)], "id int, w int")
    assert schema_diff(df, e.schema) == {"extra": ["w"], "missing": ["v"], "retyped": ["id"]}


def test_row_count_gate(spark):
    assert row_count_gate(spark.range(3)).first().n == 3
    with pytest.raises(Exception):
        row_count_gate(spark.range(0)).collect()
    with pytest.raises(QualityError):
        check_row_count(spark.range(0))


def test_key_constraint_report(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id bigint")
    rep = key_constraint_report(df, "id")
    assert sorted((r.id if r.id is not None else -1, r.n) for r in rep.collect()) == [(-1, 1), (1, 2)]
    with pytest.raises(QualityError):
        enforce_key_constraint(df, "id", strict=True)
    multi = spark.createDataFrame([(1, 1), (1, 1), (1, None)], "a int, b int")
    assert key_constraint_report(multi, ["a", "b"]).count() == 2
