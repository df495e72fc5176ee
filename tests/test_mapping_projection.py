import json

import pytest
from pyspark.errors import AnalysisException

from quarry.operators.mapping import apply_mapping, parse_mapping
from quarry.operators.projection import named_projection, sql_projection

DOC = json.dumps({"schema": [
    {"Name": "a_id", "Type": "string", "NameTo": "id", "TypeTo": "bigint"},
    {"Name": "a_label", "Type": "string", "NameTo": "label", "TypeTo": "string"},
    {"Name": "a_ms", "Type": "long", "NameTo": "dt", "TypeTo": "long"},
    {"Name": "a_flag", "Type": "boolean", "NameTo": "flag", "TypeTo": "boolean"},
]})


def frame(spark):
    return spark.createDataFrame([("12", "x", 5, True, "junk"), ("abc", "y", None, False, "junk"),
                                  ("12.7", "z", 7, None, "junk")],
                                 "a_id string, a_label string, a_ms bigint, a_flag boolean, other string")


def test_mapping_keeps_renames_casts_in_order(spark):
    out = apply_mapping(frame(spark), DOC)
    assert out.columns == ["id", "label", "dt", "flag"]
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "string", "bigint", "boolean"]
    # try_cast: unparseable and fractional text become null (ANSI would raise).
    assert [r.id for r in out.orderBy("label").collect()] == [12, None, None]


def test_mapping_strict_raises(spark):
    with pytest.raises(Exception):
        apply_mapping(frame(spark), DOC, strict=True).collect()


def test_mapping_missing_column(spark):
    m = parse_mapping(DOC) + [("absent", "string", "gone", "int")]
    with pytest.raises(ValueError, match="absent"):
        apply_mapping(frame(spark), m)
    out = apply_mapping(frame(spark), m, missing="null")
    assert out.columns[-1] == "gone" and {r.gone for r in out.collect()} == {None}


def test_projection_view_named_table_with_semicolon(spark):
    df = apply_mapping(frame(spark), DOC)
    out = sql_projection(df, "select id, upper(label) as label from table where id is not null;")
    assert [tuple(r) for r in out.collect()] == [(12, "X")]


def test_projection_does_not_collide_between_pipelines(spark):
    a = spark.createDataFrame([(1,)], "v int")
    b = spark.createDataFrame([(2,)], "v int")
    qa = sql_projection(a, "select v from table")
    qb = sql_projection(b, "select v from table")
    assert qa.first().v == 1 and qb.first().v == 2
    with pytest.raises(AnalysisException):
        spark.table("table")  # nothing global was registered


def test_projection_placeholder_and_named_frames(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    assert sql_projection(a, "select s from {table}").first().s == "x"
    b = spark.createDataFrame([(1, 9)], "k int, w int")
    out = named_projection({"teste": a, "other": b}, "select s, w from teste join other using (k)")
    assert tuple(out.first()) == ("x", 9)


def test_qualified_columns_and_comma_joins(spark):
    from quarry.operators.projection import named_projection, sql_projection

    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert sorted(r.id for r in sql_projection(df, "select table.id from table where table.v <> 'x'").collect()) == [1, 2]
    assert sql_projection(df, "select t.id from table t where t.id = 1").count() == 1
    assert sql_projection(df, "select t.id from table as t").count() == 2
    other = spark.createDataFrame([(1, 10)], "k int, w int")
    got = named_projection({"table": df, "a": other}, "select a.w, table.v from a, table where a.k = table.id").collect()
    assert [tuple(r) for r in got] == [(10, "a")]
