import pytest
from pyspark.sql import functions as F

from quarry.operators.dedup import deduplicate, keep_latest
from tests.conftest import SF_SMALL, _explain


def test_keeps_latest_with_nulls_last(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, None, "b"), (1, 3, "c"), (2, None, "d"), (None, 1, "e"),
                                (None, 2, "f")], "k int, v int, tag string")
    out = deduplicate(df, [{"partitionby": ["k"], "orderby": ["v"]}])
    assert sorted((r.k if r.k is not None else -1, r.tag) for r in out.collect()) == [(-1, "f"), (1, "a"), (2, "d")]


def test_specs_apply_in_sequence(spark):
    df = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "x", 3), (2, "y", 0)], "a int, b string, v int")
    out = deduplicate(df, [{"partitionby": ["a"], "orderby": ["v"]}, {"partitionby": ["b"], "orderby": ["v"]}])
    # First spec keeps (1,y,2) and (2,x,3); second sees those two only.
    assert sorted(tuple(r) for r in out.collect()) == [(1, "y", 2), (2, "x", 3)]


def test_empty_specs_is_noop(spark):
    df = spark.range(5)
    assert deduplicate(df, []).count() == 5
    assert deduplicate(df, None).count() == 5


def test_empty_orderby_rejected(spark):
    with pytest.raises(ValueError):
        deduplicate(spark.range(3), [{"partitionby": ["id"], "orderby": []}])


def test_user_column_named_row_survives(spark):
    df = spark.createDataFrame([(1, 7, 1), (1, 8, 2)], "k int, row int, v int")
    out = deduplicate(df, [{"partitionby": ["k"], "orderby": ["v"]}])
    assert out.columns == ["k", "row", "v"]
    assert out.first().row == 8


def test_tie_break_and_idempotence(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 0, "c")], "k int, v int, t string")
    spec = [{"partitionby": ["k"], "orderby": ["v"], "tie_break": ["t"]}]
    once = deduplicate(df, spec)
    assert [r.t for r in once.collect()] == ["b"]
    assert sorted(map(tuple, deduplicate(once, spec).collect())) == sorted(map(tuple, once.collect()))


def test_one_row_per_key_and_partial_limit_before_shuffle(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    out = keep_latest(ev, ["user_id"], ["ts", "event_id"])
    assert out.count() == ev.select("user_id").distinct().count()
    plan = _explain(out, "formatted")
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan
    # One shuffle: exactly one Exchange node in the formatted details.
    assert sum(1 for line in plan.splitlines() if line.startswith("(") and ") Exchange" in line) == 1


def test_hot_key_collapses_before_shuffle(spark):
    # A third of the rows share one key.
    hot = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                    F.col("id").alias("v"))
    out = keep_latest(hot, ["k"], ["v"])
    assert out.where("k = 0").first().v == 29997
    assert out.count() == 20001
