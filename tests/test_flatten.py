import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from quarry.operators.flatten import FlattenNameClash, coalesce_choice, flatten_all, flatten_struct, is_flat
from tests.conftest import SF_SMALL, _explain

NESTED_DDL = ("id int, s struct<a:int, b:struct<c:int>>, xs array<int>, ys array<string>, m map<string,int>, "
              "az array<struct<z:int>>, aa array<array<int>>, nn struct<n:int>, ea array<int>")


def nested(spark):
    row = (1, (10, (100,)), [1, 2], ["a", "b"], {"k": 1}, [(7,)], [[1], [2, 3]], None, [])
    return spark.createDataFrame([row], NESTED_DDL)


def test_flatten_all_column_order_and_cross_product(spark):
    out = flatten_all(nested(spark))
    assert out.columns == ["id", "xs", "ys", "m", "aa", "ea", "s_a", "az_z", "nn_n", "s_b_c"]
    # Two independent arrays (and the nested one) multiply: 2 x 2 x 3 = 12.
    assert out.count() == 12
    assert isinstance(out.schema["m"].dataType, MapType)  # maps are not flattened
    rows = out.collect()
    assert {r.ea for r in rows} == {None}  # empty array keeps its row
    assert {r.nn_n for r in rows} == {None}  # null struct: children null
    assert sorted({r.aa for r in rows}) == [1, 2, 3]


def test_flatten_struct_leaves_arrays(spark):
    out = flatten_struct(nested(spark))
    assert out.columns == ["id", "xs", "ys", "m", "az", "aa", "ea", "s_a", "nn_n", "s_b_c"]
    assert isinstance(out.schema["az"].dataType, ArrayType)
    assert isinstance(out.schema["az"].dataType.elementType, StructType)
    assert out.count() == 1
    assert is_flat(out, allow_arrays=True) and not is_flat(out)


def test_null_and_empty_arrays_keep_rows(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [(5,), (6,)])], "id int, xs array<struct<v:int>>")
    out = flatten_all(df)
    assert out.columns == ["id", "xs_v"]
    assert sorted((r.id, r.xs_v) for r in out.collect()) == [(1, None), (2, None), (3, 5), (3, 6)]


def test_name_clash_fails_early(spark):
    df = spark.createDataFrame([(1, (2,))], "s_a int, s struct<a:int>")
    with pytest.raises(FlattenNameClash, match="s_a"):
        flatten_struct(df)


def test_dotted_field_names(spark):
    df = spark.createDataFrame([((1, 2),)], "`s.x` struct<`a.b`:int, c:int>")
    out = flatten_struct(df)
    assert out.columns == ["s.x_a.b", "s.x_c"]
    assert out.first()["s.x_a.b"] == 1


def test_array_of_array_and_struct_holding_array(spark):
    df = spark.createDataFrame([(1, ([[1, 2], [3]],))], "id int, s struct<aa:array<array<int>>>")
    out = flatten_all(df)
    assert out.columns == ["id", "s_aa"]
    assert sorted(r.s_aa for r in out.collect()) == [1, 2, 3]


def test_with_position_and_array_selection(spark):
    df = spark.createDataFrame([(1, [10, 20], ["x"])], "id int, xs array<int>, ys array<string>")
    out = flatten_all(df, arrays=["xs"], with_position=True)
    assert out.columns == ["id", "xs_pos", "xs", "ys"]
    assert sorted((r.xs_pos, r.xs) for r in out.collect()) == [(0, 10), (1, 20)]


def test_flatten_is_one_projection_per_array(spark):
    out = flatten_all(nested(spark))
    plan = _explain(out, "extended").split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    # Six array levels to explode (xs, ys, az, aa twice, ea): one Generate each.
    assert plan.count("Generate explode") == 6
    assert plan.count("Project") <= 7
    assert is_flat(out)


def test_nested_pruning_reaches_scan(spark):
    from quarry import fixtures as fx

    df = flatten_struct(fx.nested_orders(spark, SF_SMALL)).select("id", "order_amount_total")
    plan = _explain(df, "formatted")
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_coalesce_choice(spark):
    df = spark.createDataFrame([(1, 5, None), (2, None, "7"), (3, None, None)],
                               "id int, at_long bigint, at_string string")
    out = coalesce_choice(df, "at")
    assert out.columns == ["id", "at"]
    assert sorted((r.id, r.at) for r in out.collect()) == [(1, 5), (2, 7), (3, None)]


def test_raw_orders_envelope_bounds_arrays(spark):
    from quarry import fixtures as fx

    raw = fx.raw_orders(spark, SF_SMALL, lines_per_record=2)
    sizes = [r.n for r in raw.select(F.size("_raw_data.lines").alias("n")).collect() if r.n is not None]
    assert max(sizes) <= 2
    # Splitting records does not change the flattened rows.
    a = flatten_all(raw).count()
    b = flatten_all(fx.raw_orders(spark, SF_SMALL)).count()
    assert a == b


def test_envelope_of_a_hot_order_stays_bounded(spark):
    from quarry import fixtures as fx

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    # A third of all lines belong to one order.
    hot = li.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")))
    raw = fx.raw_orders(spark, SF_SMALL, lines_per_record=16, lineitem=hot)
    sizes = raw.select(F.size("_raw_data.lines").alias("n")).where("n is not null").agg(F.max("n")).first()[0]
    assert sizes <= 16
    hot_records = raw.where(F.col("_raw_data.orderId") == "0").count()
    hot_lines = hot.where("l_orderkey = 0").count()
    assert hot_records >= hot_lines // 16
    flat = flatten_all(raw).where(F.col("_raw_data_lines_lineNumber").isNotNull())
    assert flat.count() == hot.join(spark.read.parquet(f"{SF_SMALL}/orders.parquet"),
                                    hot.l_orderkey == F.col("o_orderkey")).count()


def test_envelope_shuffles_the_lines_once(spark):
    from quarry import fixtures as fx

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        plan = _explain(fx.raw_orders(spark, SF_SMALL), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Details of the exchanges: a node's title, then its input columns.
    inputs = [b.splitlines()[1] for b in plan.split("\n\n") if b.lstrip().startswith("(") and " Exchange" in b.splitlines()[0]]
    assert sum("l_extendedprice" in x or "__lines" in x for x in inputs) == 1, inputs


def test_envelope_of_odd_rows(spark):
    """Lines that are all alike share a salt; null keys, orders without lines or twice."""
    from quarry import fixtures as fx

    line = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    day = dt.datetime(2024, 1, 2)
    rows = [(key, 1, 2, 1, 3.0, 4.0, 0.0, 0.1, "N", "O", day) for key in [7] * 10 + [8, 8, None, 99]]
    order = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    orders = [(key, 1, status, 9.0, day, "5-LOW") for key, status in [(7, "F"), (8, "O"), (8, "O"), (9, "F"), (10, "O"), (None, "F"), (None, "O")]]
    raw = fx.raw_orders(spark, "", lines_per_record=4, orders=spark.createDataFrame(orders, order), lineitem=spark.createDataFrame(rows, line))
    got = sorted((str(r.k), -1 if r.n is None else r.n) for r in raw.select(F.col("_raw_data.orderId").alias("k"), F.when(F.col("_raw_data.lines").isNotNull(), F.size("_raw_data.lines")).alias("n")).collect())
    assert got == [("10", -1), ("7", 2), ("7", 4), ("7", 4), ("8", 2), ("8", 2), ("9", 0), ("None", -1), ("None", 0)]


def test_wide_payload_flattens_quickly(spark):
    import time

    from pyspark.sql.types import IntegerType, StructField

    inner = StructType([StructField(f"f{i}", IntegerType()) for i in range(2000)])
    schema = StructType([StructField("id", IntegerType()), StructField("payload", inner)])
    df = spark.createDataFrame([], schema)
    t0 = time.perf_counter()
    out = flatten_struct(df)
    assert len(out.columns) == 2001 and out.columns[-1] == "payload_f1999"
    assert time.perf_counter() - t0 < 30


def test_coalesce_choice_with_named_alternatives(spark):
    df = spark.createDataFrame([(1, None, "7", 9.5)], "id int, at_long bigint, at_string string, at_longitude double")
    out = coalesce_choice(df, "at", alternatives=["long", "string"])
    assert out.columns == ["id", "at_longitude", "at"]
    assert out.first().at == 7
