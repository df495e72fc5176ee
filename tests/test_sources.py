import datetime as dt

from quarry.sources.descriptor import descriptor_schema, descriptor_sql, read_with_descriptor
from quarry.sources.scan import read_parquet_glob, read_rolling, rolling_predicate_sql
from tests.conftest import _explain


def _day_table(spark, path):
    rows = [(i, y, m, d) for i, (y, m, d) in enumerate(
        [("2022", "02", "27"), ("2022", "02", "28"), ("2022", "03", "01"), ("2022", "03", "15"), ("2021", "12", "31")])]
    df = spark.createDataFrame(rows, "id int, partition_0 string, partition_1 string, partition_2 string")
    df.write.mode("overwrite").partitionBy("partition_0", "partition_1", "partition_2").parquet(path)


def test_componentwise_rolling_drops_next_month(spark, tmp_table):
    path = tmp_table("days")
    _day_table(spark, path)
    as_of = dt.date(2022, 3, 2)  # 2 days back -> 2022-02-28
    comp = read_rolling(spark, path, 2, as_of, mode="componentwise")
    date = read_rolling(spark, path, 2, as_of, mode="date")
    # Componentwise: day 1 < 28 and day 15 < 28 are dropped (the trap).
    assert sorted(r.id for r in comp.collect()) == [1]
    assert sorted(r.id for r in date.collect()) == [1, 2, 3]
    for df in (comp, date):
        plan = _explain(df, "formatted")
        assert "PartitionFilters" in plan and "partition_2" in plan.split("PartitionFilters")[1].split("\n")[0]


def test_rolling_predicate_text():
    assert rolling_predicate_sql(1, dt.date(2022, 3, 1)) == \
        "partition_0 >= 2022 AND partition_1 >= 02 AND partition_2 >= 28"


def test_string_partitions_compare_numerically(spark, tmp_table):
    path = tmp_table("days_str")
    _day_table(spark, path)
    df = spark.read.option("basePath", path).schema(
        "id int, partition_0 string, partition_1 string, partition_2 string").parquet(path)
    out = df.where(rolling_predicate_sql(1, dt.date(2022, 3, 1)))
    assert sorted(r.id for r in out.collect()) == [1]


def test_descriptor_schema_nested_and_sql_key(spark, tmp_path):
    desc = {"nome": "int", "telefone": "string",
            "endereco": {"rua": "string", "numero": "int", "complemento": "int"},
            "sql": "select nome, telefone from teste"}
    st = descriptor_schema(desc)
    assert st.simpleString() == ("struct<nome:int,telefone:string,"
                                 "endereco:struct<rua:string,numero:int,complemento:int>>")
    assert descriptor_sql(desc) == "select nome, telefone from teste"
    p = tmp_path / "d.json"
    p.write_text('{"nome": 1, "telefone": "x", "endereco": {"rua": "r", "numero": 2}}\n')
    df = read_with_descriptor(spark, str(p), desc)
    r = df.first()
    assert r.nome == 1 and r.endereco.numero == 2 and r.endereco.complemento is None


def test_descriptor_from_yaml_text():
    st = descriptor_schema("nome: int\ntelefone: string\n")
    assert [f.name for f in st.fields] == ["nome", "telefone"]


def test_parquet_glob_merges_schemas(spark, tmp_table):
    base = tmp_table("glob")
    spark.createDataFrame([(1, "a")], "id int, x string").write.parquet(f"{base}/p1")
    spark.createDataFrame([(2,)], "id int").write.parquet(f"{base}/p2")
    df = read_parquet_glob(spark, f"{base}/p*/*.parquet")
    assert sorted((r.id, r.x) for r in df.collect()) == [(1, "a"), (2, None)]


def test_catalog_table_and_sql_text_predicate(spark, tmp_table):
    from quarry.sources.scan import read_partitioned, read_table

    path = tmp_table("days_sql")
    _day_table(spark, path)
    spark.read.parquet(path).createOrReplaceTempView("quarry_days")
    assert read_table(spark, "quarry_days", fmt="table").count() == 5
    pruned = read_partitioned(spark, path, rolling_predicate_sql(1, dt.date(2022, 3, 1)))
    assert sorted(r.id for r in pruned.collect()) == [1]
    assert "PartitionFilters: [isnotnull(partition_0" in _explain(pruned, "formatted")


def test_small_files_are_packed_into_few_read_tasks(spark):
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL

    df = entry.queries()["scan_small_files"](spark, SF_SMALL)
    files = df.inputFiles()
    assert len(files) == 64
    assert df.rdd.getNumPartitions() < len(files) // 4


def test_descriptor_sql_key_points_to_a_yaml_document(spark, tmp_path):
    from quarry.operators.projection import named_projection

    sql_doc = tmp_path / "sql.yaml"
    sql_doc.write_text("sql: |\n  select nome, endereco.rua as rua\n  from teste\n")
    desc = tmp_path / "teste.yaml"
    desc.write_text("nome: int\ntelefone: string\nendereco:\n  rua: string\n  numero: int\n"
                    f"sql: {sql_doc}\n")
    assert descriptor_sql(str(desc)).strip().startswith("select nome")
    data = tmp_path / "people.json"
    data.write_text('{"nome": 7, "telefone": "1", "endereco": {"rua": "R", "numero": 3}}\n')
    df = read_with_descriptor(spark, str(data), str(desc))
    out = named_projection({"teste": df}, descriptor_sql(str(desc)))
    assert [tuple(r) for r in out.collect()] == [(7, "R")]
