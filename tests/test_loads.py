"""Loads that must hold under failures: reject channel, swapped refreshes, exactly-once
streams, bookmarks over catalog tables, files whose types differ, key checks."""

import datetime as dt
import json
import os
import subprocess
import sys
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.operators.flatten import coalesce_choice, flatten_all, flatten_struct
from quarry.operators.quality import QualityError
from quarry.operators.upsert import upsert_guarded
from quarry.plans.pipeline import PipelineConfig, query_descriptor, run_pipeline
from quarry.sinks import files
from quarry.sinks.publish import full_refresh, publish_upsert, read_bucketed, table_state
from quarry.sources import drift
from quarry.sources.scan import read_rolling, rolling_predicate
from quarry.sources.zones import TooManyRejects, load_entity
from quarry.streaming.bookmark import process_new_table_files
from tests.conftest import _explain

D = dt.datetime
SHAPE = StructType().add("a", "long").add("s", "string")


# --- S7: reject channel ----------------------------------------------------------

LINES = ['{"a": 1, "s": "x"}', '{"a": "one", "s": "y"}', "not json", '{"a": 2, "s": "z", "more": 3}', '{"s": "no a"}', '{"a": 4, "s": "cut']


def landing(tmp_path, lines, name="land"):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "part.json").write_text("\n".join(lines))
    return str(folder)


def test_bad_records_go_to_quarantine(spark, tmp_path):
    dst = str(tmp_path / "zone" / "people")
    load = load_entity(spark, landing(tmp_path, LINES), dst, SHAPE, max_reject_share=0.5)
    assert (load.rows, load.rejected) == (3, 3)
    assert sorted((r.a, r.s) for r in spark.read.parquet(dst).where("a is not null").collect()) == [(1, "x"), (2, "z")]
    assert spark.read.parquet(dst).columns == ["a", "s"] and spark.read.parquet(dst).where("a is null and s is null").count() == 0
    bad = spark.read.parquet(load.rejects).collect()
    assert sorted(r.record for r in bad) == sorted([LINES[1], LINES[2], LINES[5]]) and all("part.json" in r.file for r in bad)
    assert {r.record: tuple(r.parsed) for r in bad}[LINES[1]] == (None, "y")       # the field that did fit


def test_too_many_rejects_leave_the_zone_as_it_was(spark, tmp_path):
    dst, shape = str(tmp_path / "zone" / "people"), SHAPE
    load_entity(spark, landing(tmp_path, LINES[:1]), dst, shape)
    with pytest.raises(TooManyRejects, match="3 of 6"):
        load_entity(spark, landing(tmp_path, LINES, "later"), dst, shape)
    assert [tuple(r) for r in spark.read.parquet(dst).collect()] == [(1, "x")]
    clean = load_entity(spark, landing(tmp_path, LINES[:1] + LINES[3:4], "clean"), dst, shape)
    assert clean.rejected == 0 and not os.path.exists(clean.rejects)        # the old rejects are gone
    assert spark.read.parquet(dst).count() == 2


def test_rejects_with_an_inferred_schema(spark, tmp_path):
    load = load_entity(spark, landing(tmp_path, LINES[:1] + ["{{"]), str(tmp_path / "z"), max_reject_share=1.0)
    assert load.table.columns == ["a", "s"] and (load.rows, load.rejected) == (1, 1)


# --- K6: refresh by swap ---------------------------------------------------------

def test_refresh_that_fails_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    full_refresh(spark.range(10), path, sort_key="id")
    broken = spark.range(1000).select(F.when(F.col("id") == 777, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(PySparkException):
        full_refresh(broken, path, sort_key="id")
    assert spark.read.parquet(path).count() == 10
    assert os.listdir(tmp_path) == ["t"]                    # nothing is left beside it
    full_refresh(spark.read.parquet(path).where("id < 5"), path)       # from itself
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(5))


def test_swap_that_is_cut_off_is_put_right(spark, tmp_path):
    path, old = str(tmp_path / "t"), files._beside(str(tmp_path / "t"), "old")
    full_refresh(spark.range(10), path)
    os.rename(path, old)                                    # the driver died between the two renames
    files.restore_folder(spark, path)
    assert spark.read.parquet(path).count() == 10 and not os.path.exists(old)
    os.rename(path, old)
    full_refresh(spark.range(3), path)                      # the next refresh does it too
    assert spark.read.parquet(path).count() == 3 and not os.path.exists(old)
    with pytest.raises(OSError):
        files.replace_folder(spark, str(tmp_path / "not there"), path)
    assert spark.read.parquet(path).count() == 3


# --- S8: files whose types differ ------------------------------------------------

def test_types_are_joined(spark, tmp_path):
    at = lambda n: str(tmp_path / "d" / n)
    spark.sql("select 1L as k, 1 as i, named_struct('x', 1, 'y', 'a') as s, array(1) as xs, 5 as only").write.parquet(at("p1"))
    spark.sql("select 'two' as k, 2L as i, named_struct('x', 'b', 'z', 2) as s, array('q') as xs").write.parquet(at("p2"))
    spark.sql("select cast(null as string) as k, 3L as i, cast(null as struct<x:string,z:int>) as s, cast(null as array<string>) as xs").write.parquet(at("p3"))
    spark.sql("select 4.5D as k, 4 as i, named_struct('x', 9, 'y', 'c') as s, array(7, 8) as xs, 6 as only").write.parquet(at("p4"))
    df = drift.read_drifting(spark, str(tmp_path / "d" / "*" / "*.parquet"))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert kinds == {"k": "struct<double:double,long:bigint,string:string>", "i": "bigint", "only": "int",
                     "s": "struct<x:struct<int:int,string:string>,y:string,z:int>", "xs": "array<struct<int:int,string:string>>"}
    rows = {r.i: r for r in df.collect()}
    assert tuple(rows[1].k) == (None, 1, None) and tuple(rows[2].k) == (None, None, "two") and tuple(rows[4].k) == (4.5, None, None)
    assert rows[3].k is None and rows[3].s is None and rows[3].xs is None and rows[2].only is None
    assert tuple(rows[1].s.x) == (1, None) and rows[1].s.z is None and tuple(rows[2].s.x) == (None, "b") and rows[2].s.z == 2
    assert [tuple(x) for x in rows[4].xs] == [(7, None), (8, None)]
    flat = coalesce_choice(flatten_struct(df.select("i", "k")), "k", alternatives=["string", "long", "double"])
    assert {r.i: r.k for r in flat.collect()} == {1: "1", 2: "two", 3: None, 4: "4.5"}


def test_agreeing_files_are_one_group_of_one_merge(spark, tmp_path):
    path = str(tmp_path / "same")
    spark.range(40).repartition(8).write.parquet(path)
    listed = drift._files(spark, path)
    assert len(listed) == 8 and [len(m) for _, m in drift.schema_groups(spark, listed)] == [8]
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        drift.read_drifting(spark, str(tmp_path / "none"))


# --- K2: one pass over the target ------------------------------------------------

def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("keep_latest", [True, False])
def test_guarded_upsert_reads_the_target_once(spark, tmp_path, keep_latest):
    path = str(tmp_path / "target")
    spark.range(500).selectExpr("id", "cast(id as string) as v", "timestamp'2024-01-02' as dt_updated").write.parquet(path)
    stage = spark.createDataFrame([(1, "a", D(2024, 1, 1)), (2, "b", D(2024, 1, 3)), (2, "c", D(2024, 1, 4)), (900, "n", None), (None, "z", None)],
                                  "id bigint, v string, dt_updated timestamp")
    out = upsert_guarded(spark.read.parquet(path), stage, "id", "dt_updated", keep_latest=keep_latest)
    plan = executed(out)
    final = plan[:plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("FileScan parquet") == 1, final
    got = sorted((r.id, r.v) for r in out.where("v > 'A'").collect() if r.id is not None)
    assert got == ([(2, "b"), (2, "c"), (900, "n")] if keep_latest else [(1, "a"), (2, "b"), (2, "c"), (900, "n")])
    assert out.count() == 499 + len(got) + 1


# --- K8: the key of the result ---------------------------------------------------

def test_duplicate_that_only_the_merge_makes(spark, tmp_table):
    path, shape = tmp_table("keyed") + "/t", "id bigint, v string, dt_updated timestamp"
    publish_upsert(spark, spark.createDataFrame([(1, "new", D(2024, 1, 9))], shape), path, buckets=4)
    stale = spark.createDataFrame([(1, "old", D(2024, 1, 1)), (2, "x", D(2024, 1, 1))], shape)      # unique by itself
    before = table_state(spark, path)
    with pytest.raises(QualityError, match="1 keys"):
        publish_upsert(spark, stale, path, guarded_by="dt_updated", key_check="strict")
    assert table_state(spark, path) == before and [r.v for r in read_bucketed(spark, path).collect()] == ["new"]
    assert sorted(n for n in os.listdir(path.replace("file:", "")) if n.startswith("__version")) == [f"__version={v}" for v in set(before["versions"].values())]
    found = publish_upsert(spark, stale, path, guarded_by="dt_updated", key_check="report")
    assert found["key_violations"] == 1 and read_bucketed(spark, path).count() == 3
    found = publish_upsert(spark, stale, path, guarded_by="dt_updated", keep_latest=True, key_check="report")
    assert found["key_violations"] == 0      # the stale row is replaced by its equal, which is dropped as older
    assert sorted(r.v for r in read_bucketed(spark, path).collect()) == ["new", "x"]


def test_old_versions_go_bucket_by_bucket(spark, tmp_table):
    path, shape = tmp_table("versions") + "/t", "id bigint, v string"
    publish_upsert(spark, spark.range(400).selectExpr("id", "'a' as v"), path, buckets=8)
    for n in range(4):
        publish_upsert(spark, spark.createDataFrame([(n, f"n{n}")], shape), path)
    root = path.replace("file:", "")
    state, rows = table_state(spark, path), {r.id: r.v for r in read_bucketed(spark, path).collect()}
    assert len(rows) == 400 and [rows[i] for i in range(4)] == ["n0", "n1", "n2", "n3"]
    assert len(os.listdir(f"{root}/_pointer")) - sum(n.endswith(".crc") for n in os.listdir(f"{root}/_pointer")) == 2
    there = {(v, b) for v in os.listdir(root) if v.startswith("__version") for b in os.listdir(f"{root}/{v}") if b.startswith("_bucket")}
    assert len(there) <= 8 + 1 and {(f"__version={v}", f"_bucket={b}") for b, v in state["versions"].items()} <= there


# --- S5: exactly once ------------------------------------------------------------

@pytest.mark.parametrize("guarded", [None, "dt_updated"])
def test_replayed_batch_adds_no_rows_without_a_key(spark, tmp_table, guarded):
    path, shape = tmp_table("replay") + "/t", "id bigint, v string, dt_updated timestamp"
    rows = spark.createDataFrame([(1, "a", D(2024, 1, 1)), (None, "n", D(2024, 1, 1))], shape)
    for batch in (("s", 0), ("s", 0), ("s", 1), ("s", 0), ("other", 0)):
        publish_upsert(spark, rows, path, buckets=4, guarded_by=guarded, batch=batch)
    assert sorted(r.v for r in read_bucketed(spark, path).collect()) == ["a", "n", "n", "n"]      # s:0, s:1, other:0
    publish_upsert(spark, rows.where("false"), path, batch=("s", 2))                          # an empty batch counts too
    assert table_state(spark, path)["streams"] == {"s": 2, "other": 0}


def test_stream_that_dies_after_the_commit_does_not_load_twice(spark, tmp_table, monkeypatch):
    from quarry.streaming import incremental

    source, target, ckpt = tmp_table("dies"), tmp_table("dies-t") + "/t", tmp_table("dies-c")
    shape = StructType().add("id", "long").add("v", "string").add("ts", "timestamp")
    spark.createDataFrame([(None, "n", D(2024, 1, 1)), (1, "a", D(2024, 1, 1))], shape).coalesce(1).write.parquet(source)
    real = incremental.publish_upsert

    def dies(*a, **k):
        real(*a, **k)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(incremental, "publish_upsert", dies)
        with pytest.raises(Exception):
            incremental.incremental_upsert(spark, source, shape, target, ckpt, key="id", date="ts", buckets=4)
    assert read_bucketed(spark, target).count() == 2
    assert incremental.incremental_upsert(spark, source, shape, target, ckpt, key="id", date="ts", buckets=4) == 0   # replayed, skipped
    assert read_bucketed(spark, target).count() == 2


@pytest.fixture()
def feed(spark, tmp_table):
    """A catalog table over a folder, and a way to add a file to it."""
    name, path = f"feed_{uuid.uuid4().hex}", tmp_table("feed")

    def add(rows):
        spark.createDataFrame(rows, "id long, v string, ts timestamp").coalesce(1).write.mode("append").parquet(path)

    add([(1, "a", D(2024, 1, 2)), (None, "n", D(2024, 1, 1))])
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    yield name, add
    spark.sql(f"DROP TABLE {name}")


def test_incremental_scan_of_a_catalog_table(spark, tmp_table, feed):
    name, add = feed
    cfg = PipelineConfig(origin=name, destination=tmp_table("feed-t") + "/t", scan="incremental", scan_format="table", flatten="none",
                         upsert="guarded", guarded_by="ts", keep_latest=True)
    assert sorted(r.v for r in run_pipeline(spark, cfg).collect()) == ["a", "n"]
    state = table_state(spark, cfg.destination)
    assert sorted(r.v for r in run_pipeline(spark, cfg).collect()) == ["a", "n"]
    assert table_state(spark, cfg.destination) == state                # nothing new: nothing published
    add([(1, "older", D(2024, 1, 1)), (2, "b", D(2024, 1, 1))])
    assert sorted(r.v for r in run_pipeline(spark, cfg).collect()) == ["a", "b", "n"]


def test_bookmark_reads_new_files_only_in_batches(spark, tmp_table, feed):
    name, add = feed
    for n in range(4):
        add([(n, f"f{n}", D(2024, 1, 3))])
    seen, done, path = [], {}, tmp_table("mark")

    def handle(rows, batch):
        plan = executed(rows)
        seen.append((batch[1], sorted(r.v for r in rows.collect()), plan))
        done[batch[0]] = batch[1]

    assert process_new_table_files(spark, name, path, done.get, handle, files_per_batch=2) == 3
    assert [b for b, _, _ in seen] == [1, 2, 3] and sorted(v for _, vs, _ in seen for v in vs) == ["a", "f0", "f1", "f2", "f3", "n"]
    assert process_new_table_files(spark, name, path, done.get, handle) == 0
    add([(9, "late", D(2024, 1, 3))])
    rows = []
    with pytest.raises(RuntimeError):       # dies before its batch is committed
        process_new_table_files(spark, name, path, done.get, lambda df, b: (_ for _ in ()).throw(RuntimeError("lost")))
    assert process_new_table_files(spark, name, path, done.get, lambda df, b: rows.extend((b[1], r.v) for r in df.collect())) == 1
    assert rows == [(4, "late")]


def test_files_are_pruned_by_path(spark, feed):
    """A batch's predicate reaches the listing: other files are not opened."""
    name, add = feed
    add([(7, "x", D(2024, 1, 3))])
    spark.catalog.refreshTable(name)
    rows = spark.table(name)
    one = rows.select("_metadata.file_path").distinct().orderBy("file_path").first()[0]
    df = rows.where(F.col("_metadata.file_path").isin([one]))
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    plan = qe.executedPlan()
    while plan.children().size():
        plan = plan.children().apply(0)
    scan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    while scan.children().size():
        scan = scan.children().apply(0)
    assert scan.metrics().get("numFiles").get().value() == 1


def test_incremental_replace_is_refused(spark, tmp_table):
    cfg = PipelineConfig(origin="o", destination="d", scan="incremental", flatten="none")
    with pytest.raises(ValueError, match="late"):
        run_pipeline(spark, cfg)


# --- S3: a date window as prefixes -----------------------------------------------

def day_table(spark, tmp_table, days, pad):
    text = lambda n: f"{n:02d}" if pad else str(n)
    rows = [(i, str(d.year), text(d.month), text(d.day)) for i, d in enumerate(days)]
    name, path = f"days_{uuid.uuid4().hex}", tmp_table("days")
    spark.createDataFrame(rows, "id int, partition_0 string, partition_1 string, partition_2 string").write.parquet(f"{path}-flat")
    spark.sql(f"CREATE TABLE {name} (id int, partition_0 string, partition_1 string, partition_2 string) USING parquet "
              f"PARTITIONED BY (partition_0, partition_1, partition_2) LOCATION '{path}'")
    spark.read.parquet(f"{path}-flat").write.insertInto(name)
    return name


@pytest.mark.parametrize("pad", [True, False])
def test_window_is_prefixes_of_a_catalog_table(spark, tmp_table, pad):
    days = [dt.date(2021, 12, 30), dt.date(2021, 12, 31), dt.date(2022, 1, 1), dt.date(2022, 2, 27), dt.date(2022, 2, 28), dt.date(2022, 3, 1),
            dt.date(2022, 3, 15), dt.date(2022, 11, 2), dt.date(2023, 1, 1)]
    name = day_table(spark, tmp_table, days, pad)
    try:
        for cutoff in (*days, dt.date(2022, 1, 31), dt.date(2021, 12, 1)):
            df = read_rolling(spark, name, 2, cutoff + dt.timedelta(days=2), fmt="table")
            assert sorted(r.id for r in df.collect()) == [i for i, d in enumerate(days) if d >= cutoff]
        filters = [line for line in _explain(read_rolling(spark, name, 2, dt.date(2022, 3, 2), fmt="table"), "formatted").splitlines() if "PartitionFilters" in line]
        assert filters and "cast(" not in filters[0] and "make_date" not in filters[0]     # a metastore takes it as it is
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_window_without_a_schema_compares_numbers(spark):
    df = spark.createDataFrame([(1, "2022", "3", "01"), (2, "2022", "02", "9")], "id int, partition_0 string, partition_1 string, partition_2 string")
    assert [r.id for r in df.where(rolling_predicate(1, dt.date(2022, 2, 11))).collect()] == [1]


# --- P2: long arrays -------------------------------------------------------------

def test_long_array_spreads_over_tasks(spark):
    df = spark.range(1).select(F.col("id"), F.sequence(F.lit(1), F.lit(1_000_000)).alias("xs"), F.array(F.lit("a"), F.lit("b")).alias("ys"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = flatten_all(df, slice_elements=10_000)
        assert out.columns == flatten_all(df).columns
        parts = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
        assert sum(r.n for r in parts) == 2_000_000 and len(parts) == 8 and max(r.n for r in parts) < 500_000
        assert out.agg(F.sum("xs")).first()[0] == 1_000_000 * 1_000_001
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("positions", [False, True])
def test_slices_change_no_rows(spark, positions):
    ddl = ("id int, s struct<a:int, zs:array<struct<q:int, ws:array<int>>>>, xs array<int>, ys array<string>, m map<string,int>, "
           "aa array<array<int>>, ea array<int>")
    rows = [(1, (10, [(1, [1, 2, 3]), (2, None), (3, [])]), list(range(7)), ["a", "b", "c"], {"k": 1}, [[1, 2, 3], [4], None, []], []),
            (2, None, None, [], None, [list(range(5))], None), (3, (1, []), [9], ["z"], {}, None, [])]
    df = spark.createDataFrame(rows, ddl)
    if positions:
        df = df.drop("aa")      # two positions of one name
    key = lambda r: str(r)
    whole, cut = flatten_all(df, with_position=positions), flatten_all(df, with_position=positions, slice_elements=2)
    assert whole.columns == cut.columns
    assert sorted(map(key, whole.collect())) == sorted(map(key, cut.collect()))


# --- PL1, PL3 --------------------------------------------------------------------

def test_descriptor_to_query(spark, tmp_path):
    (tmp_path / "sql.yaml").write_text("sql: select nome, endereco.rua as rua from pessoas\n")
    (tmp_path / "d.yaml").write_text(f"nome: int\nendereco:\n  rua: string\nsql: {tmp_path}/sql.yaml\n")
    (tmp_path / "people.json").write_text('{"nome": 7, "endereco": {"rua": "R"}}\n')
    out = query_descriptor(spark, str(tmp_path / "people.json"), str(tmp_path / "d.yaml"), "pessoas")
    assert [tuple(r) for r in out.collect()] == [(7, "R")]
    with pytest.raises(ValueError, match="no query"):
        query_descriptor(spark, str(tmp_path), {"nome": "int"}, "pessoas")


def test_cli_finds_mapping_and_sql_by_name(spark, tmp_path):
    from quarry.session import scratch_root

    src = str(tmp_path / "raw")
    spark.createDataFrame([((1, "x"), 1)], "_raw struct<id:string, name:string>, _emitted_at bigint").write.parquet(src)
    (tmp_path / "people.json").write_text(json.dumps({"schema": [{"Name": "_raw_id", "Type": "string", "NameTo": "id", "TypeTo": "bigint"}]}))
    (tmp_path / "people.sql").write_text("select id, id + 1 as next from table")
    (tmp_path / "conf").write_text(json.dumps({"conf": [{"origin_table": src, "destination_table": "people", "flow": "flow"}]}))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "quarry", "run", str(tmp_path / "conf"), "--folder", str(tmp_path), "--warehouse", str(tmp_path / "w"),
                          "--split-bytes", "10485760", "--master", "local[2]", "--conf", f"spark.checkpoint.dir={scratch_root(spark)}"],
                         cwd=root, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert [tuple(r) for r in read_bucketed(spark, str(tmp_path / "w" / "people")).collect()] == [(1, 2)]


def test_split_bytes_hold_for_one_entry(spark, tmp_table, monkeypatch):
    key = "spark.sql.files.maxPartitionBytes"
    before, seen = spark.conf.get(key), []
    cfg = PipelineConfig(origin="", destination=tmp_table("split") + "/t", flatten="none", split_bytes=12345678)
    from quarry.plans import pipeline
    real = pipeline.publish
    monkeypatch.setattr(pipeline, "publish", lambda *a, **k: seen.append(spark.conf.get(key)) or real(*a, **k))
    run_pipeline(spark, cfg, source=spark.createDataFrame([(1,)], "id long"))
    assert seen == ["12345678"] and spark.conf.get(key) == before
