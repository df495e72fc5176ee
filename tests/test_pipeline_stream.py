import datetime as dt

from pyspark.sql import functions as F

from quarry.plans.pipeline import PRESETS, RECIPES, config_from_entry, run_batch
from quarry.sinks.publish import read_bucketed
from quarry.streaming.incremental import incremental_upsert
from tests.conftest import SF_SMALL


def test_dispatch_by_flow_name():
    assert config_from_entry({"origin_table": "o", "destination_table": "d", "flow": "flow6"}).upsert == "guarded"
    cfg = config_from_entry({"origin_table": "o", "destination_table": "d", "flow": "flow3"})
    assert (cfg.scan, cfg.flatten, cfg.upsert) == ("full", "all", "replace")
    cfg = config_from_entry({"origin_table": "o", "destination_table": "d", "flow": "flow2", "as_of": "2024-01-02"})
    assert cfg.scan == "rolling" and cfg.as_of == dt.date(2024, 1, 2)
    assert set(PRESETS.values()) == set(RECIPES)


def test_batch_runs_each_entry(spark, tmp_table):
    src = tmp_table("raw")
    spark.createDataFrame([((1, "ação"), 1000), ((1, "b"), 2000), ((2, "c"), 3000)],
                          "_raw struct<id:string, name:string>, _emitted_at bigint").write.parquet(src)
    dest = tmp_table("dest")
    doc = {"conf": [{"origin_table": src, "destination_table": dest, "flow": "flow",
                     "deduplicate": [{"partitionby": ["_raw_id"], "orderby": ["_emitted_at"]}],
                     "capitalize": ["name"], "capitalizeword": [{"field": "name", "pattern": "A", "replacement": "4"}],
                     "schema": {"schema": [{"Name": "_raw_id", "Type": "string", "NameTo": "id", "TypeTo": "bigint"},
                                           {"Name": "_raw_name", "Type": "string", "NameTo": "name",
                                            "TypeTo": "string"}]},
                     "sql": "select id, name from table;"}]}
    out = run_batch(spark, doc)[dest]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "B"), (2, "C")]


def test_incremental_reads_only_new_files(spark, tmp_table):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    landing, target, ckpt = tmp_table("land"), tmp_table("tgt") + "/t", tmp_table("ckpt")
    drops = [ev.where(F.pmod("event_id", F.lit(2)) == i) for i in range(2)]
    kw = dict(key="user_id", date="ts", dedup=[{"partitionby": ["user_id"], "orderby": ["ts", "event_id"]}],
              buckets=4)
    drops[0].write.mode("append").parquet(landing)
    assert incremental_upsert(spark, landing, ev.schema, target, ckpt, **kw) == 1
    drops[1].write.mode("append").parquet(landing)
    assert incremental_upsert(spark, landing, ev.schema, target, ckpt, **kw) == 1
    assert incremental_upsert(spark, landing, ev.schema, target, ckpt, **kw) == 0
    got = read_bucketed(spark, target)
    latest = ev.groupBy("user_id").agg(F.max("ts").alias("ts"))
    assert got.count() == latest.count()
    assert got.join(latest, ["user_id", "ts"]).count() == latest.count()


def test_pipeline_coalesces_type_choice_fields(spark, tmp_table):
    from quarry.plans.pipeline import PipelineConfig, transform

    df = spark.createDataFrame([((1, (5, None)), 1), ((2, (None, "7")), 2)],
                               "_raw struct<id:bigint, at:struct<long:bigint, string:string>>, _emitted_at bigint")
    cfg = PipelineConfig(origin="", destination="", flatten="struct", coalesce=["_raw_at"],
                         mapping=[("_raw_id", "long", "id", "bigint"), ("_raw_at", "long", "dt", "bigint")])
    assert sorted(tuple(r) for r in transform(df, cfg).collect()) == [(1, 5), (2, 7)]


def test_cluster_settings_size_tasks():
    from quarry.session import cluster_settings

    conf = cluster_settings(100 * 1024 ** 4)  # 100 TB
    assert conf["spark.sql.shuffle.partitions"] == str(100 * 1024 ** 4 // (2 * 1024 ** 3))
    assert conf["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 ** 2)


def test_cli_runs_a_config_file(spark, tmp_table, tmp_path):
    import json as _json
    import subprocess
    import sys
    import os

    from quarry.session import scratch_root

    src = tmp_table("cli_raw")
    spark.createDataFrame([((1, "ação"), 1000), ((2, "b"), 2000)],
                          "_raw struct<id:string, name:string>, _emitted_at bigint").write.parquet(src)
    mapping = tmp_path / "schema.json"
    mapping.write_text(_json.dumps({"schema": [
        {"Name": "_raw_id", "Type": "string", "NameTo": "id", "TypeTo": "bigint"},
        {"Name": "_raw_name", "Type": "string", "NameTo": "name", "TypeTo": "string"}]}))
    sql = tmp_path / "select.sql"
    sql.write_text("select id, name from table;")
    dest = tmp_table("cli_dest")
    doc = tmp_path / "conf.json"
    doc.write_text(_json.dumps({"conf": [{"origin_table": src, "destination_table": dest, "flow": "flow",
                                          "deduplicate": [], "capitalize": ["name"], "capitalizeword": [],
                                          "schema": str(mapping), "sql": str(sql)}]}))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "quarry", "run", str(doc), "--master", "local[2]",
                          "--conf", f"spark.checkpoint.dir={scratch_root(spark)}"],
                         cwd=root, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert _json.loads(out.stdout.strip().splitlines()[-1]) == {"destination": dest, "rows": 2}
    assert sorted(tuple(r) for r in read_bucketed(spark, dest).drop("_bucket").collect()) == [(1, "ACAO"), (2, "B")]


def test_new_checkpoint_on_existing_target_is_not_skipped(spark, tmp_table):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    target = tmp_table("tgt2") + "/t"
    kw = dict(key="user_id", date="ts", dedup=[{"partitionby": ["user_id"], "orderby": ["ts", "event_id"]}],
              buckets=4)
    first, second = tmp_table("land_a"), tmp_table("land_b")
    ev.where("event_id % 2 = 0").write.parquet(first)
    ev.where("event_id % 2 = 1").write.parquet(second)
    assert incremental_upsert(spark, first, ev.schema, target, tmp_table("ck_a"), **kw) == 1
    # A second stream (its own checkpoint, batch ids from 0 again) into the same table.
    assert incremental_upsert(spark, second, ev.schema, target, tmp_table("ck_b"), **kw) == 1
    latest = ev.groupBy("user_id").agg(F.max("ts").alias("ts"))
    got = read_bucketed(spark, target)
    assert got.join(latest, ["user_id", "ts"]).count() == latest.count() == got.count()


def test_unknown_flow_is_a_clear_error():
    import pytest

    with pytest.raises(ValueError, match="unknown preset/flow 'flow9'"):
        config_from_entry({"origin_table": "o", "destination_table": "d", "flow": "flow9"})


def test_catalog_origin_from_database_key(spark, tmp_table):
    from quarry.plans.pipeline import run_pipeline

    spark.createDataFrame([((1, "x"), 1)], "_raw struct<id:string, name:string>, _emitted_at bigint") \
        .createOrReplaceGlobalTempView("quarry_raw_people")
    cfg = config_from_entry({"origin_table": "quarry_raw_people", "database": "global_temp",
                             "destination_table": tmp_table("from_catalog"), "flow": "flow",
                             "schema": {"schema": [{"Name": "_raw_id", "Type": "string", "NameTo": "id",
                                                    "TypeTo": "bigint"}]}})
    assert cfg.scan_format == "table" and cfg.origin == "global_temp.quarry_raw_people"
    assert [tuple(r) for r in run_pipeline(spark, cfg).collect()] == [(1,)]


def test_scratch_root_created_once_when_unset():
    from quarry.session import scratch_root

    class _Conf:
        def get(self, key, default=None):
            return default

    class _SC:
        def __init__(self):
            self.dir = None

        def getConf(self):
            return _Conf()

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d + "/uuid"

    class _Spark:
        conf = _Conf()
        sparkContext = _SC()

    s = _Spark()
    first = scratch_root(s)
    assert s.sparkContext.dir is not None
    assert first == s.sparkContext.dir.rstrip("/") == scratch_root(s)


def test_pipeline_first_load_empty_then_data(spark, tmp_table):
    from quarry.plans.pipeline import PipelineConfig, run_pipeline

    raw = spark.createDataFrame([((1, "a"), 1), ((2, "b"), 2)], "_raw struct<id:string, name:string>, _emitted_at bigint")
    cfg = PipelineConfig(origin="", destination=tmp_table("empty_first") + "/t", flatten="struct",
                         mapping=[("_raw_id", "string", "id", "bigint"), ("_raw_name", "string", "name", "string")])
    assert run_pipeline(spark, cfg, source=raw.where("false")).count() == 0
    assert sorted(tuple(r) for r in run_pipeline(spark, cfg, source=raw).collect()) == [(1, "a"), (2, "b")]


def test_example_config_runs(spark):
    import json as _json
    import os
    import subprocess
    import sys

    from quarry.session import scratch_root
    from tests.conftest import SF_SMALL

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ)
    conf = ["--conf", f"spark.checkpoint.dir={scratch_root(spark)}"]
    prep = subprocess.run([sys.executable, "examples/prepare_landing.py", SF_SMALL], cwd=root,
                          capture_output=True, text=True, timeout=600, env=env)
    assert prep.returncode == 0, prep.stderr[-2000:]
    conf_path = prep.stdout.strip().splitlines()[-1]
    run = subprocess.run([sys.executable, "-m", "quarry", "run", conf_path, "--master", "local[2]", *conf],
                         cwd=root, capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr[-2000:]
    results = [_json.loads(line) for line in run.stdout.strip().splitlines()]
    assert [r["rows"] > 0 for r in results] == [True, True]
    labels = {r.urgency for r in read_bucketed(spark, results[0]["destination"]).select("urgency").collect()}
    assert "URGENT (1)" in labels and all(len(x) <= 12 for x in labels)


def test_incremental_runs_the_pipeline_transform_per_batch(spark, tmp_table):
    from quarry import fixtures as fx
    from quarry.plans.pipeline import PipelineConfig, transform

    raw = fx.raw_events(spark, SF_SMALL)
    landing, target, ckpt = tmp_table("raw_land"), tmp_table("raw_tgt") + "/t", tmp_table("raw_ck")
    cfg = PipelineConfig(origin="", destination="", flatten="struct",
                         mapping=[("_raw_data_userId", "string", "id", "bigint"),
                                  ("_raw_data_event_id", "long", "event_id", "bigint"),
                                  ("_emitted_at", "long", "dt_ms", "long")],
                         sql="select id, event_id, timestamp_millis(dt_ms) as dt_updated from table")
    kw = dict(key="id", date="dt_updated", transform=lambda b: transform(b, cfg),
              dedup=[{"partitionby": ["id"], "orderby": ["dt_updated", "event_id"]}], buckets=4)
    raw.where("_emitted_at % 2 = 1").write.mode("append").parquet(landing)
    assert incremental_upsert(spark, landing, raw.schema, target, ckpt, **kw) == 1
    raw.where("_emitted_at % 2 = 0").write.mode("append").parquet(landing)
    assert incremental_upsert(spark, landing, raw.schema, target, ckpt, **kw) == 1
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    expected = (ev.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))
                  .withColumnRenamed("user_id", "id"))
    got = read_bucketed(spark, target).select("id", "event_id")
    assert got.count() == expected.count()
    assert got.join(expected, ["id", "event_id"]).count() == expected.count()


def test_pipeline_load_checks_fail_before_publishing(spark, tmp_table):
    import pytest

    from quarry.operators.quality import QualityError
    from quarry.plans.pipeline import PipelineConfig, run_pipeline
    from quarry.sinks.publish import _exists

    raw = spark.createDataFrame([((1, "a"), 1), ((1, "b"), 2)], "_raw struct<id:string, name:string>, _emitted_at bigint")
    mapping = [("_raw_id", "string", "id", "bigint"), ("_raw_name", "string", "name", "string")]
    dest = tmp_table("checked") + "/t"
    strict = PipelineConfig(origin="", destination=dest, flatten="struct", mapping=mapping, key_check="strict")
    with pytest.raises(QualityError):
        run_pipeline(spark, strict, source=raw)
    assert not _exists(spark, dest)
    gated = PipelineConfig(origin="", destination=dest, flatten="struct", mapping=mapping, require_rows=True)
    with pytest.raises(QualityError):
        run_pipeline(spark, gated, source=raw.where("false"))
    assert run_pipeline(spark, gated, source=raw).count() == 2  # duplicates are legal without key_check


def test_entry_finds_mapping_and_sql_by_destination(spark, tmp_path):
    """The shape of catalog entries: a database, and no schema or SQL of their own."""
    import json

    import pytest

    from quarry.sinks.publish import read_bucketed

    spark.createDataFrame([(("1", "x"), 1)], "_raw struct<id:string, name:string>, _emitted_at bigint") \
        .createOrReplaceGlobalTempView("quarry_raw_entry")
    (tmp_path / "people.json").write_text(json.dumps({"schema": [{"Name": "_raw_id", "Type": "string", "NameTo": "id", "TypeTo": "bigint"}]}))
    doc = {"conf": [{"origin_table": "quarry_raw_entry", "glue_database": "global_temp", "destination_table": "people", "flow": "flow"}]}
    with pytest.raises(FileNotFoundError):
        run_batch(spark, doc, folder=str(tmp_path), warehouse=str(tmp_path / "w"))
    (tmp_path / "people.sql").write_text("select table.id, table.id + 1 as next from table;")
    run_batch(spark, doc, folder=str(tmp_path), warehouse=str(tmp_path / "w"))
    assert [tuple(r) for r in read_bucketed(spark, str(tmp_path / "w" / "people")).collect()] == [(1, 2)]
    with pytest.raises(ValueError, match="no flow"):
        config_from_entry({"origin_table": "o", "destination_table": "d"})


def test_incremental_scan_of_a_pipeline(spark, tmp_table):
    from quarry.plans.pipeline import PipelineConfig, run_pipeline

    origin, dest = tmp_table("landing"), tmp_table("inc") + "/t"
    cfg = PipelineConfig(origin=origin, destination=dest, scan="incremental", flatten="none", late_files="replace")
    spark.createDataFrame([(1, "a")], "id long, v string").write.mode("append").parquet(origin)
    assert run_pipeline(spark, cfg).count() == 1
    spark.createDataFrame([(1, "b"), (2, "c")], "id long, v string").write.mode("append").parquet(origin)
    assert sorted(r.v for r in run_pipeline(spark, cfg).collect()) == ["b", "c"]
    assert sorted(r.v for r in run_pipeline(spark, cfg).collect()) == ["b", "c"]    # nothing new
