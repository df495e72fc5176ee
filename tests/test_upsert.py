import datetime as dt
import os

import pytest

from quarry.operators.upsert import upsert_guarded, upsert_replace
from quarry.sinks.publish import TableConflict, publish_upsert, read_bucketed, replace_group_sql, table_state, write_bucketed, jdbc_options
from tests.conftest import _explain

D = dt.datetime
SCHEMA = "id bigint, v string, dt_updated timestamp"


def target(spark):
    return spark.createDataFrame([(1, "t1", D(2024, 1, 2)), (2, "t2", D(2024, 1, 2)), (3, "t3", D(2024, 1, 2)),
                                  (4, "t4", None), (None, "tn", D(2024, 1, 1)), (5, "t5", D(2024, 1, 2))], SCHEMA)


def stage(spark):
    return spark.createDataFrame([(1, "newer", D(2024, 1, 3)), (2, "older", D(2024, 1, 1)),
                                  (3, "equal", D(2024, 1, 2)), (4, "vs-null", D(2024, 1, 3)),
                                  (5, "nulldate", None), (6, "new", D(2024, 1, 1)), (6, "new-dup", D(2024, 1, 1)),
                                  (None, "sn", D(2024, 1, 1))], SCHEMA)


def rows(df):
    return sorted((r.id if r.id is not None else -1, r.v) for r in df.collect())


def test_replace_group_semantics(spark):
    out = upsert_replace(target(spark), stage(spark), "id")
    # Every stage row is inserted (duplicates too); null ids never match.
    assert rows(out) == sorted([(-1, "tn"), (-1, "sn"), (1, "newer"), (2, "older"), (3, "equal"), (4, "vs-null"),
                                (5, "nulldate"), (6, "new"), (6, "new-dup")])
    assert out.count() == target(spark).count() - 5 + stage(spark).count()


def test_guarded_parity_keeps_stale_rows(spark):
    out = upsert_guarded(target(spark), stage(spark), "id", "dt_updated")
    # id 2: stage older -> target kept AND stale stage row inserted.
    # id 4: target date null -> never removed.  id 5: stage date null -> no delete.
    assert rows(out) == sorted([(-1, "tn"), (-1, "sn"), (1, "newer"), (2, "t2"), (2, "older"), (3, "equal"),
                                (4, "t4"), (4, "vs-null"), (5, "t5"), (5, "nulldate"), (6, "new"), (6, "new-dup")])


def test_guarded_keep_latest(spark):
    out = upsert_guarded(target(spark), stage(spark), "id", "dt_updated", keep_latest=True)
    assert rows(out) == sorted([(-1, "tn"), (-1, "sn"), (1, "newer"), (2, "t2"), (3, "equal"), (4, "t4"),
                                (4, "vs-null"), (5, "t5"), (6, "new"), (6, "new-dup")])


def test_keep_latest_is_arrival_order_independent(spark):
    t = spark.createDataFrame([(1, "a", D(2024, 1, 1))], SCHEMA)
    s1 = spark.createDataFrame([(1, "b", D(2024, 1, 3)), (2, "x", D(2024, 1, 1))], SCHEMA)
    s2 = spark.createDataFrame([(1, "c", D(2024, 1, 2)), (2, "y", D(2024, 1, 5))], SCHEMA)
    one = upsert_guarded(upsert_guarded(t, s1, "id", "dt_updated", keep_latest=True), s2, "id", "dt_updated",
                         keep_latest=True)
    two = upsert_guarded(upsert_guarded(t, s2, "id", "dt_updated", keep_latest=True), s1, "id", "dt_updated",
                         keep_latest=True)
    assert rows(one) == rows(two) == [(1, "b"), (2, "y")]


def test_replace_twice_equals_once_for_non_null_ids(spark):
    s = stage(spark).where("id is not null")
    once = upsert_replace(target(spark), s, "id")
    twice = upsert_replace(once, s, "id")
    assert rows(once) == rows(twice)


def test_small_stage_is_broadcast_big_stage_is_not(spark):
    out = upsert_replace(target(spark), stage(spark), "id")
    assert "BroadcastHashJoin" in _explain(out, "formatted") and "LeftAnti" in _explain(out, "formatted")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        out = upsert_replace(target(spark), stage(spark), "id", broadcast_max_rows=2)
        plan = _explain(out, "formatted")
        assert "BroadcastHashJoin" not in plan and "LeftAnti" in plan
        assert rows(out) == rows(upsert_replace(target(spark), stage(spark), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_publish_rewrites_only_touched_buckets(spark, tmp_table):
    path = tmp_table("bucketed")
    big = spark.range(2000).selectExpr("id", "cast(id as string) as v", "timestamp'2024-01-01' as dt_updated")
    write_bucketed(big, path, "id", buckets=16)
    before = table_state(spark, path)["versions"]
    st = spark.createDataFrame([(7, "seven", D(2024, 1, 2)), (5000, "new", D(2024, 1, 2))], SCHEMA)
    publish_upsert(spark, st, path, key="id", buckets=16)
    after = table_state(spark, path)["versions"]
    changed = [b for b in after if before.get(b) != after[b]]
    assert 1 <= len(changed) <= 2
    out = read_bucketed(spark, path)
    assert out.count() == 2001
    assert out.where("id = 7").first().v == "seven"


def test_publish_creates_then_guards(spark, tmp_table):
    path = tmp_table("guarded") + "/t"
    publish_upsert(spark, target(spark), path, key="id", buckets=4)
    publish_upsert(spark, stage(spark), path, key="id", buckets=4, guarded_by="dt_updated", keep_latest=True)
    assert rows(read_bucketed(spark, path).select("id", "v", "dt_updated")) == \
        rows(upsert_guarded(target(spark), stage(spark), "id", "dt_updated", keep_latest=True))


def test_warehouse_statements_and_options():
    pre, post = replace_group_sql("h.t", "h.t_stage_table", "id", guarded_by="dt_updated")
    assert pre == ["DROP TABLE IF EXISTS h.t_stage_table",
                   "CREATE TABLE h.t_stage_table AS SELECT * FROM h.t WHERE 1 = 0"]
    assert post[0] == ("DELETE FROM h.t WHERE EXISTS (SELECT 1 FROM h.t_stage_table WHERE "
                       "h.t_stage_table.id = h.t.id AND h.t_stage_table.dt_updated >= h.t.dt_updated)")
    assert post[1:] == ["INSERT INTO h.t SELECT * FROM h.t_stage_table", "DROP TABLE h.t_stage_table"]
    assert jdbc_options()["batchsize"] == "10"


@pytest.mark.parametrize("guarded", [False, True])
def test_hot_key_of_a_parquet_target_is_split(spark, tmp_table, guarded):
    """A third of the target shares one key; read from Parquet, with broadcasting
    off, no partition of the result holds the whole key."""
    from pyspark.sql import functions as F

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n, path = 30000, tmp_table("hot")
        (spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(8)).otherwise(F.col("id")).alias("id"),
                               F.col("id").cast("string").alias("v"), F.lit(D(2024, 1, 3)).cast("timestamp").alias("dt_updated"))
              .write.parquet(path))
        t = spark.read.parquet(path)
        # An older stage: guarded, the hot rows survive the join; replaced, all but them.
        s = spark.range(1 if not guarded else 0, n, 2).select(F.col("id"), F.lit("s").alias("v"),
                                                              F.lit(D(2024, 1, 2)).cast("timestamp").alias("dt_updated"))
        out = (upsert_guarded(t, s, "id", "dt_updated", broadcast_max_rows=None) if guarded
               else upsert_replace(t, s, "id", broadcast_max_rows=None))
        hot = out.where("id = 8 and v != 's'").groupBy(F.spark_partition_id().alias("p")).count().collect()
        total = sum(r["count"] for r in hot)
        assert total == n // 3 + (8 % 3 != 0)
        assert max(r["count"] for r in hot) < total / 2
        assert "SinglePartition" not in _explain(out, "formatted")
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_another_bucket_count_or_key_is_refused(spark, tmp_table):
    path = tmp_table("conflict") + "/t"
    publish_upsert(spark, target(spark), path, key="id", buckets=16)
    with pytest.raises(TableConflict):
        publish_upsert(spark, stage(spark), path, key="id", buckets=64)
    with pytest.raises(TableConflict):
        publish_upsert(spark, stage(spark), path, key="v")
    publish_upsert(spark, stage(spark), path, key="id")      # the table's own count
    assert rows(read_bucketed(spark, path)) == rows(upsert_replace(target(spark), stage(spark), "id"))


def test_failure_before_the_swap_leaves_the_old_table(spark, tmp_table, monkeypatch):
    from quarry.sinks import publish

    path = tmp_table("swap") + "/t"
    publish_upsert(spark, target(spark), path, key="id", buckets=4)
    before = rows(read_bucketed(spark, path))

    def lost(*a, **k):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(publish, "_commit", lost)
        with pytest.raises(RuntimeError):
            publish_upsert(spark, stage(spark), path, key="id")
    assert rows(read_bucketed(spark, path)) == before
    publish_upsert(spark, stage(spark), path, key="id")
    assert rows(read_bucketed(spark, path)) == rows(upsert_replace(target(spark), stage(spark), "id"))
    assert "_staging" not in os.listdir(path.replace("file:", ""))


def test_not_null_and_evolve(spark, tmp_table):
    from pyspark.sql import functions as F

    from quarry.operators.conform import SchemaMismatch

    path = tmp_table("evolve") + "/t"
    publish_upsert(spark, target(spark).where("id is not null"), path, key="id", buckets=4)
    with pytest.raises(SchemaMismatch, match="NOT NULL"):
        publish_upsert(spark, stage(spark), path, key="id", not_null=["id"])
    publish_upsert(spark, stage(spark).where("id = 6").withColumn("extra", F.lit(7)), path, key="id", on_extra="evolve")
    got = {(r.id, r.v): r.extra for r in read_bucketed(spark, path).collect()}
    assert got[(6, "new")] == 7 and got[(1, "t1")] is None


def test_equal_dates_across_drops_in_every_order(spark):
    import itertools

    drops = [spark.createDataFrame([(1, v, D(2024, 1, 1))], SCHEMA) for v in "abc"]
    for order in itertools.permutations(drops):
        t = order[0]
        for s in order[1:]:
            t = upsert_guarded(t, s, "id", "dt_updated", keep_latest=True, tie_break=["v"])
        assert rows(t) == [(1, "c")]


@pytest.mark.parametrize("parts,null_parts", [(1, None), (3, 5)])
def test_large_stage_meets_the_target_in_one_shuffle(spark, parts, null_parts):
    from pyspark.sql import functions as F
    from quarry.operators.upsert import replace_laid_out

    place = lambda df: df.withColumn("place", F.pmod(F.xxhash64("id"), F.lit(4)).cast("int"))
    hot = spark.range(50).select(F.lit(1).cast("bigint").alias("id"), F.concat(F.lit("h"), "id").alias("v"), F.lit(D(2024, 1, 2)).alias("dt_updated"))
    old = target(spark).unionAll(target(spark)).unionAll(hot)
    out = replace_laid_out(place(old), place(stage(spark)), "id", "place", parts, null_parts)
    assert out.columns == ["id", "v", "dt_updated", "place"]
    titles = [b for b in _explain(out, "formatted").split("\n\n") if " Exchange\n" in b]
    assert sum("dt_updated#" in b.splitlines()[1] for b in titles) == 1, "\n".join(titles)
    assert rows(out) == rows(upsert_replace(old, stage(spark), "id"))


def test_publish_of_a_large_stage(spark, tmp_table, monkeypatch):
    from quarry.operators import upsert as up
    from quarry.sinks import publish

    monkeypatch.setattr(up, "BROADCAST_MAX_BYTES", 0)
    monkeypatch.setattr(publish, "WRITER_BYTES", 100)   # several writers a bucket
    used, whole = [], up.replace_laid_out
    monkeypatch.setattr(up, "replace_laid_out", lambda *a: used.append(a[4:]) or whole(*a))
    path = tmp_table("large")
    publish_upsert(spark, target(spark), path, buckets=2)
    publish_upsert(spark, stage(spark), path)
    assert len(used) == 1 and used[0][0] > 1
    assert rows(read_bucketed(spark, path)) == rows(upsert_replace(target(spark), stage(spark), "id"))


def test_broadcast_bound_from_session_setting(spark):
    from quarry.operators.upsert import BROADCAST_MAX_ROWS_CONF

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        spark.conf.set(BROADCAST_MAX_ROWS_CONF, "2")  # the stage has 6 distinct keys
        assert "BroadcastHashJoin" not in _explain(upsert_replace(target(spark), stage(spark), "id"), "formatted")
        spark.conf.set(BROADCAST_MAX_ROWS_CONF, "100")
        assert "BroadcastHashJoin" in _explain(upsert_replace(target(spark), stage(spark), "id"), "formatted")
    finally:
        spark.conf.unset(BROADCAST_MAX_ROWS_CONF)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_full_refresh_layout_is_globally_ordered_by_key(spark, tmp_table):
    from pyspark.sql import functions as F

    from quarry.sinks.publish import full_refresh
    from tests.conftest import SF_SMALL

    path = tmp_table("sorted")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    # Small input: keep the 8 range partitions instead of letting AQE merge them.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        full_refresh(orders.repartition(8), path, sort_key="o_orderkey")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = (spark.read.parquet(path).groupBy(F.input_file_name().alias("f"))
                  .agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi")).orderBy("lo").collect())
    assert len(files) > 1
    for a, b in zip(files, files[1:]):
        assert a.hi < b.lo  # key ranges of files do not overlap: min/max stats prune lookups
    assert all(f.endswith(".zstd.parquet") for f in spark.read.parquet(path).inputFiles())
    # Rows inside each file come out in key order.
    keys = [r.o_orderkey for r in spark.read.parquet(files[0].f).collect()]
    assert keys == sorted(keys)


def test_publish_into_buckets_that_do_not_exist_yet(spark, tmp_table):
    from quarry.sinks.publish import _existing_buckets

    path = tmp_table("sparse") + "/t"
    publish_upsert(spark, target(spark).where("id in (1, 2)"), path, key="id", buckets=64)
    before = _existing_buckets(spark, path)
    assert 1 <= len(before) <= 2
    st = spark.createDataFrame([(2, "two", D(2024, 1, 3))] + [(i, f"n{i}", D(2024, 1, 3)) for i in range(100, 140)],
                               SCHEMA)
    publish_upsert(spark, st, path, key="id", buckets=64)
    out = rows(read_bucketed(spark, path).select("id", "v", "dt_updated"))
    assert out == sorted([(1, "t1"), (2, "two")] + [(i, f"n{i}") for i in range(100, 140)])
    assert len(_existing_buckets(spark, path)) > len(before)


def test_publish_empty_stage_leaves_table_unchanged(spark, tmp_table):
    path = tmp_table("empty_stage") + "/t"
    publish_upsert(spark, target(spark), path, key="id", buckets=4)
    before = rows(read_bucketed(spark, path).select("id", "v", "dt_updated"))
    publish_upsert(spark, stage(spark).where("false"), path, key="id", buckets=4, guarded_by="dt_updated")
    assert rows(read_bucketed(spark, path).select("id", "v", "dt_updated")) == before


def test_read_bucketed_of_a_table_without_rows(spark, tmp_table):
    path = tmp_table("no_rows") + "/t"
    publish_upsert(spark, stage(spark).where("false"), path, key="id", buckets=4)
    assert read_bucketed(spark, path, schema=stage(spark).schema).count() == 0


def test_publish_conforms_stage_to_the_table(spark, tmp_table):
    from pyspark.sql import functions as F

    from quarry.operators.conform import SchemaMismatch

    path = tmp_table("conform") + "/t"
    publish_upsert(spark, target(spark), path, key="id", buckets=64)
    # id arrives as text: buckets must be computed after conforming, or the
    # wrong bucket folders would be read and rows lost.
    reordered = stage(spark).selectExpr("dt_updated", "v", "cast(id as string) as id")
    publish_upsert(spark, reordered, path, key="id", buckets=64)
    assert rows(read_bucketed(spark, path).select("id", "v", "dt_updated")) == \
        rows(upsert_replace(target(spark), stage(spark), "id"))
    import pytest

    with pytest.raises(SchemaMismatch, match="extra"):
        publish_upsert(spark, stage(spark).withColumn("extra", F.lit(1)), path, key="id", buckets=64)


def test_suggest_buckets():
    from quarry.sinks.publish import suggest_buckets

    assert suggest_buckets(100 * 1024 ** 4) == 32768
    assert suggest_buckets(10 * 1024 ** 2) == 16
    assert suggest_buckets(100 * 1024 ** 3) == 32
