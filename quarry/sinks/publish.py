"""Publishing results: full refresh, sorted/compressed layout and all-or-nothing
upserts into a Parquet table laid out in key buckets.

A plain Parquet table supports neither MERGE nor DELETE, and Spark refuses to
overwrite a path it is reading.  An upsert is therefore published as:

1. the table is partitioned by ``_bucket = pmod(xxhash64(key), N)`` (null keys
   hash to one fixed bucket); ``N`` (from the bytes of the first load, if not given),
   the key and the schema are kept with the table, and a conflicting value is refused;
2. the stage is written once below ``_staging`` (removed at the end): its plan
   runs once, and counts, checks and touched buckets come from one aggregate over it;
3. the new contents of the touched buckets (survivors and stage) are written to a
   version folder of their own; only touched buckets are read.  The key constraint is
   checked on what was written, so duplicates that only the merge makes are found;
4. one small pointer file, which names the version of every bucket, is put
   in place by a rename.  Until then readers see the old table, whole; after it
   the new one.  A failure before the rename removes the version folder (a lost driver
   leaves one that nothing refers to).  The previous pointer and its folders stay
   for readers under way; older ones are removed.

The pointer also holds the last batch of each stream that feeds the table, so a batch
and its data are committed by the same rename, and a replayed one is skipped.

The rename refuses a name that exists, which is atomic on HDFS and local disks.  On an
object store without conditional writes two writers at the same moment may both
win: let one job at a time publish to a table there.

For a 1 % stage on a 100 TB table this rewrites the touched buckets only.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.conform import SchemaMismatch, conform
from ..operators.quality import QualityError, key_constraint_report
from ..operators import upsert as up
from ..operators.upsert import upsert_guarded, upsert_replace
from .files import _bytes, _exists, _fs, _names, _remove, fresh_beside, replace_folder, restore_folder

BUCKET = "_bucket"
VERSION = "__version"
WRITER_BYTES = 256 << 20   # about so much of a bucket's data goes to one writer


def suggest_buckets(table_bytes: int, bucket_bytes: int = 4 << 30, minimum: int = 16) -> int:
    """Bucket count so one bucket holds about ``bucket_bytes`` (a power of
    two, at least ``minimum``): an upsert then rewrites a few GB per touched
    bucket, and a 100 TB table gets 32,768 buckets."""
    need = max(minimum, -(-int(table_bytes) // int(bucket_bytes)))
    return 1 << (need - 1).bit_length()


def bucket_expr(key: str | Sequence[str], buckets: int):
    keys = [key] if isinstance(key, str) else list(key)
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


class TableConflict(ValueError):
    """The table was written with another bucket count or key, or someone else
    published meanwhile."""


def _pointer(spark: SparkSession, path: str, name: str) -> dict:
    fs, p = _fs(spark, f"{path.rstrip('/')}/_pointer/{name}")
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {"bytes": {}, "streams": {}} | json.loads(text) | {"n": int(name.split(".")[0])}


def table_state(spark: SparkSession, path: str) -> dict | None:
    """What the newest pointer says: buckets, key, schema, the version of each
    bucket, the bytes of a version's bucket, the last batch of each stream; None
    without a table."""
    names = _names(spark, f"{path.rstrip('/')}/_pointer/*.json")
    return _pointer(spark, path, names[-1]) if names else None


def committed_batch(spark: SparkSession, path: str, stream: str) -> int | None:
    """The last batch of a stream that the table at ``path`` holds."""
    state = table_state(spark, path)
    return state["streams"].get(stream) if state else None


def _commit(spark: SparkSession, path: str, state: dict, after: int) -> None:
    """Puts pointer ``after + 1`` in place, unless it is there already."""
    root = f"{path.rstrip('/')}/_pointer"
    name = f"{after + 1:09d}.json"
    fs, tmp = _fs(spark, f"{root}/.{uuid.uuid4().hex}")
    _, final = _fs(spark, f"{root}/{name}")
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps({k: state[k] for k in ("buckets", "key", "schema", "versions", "bytes", "streams")}).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(tmp, final):
        fs.delete(tmp, False)
        raise TableConflict(f"{path}: pointer {name} exists: another writer published meanwhile")


def _clean(spark: SparkSession, path: str, new: dict, old: dict | None) -> None:
    """Removes the pointers before ``old`` and what only they name: one call for a
    version folder, or for each bucket that was replaced."""
    root = path.rstrip("/")
    used = {(v, b) for st in (new, old or {"versions": {}}) for b, v in st["versions"].items()}
    live = {v for v, _ in used}
    for name in _names(spark, f"{root}/{VERSION}=*"):
        if name.split("=", 1)[1] not in live:
            _remove(spark, f"{root}/{name}")
    for name in _names(spark, f"{root}/_pointer/*.json")[:-2]:
        for b, v in _pointer(spark, path, name)["versions"].items():
            if v in live and (v, b) not in used:
                _remove(spark, f"{root}/{VERSION}={v}/{BUCKET}={b}")
        _remove(spark, f"{root}/_pointer/{name}")


def _existing_buckets(spark: SparkSession, path: str) -> set[int]:
    """Numbers of the buckets that hold rows, from the pointer."""
    state = table_state(spark, path)
    return {int(b) for b in state["versions"]} if state else set()


def _read_buckets(spark: SparkSession, path: str, state: dict, schema: StructType, buckets=None) -> DataFrame:
    """Some (else all) buckets of a table as ``schema`` and the bucket column;
    folders of other buckets are not even listed."""
    root = path.rstrip("/")
    dirs = [f"{root}/{VERSION}={v}/{BUCKET}={b}" for b, v in sorted(state["versions"].items(), key=lambda x: int(x[0]))
            if buckets is None or int(b) in buckets]
    if not dirs:
        return spark.createDataFrame([], schema).withColumn(BUCKET, F.lit(0))
    df = spark.read.schema(schema).option("basePath", root).parquet(*dirs)
    return df.select(*[F.col(f"`{f.name}`") for f in schema.fields], F.col(BUCKET).cast("int").alias(BUCKET))


def full_refresh(df: DataFrame, path: str, fmt: str = "parquet", sort_key: str | None = None,
                 compression: str = "zstd") -> None:
    """K6 (WRITE_TRUNCATE) with the K7/O3 layout: zstd pages, rows range-
    partitioned and sorted by ``sort_key`` (min/max stats per file then
    prune key lookups).  All or nothing: the new contents are written beside the
    table and swapped in when complete; ``df`` may read the table itself."""
    out, spark = df, df.sparkSession
    if sort_key:
        # Range by (key, row hash): files stay globally ordered by key, and
        # the sampler can split one hot key value over several tasks.
        row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        out = out.repartitionByRange(F.col(f"`{sort_key}`"), row_hash).sortWithinPartitions(F.col(f"`{sort_key}`"))
    restore_folder(spark, path)
    fresh = fresh_beside(path)
    try:
        out.write.format(fmt).option("compression", compression).save(fresh)
        replace_folder(spark, fresh, path)
    finally:
        _remove(spark, fresh)


def _write_version(df: DataFrame, path: str, version: str, sort_key: str, writers: int | None) -> None:
    """``writers=None``: the rows are in partitions by bucket already."""
    laid_out = _layout(df, sort_key, writers) if writers else df.sortWithinPartitions(BUCKET, sort_key)
    (laid_out.write.mode("overwrite").option("compression", "zstd")
        .partitionBy(BUCKET).parquet(f"{path.rstrip('/')}/{VERSION}={version}"))


def _plain(schema: StructType) -> StructType:
    """The schema without nullability, which Parquet tables do not keep."""
    out = StructType()
    for f in schema.fields:
        out = out.add(f.name, f.dataType, True)
    return out


def write_bucketed(df: DataFrame, path: str, key: str | Sequence[str], buckets: int,
                   sort_key: str | None = None, writers: int | None = None) -> None:
    """Writes the whole table anew as one version."""
    spark, keys = df.sparkSession, [key] if isinstance(key, str) else list(key)
    root, old = path.rstrip("/"), table_state(spark, path)
    version = "r" + uuid.uuid4().hex
    _write_version(df.withColumn(BUCKET, bucket_expr(keys, buckets)), path, version, sort_key or keys[0], writers or 4)
    found = [n.split("=", 1)[1] for n in _names(spark, f"{root}/{VERSION}={version}/{BUCKET}=*")]
    new = {"buckets": buckets, "key": keys, "schema": _plain(df.schema).json(), "versions": dict.fromkeys(found, version),
           "bytes": {version: _bytes(spark, f"{root}/{VERSION}={version}") // max(1, len(found))}, "streams": old["streams"] if old else {}}
    _commit(spark, path, new, old["n"] if old else 0)
    _clean(spark, path, new, old)


def _layout(df: DataFrame, sort_key: str, writers: int) -> DataFrame:
    """Hash-partition by (bucket, salt) where the salt is a row hash modulo
    ``writers``: each bucket is written by at most so many tasks, a hot or null key
    is split over them, and no sampling pass re-evaluates the input.  Rows
    are sorted by key inside each file, so min/max statistics prune lookups."""
    salt = [F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(writers))] if writers > 1 else []
    return df.repartition(F.col(BUCKET), *salt).sortWithinPartitions(BUCKET, sort_key)


def read_bucketed(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The published table, through its pointer, without its bucket column.  With
    ``schema``, a table that does not exist yet reads as an empty frame."""
    state = table_state(spark, path)
    if state is None:
        if schema is None:
            raise FileNotFoundError(f"{path}: no published table")
        return spark.createDataFrame([], schema)
    return _read_buckets(spark, path, state, StructType.fromJson(json.loads(state["schema"]))).drop(BUCKET)


def publish_upsert(spark: SparkSession, stage: DataFrame, path: str, key: str = "id",
                   buckets: int | None = None, guarded_by: str | None = None, keep_latest: bool = False,
                   tie_break: Sequence[str] = (), on_extra: str = "error", not_null: Sequence[str] = (),
                   require_rows: bool = False, key_check: str = "off", batch: tuple[str, int] | None = None) -> dict:
    """K1 (``guarded_by=None``) or K2 (``guarded_by=<date column>``) into the
    bucketed Parquet table at ``path``; creates the table on first use.

    The stage is conformed to the table's schema (K3; ``on_extra="evolve"`` adds
    its surplus columns to the table), written once, and checked there: empty
    loads (``require_rows``) and nulls in ``not_null`` columns.  Keys that occur
    twice or are null are looked for in the merged buckets (``key_check``: "off",
    "report", "strict").  Nothing is published when a check fails.

    ``batch`` = (stream, number) is committed with the data; a number that the table
    holds already is not published again.  Returns the counts."""
    root, run = path.rstrip("/"), "r" + uuid.uuid4().hex
    old = table_state(spark, path)
    fixed = old["buckets"] if old and old["versions"] else None     # rows fix the count
    if fixed and buckets not in (None, fixed):
        raise TableConflict(f"{path} has {fixed} buckets, not {buckets}")
    if old and old["key"] != [key]:
        raise TableConflict(f"{path} is keyed by {old['key']}, not {key}")
    streams = dict(old["streams"]) if old else {}
    if batch:
        if streams.get(batch[0], batch[1] - 1) >= batch[1]:
            return {"rows": 0, "key_violations": None, "buckets": [], "skipped": True}
        streams[batch[0]] = batch[1]
    schema = _plain(stage.schema)
    if old:
        have = StructType.fromJson(json.loads(old["schema"]))
        if [(f.name, f.dataType) for f in schema.fields] != [(f.name, f.dataType) for f in have.fields]:
            stage = conform(stage, have, on_extra=on_extra)
        schema = _plain(stage.schema)
    staged_path, version_path, committed = f"{root}/_staging/{run}", f"{root}/{VERSION}={run}", False
    try:
        stage.write.option("compression", "zstd").parquet(staged_path)
        staged_bytes = _bytes(spark, staged_path)
        n_buckets = fixed or buckets or suggest_buckets(staged_bytes)
        staged = spark.read.schema(schema).parquet(staged_path).withColumn(BUCKET, bucket_expr(key, n_buckets))
        # One aggregate; at most a row per bucket comes to the driver.
        width = F.coalesce(F.octet_length(F.col(f"`{key}`").cast("string")), F.lit(0))
        bad = [F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"null_{i}") for i, c in enumerate(not_null)]
        facts = staged.groupBy(BUCKET).agg(F.count("*").alias("n"), F.sum(width).alias("width"), *bad).collect()
        rows, key_bytes = sum(r["n"] for r in facts), sum(r["width"] for r in facts)
        nulls = {c: sum(r[f"null_{i}"] for r in facts) for i, c in enumerate(not_null)}
        if any(nulls.values()):
            raise SchemaMismatch(f"nulls in NOT NULL columns: { {c: n for c, n in nulls.items() if n} }")
        if require_rows and not rows:
            raise QualityError("row-count gate: the load is empty")
        found = {"rows": rows, "key_violations": None, "buckets": sorted(r[BUCKET] for r in facts)}
        versions, sizes = (dict(old["versions"]), dict(old["bytes"])) if old else ({}, {})
        if rows:
            merged, touched = staged, [str(b) for b in found["buckets"]]
            size = staged_bytes + sum(sizes.get(versions[b], 0) for b in touched if b in versions)
            # A third of it may lie in one bucket.
            writers = max(1, -(-size // (3 * WRITER_BYTES)))
            if old:
                target = _read_buckets(spark, path, old, schema, set(found["buckets"]))
                small = rows * 32 + key_bytes       # what a row per key would take at most
                if guarded_by is None and small > up.BROADCAST_MAX_BYTES:
                    merged = up.replace_laid_out(target, staged, key, BUCKET, min(writers, up.salts(staged)), writers)
                    writers = None
                elif guarded_by is None:
                    merged = upsert_replace(target, staged, key, stage_bytes=small)
                else:
                    merged = upsert_guarded(target, staged, key, guarded_by, keep_latest=keep_latest, tie_break=tie_break, stage_bytes=small)
            _write_version(merged, path, run, key, writers)
            if key_check != "off":
                done = spark.read.schema(schema).parquet(version_path)
                found["key_violations"] = key_constraint_report(done, key).count()
                if key_check == "strict" and found["key_violations"]:
                    raise QualityError(f"key constraint violated on {key}: {found['key_violations']} keys")
            # A touched bucket keeps at least the newest row of a stage key.
            versions |= dict.fromkeys(touched, run)
            sizes[run] = _bytes(spark, version_path) // len(touched)
        if rows or batch or not old:
            live = set(versions.values())
            new = {"buckets": n_buckets, "key": [key], "schema": schema.json(), "versions": versions,
                   "bytes": {v: n for v, n in sizes.items() if v in live}, "streams": streams}
            _commit(spark, path, new, old["n"] if old else 0)
            committed = True
            _clean(spark, path, new, old)
        return found
    finally:
        _remove(spark, staged_path)
        if not committed:
            _remove(spark, version_path)
        if not _names(spark, f"{root}/_staging/*"):
            _remove(spark, f"{root}/_staging")
        if not old and not _names(spark, f"{root}/*"):
            _remove(spark, root)        # nothing was published


def replace_group_sql(target: str, stage: str, key: str = "id",
                      guarded_by: str | None = None) -> tuple[list[str], list[str]]:
    """Statements of a staged warehouse load: recreate the stage with the
    target's shape, then (in one transaction) delete the target rows that a
    stage row replaces and insert every stage row.  Uses the portable
    ``DELETE … WHERE EXISTS`` form of delete-using."""
    pre = [f"DROP TABLE IF EXISTS {stage}",
           f"CREATE TABLE {stage} AS SELECT * FROM {target} WHERE 1 = 0"]
    cond = f"{stage}.{key} = {target}.{key}"
    if guarded_by:
        cond += f" AND {stage}.{guarded_by} >= {target}.{guarded_by}"
    post = [f"DELETE FROM {target} WHERE EXISTS (SELECT 1 FROM {stage} WHERE {cond})",
            f"INSERT INTO {target} SELECT * FROM {stage}",
            f"DROP TABLE {stage}"]
    return pre, post


def jdbc_options(batch_size: int = 10, extra: dict | None = None) -> dict:
    """K5: writer options of the staged bulk load (rows per insert batch)."""
    opts = {"batchsize": str(batch_size)}
    opts.update(extra or {})
    return opts


def _run_statements(spark: SparkSession, url: str, properties: dict, statements: list[str],
                    transaction: bool) -> None:
    jvm = spark._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        conn.setAutoCommit(not transaction)
        stmt = conn.createStatement()
        for sql in statements:
            stmt.execute(sql)
        if transaction:
            conn.commit()
    except Exception:
        if transaction:
            conn.rollback()
        raise
    finally:
        conn.close()


def publish_jdbc(df: DataFrame, url: str, target: str, key: str = "id", guarded_by: str | None = None,
                 properties: dict | None = None, batch_size: int = 10_000, widths: dict | None = None) -> None:
    """K1/K2 into a warehouse table over JDBC (K5): stage table shaped like
    the target, bulk append from the executors, then delete-where-exists +
    insert in one transaction on the driver's connection.  ``widths`` cuts
    over-long strings first (the TRUNCATECOLUMNS load option).

    Not exercised here: no warehouse server is reachable in this
    environment, only the statements are tested."""
    from ..functions.text import truncate_width

    stage = f"{target}_stage_table"
    pre, post = replace_group_sql(target, stage, key, guarded_by)
    props = dict(properties or {})
    spark = df.sparkSession
    _run_statements(spark, url, props, pre, transaction=False)
    out = truncate_width(df, widths) if widths else df
    writer = out.write.mode("append")
    for k, v in jdbc_options(batch_size).items():
        writer = writer.option(k, v)
    writer.jdbc(url, stage, properties=props)
    _run_statements(spark, url, props, post, transaction=True)
