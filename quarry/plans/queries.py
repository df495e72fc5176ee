"""Registered queries: one per operator of the inventory, each over the
whole given tables (or data Spark derives from them).

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names match the DuckDB oracle in ``oracles.py``.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.text import capitalize, regex_rules, truncate_width
from ..functions.times import (epoch_millis_ntz, epoch_ms_to_text, epoch_ms_to_timestamp_ntz)
from ..operators.conform import conform, empty_like
from ..operators.dedup import deduplicate
from ..operators.flatten import coalesce_choice, flatten_all, flatten_struct
from ..operators.mapping import apply_mapping
from ..operators.projection import named_projection, sql_projection
from ..operators.quality import key_constraint_report, row_count_gate
from ..operators.upsert import upsert_guarded, upsert_replace
from ..session import run_path
from ..sinks.publish import full_refresh, publish_upsert, read_bucketed, write_bucketed
from ..sources.descriptor import descriptor_schema, descriptor_sql
from ..sources.scan import read_parquet_glob, read_rolling, read_table
from ..sources.zones import ingest_zone, load_zone
from ..streaming.incremental import incremental_upsert
from .pipeline import (PipelineConfig, RECIPES, config_from_entry, load_curated, query_descriptor, run_batch, run_pipeline,
                       transform)


def _utc(spark: SparkSession) -> None:
    # Epoch ⇄ text conversions go through the session zone; the registered
    # queries are defined in UTC.
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# ------------------------------------------------------------------ sources

def q_scan_catalog(spark, sf):
    return read_table(spark, f"{sf}/orders.parquet")


def q_scan_small_files(spark, sf):
    """Lineitem landed as many small files; Spark packs them into read
    splits (``maxPartitionBytes`` / ``openCostInBytes``), so the scan runs
    far fewer tasks than there are files."""
    path = run_path(spark, "small_files")
    li = fx.table(spark, sf, "lineitem")
    li.repartition(64).write.mode("overwrite").parquet(path)  # round-robin: 64 small files, no key skew
    return read_table(spark, path).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


ROLLING = {"componentwise": (dt.date(2024, 1, 20), 5), "date": (dt.date(2024, 1, 25), 3)}


def _rolling(mode):
    def q(spark, sf):
        path = fx.write_events_by_day(spark, sf, run_path(spark, "events_by_day"))
        as_of, days = ROLLING[mode]
        return read_rolling(spark, path, days, as_of, mode=mode)
    return q


EVENT_DESCRIPTOR = {"event_id": "long", "event_type": "string", "props": {"k": "long"},
                    "sql": "select event_id, event_type, props.k as k from events"}


def q_schema_from_descriptor(spark, sf):
    ev = fx.table(spark, sf, "events")
    st = descriptor_schema(EVENT_DESCRIPTOR)
    parsed = ev.select(F.col("event_id").try_cast(st["event_id"].dataType).alias("event_id"),
                       F.col("event_type"),
                       F.from_json(F.col("props"), st["props"].dataType).alias("props"))
    return named_projection({"events": parsed}, descriptor_sql(EVENT_DESCRIPTOR))


def q_descriptor_json_read(spark, sf):
    """S6 read path: events land as JSON files with a nested ``props``
    object and are read with the descriptor's declared schema (no inference
    pass over the files), then queried by the descriptor's stored SQL."""
    landing = run_path(spark, "events_json")
    ev = fx.table(spark, sf, "events")
    (ev.select("event_id", "event_type", F.from_json("props", "k bigint").alias("props"))
       .write.mode("overwrite").json(landing))
    return query_descriptor(spark, landing, EVENT_DESCRIPTOR, "events")


def q_zone_ingest(spark, sf):
    landing = run_path(spark, "landing")
    processing = run_path(spark, "processing")
    sources = fx.write_zone(spark, sf, landing)
    schemas = {n: fx.table(spark, sf, n).schema for n in sources}
    zone = ingest_zone(spark, sources, processing, schemas)
    # Every row and column of the refreshed zone, under common names.
    names = ("key", "name", "number", "amount", "label", "kind")
    columns = {"customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", None),
               "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal", None, None),
               "part": ("p_partkey", "p_name", "p_size", "p_retailprice", "p_brand", "p_type")}
    parts = [zone[n].select(F.lit(n).alias("entity"), *[
                 (F.col(c) if c else F.lit(None).cast("string")).alias(to) for c, to in zip(cols, names)])
             for n, cols in columns.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_zone_rejects(spark, sf):
    """S7 with records that do not fit: the zone's rows, and the customers whose
    records lie in quarantine, read from their text."""
    root = run_path(spark, "damaged")
    landing = fx.write_damaged_zone(spark, sf, f"{root}/landing")
    schema = fx.table(spark, sf, "customer").schema
    load = load_zone(spark, {"customer": landing}, f"{root}/processing", {"customer": schema}, max_reject_share=0.9)["customer"]
    out = load.table.select(F.lit("zone").alias("place"), "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    if load.rejected:
        key = F.regexp_extract("record", r'"c_custkey":(\d+)', 1).cast("long")
        none = lambda c: F.lit(None).cast(schema[c].dataType).alias(c)
        bad = spark.read.parquet(load.rejects).select(F.lit("rejects").alias("place"), key.alias("c_custkey"), none("c_name"), none("c_nationkey"), none("c_acctbal"))
        out = out.unionAll(bad)
    return out


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def q_curated_refresh(spark, sf):
    src = fx.write_curated_files(spark, sf, run_path(spark, "curated_src"))
    out = load_curated(spark, f"{src}/drop=*/*.parquet", run_path(spark, "curated"), sort_key="o_orderkey")
    return out.select(*ORDER_COLS)


def q_curated_drift(spark, sf):
    """S8/PL2 over drops whose types differ: the key's choice is collapsed."""
    src = fx.write_drifting_files(spark, sf, run_path(spark, "drift_src"))
    out = load_curated(spark, f"{src}/drop=*/*.parquet", run_path(spark, "drift"), on_drift="choice")
    return coalesce_choice(flatten_struct(out), "o_orderkey").select(*ORDER_COLS)


def q_refresh_survives_failure(spark, sf):
    """K6: a refresh that fails while it writes leaves the table as it was."""
    path = run_path(spark, "orders_refreshed")
    orders = fx.table(spark, sf, "orders")
    full_refresh(orders, path, sort_key="o_orderkey")
    half = F.when(F.col("o_orderstatus") == "F", F.raise_error(F.lit("the source broke off"))).otherwise(F.lit("new"))
    try:
        full_refresh(orders.withColumn("o_orderpriority", half), path, sort_key="o_orderkey")
    except PySparkException:
        return spark.read.parquet(path).select(*ORDER_COLS)
    raise AssertionError("the broken refresh went through")


def q_row_count_gate(spark, sf):
    src = fx.write_curated_files(spark, sf, run_path(spark, "curated_src"))
    return row_count_gate(read_parquet_glob(spark, f"{src}/drop=*/*.parquet"))


# ------------------------------------------------------------------ reshaping

def q_flatten_struct(spark, sf):
    return flatten_struct(fx.nested_orders(spark, sf))


def q_flatten_all(spark, sf):
    return flatten_all(fx.raw_orders(spark, sf))


def q_flatten_sliced(spark, sf):
    """P2 with arrays cut into slices that are dealt over tasks before they are
    exploded, their product included."""
    return flatten_all(fx.long_arrays(spark, sf), slice_elements=16)


def q_flatten_two_arrays(spark, sf):
    return flatten_all(fx.multi_array(spark, sf)).drop("m")


def q_type_choice(spark, sf):
    flat = flatten_all(fx.raw_orders(spark, sf))
    text = F.col("_raw_data_lines_shippedAt_string")
    parsed = epoch_millis_ntz(F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd'T'HH:mm:ss")))
    out = coalesce_choice(flat, "_raw_data_lines_shippedAt", parse={"string": parsed}, to="shipped_ms")
    return out.select(F.col("_raw_data_orderId").alias("order_id"),
                      F.col("_raw_data_lines_lineNumber").alias("line_number"),
                      F.col("_raw_data_lines_partKey").alias("part_key"),
                      F.col("_raw_data_lines_suppKey").alias("supp_key"),
                      F.col("_raw_data_lines_price").alias("price"),
                      "shipped_ms")


def q_dedup_latest_event(spark, sf):
    ev = fx.table(spark, sf, "events")
    return deduplicate(ev, [{"partitionby": ["user_id"], "orderby": ["ts", "event_id"]}])


LINE_TIE_BREAK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax"]


def q_dedup_hot_keys(spark, sf):
    """Dedup where every group is hot: lineitem by (return flag, line status)
    has a handful of groups, each holding about a quarter of all rows.  The
    partial WindowGroupLimit keeps one row per group per map task, so no task
    receives a whole group."""
    li = fx.table(spark, sf, "lineitem")
    return deduplicate(li, [{"partitionby": ["l_returnflag", "l_linestatus"], "orderby": ["l_shipdate"],
                             "tie_break": LINE_TIE_BREAK}])


def q_dedup_sequential(spark, sf):
    o = fx.table(spark, sf, "orders")
    return deduplicate(o, [
        {"partitionby": ["o_custkey", "o_orderstatus"], "orderby": ["o_orderdate"], "tie_break": ["o_orderkey"]},
        {"partitionby": ["o_custkey"], "orderby": ["o_totalprice"], "tie_break": ["o_orderkey"]},
    ])


ORDERS_MAPPING = [
    ("key_txt", "string", "id", "bigint"),
    ("cust_txt", "string", "cust", "long"),
    ("price_txt", "string", "price", "double"),
    ("o_orderstatus", "string", "status", "string"),
    ("o_orderpriority", "string", "priority_num", "bigint"),
    ("rank_txt", "string", "priority_rank", "int"),
    ("created_ms", "long", "dt_created", "long"),
]


def _orders_as_text(spark, sf):
    o = fx.table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("key_txt"),
                    F.col("o_custkey").cast("string").alias("cust_txt"),
                    F.col("o_totalprice").cast("string").alias("price_txt"),
                    "o_orderstatus", "o_orderpriority",
                    F.substring("o_orderpriority", 1, 1).alias("rank_txt"),
                    epoch_millis_ntz(F.col("o_orderdate")).alias("created_ms"))


def q_apply_mapping(spark, sf):
    return apply_mapping(_orders_as_text(spark, sf), ORDERS_MAPPING)


PROJECTION_SQL = """
select id, cust, status, price, priority_rank,
       cast(from_unixtime(dt_created/1000) as timestamp_ntz) as dt_created
from table
where price > 100000;
"""


def q_sql_projection(spark, sf):
    _utc(spark)
    return sql_projection(apply_mapping(_orders_as_text(spark, sf), ORDERS_MAPPING), PROJECTION_SQL)


def _events_ms(spark, sf):
    ev = fx.table(spark, sf, "events")
    return ev.select("event_id", epoch_millis_ntz(F.col("ts")).alias("ts_ms"))


def q_epoch_ms_timestamp(spark, sf):
    _utc(spark)
    e = _events_ms(spark, sf)
    return e.select("event_id", "ts_ms", epoch_ms_to_timestamp_ntz(F.col("ts_ms")).alias("ts_sec"))


def q_epoch_ms_text(spark, sf):
    _utc(spark)
    e = _events_ms(spark, sf)
    return e.select("event_id", epoch_ms_to_text(F.col("ts_ms")).alias("ts_text"))


def q_capitalize_unaccent(spark, sf):
    d = fx.table(spark, sf, "documents")
    return capitalize(d.select("doc_id", "lang", "text"), ["text"])


REGEX_RULES = [
    {"field": "p_brand", "pattern": r"Brand#(\d+)", "replacement": "B-$1"},
    {"field": "p_name", "pattern": r"\s+", "replacement": "_"},
    {"field": "p_name", "pattern": r"^([a-z]+)_([a-z]+)$", "replacement": "$2 $1"},
]


def q_regex_clean(spark, sf):
    p = fx.table(spark, sf, "part")
    return regex_rules(p.select("p_partkey", "p_name", "p_brand"), REGEX_RULES)


# ------------------------------------------------------------------ upserts / sinks

def q_upsert_replace(spark, sf):
    return upsert_replace(fx.orders_target(spark, sf), fx.orders_stage(spark, sf), "id")


def q_upsert_guarded(spark, sf):
    return upsert_guarded(fx.orders_target(spark, sf), fx.orders_stage(spark, sf), "id", "dt_updated")


def q_upsert_guarded_keep_latest(spark, sf):
    return upsert_guarded(fx.orders_target(spark, sf), fx.orders_stage(spark, sf), "id", "dt_updated",
                          keep_latest=True)


def q_upsert_publish_bucketed(spark, sf):
    path = run_path(spark, "orders_table")
    write_bucketed(fx.orders_target(spark, sf), path, "id", buckets=16)
    publish_upsert(spark, fx.orders_stage(spark, sf), path, key="id", buckets=16)
    return read_bucketed(spark, path)


def q_upsert_publish_guarded(spark, sf):
    path = run_path(spark, "orders_table")
    write_bucketed(fx.orders_target(spark, sf), path, "id", buckets=16)
    publish_upsert(spark, fx.orders_stage(spark, sf), path, key="id", buckets=16, guarded_by="dt_updated",
                   keep_latest=True)
    return read_bucketed(spark, path)


def q_conform_to_target(spark, sf):
    target = fx.orders_target(spark, sf)
    incoming = target.select(F.col("dt_updated").alias("DT_UPDATED"), F.col("price").cast("string").alias("price"),
                             "priority", "status", F.col("cust").cast("string").alias("cust"),
                             F.col("id").cast("string").alias("id"))
    shape = empty_like(spark, target.schema)  # O2: the target's shape, no rows
    return conform(incoming, shape.schema)


def q_truncate_width(spark, sf):
    d = fx.table(spark, sf, "documents")
    return truncate_width(d.select("doc_id", "text", "source"), {"text": 35, "source": 3})


def q_key_constraint_report(spark, sf):
    return key_constraint_report(fx.table(spark, sf, "lineitem"), "l_orderkey")


def q_target_layout(spark, sf):
    path = run_path(spark, "orders_sorted")
    full_refresh(fx.table(spark, sf, "orders"), path, sort_key="o_orderkey", compression="zstd")
    return spark.read.parquet(path)


# ------------------------------------------------------------------ pipelines

EVENTS_MAPPING = [
    ("_raw_data_userId", "string", "user_id", "bigint"),
    ("_raw_data_event_id", "long", "event_id", "bigint"),
    ("_raw_data_event_type", "string", "kind", "string"),
    ("_raw_data_event_value", "double", "value", "double"),
    ("_raw_data_event_at", "string", "at_ms", "long"),
    ("_emitted_at", "long", "emitted_ms", "long"),
]
EVENTS_SQL = """
select user_id, event_id, kind, value, cast(from_unixtime(at_ms/1000) as timestamp_ntz) as happened_at,
       from_unixtime(emitted_ms/1000) as emitted_text
from table;
"""
EVENTS_DEDUP = [{"partitionby": ["_raw_data_userId"], "orderby": ["_emitted_at", "_raw_data_event_id"]}]
EVENTS_REGEX = [{"field": "kind", "pattern": "^(ERROR|SIGNUP)$", "replacement": "ALERT_$1"}]

# What a customer is charged per order line, and how long it took to ship.
CHARGES_MAPPING = [
    ("_raw_data_orderId", "string", "order_no", "bigint"),
    ("_raw_data_lines_lineNumber", "string", "line_no", "int"),
    ("_raw_data_custId", "long", "customer_no", "bigint"),
    ("_raw_data_lines_suppKey", "long", "supplier_no", "bigint"),
    ("_raw_data_lines_quantity", "double", "quantity", "double"),
    ("_raw_data_lines_price", "double", "list_price", "double"),
    ("_raw_data_lines_discount", "double", "discount", "double"),
    ("_raw_data_lines_tax", "double", "tax", "double"),
    ("_raw_data_priority", "string", "urgency", "string"),
    ("_raw_data_createdAt", "string", "ordered_ms", "bigint"),
    ("_raw_data_lines_shippedAt_long", "long", "shipped_ms", "bigint"),
]
CHARGES_SQL = """
select order_no, line_no, customer_no, supplier_no, urgency, quantity,
       list_price * (1 - discount) as net_price,
       list_price * (1 - discount) * (1 + tax) as charged,
       case when discount >= 0.05 then 'reduced' else 'full' end as price_class,
       cast(from_unixtime(ordered_ms/1000) as timestamp_ntz) as ordered_at,
       floor((shipped_ms - ordered_ms) / 86400000) as days_to_ship,
       tax
from table
"""
CHARGES_DEDUP = [{"partitionby": ["_raw_data_orderId", "_raw_data_lines_lineNumber"],
                  "orderby": ["_emitted_at", "_raw_data_lines_shippedAt_long"],
                  "tie_break": ["_raw_data_lines_partKey", "_raw_data_lines_suppKey", "_raw_data_lines_price",
                                "_raw_data_lines_quantity", "_raw_data_lines_discount", "_raw_data_lines_tax",
                                "_raw_data_lines_returnFlag", "_raw_data_lines_shippedAt_string"]}]
CHARGES_REGEX = [{"field": "urgency", "pattern": r"^(\d)-(.*)$", "replacement": "$2 ($1)"}]
# The published table has no ``tax`` (``charged`` includes it), a price class of two
# letters, and whole numbers of items and days.
CHARGES_TARGET = ("order_no bigint NOT NULL, line_no int, customer_no bigint, supplier_no bigint, urgency varchar(12), "
                  "quantity int, net_price double, charged double, price_class varchar(2), ordered_at timestamp_ntz, days_to_ship int")


def charges_pipeline_config(destination: str, origin: str = "") -> PipelineConfig:
    return PipelineConfig(origin=origin, destination=destination, dedup=CHARGES_DEDUP,
                          mapping=CHARGES_MAPPING, sql=CHARGES_SQL, capitalize=["urgency", "price_class"],
                          regex=CHARGES_REGEX, key="order_no", target_ddl=CHARGES_TARGET, on_extra="drop",
                          **RECIPES["full_all_replace"])


def events_pipeline_config(destination: str, recipe: str, origin: str = "", **kw) -> PipelineConfig:
    return PipelineConfig(origin=origin, destination=destination, dedup=EVENTS_DEDUP, mapping=EVENTS_MAPPING,
                          sql=EVENTS_SQL, capitalize=["kind"], regex=EVENTS_REGEX, key="user_id",
                          guarded_by="happened_at", **RECIPES[recipe], **kw)


def nested_orders_flagship(spark: SparkSession, sf: str) -> DataFrame:
    """The minimum slice: envelope → flatten_all → dedup → mapping → SQL →
    capitalize → regex (what gets published)."""
    _utc(spark)
    return transform(fx.raw_orders(spark, sf), charges_pipeline_config(destination=""))


def q_recipe_full_all_replace(spark, sf):
    """Recipe (full scan, flatten_all, replace): run twice — the whole
    envelope, then the records of open orders again — into a bucketed
    table."""
    _utc(spark)
    raw_path = run_path(spark, "raw_orders")
    fx.raw_orders(spark, sf).write.mode("overwrite").option("compression", "zstd").parquet(raw_path)
    cfg = charges_pipeline_config(run_path(spark, "deal_like") + "/table", origin=raw_path)
    run_pipeline(spark, cfg)
    # Second drop: open orders re-emitted a day later, escalated to urgent.
    reopened = (spark.read.parquet(raw_path).where(F.col("_raw_data.status") == "O")
                     .withColumn("_raw_data", F.col("_raw_data").withField("priority", F.lit("1-URGENT")))
                     .withColumn("_emitted_at", F.col("_emitted_at") + F.lit(fx.DAY_MS)))
    return run_pipeline(spark, cfg, source=reopened)


def _raw_events_drop(spark, sf, lo: str | None, hi: str | None) -> DataFrame:
    ev = fx.raw_events(spark, sf)
    at = F.col("_emitted_at")
    if lo:
        ev = ev.where(at >= epoch_millis_ntz(F.lit(dt.datetime.fromisoformat(lo)).cast("timestamp_ntz")))
    if hi:
        ev = ev.where(at < epoch_millis_ntz(F.lit(dt.datetime.fromisoformat(hi)).cast("timestamp_ntz")))
    return ev


def q_recipe_full_struct_replace(spark, sf):
    """Recipe (full, flatten_struct, replace): events before noon of the last day,
    then those from then on; users without a late event keep their old row."""
    _utc(spark)
    cfg = events_pipeline_config(run_path(spark, "contacts_like") + "/table", "full_struct_replace")
    run_pipeline(spark, cfg, source=_raw_events_drop(spark, sf, None, "2024-01-30 12:00:00"))
    return run_pipeline(spark, cfg, source=_raw_events_drop(spark, sf, "2024-01-30 12:00:00", None))


def q_recipe_full_struct_guarded(spark, sf):
    """Recipe (full, flatten_struct, guarded): events from Jan 15 on, then a drop of
    those before Jan 20, stale for most users (the unconditional insert keeps
    the stale rows next to the newer ones).  Every event is in a drop."""
    _utc(spark)
    cfg = events_pipeline_config(run_path(spark, "archived_like") + "/table", "full_struct_guarded")
    run_pipeline(spark, cfg, source=_raw_events_drop(spark, sf, "2024-01-15", None))
    return run_pipeline(spark, cfg, source=_raw_events_drop(spark, sf, None, "2024-01-20"))


def q_recipe_rolling_struct_replace(spark, sf):
    """Recipe (rolling scan, flatten_struct, replace): the envelope stored by
    day; first run as of Jan 10 looking back 9 days, second as of Jan 31
    looking back 1 day.  Users without an event on the last day keep their row."""
    _utc(spark)
    raw = fx.raw_events(spark, sf).withColumn("__ts", F.timestamp_millis("_emitted_at"))
    origin = fx.write_by_day(raw, "__ts", run_path(spark, "raw_events_by_day"))
    dest = run_path(spark, "companies_like") + "/table"
    first = events_pipeline_config(dest, "rolling_struct_replace", origin=origin, rolling_days=9,
                                   as_of=dt.date(2024, 1, 10))
    second = events_pipeline_config(dest, "rolling_struct_replace", origin=origin, rolling_days=1,
                                    as_of=dt.date(2024, 1, 31))
    # The partition columns come back with the envelope; the mapping drops them.
    run_pipeline(spark, first)
    return run_pipeline(spark, second)


def _entry_schema(mapping):
    return {"schema": [{"Name": a, "Type": b, "NameTo": c, "TypeTo": d} for a, b, c, d in mapping]}


def q_config_batch(spark, sf):
    """PL1: a config document with two entries dispatched by flow name; every
    column of both published tables."""
    _utc(spark)
    raw_orders_path = run_path(spark, "raw_orders")
    fx.raw_orders(spark, sf).write.mode("overwrite").option("compression", "zstd").parquet(raw_orders_path)
    raw_events_path = run_path(spark, "raw_events")
    fx.raw_events(spark, sf).write.mode("overwrite").option("compression", "zstd").parquet(raw_events_path)
    dest = run_path(spark, "batch")
    doc = {"conf": [
        {"origin_table": raw_events_path, "destination_table": f"{dest}/contacts", "flow": "flow", "key": "user_id",
         "deduplicate": EVENTS_DEDUP, "capitalize": ["kind"], "capitalizeword": EVENTS_REGEX,
         "schema": _entry_schema(EVENTS_MAPPING), "sql": EVENTS_SQL},
        {"origin_table": raw_orders_path, "destination_table": f"{dest}/deal_pipelines", "flow": "flow3",
         "key": "order_no", "deduplicate": CHARGES_DEDUP, "capitalize": ["urgency", "price_class"], "capitalizeword": CHARGES_REGEX,
         "schema": _entry_schema(CHARGES_MAPPING), "sql": CHARGES_SQL, "target_ddl": CHARGES_TARGET, "on_extra": "drop"},
    ]}
    tables = [df.withColumn("destination", F.lit(name.rsplit("/", 1)[-1])) for name, df in run_batch(spark, doc).items()]
    return tables[0].unionByName(tables[1], allowMissingColumns=True)


# ------------------------------------------------------------------ incremental

def q_incremental_upsert(spark, sf):
    landing = run_path(spark, "events_landing")
    target = run_path(spark, "events_latest") + "/table"
    checkpoint = run_path(spark, "events_stream_ckpt")
    schema = fx.table(spark, sf, "events").schema
    # Drops arrive newest first, the worst order for a "latest" table.
    for i, drop in enumerate(reversed(fx.events_drops(spark, sf, 3))):
        drop.write.mode("append").parquet(landing)
        incremental_upsert(spark, landing, schema, target, checkpoint, key="user_id", date="ts",
                           dedup=[{"partitionby": ["user_id"], "orderby": ["ts", "event_id"]}], buckets=8)
    return read_bucketed(spark, target).select(*schema.names)


def q_incremental_catalog_table(spark, sf):
    """S5 over a catalog table: events arrive as files of an external table, newest
    drop first; each run reads the files that its bookmark has not seen."""
    landing, name = run_path(spark, "events_feed"), f"events_feed_{uuid.uuid4().hex}"
    drops = list(reversed(fx.events_drops(spark, sf, 3)))
    entry = {"origin_table": name, "glue_database": spark.catalog.currentDatabase(), "destination_table": run_path(spark, "feed_latest") + "/table",
             "scan": "incremental", "flatten": "none", "upsert": "guarded", "key": "user_id", "guarded_by": "ts", "keep_latest": True,
             "latest_by": ["event_id"], "deduplicate": [{"partitionby": ["user_id"], "orderby": ["ts", "event_id"]}]}
    out = None
    try:
        for drop in drops:
            drop.write.mode("append").parquet(landing)
            if out is None:
                spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{landing}'")
            out = run_pipeline(spark, config_from_entry(entry))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return out


_REGISTERED = {
    "scan_catalog": q_scan_catalog,
    "scan_small_files": q_scan_small_files,
    "rolling_scan_componentwise": _rolling("componentwise"),
    "rolling_scan_date": _rolling("date"),
    "schema_from_descriptor": q_schema_from_descriptor,
    "descriptor_json_read": q_descriptor_json_read,
    "zone_ingest": q_zone_ingest,
    "zone_rejects": q_zone_rejects,
    "curated_refresh": q_curated_refresh,
    "curated_drift": q_curated_drift,
    "refresh_survives_failure": q_refresh_survives_failure,
    "row_count_gate": q_row_count_gate,
    "flatten_struct": q_flatten_struct,
    "flatten_all": q_flatten_all,
    "flatten_two_arrays": q_flatten_two_arrays,
    "flatten_sliced": q_flatten_sliced,
    "type_choice_coalesce": q_type_choice,
    "dedup_latest_event": q_dedup_latest_event,
    "dedup_sequential": q_dedup_sequential,
    "dedup_hot_keys": q_dedup_hot_keys,
    "apply_mapping": q_apply_mapping,
    "sql_projection": q_sql_projection,
    "epoch_ms_timestamp": q_epoch_ms_timestamp,
    "epoch_ms_text": q_epoch_ms_text,
    "capitalize_unaccent": q_capitalize_unaccent,
    "regex_clean": q_regex_clean,
    "upsert_replace": q_upsert_replace,
    "upsert_guarded": q_upsert_guarded,
    "upsert_guarded_keep_latest": q_upsert_guarded_keep_latest,
    "upsert_publish_bucketed": q_upsert_publish_bucketed,
    "upsert_publish_guarded": q_upsert_publish_guarded,
    "conform_to_target": q_conform_to_target,
    "truncate_width": q_truncate_width,
    "key_constraint_report": q_key_constraint_report,
    "target_layout": q_target_layout,
    "nested_orders_flagship": nested_orders_flagship,
    "recipe_full_all_replace": q_recipe_full_all_replace,
    "recipe_full_struct_replace": q_recipe_full_struct_replace,
    "recipe_full_struct_guarded": q_recipe_full_struct_guarded,
    "recipe_rolling_struct_replace": q_recipe_rolling_struct_replace,
    "config_batch": q_config_batch,
    "incremental_upsert": q_incremental_upsert,
    "incremental_catalog_table": q_incremental_catalog_table,
}


def _pinned(fn):
    def run(spark, sf):
        _utc(spark)
        return fn(spark, sf)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


# Every registered query is defined in UTC (epoch ⇄ text goes through the
# session zone).
QUERIES = {name: _pinned(fn) for name, fn in _REGISTERED.items()}
