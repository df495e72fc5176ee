"""Config-driven table pipelines.

One parameterised pipeline covers every entity flow:

    scan → flatten → deduplicate → map schema → SQL → capitalize → regex → upsert

Steps up to the SQL stay one lazy DataFrame plan; publishing is the single
action.  A config document lists entries; each entry names a *preset* (the
recipe) and carries its own dedup specs, text rules, mapping and SQL.
"""

from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Iterable, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType, _parse_datatype_string

from ..functions.text import capitalize, regex_rules
from ..operators.dedup import deduplicate
from ..operators.flatten import coalesce_choice, flatten_all, flatten_struct
from ..operators.conform import conform
from ..operators.mapping import apply_mapping, parse_mapping
from ..operators.projection import named_projection, sql_projection
from ..operators.quality import check_row_count
from ..sinks.publish import committed_batch, full_refresh, publish_upsert, read_bucketed
from ..sources.descriptor import descriptor_sql, load_descriptor, read_with_descriptor
from ..sources.drift import read_drifting
from ..sources.scan import read_parquet_glob, read_rolling, read_split_settings, read_table
from ..streaming.bookmark import process_new_table_files
from ..streaming.incremental import process_new_files


@dataclass
class PipelineConfig:
    origin: str                       # path (or catalog table with scan_format="table")
    destination: str                  # published table path
    scan: str = "full"                # "full" (S1) | "rolling" (S2+S3) | "incremental" (S5)
    flatten: str = "struct"           # "struct" (P1) | "all" (P2) | "none"
    upsert: str = "replace"           # "replace" (K1) | "guarded" (K2)
    key: str = "id"
    guarded_by: str = "dt_updated"
    keep_latest: bool = False
    dedup: list = field(default_factory=list)
    mapping: list = field(default_factory=list)
    sql: str | None = None
    capitalize: list = field(default_factory=list)
    regex: list = field(default_factory=list)
    scan_format: str = "parquet"
    rolling_days: int = 1
    rolling_mode: str = "date"
    as_of: dt.date | None = None
    buckets: int | None = None        # None: the table's own; of a new one, by the bytes of its first load
    latest_by: list = field(default_factory=list)  # with keep_latest: told apart by these among equal dates
    checkpoint: str | None = None     # bookmark of scan="incremental" (default: below the destination)
    late_files: str = "error"         # incremental with upsert="replace": "error" | "replace" (what arrives last stays, though older)
    slice_elements: int | None = None  # flatten="all": longer arrays are cut and dealt over tasks first
    split_bytes: int | None = None    # S4: files are packed into read splits of this size
    tie_break: list = field(default_factory=list)
    coalesce: list = field(default_factory=list)  # type-choice fields collapsed after flattening
    target_ddl: str | None = None     # K3/K4: conform to this schema before publishing
    on_extra: str = "error"           # "error" | "drop" | "evolve"
    key_check: str = "report"         # K8 on the merged buckets: "off" | "report" | "strict" (fail before publishing)
    require_rows: bool = False        # A1 on the incoming rows: fail an empty load


# The four distinct recipes behind the eight entity flows.
RECIPES = {
    "full_struct_replace": dict(scan="full", flatten="struct", upsert="replace"),
    "rolling_struct_replace": dict(scan="rolling", flatten="struct", upsert="replace"),
    "full_all_replace": dict(scan="full", flatten="all", upsert="replace"),
    "full_struct_guarded": dict(scan="full", flatten="struct", upsert="guarded"),
}

# The entity presets and the flow names used by existing
# configuration documents, so those documents dispatch unchanged.  Each
# entity maps to one of the four recipes; rolling reads look back one day.
PRESETS = {
    "contacts": "full_struct_replace",
    "companies": "rolling_struct_replace",
    "deal_pipelines": "full_all_replace",
    "deals": "full_struct_replace",
    "owners": "full_all_replace",
    "archived_companies": "full_struct_guarded",
    "archived_contacts": "full_struct_guarded",
    "archived_deals": "full_struct_guarded",
}
FLOW_NAMES = {"flow": "contacts", "flow2": "companies", "flow3": "deal_pipelines", "flow4": "deals",
              "flow5": "owners", "flow6": "archived_companies", "flow7": "archived_contacts",
              "flow8": "archived_deals"}


def _named_file(folder: str | None, name: str, endings: tuple[str, ...]) -> str | None:
    for ending in endings if folder else ():
        path = os.path.join(folder, name + ending)
        if os.path.isfile(path):
            return path
    return None


def config_from_entry(entry: Mapping, folder: str | None = None, warehouse: str | None = None) -> PipelineConfig:
    """Build a config from one ``conf`` entry of the document
    (``origin_table, destination_table, deduplicate, capitalize,
    capitalizeword, flow`` …).  The recipe is looked up by flow/preset name.

    An entry without ``schema`` or ``sql`` has them in ``folder``, by its
    destination's name (``<name>.schema.json``, ``<name>.json``; ``<name>.sql``,
    ``<name>.yaml``); with a folder, a missing file is an error.
    ``warehouse`` is the folder of destinations given by name."""
    if not any(entry.get(k) for k in ("preset", "flow", "scan", "flatten", "upsert")):
        raise ValueError(f"entry {entry.get('destination_table')!r} names no flow or preset")
    name = str(entry["destination_table"]).rstrip("/").rsplit("/", 1)[-1]
    entry = dict(entry)
    for k, endings in (("schema", (".schema.json", ".json")), ("sql", (".sql", ".yaml", ".yml"))):
        if not entry.get(k) and folder:
            entry[k] = _named_file(folder, name, endings)
            if not entry[k]:
                raise FileNotFoundError(f"no {k} of {name!r} in {folder}: {[name + e for e in endings]}")
    if warehouse and "/" not in entry["destination_table"]:
        entry["destination_table"] = f"{warehouse.rstrip('/')}/{name}"
    preset = entry.get("preset") or FLOW_NAMES.get(entry.get("flow", ""), entry.get("flow"))
    recipe_name = PRESETS.get(preset, preset) if preset else None
    if recipe_name is not None and recipe_name not in RECIPES:
        raise ValueError(f"unknown preset/flow {preset!r} for {entry.get('destination_table')!r}; "
                         f"presets: {sorted(PRESETS)}, flows: {sorted(FLOW_NAMES)}, recipes: {sorted(RECIPES)}")
    recipe = RECIPES[recipe_name] if recipe_name else {}
    kw = dict(recipe)
    origin = entry["origin_table"]
    database = entry.get("database") or entry.get("glue_database")
    if database:
        # A catalog table: ``database.origin_table`` read with spark.table.
        origin = f"{database}.{origin}"
        kw["scan_format"] = "table"
    kw.update(
        origin=origin, destination=entry["destination_table"],
        dedup=list(entry.get("deduplicate", [])), capitalize=list(entry.get("capitalize", [])),
        regex=list(entry.get("capitalizeword", [])),
        mapping=parse_mapping(_maybe_file(entry["schema"], json.loads)) if entry.get("schema") else [],
        sql=_sql_text(entry.get("sql")))
    for k in ("scan", "flatten", "upsert", "latest_by", "checkpoint", "key", "guarded_by", "keep_latest", "scan_format", "rolling_days", "rolling_mode", "buckets",
              "tie_break", "target_ddl", "on_extra", "coalesce", "key_check", "require_rows", "late_files", "slice_elements", "split_bytes"):
        if k in entry:
            kw[k] = entry[k]
    if entry.get("as_of"):
        kw["as_of"] = dt.date.fromisoformat(str(entry["as_of"]))
    return PipelineConfig(**kw)


def _maybe_file(value, parse):
    """Config values may be given inline or as a path to a file."""
    if isinstance(value, str) and os.path.isfile(value):
        with open(value, encoding="utf-8") as fh:
            return parse(fh.read())
    return value


def _sql_text(value):
    """Inline SQL, a ``.sql`` file, or a YAML file with an ``sql`` key."""
    if isinstance(value, str) and os.path.isfile(value):
        if value.endswith((".yaml", ".yml")):
            return descriptor_sql(value)
        with open(value, encoding="utf-8") as fh:
            return fh.read()
    return value


def load_document(source: str | Mapping) -> Mapping:
    """A ``{"conf": [...]}`` document as a dict, JSON text, or a JSON/YAML file."""
    if isinstance(source, Mapping):
        return source
    if os.path.isfile(source):
        with open(source, encoding="utf-8") as fh:
            text = fh.read()
        if source.endswith((".yaml", ".yml")):
            import yaml

            return yaml.safe_load(text)
        return json.loads(text)
    return json.loads(source)


def scan(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    if cfg.scan == "rolling":
        return read_rolling(spark, cfg.origin, cfg.rolling_days, cfg.as_of or dt.date.today(),
                            cfg.rolling_mode, cfg.scan_format)
    return read_table(spark, cfg.origin, cfg.scan_format)


def transform(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Everything between scan and publish, as one lazy plan."""
    if cfg.flatten == "struct":
        df = flatten_struct(df)
    elif cfg.flatten == "all":
        df = flatten_all(df, slice_elements=cfg.slice_elements)
    for choice in cfg.coalesce:
        df = coalesce_choice(df, choice)
    df = deduplicate(df, cfg.dedup, cfg.tie_break)
    if cfg.mapping:
        df = apply_mapping(df, cfg.mapping)
    if cfg.sql:
        df = sql_projection(df, cfg.sql)
    df = capitalize(df, cfg.capitalize)
    df = regex_rules(df, cfg.regex)
    return df


@contextmanager
def _split_settings(spark: SparkSession, split_bytes: int | None):
    """S4 for the plans that run inside: Spark's split packing is a session setting."""
    wanted = read_split_settings(split_bytes, open_cost_bytes=min(split_bytes, 8 << 20)) if split_bytes else {}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def run_pipeline(spark: SparkSession, cfg: PipelineConfig, source: DataFrame | None = None) -> DataFrame:
    """Run one pipeline end to end and return the published table.  With
    ``scan="incremental"``, only files that the bookmark has not seen are read,
    each batch published on its own, exactly once."""
    with _split_settings(spark, cfg.split_bytes):
        if cfg.scan == "incremental" and source is None:
            return _run_incremental(spark, cfg)
        df = transform(source if source is not None else scan(spark, cfg), cfg)
        publish(spark, cfg, df)
        return read_bucketed(spark, cfg.destination)


def _run_incremental(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    if cfg.upsert == "replace" and cfg.late_files != "replace":
        raise ValueError(f"{cfg.destination}: with scan='incremental', upsert='replace' lets an older file that arrives late replace "
                         "newer rows; use upsert='guarded' with keep_latest, or late_files='replace' where arrival order is meant")
    bookmark = cfg.checkpoint or f"{cfg.destination.rstrip('/')}/_bookmark"
    handle = lambda df, batch: publish(spark, cfg, transform(df, cfg), batch)
    shape = read_table(spark, cfg.origin, cfg.scan_format).schema
    if cfg.scan_format == "table":
        process_new_table_files(spark, cfg.origin, bookmark, lambda stream: committed_batch(spark, cfg.destination, stream), handle)
    else:
        process_new_files(spark, cfg.origin, shape, bookmark, handle, cfg.scan_format)
    empty = transform(spark.createDataFrame([], shape), cfg)
    return read_bucketed(spark, cfg.destination, schema=empty.schema)


def publish(spark: SparkSession, cfg: PipelineConfig, df: DataFrame, batch: tuple[str, int] | None = None) -> dict:
    """Conform the transformed rows and upsert them; the checks run on the
    written rows, before anything is published."""
    not_null = []
    if cfg.target_ddl:
        shape = target_schema(cfg.target_ddl)
        not_null = [f.name for f in shape.fields if not f.nullable]
        df = conform(df, shape, on_extra=cfg.on_extra)
    return publish_upsert(spark, df, cfg.destination, key=cfg.key, buckets=cfg.buckets,
                          guarded_by=cfg.guarded_by if cfg.upsert == "guarded" else None, keep_latest=cfg.keep_latest,
                          tie_break=cfg.latest_by, on_extra="evolve" if cfg.on_extra == "evolve" else "error",
                          not_null=not_null, require_rows=cfg.require_rows, key_check=cfg.key_check, batch=batch)


def target_schema(ddl: str) -> StructType:
    """A target table's column list (``id bigint NOT NULL, label varchar(35),
    …``) through Spark's own DDL parser; ``varchar(n)`` keeps its width for
    conformance."""
    return _parse_datatype_string(ddl)


def run_batch(spark: SparkSession, document: str | Mapping, folder: str | None = None,
              warehouse: str | None = None) -> dict[str, DataFrame]:
    """PL1: run every entry of ``{"conf": [...]}`` in order.  Each entry is
    its own plan; dispatch is by preset name."""
    doc = load_document(document)
    out = {}
    for entry in doc["conf"]:
        cfg = config_from_entry(entry, folder, warehouse)
        out[entry["destination_table"]] = run_pipeline(spark, cfg)
    return out


def load_curated(spark: SparkSession, pattern: str | Iterable[str], destination: str,
                 sort_key: str | None = None, on_drift: str = "error") -> DataFrame:
    """PL2: Parquet glob (S8) → row-count gate (A1) → full refresh (K6).
    ``on_drift="choice"`` joins the types of files that disagree (``sources/drift.py``)."""
    read = read_drifting if on_drift == "choice" else read_parquet_glob
    df = read(spark, pattern if isinstance(pattern, str) else list(pattern))
    # The gate comes first: an empty load must not replace a good table.
    check_row_count(df)
    full_refresh(df, destination, sort_key=sort_key)
    return spark.read.parquet(destination)


def query_descriptor(spark: SparkSession, source: str, descriptor: str | Mapping, frame: str, fmt: str = "json") -> DataFrame:
    """PL3: descriptor → schema → query.  The files of ``source`` read with the
    descriptor's declared schema (S6), under the name ``frame`` in its stored SELECT (P5)."""
    described = load_descriptor(descriptor)
    sql = descriptor_sql(described)
    if not sql:
        raise ValueError("the descriptor has no query under 'sql'")
    return named_projection({frame: read_with_descriptor(spark, source, described, fmt)}, sql)
