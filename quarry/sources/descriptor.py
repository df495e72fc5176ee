"""Declared schemas from a YAML/dict descriptor (S6) and its stored query (P5).

A descriptor maps field name → type name; a nested mapping is a nested
record; the key ``sql`` is not a field but where the descriptor's query is
kept (text or a path to a YAML document with an ``sql`` key).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from ..operators.mapping import spark_type

RESERVED_KEYS = ("sql",)


def load_descriptor(source: str | dict) -> dict:
    if isinstance(source, dict):
        return source
    import yaml  # config-only parsing on the driver

    if os.path.exists(source):
        with open(source, encoding="utf-8") as fh:
            return yaml.safe_load(fh) or {}
    return yaml.safe_load(source) or {}


def descriptor_schema(descriptor: str | dict) -> StructType:
    """field→type mapping → ``StructType`` (nested mapping → struct)."""
    desc = load_descriptor(descriptor)
    fields = []
    for name, typ in desc.items():
        if name in RESERVED_KEYS:
            continue
        if isinstance(typ, dict):
            fields.append(StructField(name, descriptor_schema(typ), True))
        else:
            fields.append(StructField(name, _parse_datatype_string(spark_type(str(typ))), True))
    return StructType(fields)


def descriptor_sql(descriptor: str | dict) -> str | None:
    """The query a descriptor points at: inline text, or a YAML file whose
    ``sql`` key holds it."""
    desc = load_descriptor(descriptor)
    ref = desc.get("sql")
    if ref is None:
        return None
    if isinstance(ref, str) and os.path.exists(ref):
        inner = load_descriptor(ref)
        return inner.get("sql") if isinstance(inner, dict) else str(inner)
    return str(ref)


def read_with_descriptor(spark: SparkSession, path: str, descriptor: str | dict, fmt: str = "json") -> DataFrame:
    """Read files with the declared schema (no inference pass)."""
    return spark.read.schema(descriptor_schema(descriptor)).format(fmt).load(path)


def parse_with_descriptor(df: DataFrame, column: str, descriptor: str | dict, alias: str | None = None) -> Column:
    """Parse a JSON text column with the declared schema."""
    return F.from_json(F.col(column), descriptor_schema(descriptor)).alias(alias or column)
