"""Declarative schema mapping: ``[(Name, Type, NameTo, TypeTo), ...]``.

Only mapped columns are kept, renamed and cast, in mapping order.  Spark 4
runs with ANSI casts, so a bad value would raise; the mapping uses
``try_cast`` (bad value → null) unless ``strict=True``.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col

Mapping4 = tuple[str, str, str, str]

# Type names as they appear in mapping documents; the rest go to Spark's
# own DDL type parser unchanged.
_TYPE_ALIASES = {"long": "bigint", "integer": "int", "short": "smallint", "byte": "tinyint",
                 "bool": "boolean", "text": "string", "varchar": "string"}


def spark_type(name: str) -> str:
    n = name.strip()
    return _TYPE_ALIASES.get(n.lower(), n)


def parse_mapping(doc: str | dict | Sequence) -> list[Mapping4]:
    """Accept the ``{"schema": [{Name, Type, NameTo, TypeTo}, ...]}`` document
    (as text or parsed) or a list of 4-tuples."""
    if isinstance(doc, str):
        doc = json.loads(doc)
    if isinstance(doc, dict):
        doc = doc["schema"]
    out = []
    for item in doc:
        if isinstance(item, dict):
            out.append((item["Name"], item["Type"], item["NameTo"], item["TypeTo"]))
        else:
            name, typ, name_to, type_to = item
            out.append((name, typ, name_to, type_to))
    return out


def apply_mapping(df: DataFrame, mapping: Iterable[Mapping4] | dict | str, strict: bool = False,
                  missing: str = "error") -> DataFrame:
    """P3 + X5.  ``missing="null"`` turns an absent source column into a
    typed null column instead of an analysis error."""
    cols = []
    present = set(df.columns)
    for name, _src_type, name_to, type_to in parse_mapping(mapping):
        target = spark_type(type_to)
        if name not in present:
            if missing == "null":
                cols.append(F.lit(None).cast(target).alias(name_to))
                continue
            raise ValueError(f"mapping source column {name!r} is not in the frame; columns: {df.columns}")
        src = col(name)
        cols.append((src.cast(target) if strict else src.try_cast(target)).alias(name_to))
    return df.select(*cols)
