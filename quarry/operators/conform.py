"""Target conformance (K3, O2): incoming rows must fit the target's shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import CharType, StringType, StructField, StructType, VarcharType

from ..functions.columns import col


class SchemaMismatch(ValueError):
    pass


def empty_like(spark: SparkSession, schema: StructType) -> DataFrame:
    """O2: ``create table stage as select * from target LIMIT 0``.  Declared
    widths (``varchar(n)``) are kept as strings; ``conform`` enforces them."""
    fields = [StructField(f.name, StringType() if isinstance(f.dataType, (VarcharType, CharType)) else f.dataType,
                          f.nullable, f.metadata) for f in schema.fields]
    return spark.createDataFrame([], StructType(fields))


def conform(df: DataFrame, target: StructType, on_extra: str = "error", on_missing: str = "error",
            strict_cast: bool = False, widths: dict[str, int] | None = None) -> DataFrame:
    """K3: match columns by name, cast to the target types, put them in
    target order.

    ``on_extra``: ``"error"`` (default) lists the surplus columns,
    ``"drop"`` discards them, ``"evolve"`` keeps them after the target
    columns.  ``on_missing``: ``"error"`` or ``"null"``.  ``widths`` cuts
    strings to declared widths (K4) instead of failing.
    """
    have = {c.lower(): c for c in df.columns}
    want = [f.name.lower() for f in target.fields]
    extra = [c for c in df.columns if c.lower() not in want]
    missing = [f.name for f in target.fields if f.name.lower() not in have]
    if extra and on_extra == "error":
        raise SchemaMismatch(f"columns not in target: {extra}; target columns: {[f.name for f in target.fields]}")
    if missing and on_missing == "error":
        raise SchemaMismatch(f"target columns missing from input: {missing}")
    cols = []
    for f in target.fields:
        dtype = f.dataType
        if isinstance(dtype, (VarcharType, CharType)):
            width = dtype.length
            dtype = StringType()
        else:
            width = None
        width = (widths or {}).get(f.name, width)
        if f.name.lower() in have:
            src = col(have[f.name.lower()])
            c = src.cast(dtype) if strict_cast else src.try_cast(dtype)
        else:
            c = F.lit(None).cast(dtype)
        if width is not None:
            c = F.substring(c, 1, int(width))
        cols.append(c.alias(f.name))
    if extra and on_extra == "evolve":
        cols.extend(col(c) for c in extra)
    return df.select(*cols)


def schema_diff(df: DataFrame, target: StructType) -> dict:
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in target.fields}
    return {"extra": sorted(set(have) - set(want)), "missing": sorted(set(want) - set(have)),
            "retyped": sorted(k for k in set(have) & set(want) if have[k] != want[k])}
