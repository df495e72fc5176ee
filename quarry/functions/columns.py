"""Column references by exact name (dots, spaces and backticks in names are
taken literally, never as struct paths)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str | Column) -> Column:
    return name if isinstance(name, Column) else F.col(quote(name))


def _hashable(dtype) -> bool:
    if isinstance(dtype, StructType):
        return all(_hashable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, ArrayType):
        return _hashable(dtype.elementType)
    return not isinstance(dtype, (MapType, VariantType))


def row_hash(df: DataFrame) -> Column:
    """A hash of a row's values, to deal rows out by; columns with maps, which Spark
    does not hash, take no part."""
    return F.xxhash64(F.lit(0), *[col(f.name) for f in df.schema.fields if _hashable(f.dataType)])
