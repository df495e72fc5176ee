"""Parquet files that disagree about a column's type (S8 with a detected schema).

``mergeSchema`` unifies files whose column sets differ and refuses files whose types
differ.  Here files are put into groups that Spark can merge: a set of folders
or files is merged whole (Spark reads the footers in parallel); one that is refused
is cut in two, by path, and each half is tried.  Drops differ from one time
on, so a change of type costs some dozen merges, however many files there are;
groups that agree are then read together.

The groups' types are joined: a narrower number becomes the wider one where no
value changes (``byte < short < int < long``, ``int < double``, ``float < double``, wider
decimals), structs and arrays are joined by their parts, and what else differs
becomes a struct of alternatives, a *choice*, named by type: ``struct<long, string>``.
Of a choice at most one field is filled.  ``flatten_struct`` makes it
``<col>_long``, ``<col>_string``, which ``coalesce_choice`` collapses.

Defined cases: a column that a group lacks is null there; a null value is a null
choice; a pattern without files is an error; maps must agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col

_RANK = {T.ByteType: 0, T.ShortType: 1, T.IntegerType: 2, T.LongType: 3}
# Names of a choice's fields, as flattened columns end in them.
_NAMES = {T.LongType: "long", T.IntegerType: "int", T.ShortType: "short", T.ByteType: "byte", T.TimestampNTZType: "timestamp_ntz"}


def _name(dtype: T.DataType) -> str:
    if isinstance(dtype, T.DecimalType):
        return f"decimal_{dtype.precision}_{dtype.scale}"
    return _NAMES.get(type(dtype)) or dtype.typeName()


def _wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds every value of both unchanged, where there is one."""
    if a == b:
        return a
    kinds = {type(a), type(b)}
    if kinds <= set(_RANK):
        return max(a, b, key=lambda t: _RANK[type(t)])
    if T.DoubleType in kinds and kinds & {T.FloatType, T.IntegerType, T.ShortType, T.ByteType}:
        return T.DoubleType()
    if T.FloatType in kinds and kinds & {T.ShortType, T.ByteType}:
        return T.FloatType()
    if kinds == {T.DecimalType}:
        whole, scale = max(a.precision - a.scale, b.precision - b.scale), max(a.scale, b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def _is_choice(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StructType) and bool(dtype.fields) and all(f.metadata.get("choice") for f in dtype.fields)


def join_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that both fit in."""
    if a == b:
        return a
    wide = _wider(a, b)
    if wide is not None:
        return wide
    if isinstance(a, T.StructType) and isinstance(b, T.StructType) and not _is_choice(a) and not _is_choice(b):
        return join_schemas(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(join_types(a.elementType, b.elementType), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        raise TypeError(f"maps that differ are not joined: {a.simpleString()}, {b.simpleString()}")
    options: list[T.DataType] = []
    for t in [f.dataType for x in (a, b) for f in (x.fields if _is_choice(x) else [T.StructField("", x)])]:
        for i, have in enumerate(options):
            if _wider(have, t) is not None or (type(have) is type(t) and isinstance(t, (T.StructType, T.ArrayType, T.MapType))):
                options[i] = join_types(have, t)
                break
        else:
            options.append(t)
    return T.StructType([T.StructField(_name(t), t, True, {"choice": True}) for t in sorted(options, key=_name)])


def join_schemas(a: T.StructType, b: T.StructType) -> T.StructType:
    """Fields by name, those of ``a`` first."""
    there = {f.name: f for f in b.fields}
    fields = [T.StructField(f.name, join_types(f.dataType, there[f.name].dataType) if f.name in there else f.dataType) for f in a.fields]
    names = {f.name for f in a.fields}
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in b.fields if f.name not in names])


def fitted(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of one type as the joined type."""
    if have == want:
        return value
    if _is_choice(want) and not _is_choice(have):
        own = next(f.name for f in want.fields if f.dataType == have or _wider(f.dataType, have) == f.dataType
                   or (type(f.dataType) is type(have) and isinstance(have, (T.StructType, T.ArrayType))))
        parts = [(fitted(value, have, f.dataType) if f.name == own else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(want, T.StructType):
        there = {f.name: f.dataType for f in have.fields}
        parts = [(fitted(value.getField(f.name), there[f.name], f.dataType) if f.name in there else F.lit(None).cast(f.dataType)).alias(f.name)
                 for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: fitted(x, have.elementType, want.elementType))
    return value.cast(want)


def _merged(spark: SparkSession, paths: Sequence[str]) -> T.StructType | None:
    """The schema of some folders or files that Spark can merge, else None."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as error:
        if len(paths) > 1 and "[CANNOT_MERGE_" in str(error):
            return None
        raise


def schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """The paths in groups of one schema each, groups in the order of their first path."""
    groups: list[tuple[T.StructType, list[str]]] = []
    left = [sorted(paths)] if paths else []
    while left:
        some = left.pop()
        shape = _merged(spark, some)
        if shape is None:
            left += [some[len(some) // 2:], some[:len(some) // 2]]
            continue
        types = {f.name: f.dataType for f in shape.fields}
        for i, (other, members) in enumerate(groups):
            if all(types.get(f.name, f.dataType) == f.dataType for f in other.fields):     # they can be read together
                groups[i] = (join_schemas(other, shape), members + some)
                break
        else:
            groups.append((shape, some))
    return groups


def _files(spark: SparkSession, pattern: str | Sequence[str]) -> list[str]:
    """The files of a pattern: names only, no contents are read."""
    patterns = [pattern] if isinstance(pattern, str) else list(pattern)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    return [r["path"] for r in listed.load(patterns).select("path").collect()]


def read_drifting(spark: SparkSession, pattern: str | Sequence[str]) -> DataFrame:
    """The Parquet files of a pattern as one frame, with types joined."""
    groups = schema_groups(spark, _files(spark, pattern))
    if not groups:
        raise FileNotFoundError(f"no Parquet files in {pattern}")
    shape = groups[0][0]
    for other, _ in groups[1:]:
        shape = join_schemas(shape, other)
    parts = []
    for have, members in groups:
        there = {f.name: f.dataType for f in have.fields}
        parts.append(spark.read.schema(have).parquet(*members).select(*[
            (fitted(col(f.name), there[f.name], f.dataType) if f.name in there else F.lit(None).cast(f.dataType)).alias(f.name) for f in shape.fields]))
    return reduce(DataFrame.unionAll, parts)
