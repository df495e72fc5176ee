"""Scans: full, partition-pruned and rolling-window reads.

All scans return a lazy DataFrame; Catalyst pushes the projections and
filters of whatever is planned on top down to the Parquet reader
(``ReadSchema`` / ``PushedFilters``) and turns predicates on partition
columns into ``PartitionFilters`` so files in pruned directories are never
read.  (A bare-path read still lists every file first; for very large
partitioned sources read a catalog table, whose metastore prunes
partitions before listing.)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from ..functions.times import cutoff_parts

PARTITION_KEYS = ("partition_0", "partition_1", "partition_2")  # year, month, day


def read_table(spark: SparkSession, source: str, fmt: str = "parquet", options: dict | None = None,
               schema=None) -> DataFrame:
    """Full scan of a catalog table (``db.table``) or a path."""
    if fmt == "table":
        return spark.table(source)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(source)


def read_partitioned(spark: SparkSession, source: str, predicate: str | Column,
                     fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """Scan with a partition predicate (SQL text or a Column).  On
    partition columns it becomes ``PartitionFilters``; pruned directories
    are never read."""
    df = read_table(spark, source, fmt, options)
    return df.filter(F.expr(predicate) if isinstance(predicate, str) else predicate)


def rolling_predicate(days: int, as_of: dt.date, mode: str = "date",
                      keys: tuple[str, str, str] = PARTITION_KEYS, schema=None) -> Column:
    """S3/F2: rows whose (year, month, day) partition is on or after
    ``as_of - days``.

    ``mode="componentwise"`` reproduces the original predicate
    ``p0 >= Y AND p1 >= M AND p2 >= D`` which compares each part on its own
    and so drops e.g. 2022-03-01 for a cutoff of 2022-02-28.
    ``mode="date"`` is the window as prefixes of a date: later years, or later
    months of the cutoff's year, or its month from the cutoff's day on.  Each is a
    plain comparison of partition columns in their own type (``schema``), so a metastore
    prunes by all of them before any listing.  Both forms prune partitions.
    """
    y, m, d = cutoff_parts(as_of, days)
    if mode == "componentwise":
        p0, p1, p2 = (F.col(k) for k in keys)
        return (p0 >= F.lit(int(y))) & (p1 >= F.lit(int(m))) & (p2 >= F.lit(int(d)))
    if mode == "date":
        later, same = zip(*[_from(k, int(v), last, schema) for k, v, last in zip(keys, (y, m, d), (9999, 12, 31))])
        return later[0] | (same[0] & later[1]) | (same[0] & same[1] & (later[2] | same[2]))
    raise ValueError(f"unknown rolling mode {mode!r}")


def _from(key: str, value: int, last: int, schema) -> tuple[Column, Column]:
    """(greater than, equal to) ``value`` of one part of a date.  Text is compared
    with the texts of the numbers, with and without a leading zero."""
    part, kind = F.col(key), schema[key].dataType if schema is not None else None
    if not isinstance(kind, StringType):
        part = part if isinstance(kind, IntegralType) else part.cast("int")
        return part > F.lit(value), part == F.lit(value)
    texts = lambda n: sorted({str(n), f"{n:02d}"})
    if last == 9999:
        return part > F.lit(str(value)), part == F.lit(str(value))
    later = [t for n in range(value + 1, last + 1) for t in texts(n)]
    return part.isin(later) if later else F.lit(False), part.isin(texts(value))


# Fixed value: the text form of the original rolling predicate, with
# zero-padded year, month and day literals.
ROLLING_PREDICATE_FORMAT = "partition_0 >= {y} AND partition_1 >= {m} AND partition_2 >= {d}"


def rolling_predicate_sql(days: int, as_of: dt.date) -> str:
    """The componentwise predicate as SQL text (what a catalog read takes)."""
    y, m, d = cutoff_parts(as_of, days)
    return ROLLING_PREDICATE_FORMAT.format(y=y, m=m, d=d)


def read_rolling(spark: SparkSession, source: str, days: int, as_of: dt.date, mode: str = "date",
                 fmt: str = "parquet") -> DataFrame:
    """S2 + S3 together: the last ``days`` days of a y/m/d-partitioned table."""
    df = read_table(spark, source, fmt)
    return df.filter(rolling_predicate(days, as_of, mode, schema=df.schema))


def add_date_partitions(df: DataFrame, ts: str) -> DataFrame:
    """Derive zero-padded ``partition_0/1/2`` (year, month, day) text from a
    timestamp, the directory layout the rolling read expects."""
    c = F.col(ts)
    return df.withColumns({"partition_0": F.date_format(c, "yyyy"),
                           "partition_1": F.date_format(c, "MM"),
                           "partition_2": F.date_format(c, "dd")})


def read_parquet_glob(spark: SparkSession, pattern: str | list[str], merge_schema: bool = True) -> DataFrame:
    """Many Parquet files (a glob) as one frame; ``mergeSchema`` unifies
    files whose column sets differ (missing columns read as null)."""
    paths = [pattern] if isinstance(pattern, str) else list(pattern)
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(*paths)


# The original packs small files into 10 MB read groups.  Spark packs
# files into read splits by itself; the knobs are session settings.  At
# 100 TB, 10 MB splits would mean ~10 million tasks, so the default target
# stays large and is only lowered for tiny inputs.
def read_split_settings(target_bytes: int = 256 * 1024 * 1024, open_cost_bytes: int = 8 * 1024 * 1024) -> dict:
    return {"spark.sql.files.maxPartitionBytes": str(target_bytes),
            "spark.sql.files.openCostInBytes": str(open_cost_bytes)}
