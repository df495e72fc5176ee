"""Written intermediates of this subpackage, and whole texts on their way to Python.

Tables go to the shared folder of ``spark.checkpoint.dir`` (see
``quarry.session.run_path``), so every executor reads them and the loss of one
loses nothing.  They are removed as soon as nothing reads them any more.

Whole texts go to Python in small Arrow batches, and alone: the other columns of a row
wait in the JVM, and only what was computed comes back.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.textkit import forget, text_chunks
from quarry.session import run_path
from quarry.sinks.files import _remove

#: Spark's own bounds of an Arrow batch and those for whole texts.  Ten thousand rows
#: of text are tens of megabytes, held by the JVM and by Python at once for every core.
BATCHES = {"maxRecordsPerBatch": ("10000", "1000"), "maxBytesPerBatch": ("67108864b", "4194304b")}
#: A writer holds a row group in memory.
ROW_GROUP_BYTES = 16 << 20


@contextmanager
def small_batches(spark):
    """Jobs that run inside have Spark's default batch bounds replaced by those of
    ``BATCHES``; bounds that the session sets itself stay.  Results don't depend on them."""
    before = {}
    for name, (default, bound) in BATCHES.items():
        key = f"spark.sql.execution.arrow.{name}"
        if spark.conf.get(key) == default:
            before[key] = default
            spark.conf.set(key, bound)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame and read it back: cuts the lineage at a table."""
    spark, path = df.sparkSession, run_path(df.sparkSession, name)
    with small_batches(spark):
        df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def remove(*tables: DataFrame) -> None:
    """Deletes tables of :func:`written` that nothing reads any more."""
    for t in tables:
        _remove(t.sparkSession, t.written_to)


def reading(df: DataFrame, *tables: DataFrame) -> DataFrame:
    """``df``, with the tables of :func:`written` that it reads when it runs."""
    df.reads = [*getattr(df, "reads", []), *tables]
    return df


def give_back() -> None:
    """Returns the memory that this Python worker holds but does not use: workers live
    on between tasks, and a few of them share an executor."""
    forget()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # not this C library
        pass


def map_texts(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` over rows with whole texts (or sets of shingles)."""
    def each(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(each, schema)


def with_values(df: DataFrame, values: Callable[[list[bytes]], list[np.ndarray]], fields: list[T.StructField], text: str = "text") -> DataFrame:
    """``df`` with the columns ``fields`` (which replace those of the same name) of
    ``values``, computed from some whole texts (UTF-8, null as empty) at a time."""
    kind = T.StructType(fields)
    names = [f.name for f in fields]

    @F.arrow_udf(kind)
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for batch in batches:
                parts = [[pa.array(v) for v in values(texts)] for texts in text_chunks(batch)]
                if parts:
                    yield pa.StructArray.from_arrays([pa.concat_arrays(column) for column in zip(*parts)], names=names)
                else:
                    yield pa.array([], pa.struct([pa.field(f.name, pa.int64()) for f in fields]))
        finally:
            give_back()

    keep = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.withColumn("__values", each(F.col(f"`{text}`"))).select(*keep, *[F.col("__values")[n].alias(n) for n in names])


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def power_of_two(x: float, least: int = 1) -> int:
    n = least
    while n < x:
        n *= 2
    return n
