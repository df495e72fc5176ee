"""Zone ingest (S7): refresh datasets from a landing zone into the next zone.

Each entity is read as JSON and rewritten as Parquet, one plan per entity.  A
declared schema skips the inference pass over the whole input; without one,
Spark infers it in a pass over all of it.

A record that does not parse, or a field of which does not fit the schema, is
rejected: the zone table has none of them.  Rejects are kept, as text and with
their file, in a quarantine table beside the zone (``rejects/<entity>/``), which
holds those of the last load.  Beyond ``max_reject_share`` of the records the load
fails, and the zone table stays as it was.  The good rows are parsed and written in
one pass, which also counts what it leaves out; only a load with rejects reads
its input a second time, for them alone.

A refresh replaces an entity's folder as a whole, and all or nothing: objects of the
processing zone that the landing zone no longer has go too, so both zones hold
the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import col
from ..operators.quality import QualityError
from ..sinks.files import _remove, fresh_beside, replace_folder, restore_folder

CORRUPT = "__corrupt_record"
MAX_REJECT_SHARE = 0.01
#: Formats whose readers can keep the text of a record that does not fit.
TEXT_FORMATS = ("json", "csv")


class TooManyRejects(QualityError):
    pass


@dataclass
class ZoneLoad:
    table: DataFrame        # the refreshed zone table
    rows: int
    rejected: int
    rejects: str            # the quarantine folder; there only if ``rejected``


def _declared(spark: SparkSession, src: str, schema: StructType | None, fmt: str) -> StructType:
    if schema is not None:
        return schema
    inferred = spark.read.format(fmt).option("columnNameOfCorruptRecord", CORRUPT).load(src).schema
    return StructType([f for f in inferred.fields if f.name != CORRUPT])


def load_entity(spark: SparkSession, src: str, dst: str, schema: StructType | None = None, fmt_in: str = "json",
                fmt_out: str = "parquet", rejects: str | None = None, max_reject_share: float = MAX_REJECT_SHARE) -> ZoneLoad:
    """Refreshes ``dst`` from ``src`` and says what went where."""
    rejects = rejects or f"{dst.rstrip('/')}.rejects"
    shape = _declared(spark, src, schema, fmt_in)
    reader, count = spark.read.format(fmt_in), Observation()
    if fmt_in in TEXT_FORMATS:
        wide = StructType([*shape.fields, StructField(CORRUPT, StringType())])
        parsed = reader.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).load(src)
        watched = parsed.observe(count, F.count(F.col(CORRUPT)).alias("rejected"))
        good = watched.where(F.col(CORRUPT).isNull()).select(*[col(f.name) for f in shape.fields])
    else:
        parsed, good = None, reader.schema(shape).load(src)
    restore_folder(spark, dst)
    fresh = fresh_beside(dst)
    try:
        good.write.format(fmt_out).option("compression", "zstd").save(fresh)
        rows, rejected = spark.read.format(fmt_out).schema(shape).load(fresh).count(), 0
        if parsed is not None and count.get["rejected"]:
            # What did parse is kept too; asking for it makes the reader parse every field.
            bad = parsed.where(F.col(CORRUPT).isNotNull()).select(
                F.col(CORRUPT).alias("record"), F.col("_metadata.file_path").alias("file"), F.struct(*[col(f.name) for f in shape.fields]).alias("parsed"))
            _refresh(spark, bad, rejects)
            rejected = spark.read.parquet(rejects).count()
        else:
            _remove(spark, rejects)     # those of an earlier load
        if rejected > max_reject_share * (rows + rejected):
            raise TooManyRejects(f"{src}: {rejected} of {rows + rejected} records do not fit, see {rejects}")
        replace_folder(spark, fresh, dst)
    finally:
        _remove(spark, fresh)
    return ZoneLoad(spark.read.format(fmt_out).load(dst), rows, rejected, rejects)


def _refresh(spark: SparkSession, df: DataFrame, path: str) -> None:
    fresh = fresh_beside(path)
    try:
        df.write.parquet(fresh)
        replace_folder(spark, fresh, path)
    finally:
        _remove(spark, fresh)


def ingest_entity(spark: SparkSession, src: str, dst: str, schema: StructType | None = None,
                  fmt_in: str = "json", fmt_out: str = "parquet", **options) -> DataFrame:
    return load_entity(spark, src, dst, schema, fmt_in, fmt_out, **options).table


def load_zone(spark: SparkSession, sources: Mapping[str, str], processing_root: str,
              schemas: Mapping[str, StructType] | None = None, max_reject_share: float = MAX_REJECT_SHARE) -> dict[str, ZoneLoad]:
    """``allow_overwrite`` semantics: the processing copy of every entity is
    replaced by the landing copy, less the records that do not fit."""
    root = processing_root.rstrip("/")
    return {name: load_entity(spark, src, f"{root}/files/{name}/", (schemas or {}).get(name), rejects=f"{root}/rejects/{name}",
                              max_reject_share=max_reject_share) for name, src in sources.items()}


def ingest_zone(spark: SparkSession, sources: Mapping[str, str], processing_root: str,
                schemas: Mapping[str, StructType] | None = None, **options) -> dict[str, DataFrame]:
    """The refreshed tables of :func:`load_zone`."""
    return {name: load.table for name, load in load_zone(spark, sources, processing_root, schemas, **options).items()}
