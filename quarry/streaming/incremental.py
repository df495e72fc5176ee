"""Incremental reads (S5): only files that arrived since the last run.

A file-source ``readStream`` with ``trigger(availableNow=True)`` processes
every new file and stops; its checkpoint (in the shared checkpoint folder)
remembers which files were read, so the next run sees only new ones and a
run with nothing new does nothing.  Each micro-batch goes through the same
pipeline transform and is upserted with ``foreachBatch``.

Exactly once: ``foreachBatch`` can replay a batch after a failure.  The number of
a batch is kept in the target's pointer, committed by the same rename as its
rows, so a replayed batch is not published again (not even its rows without a key,
which no upsert would replace).  The numbers are those of the checkpoint, which has an
id of its own: a new checkpoint on the same table starts a stream of its own.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.dedup import deduplicate
from ..sinks.publish import publish_upsert


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave a checkpoint when its stream first started."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]


def incremental_upsert(spark: SparkSession, source_dir: str, schema: StructType, target: str,
                       checkpoint: str, key: str, date: str, dedup: list | None = None,
                       transform: Callable[[DataFrame], DataFrame] | None = None,
                       buckets: int | None = None, fmt: str = "parquet", max_files_per_trigger: int | None = None,
                       reader_options: dict | None = None) -> int:
    """Process all files not seen before, upserting them into ``target``
    (guarded by ``date``, keep-latest).  Returns the number of micro-batches
    run.  ``reader_options`` go to the file source (e.g. ``maxFileAge`` to
    bound what each run lists in a large landing folder)."""
    batches = []
    specs = dedup or [{"partitionby": [key], "orderby": [date]}]
    # Equal dates are told apart here as they are within a batch.
    ties = [c for c in (*specs[-1]["orderby"], *specs[-1].get("tie_break", [])) if c != date]

    def handle(rows: DataFrame, batch: tuple[str, int]) -> None:
        df = deduplicate(transform(rows) if transform else rows, specs)
        done = publish_upsert(spark, df, target, key=key, buckets=buckets, guarded_by=date, keep_latest=True, tie_break=ties, batch=batch)
        if not done.get("skipped"):
            batches.append(batch)

    process_new_files(spark, source_dir, schema, checkpoint, handle, fmt, max_files_per_trigger, reader_options)
    return len(batches)


def process_new_files(spark: SparkSession, source_dir: str, schema: StructType, checkpoint: str,
                      handle: Callable[[DataFrame, tuple[str, int]], None], fmt: str = "parquet",
                      max_files_per_trigger: int | None = None, reader_options: dict | None = None) -> None:
    """Hands the rows of files that ``checkpoint`` has not seen yet to
    ``handle(rows, (stream, number))``, in micro-batches, and stops."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (reader_options or {}).items():
        reader = reader.option(k, v)
    run = lambda rows, number: handle(rows, (stream_id(spark, checkpoint), number))
    query = (reader.load(source_dir).writeStream.foreachBatch(run)
                   .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
