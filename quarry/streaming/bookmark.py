"""Incremental reads of a catalog table (S5): a bookmark kept as data.

A catalog table is no streaming source, so what was read is kept as a table of its
own: the files (path, time, size) of each batch.  A run lists the files that the
table's scan reads now, by their metadata columns (no data columns are read),
and anti-joins them with those of the batches that the target holds.  What is left
is read in batches of at most ``FILES_PER_BATCH`` files, oldest first; a batch
selects its files by path, which prunes them before they are opened.

Exactly once: a batch's files are written down under its number, then the batch is
published, and the target's pointer takes its number by the same rename as the
data.  So a batch counts as read exactly if its rows are there; one that
was cut off is planned anew under the same number.

Defined cases: a file that was rewritten in place is new; a table without files has no
batches; a target that was removed is filled again from the start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import run_path
from ..sinks.files import _exists

FILES_PER_BATCH = 1000
FILES = "file string, modified long, bytes long"     # time in microseconds


def table_files(df: DataFrame) -> DataFrame:
    """(file, modified, bytes) of every file with rows that a scan reads."""
    of = lambda c: F.col(f"_metadata.{c}")
    return df.select(of("file_path").alias("file"), F.unix_micros(of("file_modification_time")).alias("modified"),
                     of("file_size").alias("bytes")).distinct()


def stream_name(path: str) -> str:
    """The name under which a target keeps the bookmark's last batch."""
    return "bookmark-" + hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:16]


def seen_files(spark: SparkSession, path: str, batches: int) -> DataFrame:
    """The files of the first ``batches`` batches."""
    folders = [f for i in range(1, batches + 1) if _exists(spark, f := f"{path.rstrip('/')}/batch-{i:09d}")]
    return spark.read.schema(FILES).parquet(*folders) if folders else spark.createDataFrame([], FILES)


def process_new_table_files(spark: SparkSession, table: str, path: str, committed: Callable[[str], int | None],
                            handle: Callable[[DataFrame, tuple[str, int]], None], files_per_batch: int = FILES_PER_BATCH) -> int:
    """Hands the rows of the table's new files to ``handle(rows, batch)``, batch by
    batch, and returns their number.  ``committed`` tells the last batch that the
    target holds of a stream, ``batch`` is (stream, number)."""
    spark.catalog.refreshTable(table)
    rows, stream = spark.table(table), stream_name(path)
    done = committed(stream) or 0
    listed = run_path(spark, "new-files")
    table_files(rows).join(seen_files(spark, path, done), ["file", "modified", "bytes"], "left_anti").write.parquet(listed)
    fresh, last, ran = spark.read.schema(FILES).parquet(listed), None, 0
    while True:
        rest = fresh
        if last is not None:
            rest = fresh.where((F.col("modified") > last["modified"]) | ((F.col("modified") == last["modified"]) & (F.col("file") > last["file"])))
        files = rest.orderBy("modified", "file").limit(files_per_batch).collect()       # a bounded number of paths
        if not files:
            return ran
        plan = f"{path.rstrip('/')}/batch-{done + 1:09d}"
        spark.createDataFrame(files, FILES).coalesce(1).write.mode("overwrite").parquet(plan)
        handle(rows.where(F.col("_metadata.file_path").isin([f["file"] for f in files])), (stream, done + 1))
        done, ran, last = done + 1, ran + 1, files[-1]
