"""Small file-system steps of the sinks, on whatever file system Spark writes to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    """(file system, path) of the JVM for a path of any scheme."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _names(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _fs(spark, pattern)
    return sorted(st.getPath().getName() for st in (fs.globStatus(p) or []))


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _bytes(spark: SparkSession, path: str) -> int:
    """Size of everything below a folder: one call."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def _beside(path: str, mark: str) -> str:
    """A folder next to ``path`` that Spark's readers skip."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}.{mark}"


def fresh_beside(path: str) -> str:
    """Where the next contents of ``path`` are written."""
    return _beside(path, f"new-{uuid.uuid4().hex}")


def restore_folder(spark: SparkSession, path: str) -> None:
    """Finishes a swap that was cut off: without a folder in place, the old one
    comes back; else what is left of the old one goes."""
    (fs, at), (_, old) = _fs(spark, path.rstrip("/")), _fs(spark, _beside(path, "old"))
    if not fs.exists(old):
        return
    if fs.exists(at):
        fs.delete(old, True)
    elif not fs.rename(old, at):
        raise OSError(f"{old} could not be put back as {path}")


def replace_folder(spark: SparkSession, fresh: str, path: str) -> None:
    """Puts the complete folder ``fresh`` in place of ``path`` by two renames.  When the
    second fails the old folder is put back; if the driver dies between them,
    the next refresh (or ``restore_folder``) does so."""
    restore_folder(spark, path)
    (fs, at), (_, new), (_, old) = _fs(spark, path.rstrip("/")), _fs(spark, fresh), _fs(spark, _beside(path, "old"))
    if fs.exists(at) and not fs.rename(at, old):
        raise OSError(f"{path} could not be set aside")
    fs.mkdirs(at.getParent())
    try:
        if not fs.rename(new, at):
            raise OSError(f"{fresh} could not be renamed")
    except Exception as error:
        restore_folder(spark, path)
        raise OSError(f"{fresh} could not be put in place of {path}") from error
    if fs.exists(old):
        fs.delete(old, True)
