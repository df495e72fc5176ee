"""Load-time quality checks (A1 row-count gate, K8 key constraint)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(AssertionError):
    pass


def row_count_gate(df: DataFrame, message: str = "row-count gate: table is empty") -> DataFrame:
    """A1 as a lazy one-row frame ``n``; evaluating it fails when the table is
    empty (``COUNT(*)`` is never null, so the meaningful gate is ``n > 0``).
    The count is a partial aggregate: one long per task crosses the shuffle."""
    n = F.count(F.lit(1))
    # The assertion is folded into the value (it yields null, then ``n``) so
    # column pruning cannot drop it.
    return (df.agg(n.alias("n"))
              .select(F.coalesce(F.assert_true(F.col("n") > 0, F.lit(message)), F.col("n")).alias("n")))


def check_row_count(df: DataFrame) -> int:
    n = df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if n <= 0:
        raise QualityError("row-count gate: table is empty")
    return n


def key_constraint_report(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """K8: key values that break ``NOT NULL`` / ``PRIMARY KEY``: every key
    with more than one row (``n``), null keys included as one group.
    Partial aggregation runs before the shuffle, so a hot key costs one
    row per map task."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*[F.col(k) for k in keys])
              .agg(F.count(F.lit(1)).alias("n"))
              .where((F.col("n") > 1) | F.greatest(*[F.col(k).isNull() for k in keys])
                     if len(keys) > 1 else (F.col("n") > 1) | F.col(keys[0]).isNull()))


def enforce_key_constraint(df: DataFrame, key: str | Sequence[str], strict: bool = False) -> DataFrame:
    """Report by default; ``strict=True`` raises when any violation exists
    (bounded check: one row is enough)."""
    report = key_constraint_report(df, key)
    if strict and report.limit(1).count() > 0:
        raise QualityError(f"key constraint violated on {key}")
    return report
