"""Latest-row deduplication (keep the top row of each group).

For every spec, in sequence: rank rows inside ``partitionby`` by all
``orderby`` keys descending (nulls last, Spark's default for ``desc``) and
keep rank 1.  Later specs see the rows the earlier ones kept.

Plan shape: ``row_number() = 1`` is rewritten by Catalyst into a
``WindowGroupLimit`` that runs *before* the shuffle (Partial) and after it
(Final).  A hot key therefore ships at most one row per map task into the
exchange, so a key holding a third of the table does not land in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col as _c

# Reserved name for the rank column: never clobbers a user column (a column
# literally called ``row`` survives).
_RANK = "__quarry_rank"


def keep_latest(df: DataFrame, partition_by: Sequence[str | Column], order_by: Sequence[str | Column],
                tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """W1/O1/F1 for one spec.  ``order_by`` keys are all descending;
    ``tie_break`` keys (also descending) make the pick deterministic."""
    if not order_by:
        raise ValueError("deduplicate: orderby must name at least one column")
    order = [_c(c).desc_nulls_last() for c in list(order_by) + list(tie_break)]
    w = Window.partitionBy(*[_c(c) for c in partition_by]).orderBy(*order)
    rank_col = _RANK
    while rank_col in df.columns:
        rank_col = "_" + rank_col
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) == 1)
              .drop(rank_col))


def deduplicate(df: DataFrame, specs: Iterable[Mapping] | None,
                tie_break: Sequence[str] = ()) -> DataFrame:
    """Apply ``[{partitionby: [...], orderby: [...]}, ...]`` in sequence.
    An empty list is a no-op."""
    for spec in specs or []:
        extra = list(spec.get("tie_break", [])) or list(tie_break)
        df = keep_latest(df, spec["partitionby"], spec["orderby"], extra)
    return df
