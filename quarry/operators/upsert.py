"""Key-based upserts as DataFrame plans.

Semantics are "replace the key group", not MERGE:

* ``upsert_replace`` (K1): every target row whose key appears in the stage is
  removed (``DELETE … USING stage WHERE stage.id = target.id``), then *all*
  stage rows are appended.  Duplicate keys inside the stage are all kept;
  null keys never match, so old null-key rows survive and new ones are
  appended.
* ``upsert_guarded`` (K2): a target row is removed only if some stage row
  with the same key is at least as new (``stage.dt >= target.dt``); a null
  date never removes.  The insert is unconditional, so a stale stage row is
  inserted next to the newer target row.  ``keep_latest=True`` drops stage
  rows for which the target holds a strictly newer date (a null date counts
  as the oldest on both sides), which makes the result independent of
  arrival order.

Scale: the stage is reduced to one row per key *before* it meets the target
(``distinct`` keys for K1, the newest date per key for K2), with partial
aggregation on the map side.  The reduced stage is broadcast only behind a
bound on its bytes (known from a written stage, else counted by an aggregate).
Beyond it, target rows are dealt over some parts of their key by a row hash
(``salts``: they grow with the shuffle width) and the reduced stage is repeated
per part, so a hot target key never meets in one task.  Rows with a null key
match nothing; they are dealt out by their hash alone.  Every form reads the target once.
Where the result is laid out by the key's bucket anyway (``sinks/publish.py``), a large
stage meets the target in that shuffle (``replace_laid_out``).

``keep_latest`` needs both sides' newest date per key.  Target rows and the
reduced stage meet in one shuffle, as one tagged union: a window over (key, part)
shows each target row its key's newest stage date, and each row of the reduced
stage the part's newest target date, whose maximum over the parts then judges the
stage rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col as _c
from ..functions.columns import row_hash

# Largest reduced stage that is shipped to every task, in bytes of its values
# and in rows.  A cluster can tune the rows with the session setting below.
BROADCAST_MAX_BYTES = 64 << 20
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_ROWS_CONF = "spark.quarry.broadcastMaxRows"
LEAST_SALTS = 16
_DEFAULT = object()


def salts(df: DataFrame) -> int:
    """Parts that a key is dealt over: the root of the shuffle width, so that a hot
    key's parts and the copies of the other side both stay small against it."""
    return max(LEAST_SALTS, math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def is_small(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Size check by one aggregate: a count and a sum per task are shuffled."""
    width = sum((F.coalesce(F.octet_length(_c(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(16))
    row = df.agg(F.count("*").alias("n"), F.sum(width.cast("long")).alias("bytes")).first()
    return row["n"] <= max_rows and (row["bytes"] or 0) <= max_bytes


def _resolve(df: DataFrame, max_rows) -> int | None:
    if max_rows is not _DEFAULT:
        return max_rows
    configured = df.sparkSession.conf.get(BROADCAST_MAX_ROWS_CONF, None)
    return int(configured) if configured else BROADCAST_MAX_ROWS


def _fits(reduced: DataFrame, max_rows, stage_bytes: int | None) -> bool:
    """Whether the reduced stage may be broadcast."""
    max_rows = _resolve(reduced, max_rows)
    if max_rows is None or max_rows <= 0:
        return False
    if stage_bytes is not None:
        return stage_bytes <= BROADCAST_MAX_BYTES
    return is_small(reduced, max_rows)


def _dealt(target: DataFrame, keys: list[str], parts: int) -> Column:
    """The part of its key that a target row is in."""
    known = _and([_c(k).isNotNull() for k in keys])
    return F.when(known, F.pmod(row_hash(target), F.lit(parts))).otherwise(row_hash(target))


def _parts(n: int) -> Column:
    """Every part of a key: the row that holds this is repeated for each."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _sides(target: DataFrame, reduced: DataFrame, keys: list[str], small: bool) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of a join on the key, and the columns to join on."""
    if small:
        return target, F.broadcast(reduced), keys
    n = salts(target)
    return target.withColumn("__salt", _dealt(target, keys, n)), reduced.withColumn("__salt", _parts(n)), [*keys, "__salt"]


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _by_position(stage: DataFrame, target: DataFrame) -> DataFrame:
    """``insert into target select * from stage`` is by position."""
    if len(stage.columns) != len(target.columns):
        raise ValueError(f"stage has {len(stage.columns)} columns, target {len(target.columns)}: "
                         f"{stage.columns} vs {target.columns}")
    return stage


def upsert_replace(target: DataFrame, stage: DataFrame, key: str | Sequence[str] = "id",
                   broadcast_max_rows=_DEFAULT, stage_bytes: int | None = None) -> DataFrame:
    """K1 = J1 (left anti on key) + U1 (append all stage rows).  ``stage_bytes``:
    a bound on the reduced stage where it is known already."""
    keys = _keys(key)
    stage_keys = stage.select(*[_c(k) for k in keys]).dropna().distinct()
    left, right, on = _sides(target, stage_keys, keys, _fits(stage_keys, broadcast_max_rows, stage_bytes))
    survivors = left.join(right, on=on, how="left_anti").select(*[_c(c) for c in target.columns])
    return survivors.unionAll(_by_position(stage, target))


def replace_laid_out(target: DataFrame, stage: DataFrame, key: str | Sequence[str], place: str, parts: int,
                     null_parts: int | None = None) -> DataFrame:
    """K1 for a large stage whose result is to be laid out by the column ``place``, a
    function of the key: target rows, stage rows and a mark per stage key meet in the
    layout's own shuffle, by (place, part), instead of one for the join before it.  Rows
    are dealt over ``parts`` of their place by their hash (over ``null_parts`` without a
    key) and a mark is repeated for each.  The result is partitioned so."""
    keys, old, new, mark = _keys(key), 0, 1, 2
    known = _and([_c(k).isNotNull() for k in keys])
    part = F.pmod(row_hash(target), F.when(known, F.lit(parts)).otherwise(F.lit(null_parts or parts)))
    rows = (target.withColumn("__kind", F.lit(old)).unionAll(_by_position(stage, target).withColumn("__kind", F.lit(new)))
                  .withColumn("__part", part))
    marks = (stage.where(known).select(*[_c(k) for k in dict.fromkeys([*keys, place])]).distinct()
                  .withColumn("__kind", F.lit(mark)).withColumn("__part", _parts(parts)))
    met = rows.unionByName(marks, allowMissingColumns=True).repartition(_c(place), "__part")
    # The place leads: the rows leave sorted by place and key.
    group = Window.partitionBy(*[_c(c) for c in dict.fromkeys([place, *keys])], "__part")
    return (met.withColumn("__last", F.max("__kind").over(group))
               .where((F.col("__kind") == new) | ((F.col("__kind") == old) & (F.col("__last") != mark)))
               .select(*[_c(c) for c in target.columns]))


def _order(date: str, tie_break: Sequence[str]) -> Column:
    return F.struct(*[_c(c) for c in (date, *tie_break)])


def _stage_summary(stage: DataFrame, keys: list[str], date: str, tie_break: Sequence[str]) -> DataFrame:
    """One row per non-null stage key with its newest order tuple (null when
    all of the key's dates are null).  Partial aggregation runs map-side."""
    not_null = _and([_c(k).isNotNull() for k in keys])
    newest = F.max(F.when(_c(date).isNotNull(), _order(date, tie_break)))
    return stage.where(not_null).groupBy(*[_c(k) for k in keys]).agg(newest.alias("__stage_max"))


def upsert_guarded(target: DataFrame, stage: DataFrame, key: str | Sequence[str] = "id",
                   date: str = "dt_updated", keep_latest: bool = False, broadcast_max_rows=_DEFAULT,
                   tie_break: Sequence[str] = (), stage_bytes: int | None = None) -> DataFrame:
    """K2 = J2 (left anti on key and ``stage.date >= target.date``) + U1.

    ``exists s: s.key = t.key and s.date >= t.date`` is the same as
    ``max(s.date) >= t.date`` per key, so the stage is reduced first.  With
    ``tie_break`` columns the whole tuple (date, tie_break...) is compared, which makes
    ``keep_latest`` independent of arrival order among equal dates too.
    """
    keys = _keys(key)
    incoming = _by_position(stage, target)
    if keep_latest:
        return _latest(target, incoming, keys, date, tie_break, stage_bytes)
    summary = _stage_summary(stage, keys, date, tie_break)
    left, right, on = _sides(target, summary, keys, _fits(summary, broadcast_max_rows, stage_bytes))
    t, n = left.alias("t"), right.alias("n")
    cond = [F.col(f"t.`{k}`") == F.col(f"n.`{k}`") for k in on]
    cond.append(F.col(f"t.`{date}`").isNotNull() & (F.col("n.__stage_max") >= F.struct(*[F.col(f"t.`{c}`") for c in (date, *tie_break)])))
    survivors = t.join(n, on=_and(cond), how="left_anti").select(*[F.col(f"t.`{c}`") for c in target.columns])
    return survivors.unionAll(incoming)


def _latest(target: DataFrame, stage: DataFrame, keys: list[str], date: str, tie_break: Sequence[str],
            stage_bytes: int | None) -> DataFrame:
    """The guarded upsert without stage rows for which the target holds a strictly
    newer order tuple (a null date counts as the oldest)."""
    fields, n = {f.name.lower(): f.dataType for f in target.schema.fields}, salts(target)
    # The stage's keys and dates in the target's types; what doesn't fit matches nothing.
    typed = stage.select(*[_c(c).try_cast(fields[c.lower()]).alias(c) for c in dict.fromkeys([*keys, date, *tie_break])])
    names = [f"__k{i}" for i in range(len(keys))]
    order = _order(date, tie_break)
    kind = target.select(order.alias("o")).schema["o"].dataType
    row = F.struct(*[_c(c) for c in target.columns])
    rows = target.select(*[_c(k).alias(x) for k, x in zip(keys, names)], _dealt(target, keys, n).alias("__part"),
                         F.when(_c(date).isNotNull(), order).alias("__mine"), F.lit(None).cast(kind).alias("__summary"), row.alias("__row"))
    asked = _stage_summary(typed, keys, date, tie_break).select(
        *[_c(k).alias(x) for k, x in zip(keys, names)], _parts(n).alias("__part"),
        F.lit(None).cast(kind).alias("__mine"), F.col("__stage_max").alias("__summary"), F.lit(None).cast(rows.schema["__row"].dataType).alias("__row"))
    group = Window.partitionBy(*names, "__part")
    met = rows.unionAll(asked).withColumns({"__stage_max": F.max("__summary").over(group), "__newest": F.max("__mine").over(group)})

    replaced = _and([F.col(n).isNotNull() for n in names]) & (F.col("__stage_max") >= F.col("__mine"))
    survivors = met.where(F.col("__row").isNotNull() & ~F.coalesce(replaced, F.lit(False))).select("__row.*")
    # The summary goes through the maximum too: both branches then read the same
    # columns, so Spark computes their exchange, and reads the target, once.
    newest = met.where(F.col("__row").isNull()).groupBy(*[_c(n).alias(k) for k, n in zip(keys, names)]).agg(
        F.max(F.struct("__newest", "__summary"))["__newest"].alias("__target_max")).where("__target_max is not null")

    left, right, on = _sides(stage, newest, keys, stage_bytes is not None and stage_bytes <= BROADCAST_MAX_BYTES)
    s, t = left.alias("s"), right.alias("t")
    mine = F.struct(*[F.col(f"s.`{c}`").try_cast(fields[c.lower()]).alias(c) for c in (date, *tie_break)])
    # Null-safe (no key of ``newest`` is null): a plain equality would be pushed below the
    # window of this branch alone, and part the two.
    cond = [F.col(f"s.`{k}`").eqNullSafe(F.col(f"t.`{k}`")) for k in on]
    cond.append((F.col("t.__target_max") > mine) | F.col(f"s.`{date}`").isNull())
    fresh = s.join(t, on=_and(cond), how="left_anti").select(*[F.col(f"s.`{c}`") for c in stage.columns])
    return survivors.unionAll(fresh)


def _and(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out
