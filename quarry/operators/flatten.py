"""Flattening of nested records (struct → columns, array → rows).

The column order follows the classic one-field-at-a-time loop: the first
complex column (in current order) is processed; a struct is replaced by its
fields named ``<col>_<field>`` *appended at the end*; an array is replaced *in
place* by its exploded element (``explode_outer``: null/empty arrays keep
their row).  The loop repeats until nothing complex remains.  Maps are not
complex (exact type test), so they pass through.

Instead of one projection per nested column, the loop is simulated on the
schema on the driver and the plan gets one projection per array level only:
struct fields become plain ``getField`` expressions and every array adds one
``Generate``.  Catalyst collapses the projections, and nested-schema pruning
can still reach the scan for leaves that are only read through structs.

Long arrays: a record's rows come from the task that holds the record, however
many they are.  With ``slice_elements``, arrays that are longer are first cut into
slices (every array of a record, so that their product is cut too), the rows with
slices are dealt over all tasks by one shuffle, and the slices are exploded there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from ..functions.columns import quote as _quote


class FlattenNameClash(ValueError):
    pass


@dataclass
class _Slot:
    name: str
    dtype: DataType
    expr: Column  # expression producing this slot from the current frame


def _is_struct(dt: DataType) -> bool:
    return type(dt) is StructType


def _is_array(dt: DataType) -> bool:
    return type(dt) is ArrayType


def _sliced(array: Column, size: int) -> Column:
    """An array as an array of its slices; a null or short one is its one slice."""
    numbers = F.sequence(F.lit(0), F.floor((F.size(array) - 1) / size).cast("int"))
    return F.when(F.size(array) > size, F.transform(numbers, lambda i: F.slice(array, i * size + 1, F.lit(size)))).otherwise(F.array(array))


_AT = " first"      # of a slice: the place of its first element, in a column of its own


def _dealt(frame: DataFrame, slots: list[_Slot], arrays: list[str], cut: set[str], size: int) -> DataFrame:
    """The frame with the slots under their names, the given arrays cut into slices, a
    row per combination of slices, dealt over all tasks.  ``cut``: those that are slices already."""
    frame = frame.select(*[s.expr.alias(s.name) for s in slots], *[F.col(_quote(n + _AT)) for n in sorted(cut)])
    for name in arrays:
        c = F.col(_quote(name))
        rest = [F.col(_quote(x)) for x in frame.columns if x != name]
        frame = frame.select(*rest, F.posexplode_outer(_sliced(c, size)).alias(name + _AT, name))
    places = {name + _AT: F.col(_quote(name + _AT)) * size for name in arrays}
    return frame.withColumns(places).repartition(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _flatten(df: DataFrame, explode_arrays: bool, sep: str = "_", arrays: list[str] | None = None,
             with_position: bool = False, slice_elements: int | None = None) -> DataFrame:
    def complex_(dt: DataType) -> bool:
        return _is_struct(dt) or (explode_arrays and _is_array(dt))

    def wanted(s: _Slot) -> bool:
        return complex_(s.dtype) and not (_is_array(s.dtype) and arrays is not None and s.name not in arrays and s.name not in exploded)

    slots = [_Slot(f.name, f.dataType, F.col(_quote(f.name))) for f in df.schema.fields]
    frame = df
    exploded: set[str] = set()
    # Kept up to date incrementally: wide payloads (thousands of leaves) stay
    # linear in the number of fields on the driver.
    existing = {s.name for s in slots}
    cut: set[str] = set()       # arrays that are slices now

    while True:
        idx = next((i for i, s in enumerate(slots) if wanted(s)), None)
        if idx is None:
            break
        if slice_elements and _is_array(slots[idx].dtype) and slots[idx].name not in cut:
            # All arrays that are here now are cut before one shuffle.
            now = [s.name for s in slots if _is_array(s.dtype) and wanted(s) and s.name not in cut]
            frame = _dealt(frame, slots, now, cut, slice_elements)
            slots = [_Slot(s.name, s.dtype, F.col(_quote(s.name))) for s in slots]
            cut.update(now)
        slot = slots[idx]
        if _is_struct(slot.dtype):
            del slots[idx]
            existing.discard(slot.name)
            for field in slot.dtype.fields:
                new_name = f"{slot.name}{sep}{field.name}"
                if new_name in existing:
                    raise FlattenNameClash(
                        f"flattening struct column {slot.name!r} would create {new_name!r}, "
                        f"which already exists; rename one of them first")
                existing.add(new_name)
                slots.append(_Slot(new_name, field.dataType, slot.expr.getField(field.name)))
        else:
            # One Generate per array: materialise every slot under its
            # current name, exploding this one in place.
            cols = []
            for s in slots:
                if s is slot:
                    if with_position:
                        cols.append(F.posexplode_outer(s.expr).alias(f"{s.name}{sep}pos", s.name))
                    else:
                        cols.append(F.explode_outer(s.expr).alias(s.name))
                else:
                    cols.append(s.expr.alias(s.name))
            places = [F.col(_quote(n + _AT)) for n in sorted(cut)]
            frame = frame.select(*cols, *places)
            if slot.name in cut:
                if with_position:
                    pos = f"{slot.name}{sep}pos"
                    frame = frame.withColumn(pos, F.col(_quote(pos)) + F.col(_quote(slot.name + _AT)))
                frame = frame.drop(slot.name + _AT)
                cut.discard(slot.name)
            new_slots = []
            for s in slots:
                if s is slot and with_position:
                    new_slots.append(_Slot(f"{s.name}{sep}pos", frame.schema[f"{s.name}{sep}pos"].dataType,
                                           F.col(_quote(f"{s.name}{sep}pos"))))
                new_slots.append(_Slot(s.name, frame.schema[s.name].dataType, F.col(_quote(s.name))))
            slots = new_slots
            existing = {s.name for s in slots}
            exploded.add(slot.name)
    return frame.select(*[s.expr.alias(s.name) for s in slots])


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Recursively expand every struct column into ``<col>_<field>``
    columns; arrays (even arrays of structs) are left alone."""
    return _flatten(df, explode_arrays=False, sep=sep)


def flatten_all(df: DataFrame, sep: str = "_", arrays: list[str] | None = None,
                with_position: bool = False, slice_elements: int | None = None) -> DataFrame:
    """Expand structs and explode arrays (``explode_outer``) until neither
    remains.  Two independent arrays give their cross product, as the
    semantics demand.

    ``arrays`` optionally restricts which array columns are exploded, by
    their current (flattened) name, e.g. ``"payload_items"`` for an array
    inside the struct ``payload``; the others pass through as arrays.
    ``with_position`` adds a ``<col>_pos`` index column per exploded array.
    ``slice_elements`` deals longer arrays over all tasks, at the cost of a shuffle.
    """
    return _flatten(df, explode_arrays=True, sep=sep, arrays=arrays, with_position=with_position, slice_elements=slice_elements)


def is_flat(df: DataFrame, allow_arrays: bool = False) -> bool:
    for f in df.schema.fields:
        if _is_struct(f.dataType):
            return False
        if not allow_arrays and _is_array(f.dataType):
            return False
    return True


def coalesce_choice(df: DataFrame, column: str, parse: dict[str, Column] | None = None,
                    to: str | None = None, alternatives: list[str] | None = None) -> DataFrame:
    """Collapse a flattened type-choice field (``<col>_long``, ``<col>_string``
    …) into one column: the first non-null alternative, converted by
    ``parse[alternative]`` (default: a ``try_cast`` to the first alternative's
    type).  ``alternatives`` names them explicitly (in priority order);
    by default every column starting with ``<col>_`` is one."""
    prefix = f"{column}_"
    if alternatives is not None:
        alts = [df.schema[f"{prefix}{a}"] for a in alternatives]
    else:
        alts = [f for f in df.schema.fields if f.name.startswith(prefix)]
    if not alts:
        raise ValueError(f"no alternatives of {column!r} in {df.columns}")
    target = alts[0].dataType
    exprs = []
    for f in alts:
        alt = f.name[len(prefix):]
        c = F.col(_quote(f.name))
        if parse and alt in parse:
            exprs.append(parse[alt])
        elif f.dataType == target:
            exprs.append(c)
        else:
            exprs.append(c.try_cast(target))
    out = to or column
    keep = [F.col(_quote(c)) for c in df.columns if c not in {f.name for f in alts} and c != out]
    return df.select(*keep, F.coalesce(*exprs).alias(out))
