"""Hard negatives by inner product, from an STR-packed R-tree.

Rows are integer vectors with a label.  Spark tiles them on the coordinates that
vary most (sort-tile-recursive: slabs of equal size on the first, each cut into
equal slabs on the next) into trees of about ``TREE`` rows; a task packs one tree
by sort-tile-recursive on label and coordinates into leaves of ``LEAF`` rows and
keeps their minimum bounding boxes.  The label is a side of the box too.

For an anchor ``a`` and a box [lo, hi] each coordinate bounds its product by
``min(a lo, a hi)`` and ``max(a lo, a hi)``; the sums bound the score of every row
in the box.  Per anchor a best-first queue opens boxes by their upper bound and
drops those outside the score windows, of the wrong label, or strictly below the
kth score found (equal ones are opened: ties go to the smaller id).

Anchors meet the trees in cells of one block of anchors (at most about ``BLOCK``)
and one group of trees (at most ``GROUP``), one task each; a cell returns at most k
rows per anchor and window, and the first k of those are taken by a window that
cuts before its shuffle.  First the positives are mined, then, with the windows that
their scores set, the negatives.

Defined results.  Rows with a null label, a null vector or a null or non-finite
component take no part.  Vectors shorter than the longest are continued with zeros.
Rows with a null id are no anchors and come last among equal scores.  "Other" rows
have another id than the anchor; rows that repeat an id each count as a candidate,
and wholly repeated anchors once.  Scores are exact; one beyond 64 bits stops the
job.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.centroids import finite, scaled
from quarry.llm.scratch import written

TREE, LEAF, FANOUT = 1024, 64, 4
BLOCK, GROUP = 4096, 64
AXES = 2
NO_ID = (1 << 63) - 1


def items(df: DataFrame, label: Column, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(row, id, label, v) of the rows that take part, written.  ``row`` numbers them."""
    usable = df.where(label.isNotNull() & finite(vector)).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), scaled(vector).alias("v"))
    rows = written(usable.withColumn("row", F.monotonically_increasing_id()), "items")
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    return rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(0), F.lit(dims) - F.size("v")))))


# --- packing ---------------------------------------------------------------------

def _tiles(rows: DataFrame, n: int) -> DataFrame:
    """The rows with their ``tree``: slabs of equal size on one coordinate after the
    other.  A coordinate is continued by a row hash, so equal values are cut too."""
    trees = max(1, -(-n // TREE))
    slabs = max(1, math.ceil(trees ** (1 / AXES)))
    rows = rows.withColumn("tree", F.lit(0).cast("long"))
    if slabs == 1:
        return rows
    dims = rows.select(F.size("v")).first()[0]
    spread = rows.agg(*[F.var_pop(F.col("v")[j]).alias(f"s{j}") for j in range(dims)]).first()
    for axis in sorted(range(dims), key=lambda j: (-spread[j], j))[:AXES]:
        key = F.struct(F.col("v")[axis].alias("c"), F.xxhash64("row", F.lit(axis)).alias("h"))
        # Equal shares come from approximate quantiles of one number per row.
        flat = F.col("__key.c").cast("double") + (F.col("__key.h").cast("double") / F.lit(2.0 ** 64) + 0.5)
        rows = rows.withColumn("__key", key).withColumn("__key", flat)
        shares = [i / slabs for i in range(1, slabs)]
        cuts = rows.groupBy("tree").agg(F.percentile_approx("__key", shares, 100 * slabs).alias("__cuts"))
        rows = rows.join(cuts, "tree").withColumn(
            "tree", F.col("tree") * slabs + F.size(F.filter("__cuts", lambda c: c < F.col("__key")))).drop("__key", "__cuts")
    return rows


def str_order(keys: list[np.ndarray], leaf: int) -> np.ndarray:
    """An order in which each run of ``leaf`` rows is one tile of the given keys."""
    def cut(at: np.ndarray, left: list[np.ndarray]) -> np.ndarray:
        at = at[np.argsort(left[0][at], kind="stable")]
        if len(left) == 1 or len(at) <= leaf:
            return at
        slabs = max(1, math.ceil((len(at) / leaf) ** (1 / len(left))))
        size = leaf * max(1, math.ceil(len(at) / leaf / slabs))
        return np.concatenate([cut(at[i:i + size], left[1:]) for i in range(0, len(at), size)])

    return cut(np.arange(len(keys[0])), keys)


PACKED = "tree long, n int, ids array<long>, labels array<long>, comps array<long>, lo array<long>, hi array<long>"


def _pack(table: pa.Table) -> pa.Table:
    n = table.num_rows
    x = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)
    label = table.column("label").to_numpy()
    ids = table.column("id").fill_null(NO_ID).to_numpy()
    wide = np.argsort(-x.var(0), kind="stable")[:AXES]
    order = str_order([label, *[x[:, j] for j in wide]], LEAF)
    x, label, ids = x[order], label[order], ids[order]
    boxed = np.concatenate([label[:, None], x], 1)
    first = np.arange(0, n, LEAF)
    lo, hi = np.minimum.reduceat(boxed, first, axis=0), np.maximum.reduceat(boxed, first, axis=0)
    cell = {"tree": pa.array([table.column("tree")[0].as_py()], pa.int64()), "n": pa.array([n], pa.int32())}
    for name, values in (("ids", ids), ("labels", label), ("comps", x), ("lo", lo), ("hi", hi)):
        cell[name] = pa.array([values.ravel()], pa.list_(pa.int64()))
    return pa.table(cell)


def trees(rows: DataFrame) -> DataFrame:
    """The packed trees of :func:`items`, one row each, written."""
    tiled = written(_tiles(rows, rows.count()), "tiles")
    return written(tiled.groupBy("tree").applyInArrow(_pack, PACKED), "trees")


# --- search ----------------------------------------------------------------------

def _exact(a: np.ndarray, x: np.ndarray) -> type:
    """float64 where every inner product is exact in it, else Python's integers."""
    top = [int(np.abs(m).max()) if m.size else 0 for m in (a, x)]
    return np.float64 if top[0] * top[1] * max(1, x.shape[1]) < 1 << 52 else object


class Forest:
    """Some packed trees, with the boxes of leaves, inner nodes and roots.  Nodes
    are numbered through all trees; ``kids`` of a leaf are its rows."""

    def __init__(self, table: pa.Table):
        sides, leaves, self.x, self.ids, self.labels, self.kids, roots = [], [], [], [], [], [], []
        at = 0
        for tree in range(table.num_rows):
            n = table.column("n")[tree].as_py()
            flat = {c: table.column(c)[tree].values.to_numpy() for c in ("ids", "labels", "comps", "lo", "hi")}
            k = -(-n // LEAF)
            self.x.append(flat["comps"].reshape(n, -1))
            self.ids.append(flat["ids"])
            self.labels.append(flat["labels"])
            level = (flat["lo"].reshape(k, -1), flat["hi"].reshape(k, -1))
            base = len(self.kids)
            self.kids += [(True, at + i, at + min(n, i + LEAF)) for i in range(0, n, LEAF)]
            sides.append(level)
            at += n
            while len(level[0]) > 1:      # inner nodes over runs of FANOUT boxes
                first = np.arange(0, len(level[0]), FANOUT)
                self_base = len(self.kids)
                self.kids += [(False, base + i, base + min(len(level[0]), i + FANOUT)) for i in first]
                level = (np.minimum.reduceat(level[0], first, axis=0), np.maximum.reduceat(level[1], first, axis=0))
                sides.append(level)
                base = self_base
            roots.append(len(self.kids) - 1)
        self.roots = roots
        self.x, self.ids, self.labels = np.concatenate(self.x), np.concatenate(self.ids), np.concatenate(self.labels)
        lo, hi = np.concatenate([s[0] for s in sides]), np.concatenate([s[1] for s in sides])
        self.label_lo, self.label_hi, self.lo, self.hi = lo[:, 0], hi[:, 0], lo[:, 1:], hi[:, 1:]
        self.opened = 0

    def ready(self, anchors: np.ndarray) -> np.ndarray:
        kind = _exact(anchors, self.x)
        self.x, self.lo, self.hi = self.x.astype(kind), self.lo.astype(kind), self.hi.astype(kind)
        return anchors.astype(kind)

    def bounds(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each box with one anchor."""
        up, down = np.maximum(a, 0), np.minimum(a, 0)
        return self.lo @ up + self.hi @ down, self.hi @ up + self.lo @ down

    def search(self, a: np.ndarray, own: int, label: int, same: bool, windows: list[tuple[int, int]], k: int) -> list[list[tuple]]:
        """Per window [low, high] its first k rows of the same (or of another)
        label, as (-score, id, position)."""
        least, most = self.bounds(a)
        fits = ((self.label_lo <= label) & (label <= self.label_hi)) if same else (self.label_lo != label) | (self.label_hi != label)
        found: list[list[tuple]] = [[] for _ in windows]
        # What a row must reach to matter to a window: its kth score, once there are k.
        floor = [lo for lo, _ in windows]

        def wanted(node: int) -> bool:
            return fits[node] and any(most[node] >= floor[w] and least[node] <= hi for w, (_, hi) in enumerate(windows))

        queue = [(-most[r], r) for r in self.roots if wanted(r)]
        heapq.heapify(queue)
        while queue:
            _, node = heapq.heappop(queue)
            if not wanted(node):
                continue
            is_leaf, first, last = self.kids[node]
            if not is_leaf:
                for kid in range(first, last):
                    if wanted(kid):
                        heapq.heappush(queue, (-most[kid], kid))
                continue
            self.opened += 1
            score = self.x[first:last] @ a
            ok = (self.ids[first:last] != own) & ((self.labels[first:last] == label) == same) & (score >= min(floor))
            if not ok.any():
                continue
            at = np.flatnonzero(ok)
            score, at = score[at], at + first
            for w, (lo, hi) in enumerate(windows):
                hits = np.flatnonzero((score >= floor[w]) & (score <= hi))
                if len(hits):
                    found[w] += [(-int(score[i]), int(self.ids[at[i]]), int(at[i])) for i in hits]
                    found[w].sort()
                    del found[w][k:]
                    if len(found[w]) == k:
                        floor[w] = max(lo, -found[w][-1][0])
        return found


def _cells(packed: DataFrame, anchors: DataFrame):
    """Blocks of anchors and groups of trees, ready to be co-grouped cell by cell."""
    spark = packed.sparkSession
    n_trees, n_anchors = packed.count(), anchors.count()
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, -(-n_trees // GROUP), min(n_trees, width))
    blocks = max(1, -(-2 * n_anchors // BLOCK))       # about half full, as the hash deals them
    here = anchors.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int"))
    here = here.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    there = packed.withColumn("grp", F.pmod(F.xxhash64("tree"), F.lit(groups)).cast("int"))
    there = there.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return here.groupBy("grp", "block").cogroup(there.groupBy("grp", "block"))


FOUND = "anchor long, positive int, score long, id long"


def _mined(packed: DataFrame, anchors: DataFrame, same: bool, k: int) -> DataFrame:
    """(anchor, positive, score, id) of the first k rows of each of an anchor's
    windows, a column of (positive, low, high)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {c: [] for c in ("anchor", "positive", "score", "id")}
        if left.num_rows and right.num_rows:
            forest = Forest(right)
            rows = left.select(["anchor", "id", "label", "windows"]).to_pylist()
            a = left.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(left.num_rows, -1)
            a = forest.ready(a)
            for row, v in zip(rows, a):
                windows = [(w["low"], w["high"]) for w in row["windows"]]
                for w, hits in zip(row["windows"], forest.search(v, row["id"], row["label"], same, windows, k)):
                    for score, no, _ in hits:
                        out["anchor"].append(row["anchor"])
                        out["positive"].append(w["positive"])
                        out["score"].append(-score)
                        out["id"].append(None if no == NO_ID else no)
        return pa.table({"anchor": pa.array(out["anchor"], pa.int64()), "positive": pa.array(out["positive"], pa.int32()),
                         "score": pa.array(out["score"], pa.int64()), "id": pa.array(out["id"], pa.int64())})

    best = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return _cells(packed, anchors).applyInArrow(run, FOUND).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _windows(low: Column, high: Column, positive: Column) -> Column:
    return F.struct(positive.cast("int").alias("positive"), low.cast("long").alias("low"), high.cast("long").alias("high"))


def mined(df: DataFrame, label: Column, anchor: Column | None = None, positives: int = 5, negatives: int = 3,
          low: int = 50, high: int = 95, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per anchor and positive the first ``negatives`` rows of another label whose
    score is at least ``low`` and at most ``high`` per cent of the positive's:
    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).
    ``label`` is a column over ``df``, ``anchor`` a condition over ``id``."""
    rows = items(df, label, id_col, vector)
    packed = trees(rows)
    chosen = F.pmod(F.col("id"), F.lit(50)) == 0 if anchor is None else anchor
    anchors = written(rows.where(F.col("id").isNotNull() & chosen).groupBy("id", "label", "v").agg(F.min("row").alias("anchor")), "anchors")

    everywhere = F.array(_windows(F.lit(-(1 << 62)), F.lit(1 << 62), F.lit(0)))
    near = written(_mined(packed, anchors.withColumn("windows", everywhere), True, positives), "positives")
    near = near.select("anchor", F.col("rank").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))

    # 100 negative >= low * positive and <= high * positive, in whole numbers.
    p = F.col("positive_score").cast("decimal(38,0)")
    span = _windows(F.ceil(p * low / 100), F.floor(p * high / 100), F.col("positive"))
    spans = near.groupBy("anchor").agg(F.sort_array(F.collect_list(span)).alias("windows"))     # at most ``positives``
    far = _mined(packed, anchors.join(spans, "anchor"), False, negatives)
    ids = anchors.select("anchor", F.col("id").alias("anchor_id"))
    return (far.select("anchor", "positive", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
               .join(near, ["anchor", "positive"]).join(ids, "anchor")
               .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
