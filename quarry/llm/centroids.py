"""Centroid clustering with equal-average equal-variance nearest-neighbour search.

Vectors are arrays of integers.  The centroids are sorted by the mean of their
components; a vector starts where its own mean falls and scans outward, the nearer
mean first.  With D components, means m and M, and v, V the lengths of the vectors
less their means,

    distance >= D (m - M)^2                  ends the scan (both sides are further),
    distance >= D (m - M)^2 + (v - V)^2      passes over one centroid,

and what is left is measured exactly in integers.  Bounds reject only what is
strictly further than the best (the second by a margin above float error), so that
among equal distances the smallest number wins.

A round is one pass over the written vectors: a task returns, per centroid, the sum
and count of its vectors (at most k rows a task); k centroids of D components are
all that the driver holds.

Defined results: a vector counts when it has exactly ``dims`` components, none null,
NaN or infinite; other rows take no part.  Null ids take part but seed no centroid.
Repeated rows count as often as they occur.  With fewer vectors than ``k`` there are
fewer centroids, with none an empty result.  A centroid that loses all its vectors
stays where it is.  Other columns are ignored, whatever their names.  Components
beyond 2**27 after scaling stop the job with a message: their distances need not
fit a long.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.scratch import written

LARGEST = 1 << 27
#: Vectors that a task measures at once.
BLOCK = 8192


def finite(vector: str = "embedding"):
    """Whether a vector is there, without null, NaN or infinite components."""
    v = F.col(f"`{vector}`")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return v.isNotNull() & ~F.coalesce(odd, F.lit(True))


def scaled(vector: str = "embedding", scale: int = 256):
    """floor(scale * x) of each component, x as double."""
    return F.transform(F.col(f"`{vector}`"), lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def integers(df: DataFrame, dims: int = 64, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v) of the vectors that count, written."""
    usable = df.where(finite(vector) & (F.size(F.col(f"`{vector}`")) == dims))
    return written(usable.select(F.col(f"`{id_col}`").alias("id"), scaled(vector).alias("v")), "vectors")


def seeds(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of ``<seed>:<id>``; equal ids by vector."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.select(key.alias("key"), "v").where("key IS NOT NULL").orderBy("key", "v").limit(k).collect()
    return _checked(np.array([r["v"] for r in rows], np.int64))


def _checked(x: np.ndarray) -> np.ndarray:
    if x.size and int(np.abs(x).max()) > LARGEST:
        raise ValueError(f"a scaled component is beyond {LARGEST}")
    return x


class Codebook:
    """Centroids sorted by mean, with the two sums that the inequalities use."""

    def __init__(self, centroids: np.ndarray):
        total = centroids.sum(1)
        self.number = np.lexsort((np.arange(len(total)), total))
        self.at = centroids[self.number]
        self.total = total[self.number]
        self.spread = self._spread(self.at, self.total)
        self.measured = 0

    @staticmethod
    def _spread(x, total):
        d = max(1, x.shape[1])
        return np.sqrt(np.maximum(0.0, (x * x).sum(1) - total.astype(np.float64) ** 2 / d))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each vector's nearest centroid."""
        n, d, k = len(x), x.shape[1], len(self.at)
        total = x.sum(1)
        spread = self._spread(x, total)
        right = np.searchsorted(self.total, total)
        left = right - 1
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, k)
        live = np.arange(n)
        for _ in range(k):
            # The side whose mean is nearer; a side that is used up is infinitely far.
            lo, hi = left[live], right[live]
            far = np.iinfo(np.int64).max
            gap_lo = np.where(lo >= 0, total[live] - self.total[np.maximum(lo, 0)], far)
            gap_hi = np.where(hi < k, self.total[np.minimum(hi, k - 1)] - total[live], far)
            down = gap_lo <= gap_hi
            c, gap = np.where(down, lo, hi), np.minimum(gap_lo, gap_hi).astype(np.float64)
            # Sums differ by D times the means: D (m - M)^2 = gap^2 / D.
            by_mean = gap * gap / d
            limit = best[live].astype(np.float64) * (1 + 1e-9) + 1e-6
            open_ = by_mean <= limit
            live, c, by_mean, limit, down = live[open_], c[open_], by_mean[open_], limit[open_], down[open_]
            if not len(live):
                break
            left[live[down]] -= 1
            right[live[~down]] += 1
            near = by_mean + (spread[live] - self.spread[c]) ** 2 * (1 - 1e-9) <= limit + 1e-6
            who, c = live[near], c[near]
            self.measured += len(who)
            gone = x[who] - self.at[c]
            dist = np.einsum("ij,ij->i", gone, gone)
            no = self.number[c]
            better = (dist < best[who]) | ((dist == best[who]) & (no < number[who]))
            best[who[better]], number[who[better]] = dist[better], no[better]
        return number, best


def _vectors(batch: pa.RecordBatch, d: int):
    """Blocks of a batch as (ids, integers)."""
    for at in range(0, batch.num_rows, BLOCK):
        part = batch.slice(at, BLOCK)
        v = part.column("v")
        yield part.column("id"), _checked(v.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(v), d))


def _sums(vectors: DataFrame, centroids: np.ndarray) -> list:
    """(cluster, count, component sums) of the vectors as they are assigned."""
    k, d = centroids.shape

    def run(batches):
        book, total, count = Codebook(centroids), np.zeros((k, d), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, x in _vectors(batch, d):
                number, _ = book.nearest(x)
                order = np.argsort(number, kind="stable")
                found, first = np.unique(number[order], return_index=True)
                total[found] += np.add.reduceat(x[order], first, axis=0)
                count += np.bincount(number, minlength=k)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(used, pa.int32()), "n": pa.array(count[used], pa.int64()),
                                          "total": pa.array(list(total[used]), pa.list_(pa.int64()))})

    parts = vectors.mapInArrow(run, "cluster int, n long, total array<long>")
    sums = F.array(*[F.sum(F.col("total")[j]) for j in range(d)])
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), sums.alias("total")).collect()


def fit(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: str = "2") -> np.ndarray:
    """The centroids after ``rounds`` rounds over :func:`integers`."""
    centroids = seeds(vectors, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        fresh = centroids.copy()
        for row in _sums(vectors, centroids):
            fresh[row["cluster"]] = [t // row["n"] for t in row["total"]]     # Python's // is the floor
        centroids = fresh
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    d, kind = centroids.shape[1] if len(centroids) else 0, vectors.schema["id"].dataType.simpleString()

    def run(batches):
        book = Codebook(centroids)
        for batch in batches:
            for ids, x in _vectors(batch, d):
                number, dist = book.nearest(x)
                yield pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), pa.array(dist, pa.int64())], ["id", "cluster", "distance"])

    if not len(centroids):      # no vector has an id to seed from
        return vectors.where("false").select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    return vectors.mapInArrow(run, f"id {kind}, cluster int, distance long")


def clustered(df: DataFrame, k: int = 40, rounds: int = 5, seed: str = "2", dims: int = 64,
              id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(``id_col``, cluster, distance, cluster_inertia, inertia, centroid_sha256) of
    every vector that counts."""
    vectors = integers(df, dims, id_col, vector)
    centroids = fit(vectors, k, rounds, seed)
    assigned = written(assign(vectors, centroids), "assigned")
    # A row per centroid: k is a parameter, so is the size of what is broadcast.
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    whole = sum(r["cluster_inertia"] for r in sums)
    about = [(r["cluster"], r["cluster_inertia"], whole, hashlib.sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest()) for r in sums]
    facts = df.sparkSession.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.withColumnRenamed("id", id_col).join(F.broadcast(facts), "cluster").select(
        id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
