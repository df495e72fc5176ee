"""Hard negatives, centroid clustering and the digest index against brute force,
and their defined results for nulls, ties, repeats, empty tables and odd columns."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import centroids, hard_negatives
from quarry.llm.digest_index import DigestIndex
from quarry.session import run_path

VECTORS = "vec_id long, embedding array<float>, label int"


def ints(v):
    return [math.floor(256 * float(x)) for x in v]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def random_rows(n, dims, seed, labels=4):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, dims)], int(rng.integers(labels))) for i in range(n)]
    for i in range(0, n, 9):              # many equal vectors: equal scores and distances
        rows[i] = (rows[i][0], rows[0][1], rows[i][2])
    return rows


# --- hard negatives --------------------------------------------------------------

def brute_negatives(rows, k=5, m=3, step=50):
    live = [(i, ints(v), lab) for i, v, lab in rows if usable(v) and lab is not None]
    big = 1 << 63
    out, seen = [], set()
    for a, av, al in live:
        if a is None or a % step or (a, tuple(av), al) in seen:
            continue
        seen.add((a, tuple(av), al))
        scored = [(-sum(x * y for x, y in zip(av, v)), big if i is None else i, lab) for i, v, lab in live if i != a]
        for p, pid, _ in sorted(s for s in scored if s[2] == al)[:k]:
            near = sorted(s for s in scored if s[2] != al and 50 * -p <= 100 * -s[0] <= 95 * -p)[:m]
            out += [(a, None if pid == big else pid, r, None if nid == big else nid, -p, -s) for r, (s, nid, _) in enumerate(near, 1)]
    return sorted(out, key=str)


def mined(spark, rows, schema=VECTORS, **kw):
    df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, schema)
    return sorted((tuple(r) for r in hard_negatives.mined(df, F.col("label"), **kw).collect()), key=str)


@pytest.mark.parametrize("n,dims,labels", [(700, 6, 4), (300, 3, 2), (120, 64, 1)])
def test_negatives_brute_force(spark, monkeypatch, n, dims, labels):
    monkeypatch.setattr(hard_negatives, "TREE", 60)       # several trees, blocks and cells
    monkeypatch.setattr(hard_negatives, "LEAF", 8)
    monkeypatch.setattr(hard_negatives, "BLOCK", 8)
    monkeypatch.setattr(hard_negatives, "GROUP", 3)
    rows = random_rows(n, dims, n, labels)
    got = mined(spark, rows)
    assert got == brute_negatives(rows)
    assert (len(got) > 20) == (labels > 1)


def test_negatives_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.5], 0), (1, [0.5, 0.4], 0), (2, [0.3, 0.3], 1), (3, [0.3, 0.3], 1), (4, None, 1), (5, [None, 0.1], 1),
            (6, [nan, 0.1], 1), (7, [inf, 0.1], 1), (8, [0.4, 0.3], None), (None, [0.3, 0.3], 1), (None, [0.5, 0.5], 0), (9, [], 1),
            (10, [0.3], 1), (3, [0.3, 0.3], 1), (50, [0.2, -0.4], 2), (50, [0.2, -0.4], 2), (100, [-0.2, -0.2], 0)]
    assert mined(spark, rows) == brute_negatives([(i, None if v is None else v + [0.0] * (2 - len(v)), lab) for i, v, lab in rows])
    df = spark.createDataFrame(rows, VECTORS)
    clash = df.withColumns({c: F.lit("x") for c in ("row", "id", "v", "tree", "anchor", "score", "windows", "block", "grp", "rank")})
    assert mined(spark, clash) == mined(spark, rows)
    assert mined(spark, df.where("false")) == []
    assert mined(spark, df.where("embedding is null")) == []


def test_negatives_large_components_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, [float(rng.randrange(-(1 << 22), 1 << 22)) + rng.random() for _ in range(4)], i % 2) for i in range(120)]
    doubles = "vec_id long, embedding array<double>, label int"
    assert mined(spark, rows, doubles) == brute_negatives(rows)


def test_tree_prunes_and_bounds_hold():
    import pyarrow as pa

    rng = np.random.default_rng(7)
    x = np.sort(rng.integers(-400, 400, (2000, 1)), axis=0) + rng.integers(-3, 3, (2000, 2))     # thin data: boxes can prune
    table = pa.table({"tree": pa.array([0] * 2000), "id": pa.array(range(2000)), "label": pa.array([0] * 2000),
                      "v": pa.array(list(x.astype(np.int64)), pa.list_(pa.int64()))})
    forest = hard_negatives.Forest(hard_negatives._pack(table))
    a = forest.ready(np.array([[5, 3]]))[0]
    least, most = forest.bounds(a)
    for node, (leaf, first, last) in enumerate(forest.kids):
        if leaf:
            s = forest.x[first:last] @ a
            assert least[node] <= s.min() and s.max() <= most[node]
    hits = forest.search(a, -1, 0, True, [(-(1 << 62), 1 << 62)], 5)[0]
    want = sorted((-int(s), int(i), at) for at, (s, i) in enumerate(zip(forest.x @ a, forest.ids)))[:5]
    assert [h[:2] for h in hits] == [w[:2] for w in want]
    assert forest.opened < len([k for k in forest.kids if k[0]]) / 4


def test_hot_vector_is_dealt_over_trees(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TREE", 64)
    rows = [(i, [0.1, 0.2] if i % 3 else [i / 999, 0.1], 0) for i in range(960)]
    df = spark.createDataFrame(rows, VECTORS)
    sizes = [r["n"] for r in hard_negatives.trees(hard_negatives.items(df, F.col("label"))).select("n").collect()]
    assert sum(sizes) == 960 and max(sizes) < 3 * 64


# --- centroid clustering ---------------------------------------------------------

def brute_clusters(rows, k, rounds, seed, dims):
    live = [(i, ints(v)) for i, v, _ in rows if usable(v) and len(v) == dims]
    keyed = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in live if i is not None)
    cents = [v for _, v in keyed[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        groups = [[] for _ in cents]
        for _, v in live:
            groups[near(v)[1]].append(v)
        cents = [[sum(c) // len(g) for c in zip(*g)] if g else old for g, old in zip(groups, cents)]
    got = [(i, *near(v)[::-1]) for i, v in live]
    inertia = [sum(d for _, c, d in got if c == j) for j in range(len(cents))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, c, d, inertia[c], sum(inertia), sha[c]) for i, c, d in got), key=str)


def clusters(df, **kw):
    return sorted((tuple(r) for r in centroids.clustered(df, **kw).collect()), key=str)


@pytest.mark.parametrize("n,dims,k,rounds", [(300, 8, 12, 4), (50, 64, 40, 2), (7, 4, 40, 3), (60, 3, 1, 1)])
def test_clusters_brute_force(spark, n, dims, k, rounds):
    rows = random_rows(n, dims, n + dims)
    rows += rows[:5] + [(None, rows[0][1], 1), (900, rows[1][1][:-1], 0), (901, None, 0), (902, [None] * dims, 0), (903, [float("nan")] * dims, 0)]
    df = spark.createDataFrame(rows, VECTORS)
    want = brute_clusters(rows, k, rounds, "2", dims)
    assert clusters(df, k=k, rounds=rounds, dims=dims) == want
    clash = df.withColumns({c: F.lit("x") for c in ("id", "v", "cluster", "distance", "key", "n", "total", "inertia")})
    assert clusters(clash, k=k, rounds=rounds, dims=dims) == want


def test_clusters_empty(spark):
    df = spark.createDataFrame([], VECTORS)
    assert clusters(df) == []
    out = centroids.clustered(spark.createDataFrame([(1, None, 1)], VECTORS))
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_scan_rejects_by_mean_and_deviation():
    rng = np.random.default_rng(1)
    cents = rng.integers(-200, 200, (40, 1)) + rng.integers(-30, 30, (40, 16)) * rng.integers(0, 4, (40, 1))
    x = rng.integers(-200, 200, (4000, 1)) + rng.integers(-30, 30, (4000, 16))
    book = centroids.Codebook(cents)
    number, dist = book.nearest(x)
    all_d = ((x[:, None, :] - cents[None]) ** 2).sum(2)
    assert (dist == all_d.min(1)).all() and (number == all_d.argmin(1)).all()
    assert book.measured < 0.5 * all_d.size


# --- digest index ----------------------------------------------------------------

DOCS = "doc_id long, text string"
UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TEXTS = ["One text", "ONE TEXT", "É", "é", None, "", " ", "x" * 200_000, "X" * 200_000, "İ", "one text"]


def sha(text):
    return hashlib.sha256((text or "").translate(str.maketrans(UP, LOW)).encode()).hexdigest()


def decisions(df):
    return sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"]).hex()) for r in df.collect())


def brute_index(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(sha(t), []).append(i)
    return sorted((i, max(groups[sha(t)]), len(groups[sha(t)]), i == max(groups[sha(t)]), sha(t)) for i, t in rows)


def test_index_one_load(spark):
    rows = list(enumerate(TEXTS))
    index = DigestIndex(spark, run_path(spark, "t-index"), 4)
    docs = spark.createDataFrame(rows, DOCS)
    want = brute_index(rows)
    assert decisions(index.ingest(docs, "a")) == want
    assert decisions(index.ingest(docs, "a")) == want                 # the load again: same answers, nothing appended
    assert index.rows().count() == len({sha(t) for t in TEXTS})
    again = DigestIndex(spark, index.path)                            # reopened: the buckets are those of the files
    assert again.buckets == 4 and again.rows().count() == index.rows().count()


def test_index_grows_load_by_load(spark):
    index = DigestIndex(spark, run_path(spark, "t-index"), 4)
    index.ingest(spark.createDataFrame([(5, "a"), (6, "b")], DOCS), "one").collect()
    second = decisions(index.ingest(spark.createDataFrame([(7, "A"), (8, "c"), (9, "c")], DOCS), "two"))
    assert second == [(7, 5, 1, False, sha("a")), (8, 9, 2, False, sha("c")), (9, 9, 2, True, sha("c"))]
    assert sorted((r["keep_id"], r["load"]) for r in index.rows().collect()) == [(5, "one"), (6, "one"), (9, "two")]


def test_index_after_half_an_append(spark):
    """A load that died after some of its digests were in place."""
    index = DigestIndex(spark, run_path(spark, "t-index"), 4)
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], DOCS)
    index.ingest(docs.where("text = 'a'"), "one").collect()
    assert decisions(index.ingest(docs, "one")) == brute_index([(1, "a"), (2, "a"), (3, "b")])
    assert index.rows().count() == 2


def test_index_repeats_nulls_and_columns(spark):
    rows = [(1, "a"), (1, "a"), (1, "a"), (None, "a"), (None, "z"), (2, "b")]
    docs = spark.createDataFrame(rows, DOCS)
    docs = docs.withColumns({c: F.lit("q") for c in ("digest", "id", "row", "keep", "n", "keep_id", "kept", "load")})
    index = DigestIndex(spark, run_path(spark, "t-index"), 4)
    got = index.ingest(docs, "one")
    assert sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"], r["kept"]) for r in got.collect()) == [
        (0, 0, 1, True), (0, 1, 4, False), (1, 1, 4, False), (1, 1, 4, False), (1, 1, 4, True), (2, 2, 1, True)]
    left = DigestIndex(spark, run_path(spark, "t-index"), 4).deduplicated(docs, "one")
    assert left.columns == docs.columns and sorted((r["doc_id"] or 0, r["text"]) for r in left.collect()) == [(0, "z"), (1, "a"), (2, "b")]
    assert index.ingest(docs.where("false"), "none").count() == 0


def test_index_hot_text_and_plan(spark):
    rows = [(i, "hot" if i % 3 else f"t{i}") for i in range(9000)]
    index = DigestIndex(spark, run_path(spark, "t-index"), 8)
    assert decisions(index.ingest(spark.createDataFrame(rows, DOCS), "one")) == brute_index(rows)
    groups = index.rows().select("digest").limit(5)
    plan = groups.hint("merge").join(index.rows(), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("SortMergeJoin"):]
    assert "Bucketed: true" in scan
