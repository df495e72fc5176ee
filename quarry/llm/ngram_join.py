"""Similarity join on word-shingle sets (Jaccard), by size-banded tiles with
bitmap signatures.

1. ``classes``: each text's distinct shingles as 64-bit hashes; texts with equal
   sets form one class (its key digests the set), so copies are never compared.
2. ``shared_sets``: shingles are dealt to buckets by their hash, where those of
   two classes or more survive.  Each class orders its shared shingles by (number
   of classes, hash); two sets of the wanted similarity must share one among
   the first |x| - ceil(t |x|) + 1 in that order, counting the unshared ones
   first.  A class whose unshared shingles alone fill that length has no partner.
   Any order will do that all classes follow, so the hot shingles, which very
   many classes hold, are not counted at all: they come last, by hash, and their
   holders are dealt by class, not by shingle.  They are those that hold at least
   ``HOT`` of a sample of the texts (one in ``SAMPLE``, by hash); at most ``MOST_HOT`` of
   them, as the bound grows with the sample.  Which ones are found changes no result.
3. Tiles are (shingle of that prefix, size band); sets of wanted similarity have
   sizes in the same or the next band.  First, each class is compared with the
   leader of a tile only, which contracts groups of near copies.  Then, in
   tiles that still hold several components, members of different components
   meet: popcounts of hashed bitmaps bound the overlap from above, and the
   pairs that pass go to the exact intersection of sorted arrays.
4. Links join to components (``quarry.llm.components``).

Large tiles are split in blocks that meet in pairs of blocks, in different
groups.  Nothing is dropped: every pair that reaches the similarity shares a
tile, and is left out only where both ends are already linked through others.

Defined cases: a null or empty text, or one without words, has the empty set and
is linked with nothing; a text of fewer words than a shingle has its whole
sequence as its one shingle; equal ids on several rows: each row gets its
component, the least id among linked rows (null only if all ids are null); other
columns play no part and pass through ``one_of_each``, but for names that begin with
two underscores.

Sets, classes and shingles are known by 64-bit hashes, shingles within a bucket by 48
bits and the bucket.  With n distinct shingles the chance that any two meet is below
n**2 / 2**55 with the least number of buckets (a hundred million: 0.3), and one such
meeting changes a similarity by one shingle of a set; two of n sets meet with n**2 / 2**65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.components import components
from quarry.llm.scratch import give_back, map_texts, power_of_two, reading, remove, with_values, written
from quarry.llm.textkit import Words, chunks, mix, shingles
from quarry.operators.upsert import salts

PERCENT = 80           # least similarity in percent
WORDS = 5              # words of a shingle
BUCKET_SHINGLES = 1 << 20   # about so many shingles are counted in one group
FLUSH_SHINGLES = 1 << 19    # shingles that a task packs at a time
LEADS = 2              # turns in which classes meet one leader each
TILE_BLOCK = 1024      # classes of a tile that meet in one group
MAP_WORDS = 16         # 64-bit words of a bitmap
SAMPLE = 64            # one text in so many is looked at for hot shingles
HOT = 1024             # classes of the sample that hold a hot shingle, at least
MOST_HOT = 1 << 20     # hot shingles at most
LAST = 0xFFFFFFFF      # the place of a hot shingle in the order of counts
_U = np.uint64


def _sets(batches, words):
    """(rows, text number, shingle) of each chunk, sorted by text and shingle."""
    for rows, texts in chunks(batches):
        yield rows, *shingles(Words(texts, lower=True), words)


def _class_keys(n: int, doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Set sizes and class keys (0 for the empty set) of n texts."""
    size = np.bincount(doc, minlength=n)
    key = np.zeros(n, _U)
    full = np.flatnonzero(size)
    if len(full):
        at = np.concatenate([[0], np.cumsum(size[full])[:-1]])
        total = np.add.reduceat(mix(h), at)
        parity = np.bitwise_xor.reduceat(h, at)
        key[full] = mix(total ^ mix(parity + size[full].astype(_U))) | _U(1)
    return size, key


def _class_values(words: int):
    """Set size and class key of some texts."""
    def values(texts: list[bytes]) -> list[np.ndarray]:
        size, key = _class_keys(len(texts), *shingles(Words(texts, lower=True), words))
        return [size.astype(np.int64), key.view(np.int64)]

    return values


def classes(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, class_key) for every row of ``docs(doc_id, text)``."""
    fields = [T.StructField("n_shingles", T.LongType()), T.StructField("class_key", T.LongType())]
    return with_values(docs.select("doc_id", "text"), _class_values(words), fields).drop("text")


def hot_shingles(docs: DataFrame, words: int = WORDS) -> np.ndarray:
    """The sorted hashes of the shingles that very many classes hold."""
    def run(batches):
        for rows, doc, h in _sets(batches, words):
            _, key = _class_keys(rows.num_rows, doc, h)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(key[doc].view(np.int64))], names=["shingle", "key"])

    some = docs.select("text").where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    # Partial aggregation leaves one of a task's copies; the pairs are 1 / SAMPLE of all.
    held = written(map_texts(some, run, "shingle long, key long").distinct().groupBy("shingle").agg(F.count("*").alias("n")), "held")
    least = max(HOT, -(-(held.agg(F.sum("n")).first()[0] or 0) // MOST_HOT))
    found = np.array([r["shingle"] for r in held.where(F.col("n") >= least).select("shingle").collect()], np.int64).view(_U)
    remove(held)
    return np.sort(found)


def _tokens(low: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """The hash that a shingle is known by from its bucket on."""
    return mix(low ^ mix(bucket.astype(_U)))


def _deal(docs: DataFrame, words: int, buckets: int, hot: np.ndarray) -> DataFrame:
    """Shingles packed by bucket of their hash: (bucket, shingles, owners, sizes,
    place of each shingle's owner); one row per bucket and some texts.  The hot ones are
    in buckets of their own, beyond the others, dealt by the class that holds them."""
    shift = _U(64 - buckets.bit_length() + 1)
    shared = docs.sparkSession.sparkContext.broadcast(hot)      # at most ``MOST_HOT`` hashes

    def flush(parts):
        # Taken out of ``parts`` one by one, so that the pieces are let go.
        key, size, doc, h = [np.concatenate(parts.pop(k)) for k in ("key", "size", "doc", "h")]
        # One of each class is enough; its copies in this task are left out.
        _, first = np.unique(key, return_index=True)
        chosen = np.zeros(len(key), bool)
        chosen[first] = True
        live = chosen[doc]
        doc, h = doc[live], h[live]
        del live
        bucket = (h >> shift).astype(np.int64) if buckets > 1 else np.zeros(len(h), np.int64)
        warm = shared.value
        is_hot = warm[np.minimum(np.searchsorted(warm, h), len(warm) - 1)] == h if len(warm) else np.zeros(len(h), bool)
        h &= _U((1 << 48) - 1)
        if is_hot.any():
            h[is_hot] = _tokens(h[is_hot], bucket[is_hot])
            bucket[is_hot] = buckets + (mix(key[doc[is_hot]]) % _U(buckets)).astype(np.int64)
        order = np.argsort(bucket.astype(np.uint16), kind="stable") if buckets <= 32768 else np.argsort(bucket, kind="stable")
        bucket, doc, h = bucket[order], doc[order], h[order]
        cut = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(cut[1:], len(h))
        columns = [[], [], [], [], []]
        for a, b in zip(cut, ends):
            own, place = np.unique(doc[a:b], return_inverse=True)
            low = h[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6 if bucket[a] < buckets else 8]
            place = place.astype("<u2") if len(own) <= 65535 else place.astype("<u4")
            for c, v in zip(columns, (int(bucket[a]), low.tobytes(), key[own].tobytes(), size[own].astype("<u4").tobytes(), place.tobytes())):
                c.append(v)
        if columns[0]:
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                                             names=["bucket", "low", "owner", "size", "place"])

    def run(batches):
        fresh = lambda: {"key": [], "size": [], "doc": [], "h": []}
        parts, at, held = fresh(), 0, 0
        for rows, doc, h in _sets(batches, words):
            size, key = _class_keys(rows.num_rows, doc, h)
            for k, v in (("key", key), ("size", size), ("doc", doc.astype(np.int32) + at), ("h", h)):
                parts[k].append(v)
            at, held = at + rows.num_rows, held + len(h)
            if held >= FLUSH_SHINGLES:
                yield from flush(parts)
                parts, at, held = fresh(), 0, 0
        if held:
            yield from flush(parts)

    return map_texts(docs.select("text"), run, "bucket long, low binary, owner binary, size binary, place binary")


_ENTRY = np.dtype([("key", "<u8"), ("token", "<u8"), ("size", "<u4"), ("df", "<u4")])


def _count_shared(table: pa.Table, dests: int) -> pa.Table:
    """Of one bucket, the (class, shingle) entries of shingles in two classes or
    more, packed by destination of the class."""
    bucket = table.column("bucket")[0].as_py() if table.num_rows else 0
    bytes_ = 6 if bucket < dests else 8
    token, key, size = [], [], []
    for low, owner, sizes, place in zip(*[table.column(c).to_pylist() for c in ("low", "owner", "size", "place")]):
        raw = np.frombuffer(low, np.uint8).reshape(-1, bytes_)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :bytes_] = raw
        token.append(wide.view("<u8").ravel())
        at = np.frombuffer(place, "<u2" if len(place) == 2 * len(raw) else "<u4")
        key.append(np.frombuffer(owner, "<u8")[at])
        size.append(np.frombuffer(sizes, "<u4")[at])
    token, key, size = np.concatenate(token), np.concatenate(key), np.concatenate(size)
    if bucket < dests:      # a hot shingle's other holders are elsewhere
        order = np.argsort(token)
        t = token[order]
        twin = np.zeros(len(t), bool)
        twin[1:] = t[1:] == t[:-1]
        twin[:-1] |= twin[1:]
        order = order[twin]
        token, key, size = token[order], key[order], size[order]
    order = np.lexsort((key, token))
    token, key, size = token[order], key[order], size[order]
    fresh = np.ones(len(token), bool)       # the same class from several tasks
    fresh[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
    token, key, size = token[fresh], key[fresh], size[fresh]
    head = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
    df = np.diff(np.append(head, len(token)))
    df = np.repeat(df, df) if bucket < dests else np.full(len(token), LAST)
    live = df >= 2
    entry = np.empty(int(live.sum()), _ENTRY)
    entry["key"], entry["size"], entry["df"] = key[live], size[live], df[live]
    entry["token"] = _tokens(token[live], np.full(1, bucket)) if bucket < dests else token
    dest = (mix(entry["key"]) % _U(dests)).astype(np.int64)
    order = np.lexsort((entry["key"], dest))
    entry, dest = entry[order], dest[order]
    cut = np.flatnonzero(np.diff(dest, prepend=-1))
    ends = np.append(cut[1:], len(dest))
    return pa.table({"dest": pa.array(dest[cut], pa.int64()),
                     "entries": pa.array([entry[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary())})


def _prefixes(table: pa.Table, percent: int) -> pa.Table:
    """The classes of one destination that may have a partner: sorted shared
    shingles, bitmap and tile shingles."""
    entry = np.concatenate([np.frombuffer(x, _ENTRY) for x in table.column("entries").to_pylist()])
    entry = entry[np.lexsort((entry["token"], entry["df"], entry["key"]))]
    cut = np.flatnonzero(np.append(True, entry["key"][1:] != entry["key"][:-1]))
    ends = np.append(cut[1:], len(entry))
    out = {k: [] for k in ("key", "size", "shared", "tokens", "bits", "prefix")}
    size = entry["size"][cut].astype(np.int64)
    length = size - (percent * size + 99) // 100 + 1
    rest = length - (size - (ends - cut))   # of the prefix, after the unshared ones
    for a, b, n, r in zip(cut[rest > 0], ends[rest > 0], size[rest > 0], rest[rest > 0]):
        token = entry["token"][a:b]
        bits = np.zeros(64 * MAP_WORDS, np.uint8)
        bits[(token % _U(64 * MAP_WORDS)).astype(np.int64)] = 1
        for k, v in (("key", int(entry["key"][a].astype(np.int64))), ("size", int(n)), ("shared", int(b - a)),
                     ("tokens", np.sort(token).tobytes()), ("bits", np.packbits(bits).tobytes()),
                     ("prefix", token[:r].astype(np.int64))):
            out[k].append(v)
    return pa.table({"key": pa.array(out["key"], pa.int64()), "size": pa.array(out["size"], pa.int64()),
                     "shared": pa.array(out["shared"], pa.int64()), "tokens": pa.array(out["tokens"], pa.binary()),
                     "bits": pa.array(out["bits"], pa.binary()), "prefix": pa.array(out["prefix"], pa.list_(pa.int64()))})


def shared_sets(docs: DataFrame, n_shingles: int, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(key, size, shared, tokens, bits, prefix) of the classes that may have a
    partner.  ``n_shingles``: shingles of all rows, which sets the buckets."""
    buckets = power_of_two(n_shingles / BUCKET_SHINGLES, 64)
    dealt = _deal(docs, words, buckets, hot_shingles(docs, words))
    entries = dealt.groupBy("bucket").applyInArrow(_freed(lambda t: _count_shared(t, buckets)), "dest long, entries binary")
    return entries.groupBy("dest").applyInArrow(
        _freed(lambda t: _prefixes(t, percent)), "key long, size long, shared long, tokens binary, bits binary, prefix array<long>")


def _freed(run):
    """A group's function that gives back its memory."""
    def each(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            give_back()

    return each


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of class keys whose sets reach the similarity."""
    side = lambda x: sets.select(F.col("key").alias(x), F.col("size").alias(f"size_{x}"), F.col("tokens").alias(f"tokens_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches):
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            total = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            hit = np.zeros(len(a), bool)
            for i, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())):
                both = np.concatenate([np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")])
                both.sort(kind="stable")    # merges two sorted runs
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                hit[i] = 100 * common >= percent * (int(total[i]) - common)
            yield pa.RecordBatch.from_arrays([pa.array(a[hit]), pa.array(b[hit])], names=["u", "v"])

    return map_texts(both.select("a", "b", "size_a", "size_b", "tokens_a", "tokens_b"), run, "u long, v long")


def _tiles(sets: DataFrame, percent: int) -> DataFrame:
    """(token, band, key, size, central): each class in the tiles of its own size
    band and of the next one.  ``central``: the share of its shingles that others
    have too; the text that others were made from has the most."""
    step = float(np.log(100 / percent))
    band = F.floor(F.log(F.col("size").cast("double")) / step + 1e-9)
    return (sets.select(F.explode("prefix").alias("token"), "key", "size", (F.col("shared") / F.col("size")).alias("central"))
            .select("token", F.explode(F.array(band, band + 1)).alias("band"), "key", "size", "central"))


def _with_components(tiles: DataFrame, comps: DataFrame) -> DataFrame:
    marked = tiles.join(comps, tiles["key"] == comps["node"], "left")
    return marked.withColumn("component", F.coalesce("component", "key")).drop("node")


def _lead_pairs(tiles: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each class with the leading class of one of its tiles, if that is of another
    component: first the most central one, in later turns one by a hash."""
    rank = F.col("central") if turn == 0 else F.xxhash64(F.lit(turn), "key").cast("double")
    lead = tiles.groupBy("token", "band").agg(F.max(F.struct(rank.alias("rank"), "key", "size", "component")).alias("lead"),
                                              F.min("component").alias("x"), F.max("component").alias("y"))
    joined = tiles.join(lead.where("x != y").select("token", "band", "lead"), ["token", "band"])
    near = (F.col("component") != F.col("lead.component")) & (100 * F.least("size", "lead.size") >= percent * F.greatest("size", "lead.size"))
    best = joined.where(near).groupBy(F.col("key").alias("a")).agg(F.max(F.struct("lead.rank", "lead.key")).alias("best"))
    return best.select("a", F.col("best.key").alias("b"))


def _tile_pairs(table: pa.Table, percent: int) -> pa.Table:
    """Pairs of classes in common tiles whose sizes and bitmaps allow the
    similarity and whose components differ."""
    col = lambda c: table.column(c).to_numpy()
    tile, blocks = col("tile"), col("blocks")
    order = np.lexsort((col("size"), col("key"), blocks, tile))
    tile, blocks, key, size, shared, comp, own = [x[order] for x in (tile, blocks, col("key"), col("size"), col("shared"), col("component"), col("block"))]
    bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), "<u8").reshape(-1, MAP_WORDS)[order]
    group = np.cumsum(np.append(0, (tile[1:] != tile[:-1]) | (blocks[1:] != blocks[:-1])))
    split = col("split")[order]
    found = []
    left = np.arange(max(0, len(key) - 1))
    step = 1
    while len(left):
        left = left[left + step < len(key)]
        left = left[group[left] == group[left + step]]
        i, j = left, left + step
        ok = comp[i] != comp[j]
        ok &= 100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])
        ok &= ~split[i] | (own[i] != own[j])    # blocks that meet others
        i, j = i[ok], j[ok]
        if len(i):
            x, y = bits[i], bits[j]
            most = np.minimum(shared[i] - np.bitwise_count(x & ~y).sum(1, dtype=np.int64),
                              shared[j] - np.bitwise_count(y & ~x).sum(1, dtype=np.int64))
            ok = (100 + percent) * most >= percent * (size[i] + size[j])
            found.append(np.stack([np.minimum(key[i], key[j])[ok], np.maximum(key[i], key[j])[ok]]))
        step += 1
    pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
    return pa.table({"a": pa.array(pairs[0], pa.int64()), "b": pa.array(pairs[1], pa.int64())})


def _other_pairs(marked: DataFrame, sets: DataFrame, percent: int, groups: int) -> DataFrame:
    """The candidate pairs left after the first links: between different
    components of a tile, through the bitmaps."""
    mixed = (marked.groupBy("token", "band").agg(F.count("*").alias("n"), F.min("component").alias("x"), F.max("component").alias("y"))
             .where("x != y").select("token", "band", F.ceil(F.col("n") / TILE_BLOCK).alias("nb")))
    member = (marked.join(mixed, ["token", "band"]).drop("size", "central")
              .withColumn("block", F.pmod(F.xxhash64("key"), F.col("nb")))
              # block b meets itself and every other block, each pair in its own group
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
              .select(F.xxhash64("token", "band").alias("tile"), "key", "component", "block",
                      (F.least("block", "other") * F.col("nb") + F.greatest("block", "other")).alias("blocks"),
                      (F.col("block") != F.col("other")).alias("split")))
    full = member.join(sets.select("key", "size", "shared", "bits"), "key")
    # A group that pairs block i with j != i holds both; 'split' tells it from a block by itself.
    spread = F.pmod(F.xxhash64("tile", "blocks"), F.lit(groups))
    return full.groupBy(spread.alias("part")).applyInArrow(_freed(lambda t: _tile_pairs(t, percent)), "a long, b long").distinct()


def class_links(docs: DataFrame, n_shingles: int, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Verified links (u, v) between classes, which give the components of all
    links; every similar pair of classes is joined by them."""
    sets = written(shared_sets(docs, n_shingles, words, percent), "sets")
    tiles = _tiles(sets, percent)
    links = None
    marked = tiles.withColumn("component", F.col("key"))
    for turn in range(LEADS):
        new, before = verified(_lead_pairs(marked, turn, percent), sets, percent), links
        links = written(new if before is None else before.union(new), "links")
        if before is not None:
            remove(before)
        marked = _with_components(tiles, components(links))
    groups = power_of_two(n_shingles / BUCKET_SHINGLES, 64)
    return written(links.union(verified(_other_pairs(marked, sets, percent, groups), sets, percent)), "links")


def _components(rows: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(class_key, component, component_id) of every class of ``rows``; a
    component is named after a class, its id is the least doc_id in it."""
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    comps = components(class_links(docs, total, words, percent))
    named = rows.where("class_key != 0").groupBy("class_key").agg(F.min("doc_id").alias("least"))
    named = named.join(comps, F.col("class_key") == F.col("node"), "left").withColumn("component", F.coalesce("component", "class_key"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return named.select("class_key", "component").join(least, "component")


def join_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs(doc_id, text)``."""
    rows = written(classes(docs, words), "classes")
    by_class = _components(rows, docs, words, percent).select("class_key", "component_id")
    # A class may hold a third of all rows: its row is repeated, its rows are dealt out.
    n = salts(docs)
    salted = by_class.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int"))
    joined = dealt.join(salted, ["class_key", "salt"], "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id"))).alias("component_id"))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row of the least
    doc_id (then the least class), and every row with the empty set."""
    fields = [T.StructField("__size", T.LongType()), T.StructField("__class", T.LongType())]
    marked = written(with_values(docs, _class_values(words), fields), "classes")
    rows = marked.select("doc_id", F.col("__size").alias("n_shingles"), F.col("__class").alias("class_key"))
    comps = _components(rows, marked, words, percent).select("class_key", "component")
    per_class = rows.where("class_key != 0").groupBy("class_key").agg(F.min("doc_id").alias("least"))
    first = per_class.join(comps, "class_key").groupBy("component").agg(
        F.min(F.struct(F.col("least").isNull(), F.col("least").alias("doc_id"), "class_key")).alias("first"))
    stay = first.select(F.col("first.doc_id").alias("stay_id"), F.col("first.class_key").alias("stay_key"))
    on = marked["__class"].eqNullSafe(stay["stay_key"]) & marked["doc_id"].eqNullSafe(stay["stay_id"])
    # Equal rows of one document: the first of them.
    nth = F.row_number().over(Window.partitionBy("__class", "doc_id").orderBy("text"))
    left = marked.where("__class != 0").join(stay, on, "left_semi").withColumn("__nth", nth).where("__nth = 1")
    return reading(left.select(*docs.columns).unionAll(marked.where("__class = 0").select(*docs.columns)), marked)
