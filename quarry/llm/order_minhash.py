"""Document fingerprints: Order MinHash, in DataFrame functions only.

A text's k-mers are its runs of ``K`` words, each numbered by its occurrence
among equal ones, so that repeats count.  A hash of (k-mer, occurrence) deals them
to ``BINS`` bins; the ``L`` of a bin with the least hashes are put in their text
order, and that tuple's hash is the bin's sign.  Texts agree in a bin where
the same k-mers were chosen *and* stand in the same order, so the share of equal
bins falls with the edit distance and not only with the sets' overlap.

Hash and place share one 64-bit word (40 + 24 bits), so that selection is sorting
of plain arrays of longs.  A text's work is n log n; no rows are exploded.

Defined cases: a null text is an empty text, whose bins are all empty; a text with
fewer words than a k-mer has its whole sequence as its one k-mer; two texts
without any sign are alike (1.0); places beyond 2**24 words share the last place.
Rows with equal ids are ordered by text; null ids come last.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 3
L = 2
BIN_BITS = 5
BINS = 1 << BIN_BITS
PLACE_BITS = 24
_PLACE = (1 << PLACE_BITS) - 1
EMPTY = "-" * 8
SEPARATORS = r"[\x20\x09-\x0D]+"


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of column ``text`` (a string of 8 hex
    digits, or dashes, per bin)."""
    c = lambda x: f"__{name}_{x}"
    out = df.withColumn(c("words"), F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SEPARATORS), ""))
    words, n = F.col(c("words")), F.size(c("words"))
    place = lambda i: F.least(i.cast("long"), _long(_PLACE))
    # k-mers with their place in the low bits, sorted: equal ones meet, in text order.
    kmers = F.when(n >= K, F.transform(
        F.sequence(F.lit(0), n - K), lambda i: F.xxhash64(*[words[i + j] for j in range(K)]).bitwiseAND(_long(~_PLACE)).bitwiseOR(place(i)))
    ).when(n > 0, F.array(F.xxhash64(words).bitwiseAND(_long(~_PLACE)))).otherwise(F.array().cast("array<long>"))
    out = out.withColumn(c("kmers"), F.sort_array(kmers))
    kmer, m = F.col(c("kmers")), F.size(c("kmers"))
    kept = lambda x: F.shiftright(x, PLACE_BITS)
    starts = F.when(m > 0, F.filter(F.sequence(F.lit(0), m - 1), lambda i: (i == 0) | (kept(kmer[i]) != kept(kmer[F.greatest(i - 1, F.lit(0))]))))
    out = out.withColumn(c("starts"), starts)
    start = F.col(c("starts"))

    def numbered(x: Column, occurrence: Column) -> Column:
        return F.xxhash64(kept(x), occurrence).bitwiseAND(_long(~_PLACE)).bitwiseOR(x.bitwiseAND(_long(_PLACE)))

    runs = F.zip_with(start, F.concat(F.slice(start, F.lit(2), F.size(start)), F.array(m)), lambda a, b: F.transform(
        F.slice(kmer, a + 1, b - a), lambda x, o: numbered(x, o)))
    chosen = F.when(F.size(start) == m, F.transform(kmer, lambda x: numbered(x, F.lit(0)))).otherwise(F.flatten(runs))
    out = out.withColumn(c("sorted"), F.sort_array(F.coalesce(chosen, F.array().cast("array<long>"))))
    order = F.col(c("sorted"))
    bin_of = lambda x: F.shiftrightunsigned(x, 64 - BIN_BITS)
    # The L least of each bin: those whose L-th predecessor is in another bin.
    out = out.withColumn(c("least"), F.when(F.size(order) > 0, F.filter(
        order, lambda x, i: (i < L) | (bin_of(order[F.greatest(i - L, F.lit(0))]) != bin_of(x)))).otherwise(F.array().cast("array<long>")))
    least = F.col(c("least"))

    def sign(b: Column) -> Column:
        own = F.filter(least, lambda x: bin_of(x) == b)
        # In text order, then without the places.
        by_place = F.sort_array(F.transform(own, lambda x: F.shiftleft(x.bitwiseAND(_long(_PLACE)), 64 - PLACE_BITS)
                                            .bitwiseOR(F.shiftrightunsigned(x, PLACE_BITS))))
        tuple_hash = F.xxhash64(F.transform(by_place, lambda x: x.bitwiseAND(_long((1 << (64 - PLACE_BITS)) - 1))))
        return F.when(F.size(own) == 0, F.lit(EMPTY)).otherwise(F.substring(F.lpad(F.hex(tuple_hash), 16, "0"), 1, 8))

    signs = F.transform(F.array(*[_long(b) for b in range(BINS)]), sign)
    out = out.withColumn(name, F.when(F.size(least) > 0, F.array_join(signs, "")).otherwise(F.lit(EMPTY * BINS)))
    return out.drop(*[c(x) for x in ("words", "kmers", "starts", "sorted", "least")])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bins among those that either text fills (1.0 for none)."""
    places = F.sequence(F.lit(0), F.lit(BINS - 1))
    filled = F.size(F.filter(places, lambda i: (F.lit(EMPTY) != _sub(a, i)) | (F.lit(EMPTY) != _sub(b, i))))
    equal = F.size(F.filter(places, lambda i: (_sub(a, i) == _sub(b, i)) & (_sub(a, i) != F.lit(EMPTY))))
    return F.when(a == b, F.lit(1.0)).otherwise(equal / filled)


def _sub(s: Column, i: Column) -> Column:
    return F.substring(s, i * 8 + 1, F.lit(8))


def _buckets(key: Column, cuts: list[int]) -> Column:
    """How many of the descending ``cuts`` are above the key, found in two steps."""
    if not cuts:
        return F.lit(0)
    width = max(1, math.isqrt(len(cuts)))
    rows = [cuts[i:i + width] for i in range(0, len(cuts), width)]
    array = lambda xs: F.lit(xs) if xs else F.array().cast("array<long>")
    heads = array([r[-1] for r in rows])
    full = F.size(F.filter(heads, lambda x: x > key))
    rest = F.get(F.array(*[array(r) for r in rows]), full)
    return full * width + F.coalesce(F.when(full < len(rows), F.size(F.filter(rest, lambda x: x > key))), F.lit(0)).cast("int")


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with ``next_<c>`` of the next row in descending doc_id (after the
    last: the first), for each of ``columns``.

    Rows are dealt to ranges of ids; the first row of each range also visits the
    range before it, so no global window is needed.  The driver sees cuts only: a
    few ids per shuffle partition."""
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id").cast("long"), _long(-(1 << 63)))
    ids = docs.select(key.alias("k"))
    found = ids.agg(F.percentile_approx("k", [i / parts for i in range(1, parts)], 10 * parts)).first()[0] if parts > 1 else None
    cuts = sorted(set(found or []), reverse=True)
    bucket = _buckets(key, cuts)
    tops = sorted(((r["b"], r["top"]) for r in ids.groupBy(_buckets(F.col("k"), cuts).alias("b")).agg(F.max("k").alias("top")).collect()))
    # The first row of a range visits the range before; that of the first range, the last.
    visits = spark.createDataFrame([(top, tops[i - 1][0]) for i, (_, top) in enumerate(tops)], "top long, visited int")
    rows = docs.withColumn("__key", key).withColumn("__bucket", bucket)
    top_ids = [top for _, top in tops]
    visitors = (rows.where(F.col("__key").isin(top_ids)) if top_ids else rows.limit(0)).join(F.broadcast(visits), F.col("__key") == F.col("top"))
    visitors = visitors.withColumn("__bucket", F.col("visited")).drop("top", "visited").withColumn("__visitor", F.lit(1))
    both = rows.withColumn("__visitor", F.lit(0)).unionByName(visitors)
    order = Window.partitionBy("__bucket").orderBy("__visitor", F.desc("__key"), *columns)
    out = both.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return out.where("__visitor = 0").drop("__key", "__bucket", "__visitor")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """The fingerprints of all texts and of their edited texts."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    near = with_next(with_fingerprint(base, "text", "fingerprint"), ["text", "fingerprint"])
    tail = F.floor(F.length("text") / 3).cast("int")
    edited = near.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - tail),
                                                F.substring(F.col("next_text"), F.lit(1), tail))).drop("next_text")
    both = with_fingerprint(edited, "edited", "edited_fingerprint")
    return both.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
