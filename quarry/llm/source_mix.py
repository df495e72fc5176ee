"""Mixing sources to target weights by Sainte-Lague apportionment.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and
share ``share`` of all words; a target stops at ``most`` times its source's size
and the excess is shared again by weight.  Then blocks of ``BLOCK`` words are
apportioned: first to sources, each next block to the highest quotient
target / (2 k + 1), then each source's blocks to its shards (documents dealt by
a seeded hash, about ``SHARD`` words each) in the same way.  A shard with quota q
and n blocks is taken whole q div n times, and q mod n of its blocks, chosen by a
seeded hash, once more.  A document gives the words of its span in its shard.

Highest quotients are found by their threshold: sums over a ladder of divisors,
refined, give each group's divisor, and only quotients between the last two
rungs are ranked.  Nothing but the source table (a row per source) is ever
gathered in one place, and what shards choose meets their documents in the shuffle
that orders these, so nothing that grows with the corpus is broadcast.

Defined cases: null or empty texts have size 0 and give nothing; the null source
is a source of its own; repeated rows are separate documents, numbered, so that an id
which many rows share (or lack) is dealt over shards too; a source (or
table) without words has target 0; other columns play no part in the plan, and pass
through ``mixed``.  Reruns agree: hashes depend on the seed, ids, sizes, these
numbers and sources only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.scratch import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BLOCK = 64
SHARD = 256 * BLOCK
SEED = 20
RUNGS = 32
PASSES = 3


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, source_key, size, copy) per row; the key is never null, and
    ``copy`` numbers the rows that agree in the rest."""
    rows = docs.select("doc_id", "source", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")).alias("source_key"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    counted = rows.groupBy("doc_id", "source", "source_key", "size").agg(F.count("*").alias("rows"))
    return counted.select("doc_id", "source", "source_key", "size", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy"))


def targets(sized: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source_key, source_size, weight, target), a row per source."""
    per = sized.groupBy("source", "source_key").agg(F.sum("size").alias("source_size"))
    # One task, one row per source: the rank and the water level need their order.
    ranked = per.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1))
    cap = F.col("source_size") * F.lit(float(most))
    level = Window.orderBy(F.col("cap") / F.col("weight"), "source_key")
    upto, whole = level.rowsBetween(Window.unboundedPreceding, -1), level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spread = (ranked.withColumn("cap", cap)
              .withColumn("want", F.sum("source_size").over(whole) * F.lit(float(share)))
              .withColumn("filled", F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
              .withColumn("open", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
              # If this source and the later ones were all below their cap, their level would be:
              .withColumn("level", (F.col("want") - F.col("filled")) / F.col("open"))
              .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap")))
    water = F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), F.col("source_key"), F.col("level")))).over(whole)
    return spread.withColumn("water", water["level"]).select(
        "source_key", "source_size", "weight",
        F.when(F.col("water").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("water") * F.col("weight"))).alias("target"))


def apportion(cells: DataFrame, group: str, key: list[str]) -> DataFrame:
    """``cells`` with ``quota``: within each ``group``, ``house`` seats by highest
    quotients of ``votes`` / (2 k + 1), at most ``most`` seats each; ties go to
    the lower ``key``.  Columns needed: votes (double), house, most (long)."""
    def seats(d: Column) -> Column:
        return F.least(F.floor(F.col("votes") / d + 0.5), F.col("most"))

    live = cells.where("votes > 0")
    # Every seat count lies between these two divisors: sum - n/2 <= seats <= sum + n/2.
    span = live.groupBy(group).agg(F.sum("votes").alias("all"), F.count("*").alias("n"), F.max("votes").alias("top"), F.max("house").alias("h"))
    rungs = span.select(group, (F.col("all") / (F.col("h") + F.col("n") / 2 + 1)).alias("low"),
                        F.when(F.col("h") > F.col("n") / 2 + 1, F.col("all") / (F.col("h") - F.col("n") / 2 - 1))
                        .otherwise(F.col("top") * 4).alias("high"))
    rungs = written(rungs, "rungs")
    for _ in range(PASSES):
        ladder = [F.col("low") + (F.col("high") - F.col("low")) * (i / RUNGS) for i in range(RUNGS + 1)]
        counted = live.join(rungs, group).groupBy(group, "low", "high", "house").agg(
            F.array(*[F.sum(seats(d)) for d in ladder]).alias("given"))
        # The last rung that still gives at least the house (else the first).
        at = F.greatest(F.size(F.filter("given", lambda g: g >= F.col("house"))) - 1, F.lit(0))
        step = (F.col("high") - F.col("low")) / RUNGS
        at = F.least(at, F.lit(RUNGS - 1))
        rungs = written(counted.select(group, (F.col("low") + step * at).alias("low"), (F.col("low") + step * (at + 1)).alias("high")), "rungs")
    sure = live.join(rungs, group).withColumn("sure", seats(F.col("high"))).withColumn("more", seats(F.col("low")))
    left = sure.groupBy(group).agg((F.max("house") - F.sum("sure")).alias("left"))
    between = (sure.where("more > sure").select(group, *[k for k in key if k != group], "votes",
                                               F.explode(F.sequence(F.col("sure"), F.col("more") - 1)).alias("__seat"))
               .withColumn("quotient", F.col("votes") / (2 * F.col("__seat") + 1)))
    order = Window.partitionBy(group).orderBy(F.desc("quotient"), *key, "__seat")
    won = (between.withColumn("place", F.row_number().over(order)).join(left, group).where("place <= left")
           .groupBy(*key).agg(F.count("*").alias("won")))
    quota = sure.select(*key, "sure").join(won, key, "left").select(*key, (F.col("sure") + F.coalesce("won", F.lit(0))).alias("quota"))
    return cells.join(quota, key, "left").withColumn("quota", F.coalesce("quota", F.lit(0)).cast("long"))


def plan(sized: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, block: int = BLOCK,
         shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """``sized`` rows with source_size, target, taken, passes (whole copies) and
    spans (from, to: word places taken once more)."""
    aim = written(targets(sized, weights, share, most).withColumn("one", F.lit(0)), "targets")
    seat = written(apportion(aim.select("one", "source_key", "source_size", "target", F.col("target").alias("votes"),
                                        F.round(F.sum("target").over(Window.partitionBy("one")) / block).cast("long").alias("house"),
                                        F.lit(1 << 60).alias("most")), "one", ["source_key"])
                   .select("source_key", "source_size", "target", F.col("quota").alias("source_quota"),
                           F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard)).cast("long").alias("shards")), "quotas")
    dealt = sized.join(seat, "source_key").withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size", "copy"), F.col("shards")))
    cells = (dealt.groupBy("source_key", "shard", "source_quota").agg(F.sum("size").alias("words"))
             .withColumn("blocks", F.greatest(F.lit(1), F.round(F.col("words") / block)).cast("long"))
             .withColumn("votes", F.col("words").cast("double")).withColumn("most", F.ceil(2 * F.col("blocks")))
             .withColumnRenamed("source_quota", "house"))
    cells = written(apportion(written(cells, "cells"), "source_key", ["source_key", "shard"]), "shards")
    ranked = F.array_sort(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: F.struct(
        F.xxhash64(F.lit(seed), F.col("source_key"), F.col("shard"), j).alias("h"), j.alias("j"))))
    cells = cells.select("source_key", "shard", "words", "blocks", "quota",
                         F.expr("quota div blocks").alias("passes"),
                         F.when(F.col("quota") % F.col("blocks") > 0,
                                F.slice(ranked["j"], F.lit(1), (F.col("quota") % F.col("blocks")).cast("int")))
                         .otherwise(F.array().cast("array<long>")).alias("chosen"))
    order = Window.partitionBy("source_key", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id", "size", "copy"), "doc_id", "size", "copy")
    # The small file that the cells come from says nothing of their arrays: without the
    # hint Spark would broadcast them.
    placed = (dealt.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("at", F.col("end") - F.col("size")).join(cells.hint("merge"), ["source_key", "shard"]))
    # Block j holds words [j * words div blocks, (j + 1) * words div blocks).
    touched = placed.withColumn("hit", F.expr(
        "CASE WHEN size > 0 AND size(chosen) > 0 THEN array_intersect(sequence(greatest(0L, at * blocks div words - 1), "
        "least(blocks - 1, (end * blocks) div words + 1)), chosen) ELSE CAST(array() AS array<bigint>) END"))
    spans = F.expr("filter(transform(array_sort(hit), j -> struct(greatest(at, j * words div blocks) - at AS `from`, "
                   "least(end, (j + 1) * words div blocks) - at AS `to`)), s -> s.`to` > s.`from`)")
    out = touched.withColumn("spans", spans)
    return out.withColumn("taken", F.col("passes") * F.col("size") + F.aggregate(
        "spans", F.lit(0).cast("long"), lambda s, x: s + x["to"] - x["from"])).select(
        "doc_id", "source", "size", "copy", "source_size", "target", "taken", "shard", "passes", "spans")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: each taken whole ``passes`` times, and once
    more cut to its chosen spans (their words joined by a space)."""
    sized = written(sizes(docs), "sizes")
    parts = plan(sized, **options).where("taken > 0").select(
        F.col("doc_id").alias("plan_id"), F.col("source").alias("plan_source"), F.col("size").alias("plan_size"), "passes", "spans",
        F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy(F.desc("taken"), "spans")).alias("plan_copy"))
    same = Window.partitionBy("doc_id", "source", "size").orderBy("text")
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", "text",
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    rows = rows.withColumn("copy", F.row_number().over(same))
    on = (rows["doc_id"].eqNullSafe(parts["plan_id"]) & rows["source"].eqNullSafe(parts["plan_source"])
          & (rows["size"] == parts["plan_size"]) & (rows["copy"] == parts["plan_copy"]))
    joined = rows.join(parts, on)
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"))
    cut = F.when(F.size("spans") == 0, F.lit(None)).when(
        F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["to"] - x["from"]) == F.col("size"), F.col("text")).otherwise(
        F.array_join(F.flatten(F.transform("spans", lambda s: F.slice(words, (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int")))), " "))
    texts = F.concat(F.array_repeat(F.col("text"), F.col("passes").cast("int")), F.filter(F.array(cut), lambda x: x.isNotNull()))
    out = joined.select("row", F.explode(texts).alias("piece"))
    fresh = {"text": F.col("piece"), "n_chars": F.length("piece").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return out.select(*[fresh[c].alias(c) if c in fresh else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
