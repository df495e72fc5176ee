"""URL filters by hashed host-suffix and path-prefix expressions.

A rule is (verdict, host, path): it fits its host and all subdomains, if the
url's path starts with the rule's.  Each url is expanded into the expressions
``host suffix + path prefix`` that could be a rule: suffixes of as many labels,
and prefixes of as many characters, as some rule has.  Expressions meet rules by an
equi-join on the first four bytes of their SHA-256, a number; the full digest then
confirms, and among the rules that fit the longest wins (equally long: the one that
blocks).

Distinct (host, path) pairs are judged once, counted as they are made distinct.  A
place with more than one row in ``HOT`` is looked up by a broadcast of at most ``HOT``
rows; all others go through a shuffle, where a place then has at most that share.
Rules are broadcast behind a check of their size; beyond it expressions (of which every
place has the shortest) are dealt over parts, for each of which the rules are repeated.

Defined cases: a null url or one without ``://`` has an empty host and path and
gets the default; rules with a null or empty host fit nothing; repeated rules count
once; repeated pages each get their row; no rules: all get the default.  Columns named
host, path, rule or verdict are replaced; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.scratch import written
from quarry.operators.upsert import is_small, salts

HASH_PREFIX = 8     # hex digits (4 bytes) of the joined prefix
MOST_RULES = 1_000_000      # rules that are broadcast at most
#: A place with more than 1 / HOT of the rows is hot: at most HOT places are.
HOT = 4096


def _lower(c: Column) -> Column:
    """A-Z to a-z, other characters as they are."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    return _lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host_text: Column, path_text: Column) -> Column:
    # A host holds no '/', so the pair is told from its parts by the first one.
    return F.sha2(F.concat(host_text, F.lit("//"), path_text), 256)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, HASH_PREFIX), 16, 10).cast("long")


def _lengths(rules: DataFrame, of: Column) -> list[int]:
    """The distinct lengths that rules have: a few numbers, however many rules."""
    return sorted(r[0] for r in rules.select(of.alias("n")).distinct().collect())


def hashed_rules(rules: DataFrame) -> DataFrame:
    """``rules(verdict, host, path)`` with digest and digest prefix."""
    live = rules.select(F.lower("verdict").alias("rule_verdict"), _lower(F.col("host")).alias("rule_host"),
                        F.coalesce("path", F.lit("")).alias("rule_path")).where("rule_host != '' and rule_verdict in ('allow', 'block')")
    # The same expression twice: the blocking one stands.
    live = live.groupBy("rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict"))
    return live.withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path"))).withColumn("short", _short(F.col("digest")))


def expressions(places: DataFrame, labels: list[int], lengths: list[int]) -> DataFrame:
    """One row per (host, path) and expression, with its digest."""
    parts = F.split("host", r"\.")
    suffix = F.array(*[F.when(F.size(parts) >= n, F.array_join(F.slice(parts, -n, n) if n else F.array(), ".")) for n in labels])
    prefix = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths])
    out = places.select("host", "path", F.explode(F.filter(suffix, lambda x: x.isNotNull())).alias("suffix"))
    prefixes = F.filter(prefix, lambda x: x.isNotNull())
    out = out.select("host", "path", "suffix", F.explode(prefixes).alias("prefix"))
    return out.select("host", "path", _digest(F.col("suffix"), F.col("prefix")).alias("full")).withColumn("start", _short(F.col("full")))


def confirmed(found: DataFrame, hashed: DataFrame) -> DataFrame:
    """The rules that each expression's place fits: joined on the short prefix alone,
    then told by the full digest."""
    if is_small(hashed, MOST_RULES):
        met = found.join(F.broadcast(hashed), F.col("start") == F.col("short"))
    else:
        n = salts(found)
        dealt = found.withColumn("part", F.pmod(F.xxhash64("host", "path"), F.lit(n)).cast("int"))
        parts = hashed.withColumn("of_part", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        met = dealt.join(parts, (F.col("start") == F.col("short")) & (F.col("part") == F.col("of_part")))
    # Digests are of one length.  As an equality this would become a join key.
    return met.where(F.startswith("full", "digest"))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict."""
    hashed = written(hashed_rules(rules), "rules")
    labels = _lengths(hashed, F.size(F.split("rule_host", r"\.")))
    lengths = _lengths(hashed, F.length("rule_path"))
    taken = ("host", "path", "rule", "verdict")
    # Names of the input may clash with those added here, so it travels as a struct.
    row = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns if c not in taken]).alias("row"),
                       host(F.col(f"`{url}`")).alias("host"), path(F.col(f"`{url}`")).alias("path"))
    if not labels:
        return row.select("row.*", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    places = written(row.groupBy("host", "path").agg(F.count("*").alias("n")), "places")
    hits = confirmed(expressions(places.where("host != ''"), labels, lengths), hashed)
    rule = F.concat("rule_host", "rule_path")
    best = hits.groupBy("host", "path").agg(F.max(F.struct(F.length(rule).alias("size"), "rule_verdict", rule.alias("rule"))).alias("best"))
    judged = written(places.join(best, ["host", "path"], "left").select(
        F.col("host").alias("at_host"), F.col("path").alias("at_path"), "n", "best.rule", F.col("best.rule_verdict").alias("found")), "judged")
    total = judged.agg(F.sum("n")).first()[0] or 0
    here = (F.col("host") == F.col("at_host")) & (F.col("path") == F.col("at_path"))
    common = F.col("n") * HOT > F.lit(total)
    looked_up = row.join(F.broadcast(judged.where(common)), here, "left")
    rest = looked_up.where("n is null").select("row", "host", "path").join(judged.where(~common), here)
    both = looked_up.where("n is not null").unionByName(rest)
    return both.select("row.*", "host", "path", "rule", F.coalesce("found", F.lit(default)).alias("verdict"))
