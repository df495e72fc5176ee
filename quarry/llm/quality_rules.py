"""Quality rules with risk-controlled thresholds.

``measure`` adds word counts and rule values to documents in one numpy pass
over their whole texts.  ``fit`` picks the cutoffs of all rules of a stratum (language)
together, on a labelled holdout in two parts, dealt by a hash of the id:

1. the first part proposes: per rule the cutoff whose documents beyond it are most
   worth losing (each good one lost counting ``cost`` bad ones caught).  The rules, best
   first, each from its most lenient level down to that cutoff, make a chain of steps,
   each of which rejects what the steps before it do and a little more;
2. the second part certifies: the steps are tried in that order, and the trial goes on
   while the exact binomial test shows that at most ``risk`` of the good documents are
   rejected *by any rule* at that step.  The last step that passes gives the cutoffs.

Steps are tested in a fixed order, so one level serves a whole chain; it is
``delta`` over the number of strata (Bonferroni).  With a chance of 1 - ``delta`` every
stratum loses at most ``risk`` of its good documents (those that pass the base rule) to
all its rules together.  A stratum without enough labels gets no cutoff.
``judge`` applies the cutoffs.

The holdout is used through counts (per stratum, rule and level; per stratum and
step), so every labelled row takes part and the driver sees tables bounded by the
strata that have enough good labels to certify anything.

Defined cases: a null or empty text has no words and fails the base rule; a
null language is the stratum ''; several labels of one document count as the
lowest; labels of unknown documents and null labels are ignored; an empty table
gives an empty result.  Documents with equal ids are measured row by row.
Columns of the input with the name of a measure are replaced by it.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.scratch import remove, with_values, written
from quarry.llm.textkit import Words, repeated

#: The measures, in the order in which they are added.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_lower", "n_bangs")
SYMBOLS = b"#*$%&|<>"
LEVELS = 64

RISK = 0.01        # largest share of a stratum's good documents that its rules may reject
DELTA = 0.05       # chance that any of the guarantees fails
COST = 20          # bad documents that must be caught for each good one lost
PROPOSE = 3        # one labelled document in so many proposes, the others certify
SEED = 31


def measure_texts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The measures of some texts (UTF-8), each over the whole text."""
    w = Words(texts)
    out = {"n_words": w.count.astype(np.int64)}
    out["word_chars"] = w.in_docs(w.solid & ((w.buf & 0xC0) != 0x80))
    out["n_symbols"] = w.in_docs(np.isin(w.buf, np.frombuffer(SYMBOLS, np.uint8)))
    # Lines end at each \n and at the end of the text; those with a word count.
    stop = w.buf == 10
    stop[w.doc_end] = True
    end = np.flatnonzero(stop)
    start = np.concatenate([np.zeros(1, np.int64), end[:-1] + 1])
    solid = np.concatenate([np.zeros(1, np.int64), np.cumsum(w.solid, dtype=np.int64)])
    full = solid[end] > solid[start]
    start, end = start[full], end[full]
    line_doc = np.searchsorted(w.doc_end, end)
    out["n_lines"] = np.bincount(line_doc, minlength=w.n)
    pairs = np.stack([line_doc.astype(np.uint64), w.spans(start, end)], axis=1)
    distinct = np.unique(pairs, axis=0)[:, 0].astype(np.int64) if len(pairs) else np.zeros(0, np.int64)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(distinct, minlength=w.n)
    first, h = w.windows(5)
    twice = first[repeated(w.doc[first], h)]
    cover = np.zeros(len(w.start) + 6, np.int64)
    cover[twice] += 1
    cover[twice + 5] -= 1
    out["n_repeat_words"] = w.per_doc(np.cumsum(cover)[:len(w.start)] > 0, w.doc)
    out["n_upper"] = w.in_docs((w.buf >= 65) & (w.buf <= 90))
    out["n_lower"] = w.in_docs((w.buf >= 97) & (w.buf <= 122))
    out["n_bangs"] = w.in_docs(w.buf == 33)
    return {c: out[c].astype(np.int64) for c in COUNTS}


def measure(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the measures; needs ``text``."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in COUNTS]

    def values(texts: list[bytes]) -> list[np.ndarray]:
        found = measure_texts(texts)
        return [found[c] for c in COUNTS]

    source = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, "text"])])
    return with_values(source, values, [T.StructField(c, T.LongType()) for c in COUNTS]).select(*[F.col(f"`{c}`") for c in keep], *COUNTS)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _share(a: str, b: Column) -> Column:
    return F.when(b > 0, F.col(a) / b).otherwise(F.lit(0.0))


def rules() -> dict[str, Column]:
    """Rule name -> value from 0 (harmless) upwards; 1 and more are one level."""
    words = F.col("n_words")
    return {
        "symbols": _share("n_symbols", words),
        "repeats": _share("n_repeat_words", words),
        "same_lines": _share("n_dup_lines", F.col("n_lines")),
        "capitals": _share("n_upper", F.col("n_upper") + F.col("n_lower")),
        "bangs": _share("n_bangs", words),
        "long_words": _share("word_chars", words * 20),
        "short_words": _share("n_words", F.col("word_chars")),
    }


def _level(value: Column) -> Column:
    return F.least(F.floor(value * LEVELS), F.lit(LEVELS - 1)).cast("int")


def stratum() -> Column:
    return F.coalesce(F.col("lang"), F.lit(""))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of X ~ Binomial(n, p), summed exactly in logarithms."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
            + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def proposed(tables: dict[str, np.ndarray], cost: float = COST) -> list[tuple[str, int]]:
    """The rules of a stratum that are worth their loss, best first, each with its
    cutoff level, from (bad, good) counts by level per rule."""
    found = []
    for rule, (bad, good) in tables.items():
        gains = [float(bad[cut:].sum() - cost * good[cut:].sum()) for cut in range(1, LEVELS)]
        best = int(np.argmax(gains[::-1]))      # of equal gains the most lenient cutoff
        if gains[::-1][best] > 0:
            found.append((-gains[::-1][best], rule, LEVELS - 1 - best))
    return [(rule, cut) for _, rule, cut in sorted(found)]


def certified(chain: list[tuple[str, int]], lost: np.ndarray, n: int, level: float, risk: float = RISK) -> dict[str, int]:
    """The cutoffs of the last step that passes.  ``lost``: of the ``n`` good documents, how
    many each step is the first to reject."""
    cuts, total, at = {}, 0, 0
    for rule, cut in chain:
        for now in range(LEVELS - 1, cut - 1, -1):
            total += int(lost[at])
            if n == 0 or binomial_tail(total, n, risk) > level:
                return cuts
            cuts[rule], at = now, at + 1
    return cuts


def _by_stratum(df: DataFrame, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    """``df(stratum, ...)`` with a column ``<name>_<rule>`` for each value of ``rows``
    (stratum, rule, values...): a row per stratum that can certify something."""
    table = df.sparkSession.createDataFrame(rows, "of string, rule string, " + ", ".join(f"{n} int" for n in names))
    wide = table.groupBy("of").agg(*[F.max(F.when(F.col("rule") == r, F.col(n))).alias(f"{n}_{r}") for r in rules() for n in names])
    return df.join(F.broadcast(wide), F.col("stratum") == F.col("of"), "left").drop("of")


def fit(measured: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA,
        cost: float = COST) -> dict[tuple[str, str], int]:
    """Cutoffs by (stratum, rule), from the documents that ``labels`` covers
    and that pass the base rule."""
    marks = (labels.where("doc_id is not null and quality is not null")
             .groupBy(F.col("doc_id").alias("labelled_id")).agg((F.min("quality") > 0).alias("good")))
    names = list(rules())
    held = (measured.where(~base_failed()).select("doc_id", stratum().alias("stratum"), *[_level(v).alias(r) for r, v in rules().items()])
            .join(marks, F.col("doc_id") == F.col("labelled_id"))
            .withColumn("proposes", F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(PROPOSE)) == 0).drop("doc_id", "labelled_id"))
    held = written(held, "holdout")
    # Fewer good labels than this certify nothing, even without a loss.
    enough = math.log(delta) / math.log1p(-risk)
    good = {r["stratum"]: r["count"] for r in held.where("good and not proposes").groupBy("stratum").count().where(F.col("count") >= enough).collect()}
    cells = held.where("proposes").select("stratum", "good", F.explode(F.array(
        *[F.struct(F.lit(r).alias("rule"), F.col(r).alias("level")) for r in names])).alias("cell"))
    counts = cells.groupBy("stratum", "cell.rule", "cell.level", "good").count().where(F.col("stratum").isin(sorted(good)))
    tables: dict[str, dict[str, np.ndarray]] = {s: {r: np.zeros((2, LEVELS), np.int64) for r in names} for s in good}
    for row in counts.collect() if good else []:
        tables[row["stratum"]][row["rule"]][int(row["good"]), row["level"]] += row["count"]
    chains = {s: proposed(t, cost) for s, t in sorted(tables.items())}

    # The step that rejects a document first: each rule's levels follow those of the rules before it.
    places = []
    for s, chain in chains.items():
        at = 0
        for rule, cut in chain:
            places.append((s, rule, cut, at))
            at += LEVELS - cut
    found: dict[tuple[str, str], int] = {}
    if places:
        steps = [F.when(F.col(r) >= F.col(f"cut_{r}"), F.col(f"at_{r}") + LEVELS - 1 - F.col(r)) for r in names]
        first = _by_stratum(held.where("good and not proposes"), places, ("cut", "at")).withColumn("step", F.least(*steps))
        lost = {s: np.zeros(sum(LEVELS - c for _, c in chain), np.int64) for s, chain in chains.items()}
        for row in first.where("step is not null").groupBy("stratum", "step").count().collect():
            lost[row["stratum"]][row["step"]] += row["count"]
        for s, chain in chains.items():
            found |= {(s, r): c for r, c in certified(chain, lost[s], good[s], delta / len(chains), risk).items()}
    remove(held)
    return found


def judge(measured: DataFrame, cuts: dict[tuple[str, str], int]) -> DataFrame:
    """Adds ``base_failed``, ``failed_rules`` and ``kept``."""
    added = ("base_failed", "failed_rules", "kept")
    keep = [F.col(f"`{c}`") for c in measured.columns if c not in added]
    # The row travels as a struct beside the cutoffs, so that no names clash.
    row = measured.select(F.struct(*keep).alias("row"), stratum().alias("stratum"), F.coalesce(base_failed(), F.lit(True)).alias("base"),
                          *[_level(v).alias(r) for r, v in rules().items()])
    joined = _by_stratum(row, [(s, r, c) for (s, r), c in sorted(cuts.items())], ("cut",))
    failed = F.filter(F.array(*[F.when(F.col(r) >= F.col(f"cut_{r}"), F.lit(r)) for r in rules()]), lambda x: x.isNotNull())
    return joined.select("row.*", F.col("base").alias("base_failed"), failed.alias("failed_rules")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
