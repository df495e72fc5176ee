"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or abstain on every document.  Expectation
maximisation over the counts of all vote patterns estimates each labeller's rates
of votes for good documents and for each kind of bad ones (a kind per labeller;
labellers are taken as independent given the kind) and the kinds' shares; a
pattern's posterior of being good is its documents' soft label.  A linear scorer over
hashed features of the text (words, their shapes and endings) is then trained on the
posteriors of a bounded sample, and scores every document whole.  No labels are read.

The patterns are counted over all documents; there are at most 3 ** labellers of
them.  The fit uses ``FIT_DOCS`` documents, the least by a hash.

Defined cases: null and empty texts have no words: the labellers that need words
abstain, the features are empty; without documents the result is empty; if all
documents vote alike the posterior is the prior and so is every score; repeated
rows are scored each; other columns play no part, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.quality_rules import measure_texts
from quarry.llm.scratch import map_texts, written
from quarry.llm.textkit import Words, chunks, mix

FIT_DOCS = 6000
DIMENSIONS = 1024
SEED = 5
KEEP = 0.5
ABSTAIN, BAD, GOOD = 0, 1, 2
#: Prior rates of votes (abstain, bad, good): of the labeller that a kind of bad
#: document is named after, of the others there, and for good documents; and how many
#: documents a prior is worth, for good ones and for a kind of bad ones, however many there are.
PRIOR_OWN, PRIOR_OTHER, PRIOR_GOOD = (0.05, 0.9, 0.05), (0.15, 0.15, 0.7), (0.1, 0.002, 0.898)
DOCS_GOOD, DOCS_BAD = 50, 10
#: A labeller calls at most so many good documents bad: what it calls bad more often is a
#: kind of bad ones.  This tells the good class from the others, which the votes alone don't.
MOST_WRONG = 0.01
_U = np.uint64


def _vote(value: np.ndarray, bad_from: float, good_to: float, able: np.ndarray) -> np.ndarray:
    """Bad from one bound on, good up to the other, else no vote."""
    return np.where(~able, ABSTAIN, np.where(value >= bad_from, BAD, np.where(value <= good_to, GOOD, ABSTAIN)))


def votes(m: dict[str, np.ndarray]) -> np.ndarray:
    """A row of votes per text, from its measures."""
    n = m["n_words"]
    some, words = n > 0, np.maximum(n, 1)
    length = m["word_chars"] / words
    columns = [
        _vote(m["n_symbols"] / words, 0.25, 0.03, some),
        _vote(m["n_repeat_words"] / words, 0.2, 0.02, some),
        _vote(m["n_dup_lines"] / np.maximum(m["n_lines"], 1), 0.3, 0.01, some & (m["n_lines"] > 1)),
        _vote(m["n_bangs"] / words, 0.25, 0.03, some),
        _vote(m["n_upper"] / np.maximum(m["n_upper"] + m["n_lower"], 1), 0.5, 0.15, some),
        np.where(n < 10, BAD, np.where(n >= 30, GOOD, ABSTAIN)),
        _vote(np.abs(length - 6), 4.5, 2.0, some),
    ]
    return np.stack(columns, axis=1).astype(np.int64)


LABELLERS = 7


def pattern(v: np.ndarray) -> np.ndarray:
    """A row of votes as one number."""
    return (v * 3 ** np.arange(v.shape[1])).sum(axis=1)


@dataclass
class LabelModel:
    """Truth is good (0) or one kind of bad per labeller (1, 2, ...)."""

    shares: np.ndarray      # of the kinds
    rates: np.ndarray       # [labeller, kind, vote]

    def kinds(self, v: np.ndarray) -> np.ndarray:
        log = np.tile(np.log(self.shares), (len(v), 1))
        for j in range(v.shape[1]):
            log += np.log(self.rates[j][:, v[:, j]]).T
        log -= log.max(axis=1, keepdims=True)
        p = np.exp(log)
        return p / p.sum(axis=1, keepdims=True)

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Of being good."""
        return self.kinds(v)[:, 0]


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation maximisation over vote rows and how often each occurs, begun
    with the documents that a labeller calls bad as of its kind."""
    j = patterns.shape[1]
    bad = patterns == BAD
    p = np.concatenate([np.where(bad.any(1), 0.1, 1.0)[:, None], 0.9 * bad / np.maximum(bad.sum(1), 1)[:, None]], axis=1)
    prior = np.array([[PRIOR_GOOD, *[PRIOR_OWN if k == i else PRIOR_OTHER for k in range(j)]] for i in range(j)])
    model = LabelModel(np.full(j + 1, 1 / (j + 1)), prior)
    for _ in range(rounds):
        weight = counts[:, None] * p
        shares = (weight.sum(0) + 1) / (counts.sum() + j + 1)
        rates = prior * np.where(np.arange(j + 1) == 0, DOCS_GOOD, DOCS_BAD)[None, :, None]
        for i in range(j):
            for kind in range(j + 1):
                rates[i, kind] += np.bincount(patterns[:, i], weights=weight[:, kind], minlength=3)
        rates /= rates.sum(axis=2, keepdims=True)
        over = np.maximum(0, rates[:, 0, BAD] - MOST_WRONG)
        rates[:, 0, BAD] -= over
        rates[:, 0, GOOD] += over
        model = LabelModel(shares, rates)
        new = model.kinds(patterns)
        if len(p) == 0 or np.abs(new - p).max() < 1e-9:
            break
        p = new
    return model


def features(texts: list[bytes], m: dict[str, np.ndarray]) -> np.ndarray:
    """Hashed features of some texts: root of the share of words by hash, by ending
    and by shape, and of words in repeated windows."""
    w = Words(texts)
    half, quarter = DIMENSIONS // 2, DIMENSIONS // 4
    out = np.zeros((w.n, DIMENSIONS), np.float32)
    size = np.minimum(w.end - w.start, 15).astype(_U)
    first, last = w.buf[w.start].astype(_U), w.buf[np.maximum(w.end - 1, 0)].astype(_U)
    kind = lambda b: np.where(b >= 128, 4, np.where((b >= 97) & (b <= 122), 1, np.where((b >= 65) & (b <= 90), 2, np.where((b >= 48) & (b <= 57), 3, b)))).astype(_U)
    middle = w.buf[(w.start + w.end) // 2].astype(_U)
    shape = mix(size * _U(1 << 24) + kind(first) * _U(1 << 16) + kind(middle) * _U(1 << 8) + kind(last))
    for code, base, width in ((w.hash, 0, half), (mix(last + _U(999)), half, quarter), (shape, half + quarter, quarter - 1)):
        cell = w.doc.astype(np.int64) * width + (code % _U(width)).astype(np.int64)
        out[:, base:base + width] += np.bincount(cell, minlength=w.n * width).reshape(w.n, width)
    out[:, -1] = m["n_repeat_words"]
    return np.sqrt(out / np.maximum(w.count, 1)[:, None])


def _parts(batches, text="__text"):
    for rows, texts in chunks(batches, text):
        for a in range(0, len(texts), 2000):
            yield rows.slice(a, 2000), texts[a:a + 2000]


def voted(docs: DataFrame, share: float, seed: int = SEED) -> DataFrame:
    """(pattern, order, vector): every document's votes; the features only of
    those whose hash lies in the first ``share`` of all."""
    source = docs.select(F.xxhash64(F.lit(seed), "doc_id", "text").alias("order"), F.col("text").alias("__text"))
    cut = int(min(1.0, share) * 2 ** 64) - 2 ** 63

    def run(batches):
        for rows, texts in _parts(batches):
            m = measure_texts(texts)
            order = rows.column(0).to_numpy()
            chosen = order < cut
            x = features([t for t, c in zip(texts, chosen) if c], {k: v[chosen] for k, v in m.items()}) if chosen.any() else None
            vectors = iter(x.astype(np.float16)) if x is not None else None
            yield pa.RecordBatch.from_arrays([pa.array(pattern(votes(m))), pa.array(order),
                                              pa.array([next(vectors).tobytes() if c else None for c in chosen], pa.binary())],
                                             names=["pattern", "order", "vector"])

    return map_texts(source, run, "pattern long, order long, vector binary")


def _rows_of(codes: np.ndarray) -> np.ndarray:
    return (codes[:, None] // 3 ** np.arange(LABELLERS)) % 3


def train_linear(x: np.ndarray, p: np.ndarray, rounds: int = 300, shrink: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by accelerated descent; both classes
    weigh alike."""
    if not len(x):
        return np.zeros(DIMENSIONS), 0.0
    x1 = np.hstack([x.astype(np.float64), np.ones((len(x), 1))])
    good, bad = p.sum(), (1 - p).sum()
    weight = p / max(good, 1e-9) + (1 - p) / max(bad, 1e-9)
    if good < 1 or bad < 1:
        weight = np.full(len(x), 1 / len(x))
    weight /= weight.sum()
    step = 1 / (0.25 * np.linalg.norm(x1 * np.sqrt(weight)[:, None], 2) ** 2 + shrink)
    w = v = np.zeros(x1.shape[1])
    for t in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x1 @ v, -30, 30)))
        new = v - step * (x1.T @ (weight * (q - p)) + shrink * v)
        v = new + t / (t + 3) * (new - w)
        w = new
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, seed: int = SEED) -> tuple[LabelModel, np.ndarray, float]:
    total = docs.count()
    seen = written(voted(docs, 2.0 * fit_docs / max(1, total), seed), "votes")
    counted = sorted((r["pattern"], r["count"]) for r in seen.groupBy("pattern").count().collect())
    codes = np.array([c for c, _ in counted], np.int64)
    model = estimate(_rows_of(codes), np.array([n for _, n in counted], np.float64))
    # The bounded sample: its vectors, a fixed number of bytes each.
    picked = seen.where("vector is not null").orderBy("order", "pattern").limit(fit_docs).select("pattern", "vector").collect()
    x = np.stack([np.frombuffer(r["vector"], np.float16) for r in picked]).astype(np.float32) if picked else np.zeros((0, DIMENSIONS), np.float32)
    p = model.posterior(_rows_of(np.array([r["pattern"] for r in picked], np.int64))) if picked else np.zeros(0)
    return model, *train_linear(x, p)


def scored(docs: DataFrame, fitted: tuple[LabelModel, np.ndarray, float], keep: tuple[str, ...] = ("doc_id",), least: float = KEEP) -> DataFrame:
    """``keep``, weak_label (the posterior), score and kept of every document."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("weak_label", T.DoubleType()), T.StructField("score", T.DoubleType()),
                                                            T.StructField("kept", T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(fitted)   # some thousand numbers

    def run(batches):
        model, w, b = shared.value
        for rows, texts in _parts(batches):
            m = measure_texts(texts)
            score = 1 / (1 + np.exp(-np.clip(features(texts, m) @ w + b, -30, 30)))
            yield pa.RecordBatch.from_arrays([*rows.columns[:len(keep)], pa.array(model.posterior(votes(m))), pa.array(score), pa.array(score >= least)],
                                             names=[*keep, "weak_label", "score", "kept"])

    return map_texts(docs.select(*keep, docs["text"].alias("__text")), run, schema)
