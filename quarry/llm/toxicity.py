"""Toxicity: a subsequence string-kernel SVM with Nystroem landmarks.

Kernel: for strings of symbols, phi_u(x) is the sum of ``DECAY`` ** span over the
occurrences, gaps allowed up to ``SPAN``, of each triple u as a subsequence of
x; K(x, t) = <phi(x), phi(t)> / (g(|x|) g(|t|)), g a fixed scale by length.  An
insult with inserted, dropped or exchanged characters still shares most triples.

Symbols are letters (white space ends a word, but not between single letters, so
that spaced-out words hold together; characters that are no letters are skipped)
and a mark at the start of each word, a letter class of its own: many insults are
told from harmless words by how a word begins.  Units are windows of ``WINDOW``
symbols within words; a word is as toxic as its worst window.

Training, on a bounded sample of labelled documents (their texts stay in the
tasks): the runs of symbols, at the start of words or anywhere, that tell toxic
documents from others best are witnesses; toxic landmarks are windows of witnesses,
chosen by pivoted Cholesky (each the window that the ones before explain least, by
how often it occurs), so that common insults don't crowd out the others; windows are
mapped by the Nystroem method (K_LL ** -1/2) and a linear SVM is fitted, with hard
negatives mined from the clean documents twice.  As the decision function is linear
in phi, it is kept as one weight per triple, which gives the same margins without
visiting the landmarks.  A document has two values: its worst word's margin and the
logarithm of the share of its words that are toxic (each by its margin, cut to
0..1), so that one harmless look-alike in a long text weighs little.  A logistic fit
of both, classes weighed as they are in all labelled documents, gives the score.

Labels, language, source and id are no inputs of a score.

Defined cases: a null or empty text, or one without a window, gets the margin of
an empty window; several labels of one document count as the highest; labels of
unknown documents and null labels are ignored; without both classes in the sample
every score is the share of toxic labels (0 without labels); repeated rows are
scored each; an empty table gives an empty result.  A column of ``docs`` named as
the score is replaced by it; other columns are kept and play no part.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.scratch import map_texts, remove, small_batches, with_values, written
from quarry.llm.textkit import chunks, mix

DECAY = 0.7
SPAN = 5            # largest distance from the first to the last letter of a triple
WINDOW = 9
FIT_DOCS = 2000     # labelled documents of each class that the fit uses at most
FIT_WINDOWS = 800   # windows of witnesses at most; four times as many of others
LANDMARKS = 96      # of each class
SEED = 7
THRESHOLD = 0.7
TELLING = 2.0       # log odds beyond which a run of letters is a witness

START = 63          # the class of a word's start
RUNS = (4, 5, 6, 7) # lengths, with the mark, of the runs at a word's start

#: Letter classes: a-z without case, and the bytes of other letters by their low bits.
_CLASS = np.zeros(256, np.int32)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[65:91] = np.arange(1, 27)
_CLASS[128:] = 27 + (np.arange(128) & 31)
_GAPS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN) if a + b <= SPAN]


def _scale() -> np.ndarray:
    """g by the number of letters of a window."""
    out = np.ones(WINDOW + 1)
    for n in range(3, WINDOW + 1):
        out[n] = np.sqrt(sum(DECAY ** (2 * (a + b)) * (n - a - b) for a, b in _GAPS if n > a + b))
    return out


SCALE = _scale()


class Letters:
    """The symbols of some texts: class, place in ``buf``, word and text of each."""

    def __init__(self, texts: list[bytes]):
        self.n = len(texts)
        joined = b"\n\n".join(texts) + b"\n\n"
        buf = np.frombuffer(joined, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, self.n)
        self.doc_end = np.cumsum(sizes + 2) - 2
        blank = (buf == 32) | ((buf >= 9) & (buf <= 13))
        cls = _CLASS[buf]
        # A blank between two single characters does not end a word.
        lone = np.zeros(len(buf), bool)
        lone[1:-1] = ~blank[1:-1] & blank[:-2] & blank[2:]
        if self.n and not blank[0] and len(blank) > 1:
            lone[0] = blank[1]
        joins = np.zeros(len(buf), bool)
        joins[1:-1] = (buf[1:-1] == 32) & lone[:-2] & lone[2:]
        word = np.cumsum(blank & ~joins, dtype=np.int32)
        at = np.flatnonzero(cls).astype(np.int32)
        word = word[at]
        head = np.append(True, word[1:] != word[:-1])[:len(at)]
        # Each word's symbols: its mark, at its first letter's place, and its letters.
        own = np.arange(len(at), dtype=np.int32) + np.cumsum(head, dtype=np.int32)
        m = len(at) + int(head.sum())
        self.heads = own[head] - 1
        self.cls = np.full(m, START, np.int32)
        self.cls[own] = cls[at]
        self.at = np.empty(m, np.int32)
        self.at[own], self.at[self.heads] = at, at[head]
        # Symbols left in the word from each one on.
        ends = np.append(self.heads[1:], m)[:len(self.heads)].astype(np.int32)
        self.left = np.repeat(ends, ends - self.heads) - np.arange(m, dtype=np.int32)
        self.head_doc = np.searchsorted(self.doc_end, self.at[self.heads])

    def doc(self, symbol: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_end, self.at[symbol])


def margins(letters: Letters, weight: np.ndarray) -> np.ndarray:
    """<weight, phi> / g of the window that begins at each symbol."""
    m = len(letters.cls)
    size = np.minimum(letters.left, WINDOW)
    total = np.zeros(m, np.float32)
    c = letters.cls
    place = np.arange(m)
    for span in range(2, SPAN + 1):
        each = np.zeros(m + 1, np.float64)
        inside = letters.left > span
        n = m - span
        if n <= 0:
            break
        got = np.zeros(n, np.float32)
        for a in range(1, span):
            got += weight[(c[:n] << 12) | (c[a:n + a] << 6) | c[span:]]
        each[1:n + 1] = got * inside[:n] * np.float32(DECAY ** span)
        each[n + 1:] = 0
        sums = np.cumsum(each)
        # Triples of this span that begin and end within the window.
        ends = np.maximum(place, place + size - span)
        total += (sums[ends] - sums[:m]).astype(np.float32)
    return total / SCALE[size].astype(np.float32)


def word_margins(letters: Letters, weight: np.ndarray, bias: float) -> np.ndarray:
    """The largest margin of each word's windows."""
    if not len(letters.heads):
        return np.zeros(0)
    return np.maximum(np.maximum.reduceat(margins(letters, weight), letters.heads) + bias, bias)


def values(texts: list[bytes], weight: np.ndarray, bias: float) -> np.ndarray:
    """(worst margin, log share of toxic words) of each text."""
    letters = Letters(texts)
    word = word_margins(letters, weight, bias)
    worst = np.full(letters.n, bias, np.float64)
    np.maximum.at(worst, letters.head_doc, word)
    n = np.bincount(letters.head_doc, minlength=letters.n)
    mass = np.bincount(letters.head_doc, weights=np.clip(word, 0, 1), minlength=letters.n)
    return np.column_stack([np.clip(worst, -3, 3), np.log((mass + 0.5) / (n + 50.0))])


def phi(windows: list[bytes], codes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """phi / g of windows (rows; a byte is a symbol) over triple codes (columns):
    those given, else all that occur."""
    c = np.zeros((len(windows), WINDOW), np.int32)
    for i, w in enumerate(windows):
        c[i, :len(w)] = np.frombuffer(w, np.uint8)
    found = []
    for a, b in _GAPS:
        x, y, z = c[:, :WINDOW - a - b], c[:, a:WINDOW - b], c[:, a + b:]
        rows, first = np.nonzero(z)
        found.append((rows, (x[rows, first] << 12) | (y[rows, first] << 6) | z[rows, first], np.full(len(rows), DECAY ** (a + b), np.float32)))
    rows, cols, vals = (np.concatenate(x) for x in zip(*found))
    if codes is None:
        codes = np.unique(cols)
    matrix = np.zeros((len(windows), max(1, len(codes))), np.float32)
    if len(codes):
        place = np.minimum(np.searchsorted(codes, cols), len(codes) - 1)
        own = codes[place] == cols
        np.add.at(matrix, (rows[own], place[own]), vals[own])
    return matrix / SCALE[(c > 0).sum(1)][:, None].astype(np.float32), codes


def central(windows: list[bytes], often: np.ndarray, n: int) -> list[int]:
    """Up to n windows by pivoted Cholesky of their kernel: each is the one whose
    remainder, times how often it occurs, is largest."""
    x = phi(windows)[0].astype(np.float64)
    rest, chosen, basis = (x * x).sum(1), [], []
    for _ in range(min(n, len(windows))):
        i = int(np.argmax(rest * often))
        if rest[i] < 1e-6:
            break
        v = x @ x[i]
        for u in basis:
            v = v - u * u[i]
        v = v / np.sqrt(rest[i])
        basis.append(v)
        chosen.append(i)
        rest = np.maximum(rest - v * v, 0)
        rest[i] = 0
    return chosen


@dataclass
class Model:
    weight: np.ndarray      # by triple code
    bias: float
    slopes: np.ndarray      # of the two values of a document
    offset: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        margin = values(texts, self.weight, self.bias) @ self.slopes + self.offset
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _svm(x: np.ndarray, y: np.ndarray, times: np.ndarray, rounds: int = 400, c: float = 400.0) -> tuple[np.ndarray, float]:
    """Linear SVM (squared hinge) by accelerated descent; classes weigh alike, and
    rows within a class by ``times``."""
    x1 = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    share = np.where(y > 0, times / max(1, times[y > 0].sum()), times / max(1, times[y < 0].sum())) * c / 2
    step = 1 / (1 + 2 * np.linalg.norm(x1 * np.sqrt(share)[:, None], 2) ** 2)
    w = v = np.zeros(x1.shape[1])
    reg = np.append(np.ones(x.shape[1]), 0.0)
    for t in range(rounds):
        slack = np.maximum(0, 1 - y * (x1 @ v))
        new = v - step * (reg * v - 2 * x1.T @ (share * y * slack))
        v = new + t / (t + 3) * (new - w)
        w = new
    return w[:-1], float(w[-1])


def _grams(letters: Letters) -> tuple[np.ndarray, np.ndarray]:
    """(first symbol, code) of runs within words: of four symbols anywhere, and of
    each length in ``RUNS`` from the start of a word."""
    c = letters.cls.astype(np.int64)
    first = np.flatnonzero(letters.left >= 4)
    found = [(first, (c[first] << 18) | (c[first + 1] << 12) | (c[first + 2] << 6) | c[first + 3])]
    for n in RUNS[1:]:
        head = letters.heads[letters.left[letters.heads] >= n]
        code = np.full(len(head), n, np.int64)
        for j in range(n):
            code = (code << 6) | c[head + j]
        found.append((head, code))
    return tuple(np.concatenate(x) for x in zip(*found))


def _window(letters: Letters, i: int) -> bytes:
    """The window that begins at symbol i, a byte per symbol."""
    return letters.cls[i:i + min(int(letters.left[i]), WINDOW)].astype(np.uint8).tobytes()


def _mapped(sample: DataFrame, run, schema: str) -> DataFrame:
    """``run(draws, toxic, letters)`` of each chunk of the sample, in tasks."""
    def each(batches):
        for rows, texts in chunks(batches):
            draw, toxic = (rows.column(rows.schema.get_field_index(c)).to_numpy() for c in ("draw", "label"))
            columns = run(draw.view(np.uint64), toxic > 0, Letters(texts))
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    names = [c.split()[0] for c in schema.split(", ")]
    return map_texts(sample, each, schema)


def _telling(sample: DataFrame, n1: int, n0: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs that tell toxic documents from others, and their log odds: by the
    documents that hold a run, or by those that hold it twice, whichever tell more."""
    def run(draw, toxic, letters):
        first, code = _grams(letters)
        codes, place = np.unique(code, return_inverse=True)
        n = max(1, len(codes))
        pairs, times = np.unique(letters.doc(first) * n + place, return_counts=True)
        bad, run_ = toxic[pairs // n], pairs % n
        count = lambda mask: np.bincount(run_[mask], minlength=len(codes))
        return codes, count(bad), count(~bad), count(bad & (times > 1)), count(~bad & (times > 1))

    names = ("pos", "neg", "pos2", "neg2")
    counts = _mapped(sample, run, "code long, " + ", ".join(f"{c} long" for c in names)).groupBy("code").agg(*[F.sum(c).alias(c) for c in names])

    def odds(pos: str, neg: str):
        # A low estimate of the share of toxic documents against a high one of clean ones.
        low = F.greatest(F.col(pos) - 1.5 * F.sqrt(pos), F.lit(1e-3)) / n1
        return F.log(low) - F.log((F.col(neg) + 1.5 * F.sqrt(neg) + 1) / n0)

    got = counts.select("code", F.greatest(odds("pos", "neg"), odds("pos2", "neg2")).alias("odds")).where(F.col("odds") > TELLING)
    got = got.toArrow().sort_by("code")
    return got.column("code").to_numpy(), got.column("odds").to_numpy()


def _witnesses(sample: DataFrame, codes: np.ndarray, odds: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """In each toxic document, the windows around its most telling runs; the
    commonest of them and how often they occur."""
    shared = sample.sparkSession.sparkContext.broadcast((codes, odds))

    def run(draw, toxic, letters):
        codes, odds = shared.value
        first, code = _grams(letters)
        place = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        value = np.where(codes[place] == code, odds[place], -np.inf)
        doc = letters.doc(first)
        best = np.full(letters.n, -np.inf)
        np.maximum.at(best, doc, value)
        telling = np.flatnonzero(toxic[doc] & (value > TELLING) & (value > best[doc] - 1.0))
        word = letters.heads[np.searchsorted(letters.heads, first[telling], "right") - 1] if len(telling) else first[:0]
        begin = np.unique(np.maximum(word, first[telling] - 2))
        times = Counter(_window(letters, i) for i in begin)
        return list(times), list(times.values())

    got = (_mapped(sample, run, "window binary, n long").groupBy("window").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "window").limit(FIT_WINDOWS).collect())
    return [bytes(r["window"]) for r in got], np.sqrt([r["n"] for r in got])


def _clean_windows(sample: DataFrame) -> set[bytes]:
    """Windows of the clean documents, drawn by a hash of document and place."""
    def run(draw, toxic, letters):
        at = np.flatnonzero(letters.left >= 3)
        doc = letters.doc(at)
        at, doc = at[~toxic[doc]], doc[~toxic[doc]]
        drawn = (mix(draw[doc] + (letters.doc_end[doc] - letters.at[at]).astype(np.uint64)) >> np.uint64(1)).astype(np.int64)
        least = np.argsort(drawn, kind="stable")[:4 * FIT_WINDOWS]
        return drawn[least], [_window(letters, i) for i in at[least]]

    got = _mapped(sample, run, "drawn long, window binary").orderBy("drawn", "window").limit(4 * FIT_WINDOWS).collect()
    return {bytes(r["window"]) for r in got}


def _hard_windows(sample: DataFrame, weight: np.ndarray, bias: float) -> set[bytes]:
    """The worst windows of the clean documents, at most one of each."""
    shared = sample.sparkSession.sparkContext.broadcast(weight)

    def run(draw, toxic, letters):
        if not len(letters.cls):
            return [], []
        value = margins(letters, shared.value) + bias
        doc = np.searchsorted(letters.doc_end, letters.at)
        order = np.lexsort((-value, doc))
        head = order[np.append(True, doc[order][1:] != doc[order][:-1])]
        head = head[~toxic[doc[head]]]
        return value[head].astype(np.float64), [_window(letters, i) for i in head]

    got = _mapped(sample, run, "value double, window binary").orderBy(F.desc("value"), "window").limit(FIT_WINDOWS).collect()
    return {bytes(r["window"]) for r in got}


def _values_of(sample: DataFrame, weight: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each sampled document's values, label and weight: at most 2 * ``FIT_DOCS`` rows."""
    shared = sample.sparkSession.sparkContext.broadcast(weight)

    def run(batches):
        for rows, texts in chunks(batches):
            v = values(texts, shared.value, bias)
            yield pa.RecordBatch.from_arrays([pa.array(v[:, 0]), pa.array(v[:, 1]), *[rows.column(rows.schema.get_field_index(c)) for c in ("label", "stands")]],
                                             names=["worst", "share", "label", "stands"])

    got = map_texts(sample, run, "worst double, share double, label int, stands double").toArrow()
    got = got.sort_by([(c, "ascending") for c in ("label", "worst", "share")])
    worst, share, label, stands = (got.column(i).to_numpy() for i in range(4))
    return np.column_stack([worst, share]), label.astype(np.int64), stands


def train(sample: DataFrame, seed: int = SEED) -> Model:
    """Fits the model on ``sample(draw, label, stands, text)``.  Tasks hold the texts; the
    driver gets counts, the chosen windows and two values of each document."""
    blank = np.zeros(1 << 18, np.float32)
    size = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    base = n1 / max(1, n1 + n0)
    if not n1 or not n0:
        level = np.log((base + 1e-9) / (1 - base + 1e-9))
        return Model(blank, 0.0, np.zeros(2), float(level))
    rng = np.random.default_rng(seed)
    codes, odds = _telling(sample, n1, n0)
    positive, often = _witnesses(sample, codes, odds) if len(codes) else ([], np.zeros(0))
    if not positive:
        return Model(blank, 0.0, np.zeros(2), float(np.log(base / (1 - base))))
    first = central(positive, often, LANDMARKS)
    negative = sorted(_clean_windows(sample) - set(positive))
    for turn in range(3):
        if turn:    # hard negatives
            negative = sorted(set(negative) | (_hard_windows(sample, weight, bias) - set(positive)))
        windows = positive + negative
        y = np.append(np.ones(len(positive)), -np.ones(len(negative)))
        marks = np.append(first, len(positive) + rng.choice(len(negative), min(LANDMARKS, len(negative)), replace=False)).astype(int)
        land, codes = phi([windows[i] for i in marks])
        x = phi(windows, codes)[0]
        roots, vectors = np.linalg.eigh(land @ land.T + 1e-4 * np.eye(len(marks)))
        root = vectors / np.sqrt(np.maximum(roots, 1e-4))
        w, bias = _svm((x @ land.T) @ root, y, np.append(often, np.ones(len(negative))))
        weight = blank.copy()
        weight[codes] = land.T @ (root @ w)
    slopes, offset = _logistic(*_values_of(sample, weight, bias))
    return Model(weight, bias, slopes, offset)


def _logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, float]:
    """Weighted logistic fit of labels on some values, by damped Newton steps with a
    little shrinkage."""
    middle, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - middle) / scale, np.ones(len(x))])
    ridge = np.append(np.full(x.shape[1], 0.5), 1e-6)
    loss = lambda w: (times * np.logaddexp(0, -(2 * y - 1) * (z @ w))).sum() + (ridge * w * w).sum() / 2
    w = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (times * (p - y)) + ridge * w
        h = (z * (times * (p * (1 - p) + 1e-9))[:, None]).T @ z + np.diag(ridge)
        d, step = np.linalg.solve(h, g), 1.0
        while step > 1e-4 and loss(w - step * d) > loss(w):
            step /= 2
        w = w - step * d
        if np.abs(step * d).max() < 1e-8:
            break
    slopes = w[:-1] / scale
    return slopes, float(w[-1] - slopes @ middle)


def sample(docs: DataFrame, labels: DataFrame, per_class: int = FIT_DOCS, only=None) -> DataFrame:
    """(draw, label, stands, text) of at most ``per_class`` labelled documents of each
    class, the least by hash among those of ``docs``; a document of several rows has
    one of them, the least.  ``stands`` is how many labelled documents it stands for."""
    marks = labels.where("doc_id is not null and toxic is not null")
    if only is not None:
        marks = marks.where(only)
    marks = marks.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("label"))
    marks = marks.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    marks = written(marks.select(F.col("doc_id").alias("labelled_id"), "label", F.xxhash64(F.lit(SEED), "doc_id").alias("draw")), "labelled")
    size = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    chosen = [marks.where(F.col("label") == c).orderBy("draw", "labelled_id").limit(per_class)
              .withColumn("stands", F.lit(max(1.0, size.get(c, 0) / per_class))) for c in (0, 1)]
    # At most 2 * per_class rows of four numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen[0].union(chosen[1])), F.col("doc_id") == F.col("labelled_id"))
    one = rows.groupBy("labelled_id", "draw", "label", "stands").agg(F.min("text").alias("text"))
    return written(one.select("draw", "label", "stands", "text"), "sample")


def fit(docs: DataFrame, labels: DataFrame, only=None, per_class: int = FIT_DOCS) -> Model:
    some = sample(docs, labels, per_class, only)
    with small_batches(docs.sparkSession):
        model = train(some)
    remove(some)
    return model


def scored(docs: DataFrame, model: Model, keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """``docs`` (or its columns ``keep``) with the score of each whole text."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != name]
    shared = docs.sparkSession.sparkContext.broadcast(model)    # one weight per triple code
    source = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, "text"])])
    found = with_values(source, lambda texts: [shared.value.score(texts)], [T.StructField(name, T.DoubleType())])
    return found.select(*[F.col(f"`{c}`") for c in keep], name)


def held_out(doc_id="doc_id"):
    """Whether a document is out of training: crc32 of its id as text mod 3 is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
