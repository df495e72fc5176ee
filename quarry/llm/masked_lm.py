"""LM scoring by masked pseudo-likelihood.

A network predicts each word from the two before and the two after (the word itself is
masked): embeddings, one matrix per place, tanh, and a softmax of two levels, both
conditioned on the window: p(word | window) = p(class | window) p(word | class, window).
The commonest words are classes by themselves; the other words of the vocabulary share
blocks, each with a softmax over its words; what is beyond the vocabulary shares
``REST`` classes by its ending, in which each word has its share of the corpus's count.
The vocabulary grows with the corpus (``vocabulary_size``), up to ``MOST`` words.
Written and trained in numpy.

1. Words are counted over the whole corpus (partial sums, then by word).
2. ``pieces``: every text is read once more and kept as word numbers, two bytes a word;
   words beyond the vocabulary are kept by hash, each once a piece, and by place.
3. Training reads every piece: each task trains its own copy of the network on a seeded
   share of its words, and copies are averaged by words trained; ``ROUNDS`` times,
   whose shares together are all words.  The sums are of whole numbers, so the order
   in which tasks end changes nothing, and neither do Arrow's batches.
4. Each document is scored whole: the sum of its words' conditional log-probabilities,
   and its mean.  Pieces ask the table of all counts for their words beyond the
   vocabulary, by the words' hash.

What is counted, kept and trained grows with the corpus; tasks share the network and
the vocabulary, at most ``MOST`` words of some dozen numbers each.

Defined cases: null and empty texts have no words, score 0.0 and a null mean; a
text of one word is predicted from an empty window; ties in counts go to the
lower hash; repeated rows count and are scored each; an empty table gives an
empty result.  Words are lower-cased in A-Z.  Columns other than ``keep`` and the text
play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.scratch import give_back, map_texts, power_of_two, remove, small_batches, written
from quarry.llm.textkit import Words, chunks, mix

SINGLES = 32            # commonest words, classes by themselves
REST = 16               # classes of the words beyond the vocabulary
MOST = 60_000           # words of the vocabulary at most; numbers have 16 bits
DIM = 10
HIDDEN = 16
PLACES = (-2, -1, 1, 2)
ROUNDS = 2
RATE = 0.1
CALM = 0.01             # gradients far below this hardly move a number
BATCH = 4096
BLOCK = 4096
SEED = 11
STEP = 1 << 24          # averaged numbers are multiples of 1 / STEP
UNIT = 1024             # ... weighed by words trained, in these units
PIECE_WORDS = 1 << 16   # distinct words beyond the vocabulary in a piece
BUCKET_WORDS = 1 << 24  # about so many words of the corpus have their counts looked up in one group
COUNT_FLUSH = 1 << 20   # distinct words that a task counts before it hands on

_U = np.uint64


def rest_class(words: Words) -> np.ndarray:
    """The class among ``REST`` of each word, by its last two bytes."""
    last = words.buf[words.end - 1].astype(_U)
    before = words.buf[np.maximum(words.end - 2, words.start)].astype(_U)
    return (mix(last * _U(257) + before) % _U(REST)).astype(np.int64)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): every distinct word's hash and count."""

    def run(batches):
        held, size = [], 0

        def flush():
            word, n = (np.concatenate(x) for x in zip(*held))
            word, place = np.unique(word, return_inverse=True)
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(np.bincount(place, weights=n).astype(np.int64))], names=["word", "n"])

        for _, texts in chunks(batches):
            held.append(np.unique(Words(texts, lower=True).hash, return_counts=True))
            size += len(held[-1][0])
            if size >= COUNT_FLUSH:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return map_texts(docs.select("text"), run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary_size(total: int) -> int:
    """Words of the vocabulary of a corpus of ``total`` words."""
    return int(min(MOST, max(SINGLES, 2 * total ** 0.4)))


@dataclass
class Vocabulary:
    """Words by number: 0 .. size - 1 by count, then the classes of the rest, then the
    edge of a text."""
    words: np.ndarray       # sorted hashes
    numbers: np.ndarray     # of those words
    counts: np.ndarray      # by number
    total: int              # words of the corpus

    def __post_init__(self):
        self.size = len(self.words)
        self.edge = self.size + REST
        self.singles = min(SINGLES, self.size)
        shared = self.size - self.singles
        # Every word pays for the blocks, about a quarter of all words for the words of one.
        self.blocks = max(1, math.isqrt(shared) // 4) if shared else 0
        self.width = -(-shared // self.blocks) if shared else 0
        self.classes = self.singles + self.blocks + REST
        at = np.arange(shared)
        self.class_of = np.concatenate([np.arange(self.singles), self.singles + at % max(1, self.blocks), self.singles + self.blocks + np.arange(REST)])
        self.member = np.concatenate([np.zeros(self.singles, np.int64), at // max(1, self.blocks), np.zeros(REST, np.int64)])

    def of(self, w: Words) -> np.ndarray:
        """The number of each word."""
        out = self.size + rest_class(w)
        if self.size:
            at = np.minimum(np.searchsorted(self.words, w.hash), self.size - 1)
            own = self.words[at] == w.hash
            out[own] = self.numbers[at[own]]
        return out

    def shapes(self) -> dict[str, tuple]:
        return {"e": (self.edge + 1, DIM), "w": (len(PLACES), DIM, HIDDEN), "b": (HIDDEN,), "u": (HIDDEN, self.classes), "c": (self.classes,),
                "u2": (self.blocks, self.width, HIDDEN), "c2": (self.blocks, self.width)}


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The commonest words of the table of all counts."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    top = counts.orderBy(F.desc("n"), "word").limit(vocabulary_size(total)).collect()     # at most MOST rows
    words = np.array([r["word"] for r in top], np.int64).view(_U)
    order = np.argsort(words)
    return Vocabulary(words[order], order.astype(np.int64), np.array([r["n"] for r in top], np.int64), total)


def unpack(flat: np.ndarray, vocab: Vocabulary) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in vocab.shapes().items():
        n = math.prod(shape)
        out[name] = flat[at:at + n].reshape(shape)
        at += n
    return out


def start(vocab: Vocabulary, seed: int = SEED) -> np.ndarray:
    """Small random numbers; the biases are the logarithms of the words' shares."""
    rng = np.random.default_rng(seed)
    scale = {"e": 0.3, "w": 0.3, "u": 0.1, "u2": 0.1}
    flat = np.concatenate([rng.normal(0, scale[k], math.prod(s)) if k in scale else np.zeros(math.prod(s)) for k, s in vocab.shapes().items()]).astype(np.float32)
    p = unpack(flat, vocab)
    own = np.bincount(vocab.class_of[:vocab.size], weights=vocab.counts, minlength=vocab.classes)
    own[vocab.singles + vocab.blocks:] = max(0, vocab.total - vocab.counts.sum()) / REST
    p["c"][:] = np.log((own + 1) / (own.sum() + len(own)))
    p["c2"][:] = -30.0      # of places without a word
    for number in range(vocab.singles, vocab.size):
        block = vocab.class_of[number] - vocab.singles
        p["c2"][block, vocab.member[number]] = np.log(vocab.counts[number] / own[vocab.class_of[number]])
    return flat


# --- pieces ----------------------------------------------------------------------

def _kept(docs: DataFrame, keep: tuple[str, ...]) -> list[T.StructField]:
    return [T.StructField(c, docs.schema[c].dataType) for c in keep]


def pieces(docs: DataFrame, vocab: Vocabulary, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(piece, docs, numbers, words, place): documents with their number of words, all
    words by number, the distinct ones beyond the vocabulary by hash (sorted), and which
    of those each such word is."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    each = T.StructType([*_kept(docs, keep), T.StructField("n_words", T.LongType())])
    schema = T.StructType([T.StructField("piece", T.LongType()), T.StructField("docs", T.ArrayType(each)),
                           *[T.StructField(c, T.BinaryType()) for c in ("numbers", "words", "place")]])

    def run(batches):
        # Numbered by task; the table is written, so one attempt's numbers hold.
        v, piece, held, size = shared.value, TaskContext.get().partitionId() << 32, [], 0

        def flush():
            rows, numbers, words, place = zip(*held)
            all_words = np.unique(np.concatenate(words))
            at = np.concatenate([np.searchsorted(all_words, w)[p] for w, p in zip(words, place)])
            kept = [pa.concat_arrays([r[c] for r in rows]) for c in range(len(keep) + 1)]
            documents = pa.ListArray.from_arrays(pa.array([0, len(kept[0])], pa.int32()), pa.StructArray.from_arrays(kept, names=each.names))
            at = at.astype("<u2" if len(all_words) <= 1 << 16 else "<u4")
            return pa.RecordBatch.from_arrays(
                [pa.array([piece], pa.int64()), documents,
                 *[pa.array([x.tobytes()], pa.binary()) for x in (np.concatenate(numbers).astype("<u2"), all_words.astype("<u8"), at)]], names=schema.names)

        for rows, texts in chunks(batches, "__text"):
            w = Words(texts, lower=True)
            numbers = v.of(w)
            rest = numbers >= v.size
            words, place = np.unique(w.hash[rest], return_inverse=True)
            if held and size + len(words) > PIECE_WORDS:
                yield flush()
                piece, held, size = piece + 1, [], 0
            held.append(([*[rows.column(i) for i in range(len(keep))], pa.array(w.count.astype(np.int64))], numbers, words, place))
            size += len(words)
        if held:
            yield flush()

    return map_texts(docs.select(*keep, docs["text"].alias("__text")), run, schema)


def _each_piece(batches) -> Iterator[tuple[int, pa.StructArray, np.ndarray, np.ndarray]]:
    """(piece, documents, words of each, numbers) of every piece."""
    for batch in batches:
        for i in range(batch.num_rows):
            docs = batch.column(1)[i].values
            yield (batch.column(0)[i].as_py(), docs, docs.field(len(docs.type) - 1).to_numpy(), np.frombuffer(batch.column(2)[i].as_py(), "<u2").astype(np.int64))


# --- the network -----------------------------------------------------------------

def framed(numbers: np.ndarray, count: np.ndarray, edge: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of some texts' words with two edges between texts, and the place of
    each word there."""
    doc = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(numbers)) + 2 * doc + 2
    out = np.full((place[-1] + 3) if len(place) else 2, edge, np.int64)
    out[place] = numbers
    return out, place


def _hidden(p: dict, frame: np.ndarray, at: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    near = [frame[at + k] for k in PLACES]
    z = p["b"] + sum(p["e"][i] @ p["w"][k] for k, i in enumerate(near))
    return near, np.tanh(z)


def _exp(h: np.ndarray, u: np.ndarray, c: np.ndarray) -> np.ndarray:
    """exp(h u + c) up to a common factor: as |h| <= 1, the largest exponent is at most 0,
    whatever the rows."""
    q = h @ u
    q += c - (c + np.abs(u).sum(0)).max()
    return np.exp(q, out=q)


def _log_of(q: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The log softmax at ``own``, a column by row, from exponentials."""
    return np.log(q[np.arange(len(own)), own] + 1e-37) - np.log(q.sum(axis=1) + 1e-37)


def _error(q: np.ndarray, own: np.ndarray, scale: np.float32) -> np.ndarray:
    """The softmax less one at ``own``, times ``scale``."""
    q *= (scale / (q.sum(axis=1) + np.float32(1e-37)))[:, None]
    q[np.arange(len(own)), own] -= scale
    return q


def _in_blocks(vocab: Vocabulary, cls: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(block, rows) of the words that share one."""
    rows = np.flatnonzero((cls >= vocab.singles) & (cls < vocab.singles + vocab.blocks))
    rows = rows[np.argsort(cls[rows].astype(np.uint16), kind="stable")]
    cut = np.flatnonzero(np.diff(cls[rows], prepend=-1))
    for part in np.split(rows, cut[1:]):
        if len(part):
            yield int(cls[part[0]]) - vocab.singles, part


def log_probabilities(p: dict, vocab: Vocabulary, frame: np.ndarray, place: np.ndarray) -> np.ndarray:
    """log p(class | window) p(word | class, window) of the words at ``place``; without
    the second factor for those beyond the vocabulary."""
    out = np.empty(len(place), np.float32)
    for a in range(0, len(place), BLOCK):
        at = place[a:a + BLOCK]
        _, h = _hidden(p, frame, at)
        own = frame[at]
        cls = vocab.class_of[own]
        logs = _log_of(_exp(h, p["u"], p["c"]), cls)
        for block, rows in _in_blocks(vocab, cls):
            logs[rows] += _log_of(_exp(h[rows], p["u2"][block].T, p["c2"][block]), vocab.member[own[rows]])
        out[a:a + BLOCK] = logs
    return out


def train_steps(flat: np.ndarray, squares: np.ndarray, vocab: Vocabulary, frame: np.ndarray, place: np.ndarray) -> None:
    """Adagrad steps on the masked words at ``place``, in place."""
    p, g2 = unpack(flat, vocab), unpack(squares, vocab)

    def move(value, square, grad):
        square += grad * grad
        value -= RATE * grad / (np.sqrt(square) + CALM)

    for a in range(0, len(place), BATCH):
        at = place[a:a + BATCH]
        scale = np.float32(1 / math.sqrt(len(at)))
        near, h = _hidden(p, frame, at)
        own = frame[at]
        cls = vocab.class_of[own]
        q = _error(_exp(h, p["u"], p["c"]), cls, scale)
        dh = q @ p["u"].T
        for block, rows in _in_blocks(vocab, cls):
            hb = h[rows]
            r = _error(_exp(hb, p["u2"][block].T, p["c2"][block]), vocab.member[own[rows]], scale)
            dh[rows] += r @ p["u2"][block]
            move(p["u2"][block], g2["u2"][block], r.T @ hb)
            move(p["c2"][block], g2["c2"][block], r.sum(0))
        dz = dh * (1 - h * h)
        de = np.concatenate([dz @ p["w"][k].T for k in range(len(PLACES))])
        dw = np.stack([p["e"][i].T @ dz for i in near])
        # Sums by neighbour; only those that occur move.
        every = np.concatenate(near)
        order = np.argsort(every.astype(np.uint16), kind="stable")
        first = np.flatnonzero(np.diff(every[order], prepend=-1))
        rows = every[order[first]]
        value, square, grad = p["e"][rows], g2["e"][rows], np.add.reduceat(de[order], first, axis=0)
        move(value, square, grad)
        p["e"][rows], g2["e"][rows] = value, square
        for name, grad in (("u", h.T @ q), ("c", q.sum(0)), ("b", dz.sum(0)), ("w", dw)):
            move(p[name], g2[name], grad)


def dealt(numbers: np.ndarray, count: np.ndarray, turn: int, rounds: int, seed: int) -> np.ndarray:
    """Which words a round masks and trains on, by a hash of the word and its place in
    its text: the same on every attempt and in every piece; each word in one round."""
    first = np.repeat(np.cumsum(count) - count, count)
    draw = mix(numbers.astype(_U) * _U(3) + (np.arange(len(numbers)) - first).astype(_U) + _U(seed))
    return draw % _U(rounds) == _U(turn)


def _summed(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = 0, 0
    for batch in batches:
        for sums, k in zip(batch.column(batch.schema.get_field_index("sums")), batch.column(batch.schema.get_field_index("n")).to_pylist()):
            total, n = total + np.frombuffer(sums.as_buffer(), np.int64), n + k
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary()), pa.array([n], pa.int64())],
                                     names=["part", "sums", "n"])


def train(held: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS, seed: int = SEED, tree: tuple[int, ...] = (256, 16, 2)) -> np.ndarray:
    """The averaged parameters after ``rounds`` passes over all :func:`pieces`, in which
    every word is masked and trained on once."""
    spark = held.sparkSession
    shared, flat = spark.sparkContext.broadcast(vocab), start(vocab, seed)
    for turn in range(rounds):
        now = spark.sparkContext.broadcast(flat)

        def run(batches):
            v, mine, squares, trained = shared.value, now.value.copy(), np.zeros_like(now.value), 0
            for _, _, count, numbers in _each_piece(batches):
                frame, place = framed(numbers, count, v.edge)
                chosen = place[dealt(numbers, count, turn, rounds, seed)]
                train_steps(mine, squares, v, frame, chosen)
                trained += len(chosen)
            if trained:
                weight = -(-trained // UNIT)
                whole = np.rint(np.clip(mine.astype(np.float64), -100, 100) * STEP).astype(np.int64) * weight
                yield pa.RecordBatch.from_arrays([pa.array([whole.tobytes()], pa.binary()), pa.array([weight], pa.int64())], names=["sums", "n"])

        parts = map_texts(held.select("piece", "docs", "numbers"), run, "sums binary, n long").withColumn("part", F.spark_partition_id())
        for width in tree:
            parts = parts.select(F.pmod("part", F.lit(width)).alias("part"), "sums", "n").groupBy("part").applyInArrow(_summed, "part int, sums binary, n long")
        with small_batches(spark):
            rows = parts.collect()              # one row per branch of the tree's root
        total = sum(r["n"] for r in rows)
        if total:
            flat = (sum(np.frombuffer(r["sums"], np.int64) for r in rows) / (total * STEP)).astype(np.float32)
        now.unpersist()
    return flat


# --- scores ----------------------------------------------------------------------

def _asked(held: DataFrame, bits: int) -> DataFrame:
    """(bucket, piece, words): the words of each piece by the first bits of their hash."""
    def run(batches):
        for batch in batches:
            for piece, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = np.frombuffer(words, "<u8")     # sorted
                bucket = (words >> _U(64 - bits)).astype(np.int64)
                cut = np.flatnonzero(np.diff(bucket, prepend=-1))
                if len(cut):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket[cut]), pa.array(np.full(len(cut), piece)), pa.array([x.tobytes() for x in np.split(words, cut[1:])], pa.binary())],
                        names=["bucket", "piece", "words"])

    return map_texts(held.select("piece", "words"), run, "bucket long, piece long, words binary")


def _answered(asked: pa.Table, counts: pa.Table) -> pa.Table:
    """The log counts of the words that the pieces ask for in one bucket."""
    known = counts.column("word").to_numpy().view(_U)
    order = np.argsort(known)
    known, logs = known[order], np.log(counts.column("n").to_numpy()[order]).astype("<f4")
    values = [logs[np.searchsorted(known, np.frombuffer(x, "<u8"))].tobytes() for x in asked.column("words").to_pylist()]
    return pa.table({"bucket": asked.column("bucket"), "piece": asked.column("piece"), "logs": pa.array(values, pa.binary())})


def rest_totals(held: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """Words of the corpus in each class of the rest."""
    size = vocab.size

    def run(batches):
        total = np.zeros(REST, np.int64)
        for _, _, _, numbers in _each_piece(batches):
            total += np.bincount(numbers[numbers >= size] - size, minlength=REST)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(REST)), pa.array(total)], names=["rest", "n"])

    rows = map_texts(held.select("piece", "docs", "numbers"), run, "rest long, n long").groupBy("rest").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(REST, np.int64)
    for r in rows:
        out[r["rest"]] = r["n"]
    return out


def _judged(held: DataFrame, flat: np.ndarray, vocab: Vocabulary) -> DataFrame:
    """(piece, docs, place, rests): documents with the sum of their words' logarithms so
    far, and how many words beyond the vocabulary each has.  The numbers stay behind."""
    # A word beyond the vocabulary has its count's share of its class: its own logarithm comes later.
    totals = np.log(np.maximum(1, rest_totals(held, vocab)))
    shared = held.sparkSession.sparkContext.broadcast((flat, vocab, totals))
    each = T.StructType([*held.schema["docs"].dataType.elementType.fields, T.StructField("log_likelihood", T.DoubleType())])
    schema = T.StructType([T.StructField("piece", T.LongType()), T.StructField("docs", T.ArrayType(each)),
                           T.StructField("place", T.BinaryType()), T.StructField("rests", T.BinaryType())])

    def run(batches):
        flat, v, totals = shared.value
        p = unpack(flat, v)
        for batch in batches:
            places = iter(batch.column(3))
            for piece, docs, count, numbers in _each_piece([batch]):
                frame, at = framed(numbers, count, v.edge)
                doc = np.repeat(np.arange(len(count)), count)
                rest = numbers >= v.size
                logs = log_probabilities(p, v, frame, at).astype(np.float64)
                logs[rest] -= totals[numbers[rest] - v.size]
                total = np.bincount(doc, weights=logs, minlength=len(count)).astype(np.float64)     # whole numbers without words
                rests = np.bincount(doc[rest], minlength=len(count)).astype("<u4")
                found = pa.StructArray.from_arrays([*docs.flatten(), pa.array(total)], names=each.names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([piece], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(count)], pa.int32()), found),
                     pa.array([next(places).as_py()], pa.binary()), pa.array([rests.tobytes()], pa.binary())], names=schema.names)

    return map_texts(held.select("piece", "docs", "numbers", "place"), run, schema)


def scored(held: DataFrame, flat: np.ndarray, vocab: Vocabulary, counts: DataFrame) -> DataFrame:
    """The kept columns, n_words, log_likelihood (sum) and mean_log_likelihood of every
    document of :func:`pieces`.  ``counts``: those of all words."""
    kept = held.schema["docs"].dataType.elementType.fields
    schema = T.StructType([*kept, T.StructField("log_likelihood", T.DoubleType()), T.StructField("mean_log_likelihood", T.DoubleType())])
    bits = power_of_two(vocab.total / BUCKET_WORDS, 64).bit_length() - 1
    by_bucket = counts.select(F.shiftrightunsigned("word", 64 - bits).alias("bucket"), "word", "n")
    answers = (_asked(held, bits).groupBy("bucket").cogroup(by_bucket.groupBy("bucket"))
               .applyInArrow(_answered, "bucket long, piece long, logs binary"))

    def finished(piece: pa.Table, answers: pa.Table) -> pa.Table:
        logs = np.frombuffer(b"".join(answers.sort_by("bucket").column("logs").to_pylist()), "<f4")
        docs = piece.column("docs").combine_chunks().flatten()
        rests = np.frombuffer(piece.column("rests")[0].as_py(), "<u4")
        raw = piece.column("place")[0].as_py()
        place = np.frombuffer(raw, "<u2" if len(raw) == 2 * int(rests.sum()) else "<u4")
        *front, n, total = docs.flatten()
        n = n.to_numpy()
        total = total.to_numpy() + np.bincount(np.repeat(np.arange(len(rests)), rests), weights=logs[place], minlength=len(rests))
        out = pa.table([*front, pa.array(n), pa.array(total), pa.array(total / np.maximum(n, 1), mask=n == 0)], names=schema.names)
        give_back()
        return out

    return _judged(held, flat, vocab).groupBy("piece").cogroup(answers.groupBy("piece")).applyInArrow(finished, schema)


def score_corpus(docs: DataFrame, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """Counts, trains and scores one corpus."""
    counts = written(word_counts(docs), "counts")
    vocab = vocabulary(counts)
    held = written(pieces(docs, vocab), "pieces")
    out = written(scored(held, train(held, vocab, rounds, seed), vocab, counts), "scores")
    remove(counts, held)
    return out
