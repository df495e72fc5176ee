"""Words, lines and shingles of whole texts, computed with numpy on the UTF-8
bytes of an Arrow batch.

A word is a maximal run of characters other than space and U+0009..U+000D
(``[^\\x20\\x09-\\x0D]+``).  All of those separators are single bytes in UTF-8,
so words, lines and their hashes come from byte arrays without decoding.
A null text is an empty text.  Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in chunks of about this many bytes (a longer text is
#: its own chunk), which bounds a task's memory whatever the batch size.
CHUNK_BYTES = 256 << 10
#: ... and of at most this many texts, so that a text's number has 16 bits.
CHUNK_TEXTS = 60_000

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising mixer (splitmix64) of an array of 64-bit words."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_ODD = mix(np.arange(1, 65, dtype=_U)) | _U(1)


def _byte_values(lower: bool) -> np.ndarray:
    v = mix(np.arange(1000, 1256, dtype=_U))
    if lower:
        v[65:91] = v[97:123]
    return v


_BYTES = {True: _byte_values(True), False: _byte_values(False)}
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; grown by doubling and kept up to
    the usual chunk size."""
    have = _POWERS.get(base, np.ones(1, _U))
    while len(have) < n:
        have = np.concatenate([have, have * _U(pow(base, len(have), 1 << 64))])
    if len(have) <= 4 * CHUNK_BYTES:
        _POWERS[base] = have
    return have[:n]


def forget() -> None:
    """Lets the tables of powers go."""
    _POWERS.clear()


def text_bytes(column) -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def _cuts(column: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, number) of runs of texts, bounded in bytes and rows."""
    at, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        if i > at and (size + n > CHUNK_BYTES or i - at >= CHUNK_TEXTS):
            yield at, i - at
            at, size = i, 0
        size += n
    if at < len(column):
        yield at, len(column) - at


def text_chunks(column: pa.Array) -> Iterator[list[bytes]]:
    """The texts of a column in bounded lists."""
    column = column.cast(pa.large_binary())
    for at, n in _cuts(column):
        yield text_bytes(column.slice(at, n))


def chunks(batches, text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of Arrow batches with their texts' bytes, bounded in bytes and rows.
    Only the texts of one slice are copied out of the batch at a time."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        for at, n in _cuts(column):
            yield batch.slice(at, n), text_bytes(column.slice(at, n))


class Words:
    """The words of some texts: ``start``/``end`` (byte places in ``buf``),
    ``doc`` (the text's number) and ``hash`` of each, and ``count`` per text."""

    def __init__(self, texts: list[bytes], lower: bool = False, hashed: bool = True):
        self.n = len(texts)
        joined = b" ".join(texts) + b" "
        self.buf = np.frombuffer(joined, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, self.n)
        self.doc_end = np.cumsum(sizes + 1) - 1          # place of the space after the text
        self.doc_start = self.doc_end - sizes
        self.solid = (self.buf != 32) & ((self.buf < 9) | (self.buf > 13))
        edge = np.flatnonzero(np.diff(self.solid.view(np.int8), prepend=0))
        self.start, self.end = edge[0::2], edge[1::2]
        self.doc = np.searchsorted(self.doc_end, self.start).astype(np.int32)
        self.count = np.bincount(self.doc, minlength=self.n)
        self.lower = lower
        self._sums = None
        self.hash = self.spans(self.start, self.end) if hashed else None

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte spans [start, end); equal spans, equal hashes."""
        if self._sums is None:
            v = _BYTES[self.lower][self.buf]
            v *= _powers(_BASE, len(v))
            self._sums = np.concatenate([np.zeros(1, _U), np.cumsum(v, dtype=_U)])
        inverse = _powers(_INV, len(self.buf) + 1)
        return mix((self._sums[end] - self._sums[start]) * inverse[start] ^ (end - start).astype(_U))

    def per_doc(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Sum of integer values by text number."""
        return np.bincount(at, weights=values, minlength=self.n).astype(np.int64)

    def in_docs(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text a mask over ``buf`` marks."""
        c = np.concatenate([np.zeros(1, np.int64), np.cumsum(mask, dtype=np.int64)])
        return c[self.doc_end] - c[self.doc_start]

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every window of k words within one text."""
        m = len(self.start) - k + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, _U)
        first = np.flatnonzero(self.doc[:m] == self.doc[k - 1:])
        h = np.zeros(len(first), _U)
        for j in range(k):
            h += self.hash[first + j] * _ODD[j]
        return first, mix(h)


def sort_within(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Order by (doc, h): a sort of h, then a stable one of the 16-bit doc."""
    by_hash = np.argsort(h)
    return by_hash[np.argsort(doc[by_hash].astype(np.uint16), kind="stable")]


def shingles(words: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct k-word shingles of each text as (doc, hash), sorted by
    both.  A text of 1..k-1 words has its whole sequence as the one shingle;
    a text without words has none."""
    first, h = words.windows(k)
    doc = words.doc[first]
    short = np.flatnonzero((words.count > 0) & (words.count < k))
    if len(short):
        at = np.searchsorted(words.doc, short)
        v = words.count[short].astype(_U) * _U(0xD1B54A32D192ED03)
        for j in range(k - 1):
            live = words.count[short] > j
            v[live] += words.hash[at[live] + j] * _ODD[j]
        doc, h = np.concatenate([doc, short.astype(doc.dtype)]), np.concatenate([h, mix(v)])
    order = sort_within(doc, h)
    doc, h = doc[order], h[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[fresh], h[fresh]


def repeated(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Marks every entry whose (doc, h) occurs at least twice."""
    out = np.zeros(len(h), bool)
    if len(h) > 1:
        order = sort_within(doc, h)
        d, x = doc[order], h[order]
        same = (d[1:] == d[:-1]) & (x[1:] == x[:-1])
        hit = np.zeros(len(h), bool)
        hit[1:] |= same
        hit[:-1] |= same
        out[order[hit]] = True
    return out
