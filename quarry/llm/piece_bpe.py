"""SentencePiece merge-type (BPE) encoding and decoding.

The text's spaces become U+2581 with one more in front; then an agenda of
adjacent symbol pairs, ordered by the score of the piece that they would form
and then from the left, is worked off until no pair forms a piece.  Characters
without a piece fall back to their bytes.

A vocabulary without pieces that hold U+2581 after another character never
merges across such a place, nor around a character that occurs in no longer
piece.  Texts are cut there, and the units' ids are kept in a bounded memo.
Whole texts are encoded; a unit's work is n log n.

Defined cases: a null text is an empty text, which has no ids and decodes to
the empty text; ids may repeat; an empty table gives an empty result.  The
model is a parameter: a merge-type model with the identity normaliser and byte
fallback (anything else is refused).
"""

from __future__ import annotations

import hashlib
import heapq
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.scratch import map_texts

MEMO_UNITS = 250_000
SPACE = "▁"
PLACE = (1 << 40) - 1
NONE = 1 << 62
SHORT = 40          # longer units keep their agenda in a heap


def _cutter(longer: list[str]) -> re.Pattern:
    """A pattern that cuts texts where no longer piece can span the cut."""
    if any(SPACE in p.lstrip(SPACE) for p in longer):
        return re.compile(r"(?s).+")
    known = set("".join(longer)) - {SPACE}
    letters = {c for c in known if c.isalpha()}
    after_letter = {b for p in longer for a, b in zip(p, p[1:]) if a in letters}
    # Others that never follow a letter within a piece begin a new unit there.
    group = lambda chars: f"[{re.escape(''.join(sorted(chars)))}]" if chars else "(?!)"
    other, joined = group(known - letters), group((known & after_letter) - letters)
    return re.compile(f"{SPACE}*(?={group(known)}){other}*(?:{group(letters)}+(?:{joined}{other}*)?)*|{SPACE}+|[^{group(known)[1:-1]}{SPACE}]")


class PieceBpe:
    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm, train = proto.normalizer_spec, proto.trainer_spec
        if train.model_type != train.BPE or norm.precompiled_charsmap or not train.byte_fallback:
            raise ValueError("a merge-type model with identity normaliser and byte fallback is needed")
        if norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces or train.treat_whitespace_as_suffix:
            raise ValueError("unsupported white space rules")
        vocabulary = sentencepiece.SentencePieceProcessor(model_proto=model)
        kind = proto.SentencePiece
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in proto.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        normal = [p for p in proto.pieces if p.type == kind.NORMAL]
        ranks = {s: r for r, s in enumerate(sorted({p.score for p in normal}, reverse=True))}
        self.rank = {p.piece: ranks[p.score] << 40 for p in normal}
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kind.NORMAL}
        self.byte = [vocabulary.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.piece = [p.piece for p in proto.pieces]
        self.kind = [p.type for p in proto.pieces]
        self.unknown, self.control, self.byte_kind = kind.UNKNOWN, kind.CONTROL, kind.BYTE
        self.unknown_text = train.unk_surface
        self.value = {i: b for b, i in enumerate(self.byte)}
        longer = [p for p in self.rank if len(p) > 1]
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in longer)
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if self.by_word else r"(?s).+")
        self.units = _cutter(longer)

    def merge(self, unit: str) -> list[str]:
        """The pieces of a unit, by the agenda.  An entry is the rank of a
        piece's score and the place of the pair's left symbol; one whose pair has
        changed meanwhile no longer has that rank and is passed over."""
        rank = self.rank
        symbols = list(unit)
        n = len(symbols)
        if n <= SHORT:      # the agenda in text order: its least rank, leftmost first
            get = rank.get
            ranks = [get(a + b, NONE) for a, b in zip(symbols, symbols[1:])]
            while ranks and (best := min(ranks)) != NONE:
                i = ranks.index(best)
                symbols[i] += symbols.pop(i + 1)
                del ranks[i]
                if i < len(ranks):
                    ranks[i] = get(symbols[i] + symbols[i + 1], NONE)
                if i:
                    ranks[i - 1] = get(symbols[i - 1] + symbols[i], NONE)
            return symbols
        agenda = []
        for i in range(n - 1):
            r = rank.get(symbols[i] + symbols[i + 1])
            if r is not None:
                agenda.append(r | i)
        if not agenda:
            return symbols
        heapq.heapify(agenda)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while agenda:
            entry = heapq.heappop(agenda)
            i = entry & PLACE
            a, j = symbols[i], after[i]
            if not a or j >= n:
                continue
            ab = a + symbols[j]
            if rank.get(ab) != entry - i:
                continue
            symbols[i], symbols[j] = ab, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank.get(ab + symbols[k])
                if r is not None:
                    heapq.heappush(agenda, r | i)
            h = before[i]
            if h >= 0:
                r = rank.get(symbols[h] + ab)
                if r is not None:
                    heapq.heappush(agenda, r | h)
        return [s for s in symbols if s]

    def unit_ids(self, unit: str) -> list[int]:
        out = []
        for s in self.merge(unit):
            i = self.id.get(s)
            out.extend([i] if i is not None else [self.byte[b] for b in s.encode()])
        return out

    def split(self, text: str) -> list[str]:
        return self.units.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for u in self.split(text) for i in self.unit_ids(u)]

    def surface(self, ids: list[int]) -> str:
        """The text of ids, a leading space kept."""
        out, raw = [], bytearray()
        for i in ids:
            if i in self.value:
                raw.append(self.value[i])
                continue
            if raw:
                out.append(_utf8(raw))
                raw = bytearray()
            kind = self.kind[i]
            out.append("" if kind == self.control else self.unknown_text if kind == self.unknown else self.piece[i])
        if raw:
            out.append(_utf8(raw))
        return "".join(out).replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        text = self.surface(ids)
        return text[1:] if text.startswith(" ") else text


def _utf8(raw: bytearray) -> str:
    """Bytes as text; each byte that is no part of a character is U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(bytes(raw[at:at + size]).decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


class Memo(dict):
    """word -> (ids as text, surface) of the words met of late.  When it is full
    it starts anew, and the words of the one before are taken over on demand;
    the units of a new word have a memo of their own kind."""

    def __init__(self, model: PieceBpe, most: int = MEMO_UNITS, units: bool = False):
        super().__init__()
        self.model, self.most, self.before = model, most, {}
        self.units = None if units else Memo(model, most, True)

    def __missing__(self, word: str):
        found = self.before.get(word)
        if found is None:
            if self.units is None:
                ids = self.model.unit_ids(word)
                found = (",".join(map(str, ids)), self.model.surface(ids))
            else:
                parts = [self.units[u] for u in self.model.units.findall(word)]
                found = parts[0] if len(parts) == 1 else (",".join([p[0] for p in parts]), "".join([p[1] for p in parts]))
        if len(word) <= 64:
            if len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[word] = found
        return found

    def forget(self) -> None:
        """Lets the words go; the model stays."""
        self.before = {}
        self.clear()
        if self.units is not None:
            self.units.forget()

    def encode(self, text: str) -> tuple[str, str]:
        """(ids as text, decoded text) of a whole text."""
        if not text:
            return "", ""
        if self.model.by_word and text[0] != " " and "  " not in text and SPACE not in text:
            found = [self[w] for w in (SPACE + text.replace(" ", " " + SPACE)).split(" ")]
        else:
            found = [self[w] for w in self.model.words.findall(SPACE + text.replace(" ", SPACE))]
        surface = "".join([x[1] for x in found])
        return ",".join([x[0] for x in found]), surface[1:] if surface.startswith(" ") else surface


_MEMOS: dict[bytes, Memo] = {}


def _memo(model: bytes) -> Memo:
    """The memo of this Python worker, which serves task after task."""
    key = hashlib.sha256(model).digest()
    if key not in _MEMOS:
        _MEMOS.clear()
        _MEMOS[key] = Memo(PieceBpe(model))
    return _MEMOS[key]


def encoded(docs: DataFrame, model_path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ids (decimal, joined by commas), n_tokens and the decoded
    text of every row of ``docs``."""
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return _apply(docs, model_path, keep, f"{kinds}, n_tokens long, ids string, decoded string", lambda n, ids, text: (n, ids, text))


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _apply(docs, model_path, ("doc_id",), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string",
                  lambda n, ids, text: (n, sha(ids), sha(text)))


def _apply(docs: DataFrame, model_path: str, keep, schema: str, row) -> DataFrame:
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())   # the vocabulary: a fixed size
    names = [x.split()[0].strip("`") for x in schema.split(", ")][len(keep):]

    def run(batches):
        memo = _memo(model.value)
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, 500):
                    part = batch.slice(at, 500)
                    rows = []
                    for text in part.column(part.num_columns - 1).to_pylist():
                        ids, decoded = memo.encode(text or "")
                        rows.append(row(ids.count(",") + 1 if ids else 0, ids, decoded))
                    new = [pa.array(c) for c in zip(*rows)]
                    yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], *new], names=[*keep, *names])
        finally:
            memo.forget()

    return map_texts(docs.select(*keep, docs["text"].alias("__text")), run, schema)


def differences(docs: DataFrame, model_path: str) -> DataFrame:
    """Rows whose ids or decoded text differ from the sentencepiece library's,
    compared in Arrow batches: (doc_id, ids, library_ids).  Empty when right."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=model.value)
        memo = _memo(model.value)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            bad = []
            for doc_id, text, want in zip(batch.column(0).to_pylist(), texts, library.encode(texts, num_threads=1)):
                ids, decoded = memo.encode(text)
                if ids != ",".join(map(str, want)) or decoded != library.decode(want):
                    bad.append((doc_id, ids, ",".join(map(str, want))))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in bad], batch.schema.field(0).type),
                                              pa.array([x[1] for x in bad], pa.string()), pa.array([x[2] for x in bad], pa.string())],
                                             names=["doc_id", "ids", "library_ids"])

    return map_texts(docs.select("doc_id", "text"), run, f"doc_id {kind}, ids string, library_ids string")
