"""SentencePiece encoding and decoding of BPE models, exact, by backtracking.

A merge-type model starts from characters and keeps merging the adjacent pair whose
piece scores best (leftmost at ties). The result is the only sequence of pieces in
which every piece is its own encoding and every adjacent pair is *compatible*: the
two pieces, merged anew from their characters, come out as the same two pieces. So
the encoder searches for that sequence instead of running merges over the text:

1. an Aho-Corasick automaton of the pieces gives the longest piece at every position;
2. from left to right it takes the longest piece that is compatible with the piece
   before it, then the next shorter ones (prefixes of the longest);
3. where none fits, it steps back and marks the position as failed in a bitfield.
   The pieces up to a position are the encoding of that prefix, hence unique, so a
   failed position never needs a second try and the work is linear in the text.

Characters without a piece become their UTF-8 bytes (byte fallback), or ``<unk>``
where the model has none; nothing merges across them. No piece has a space mark
after another character, so a text is cut before each run of spaces, and each
distinct cut is encoded once as long as it is remembered.

Results at the edges: null is the empty text (no pieces); spaces are never trimmed;
U+2581 in a text is a space mark and decodes to a space; decoding joins byte pieces,
takes bad UTF-8 as U+FFFD per byte, leaves control pieces out and writes ``<unk>``
as the model's surface. Models other than identity-normalised BPE are refused.
The model file is read on the driver and travels as its bytes; rows are independent,
so nothing is shuffled and only one batch of texts is held at a time.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
#: Remembered cuts and pairs; the limits bound memory only, what is forgotten is worked out again.
CUTS, PAIRS, LONGEST_CUT = 400_000, 1_000_000, 64

NEVER = float("-inf")

# Wire names of the model file's fields and piece types.
PIECE, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of every field of a protocol-buffer message."""
    at, end = 0, len(data)

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < end:
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            size = number()
        yield tag >> 3, data[at : at + size]
        at += size


class Model:
    """The parts of a model file that encoding and decoding need."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        kind, fallback, dummy, extra, charsmap, suffix, self.unk_surface = 1, False, True, True, b"", False, " ⁇ "
        for tag, value in _fields(data):
            if tag == PIECE:
                f = dict(_fields(value))
                self.pieces.append(f.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", f[2])[0] if 2 in f else 0.0)
                self.types.append(f.get(3, NORMAL))
            elif tag == TRAINER:
                f = dict(_fields(value))
                kind, fallback, suffix = f.get(3, 1), bool(f.get(35, 0)), bool(f.get(24, 0))
                self.unk_surface = f.get(44, self.unk_surface.encode()).decode()
            elif tag == NORMALIZER:
                f = dict(_fields(value))
                charsmap, dummy, extra = f.get(2, b""), bool(f.get(3, 1)), bool(f.get(4, 1))
        if kind != BPE or charsmap or extra or suffix or any(t in (USER_DEFINED, UNUSED) for t in self.types):
            raise ValueError("only identity-normalised BPE models without user-defined or unused pieces")
        self.dummy_prefix = dummy
        self.unk = self.types.index(UNKNOWN)
        self.byte = [-1] * 256
        for i, t in enumerate(self.types):
            if t == BYTE:
                self.byte[int(self.pieces[i][3:5], 16)] = i
        self.fallback = fallback
        self.byte_of = {i: b for b, i in enumerate(self.byte) if i >= 0}
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.types[i] == NORMAL}
        self.score = {p: self.scores[i] for p, i in self.ids.items()}


def merged(model: Model, text: str) -> list[str]:
    """Pieces of a short text by merging: the definition that pairs are held against."""
    parts, score = list(text), model.score
    gain = [score.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
    while gain:
        best = max(gain)
        if best == NEVER:
            break
        i = gain.index(best)  # the leftmost
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del gain[i]
        if i:
            gain[i - 1] = score.get(parts[i - 1] + parts[i], NEVER)
        if i < len(gain):
            gain[i] = score.get(parts[i] + parts[i + 1], NEVER)
    return parts


class Codec:
    """Encoder and decoder of one model."""

    def __init__(self, data: bytes):
        self.model = m = Model(data)
        for p in m.ids:
            if SPACE in p.lstrip(SPACE):
                raise ValueError(f"a piece with a space mark after another character: {p!r}")
        # pieces that merging can end in; the others never occur in an encoding
        own = [p for p in m.ids if merged(m, p) == [p]]
        self.known = {p for p in own if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for p in own:
            self.automaton.add_word(p, (m.ids[p], len(p)))
        self.automaton.make_automaton()
        kept = set(own)
        self.length, self.shorter = [0] * len(m.pieces), [-1] * len(m.pieces)
        for p in own:
            self.length[m.ids[p]] = len(p)
            # the next shorter piece that starts the piece, -1 if none
            self.shorter[m.ids[p]] = next((m.ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in kept), -1)
        self.follows: list[dict[int, bool]] = [{} for _ in m.pieces]
        self.remembered = 0
        self.cuts: dict[str, list[int]] = {}
        self.surface = [p.replace(SPACE, " ") for p in m.pieces]
        for i, t in enumerate(m.types):
            if t in (CONTROL, UNKNOWN):
                self.surface[i] = "" if t == CONTROL else m.unk_surface

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two pieces, merged anew, are the same two pieces."""
        a, b = self.model.pieces[left], self.model.pieces[right]
        fits = merged(self.model, a + b) == [a, b]
        if self.remembered >= PAIRS:
            for known in self.follows:
                known.clear()
            self.remembered = 0
        self.follows[left][right] = fits
        self.remembered += 1
        return fits

    def pieces_of(self, text: str) -> list[int]:
        """Encoding of a text in which every character has a piece."""
        size = len(text)
        longest = [-1] * size
        for end, (piece, n) in self.automaton.iter(text):
            longest[end - n + 1] = piece  # later ends are longer
        failed = None  # one bit a position, made at the first failure
        length, shorter, follows = self.length, self.shorter, self.follows
        out: list[int] = []
        at, take, known = 0, longest[0], None
        while True:
            while take >= 0:
                end = at + length[take]
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    if known is None:
                        break
                    fits = known.get(take)
                    if fits is None:
                        fits = self.compatible(out[-1], take)
                    if fits:
                        break
                take = shorter[take]
            if take >= 0:
                out.append(take)
                if end == size:
                    return out
                at, known, take = end, follows[take], longest[end]
                continue
            # no piece goes on from here: the position has failed
            if failed is None:
                failed = bytearray(size // 8 + 1)
            failed[at >> 3] |= 1 << (at & 7)
            take = out.pop()
            at -= length[take]
            known = follows[out[-1]] if out else None
            take = shorter[take]

    def _cut(self, text: str) -> list[int]:
        if self.known.issuperset(text):
            return self.pieces_of(text)
        out, run = [], []
        for c in text:
            if c in self.known:
                run.append(c)
                continue
            if run:
                out += self.pieces_of("".join(run))
                run = []
            out += [self.model.byte[b] for b in c.encode()] if self.model.fallback else [self.model.unk]
        return out + self.pieces_of("".join(run)) if run else out

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        text = text.replace(SPACE, " ")
        if self.model.dummy_prefix:
            text = " " + text
        out: list[int] = []
        cuts, marks = self.cuts, ""
        for i, word in enumerate(text.split(" ")):
            if i:
                marks += SPACE
            if not word:
                continue
            cut = marks + word
            marks = ""
            ids = cuts.get(cut)
            if ids is None:
                ids = self._cut(cut)
                if len(cut) <= LONGEST_CUT:
                    if len(cuts) >= CUTS:
                        cuts.clear()
                    cuts[cut] = ids
            out += ids
        return out + self._cut(marks) if marks else out

    def decode(self, ids: list[int]) -> str:
        if not ids:
            return ""
        surface, byte_of = self.surface, self.model.byte_of
        if byte_of.keys().isdisjoint(ids):
            parts = [surface[i] for i in ids]
        else:
            parts, run = [], bytearray()
            for i in [*ids, -1]:
                b = byte_of.get(i)
                if b is not None:
                    run.append(b)
                    continue
                if run:
                    parts.append(_text_of(bytes(run)))
                    run = bytearray()
                if i >= 0:
                    parts.append(surface[i])
        if self.model.dummy_prefix:
            # the mark that encoding put in front belongs to the first piece with a text
            first = next((k for k, p in enumerate(parts) if p), None)
            at = next((k for k, i in enumerate(ids) if i in byte_of or surface[i]), None)
            if first is not None and ids[at] not in byte_of and self.model.pieces[ids[at]].startswith(SPACE):
                parts[first] = parts[first][1:]
        return "".join(parts)


def _text_of(data: bytes) -> str:
    """UTF-8 text; every byte that starts no character is U+FFFD."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def model_bytes(path: str | None = None) -> bytes:
    """The model file, by default the public 32k piece vocabulary; read on the driver."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


_CODECS: dict[bytes, Codec] = {}


def _codec(data: bytes) -> Codec:
    """One codec per worker process and model."""
    key = hashlib.sha256(data).digest()
    if key not in _CODECS:
        _CODECS[key] = Codec(data)
    return _CODECS[key]


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` (array of int) for every row."""
    model = docs.sparkSession.sparkContext.broadcast(model_bytes(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model.value)
        for batch in batches:
            ids = [codec.encode(t) for t in _texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decoded(ids: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` of rows with ``doc_id, ids``; null ids give an empty text."""
    model = ids.sparkSession.sparkContext.broadcast(model_bytes(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model.value)
        for batch in batches:
            texts = [codec.decode(row.as_py() or []) for row in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = ids.schema["doc_id"].dataType.simpleString()
    return ids.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def _texts(column: pa.Array) -> Iterator[str]:
    for value in column:
        yield value.as_py() or ""


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row: every text is
    encoded and its ids are decoded again; only the digests leave the worker."""
    model = docs.sparkSession.sparkContext.broadcast(model_bytes(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model.value)
        names = [str(i) for i in range(len(codec.model.pieces))]
        for batch in batches:
            counts, listed, texts = [], [], []
            for text in _texts(batch.column("text")):
                ids = codec.encode(text)
                counts.append(len(ids))
                listed.append(hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest())
                texts.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(listed, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
