"""SentencePiece encoding and decoding for merge-type models, exact, by backtracking.

A sequence of pieces is the model's encoding of its text if, and only if, every two neighbours are compatible: merging the text of
the two alone ends at these two pieces. That is seen by undoing the last merges along their facing edges, from a table of each piece's two halves,
until a merge of the edges would have come first or none can. So the encoder walks the text taking the longest piece at each position (all found by one pass of an
Aho-Corasick automaton over the reversed text), steps to shorter prefixes while the piece before is not compatible, and goes one piece
back where no prefix fits; a bitfield holds the positions from which the rest is known to fail, so none is tried twice.

No piece reaches over the start of a word (a space mark after another character) in models that part text at blanks; that is read
from the model, and such words are encoded on their own and kept in a bounded cache. A line break that no longer piece contains
parts words likewise. In other models a text is one word.

Only models of merge type with identity normalisation are taken; others raise ValueError, as the result would not be exact.

Defined cases: a null or empty text has no pieces and decodes to the empty text. Characters without a piece become byte pieces, or the
unknown piece in a model without them. Texts of any length are encoded whole; long words are not cached. Repeated rows and other
columns don't matter.
"""

from __future__ import annotations

import hashlib
import re
import struct
from functools import lru_cache
from itertools import chain, groupby

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from claimtrail.llm.arrow import map_batches
from claimtrail.llm.columns import pack, unpack

SPACE = "▁"
CACHED_WORDS = 300_000  # of each of two generations
CACHED_PAIRS = 400_000  # then others are computed each time
CACHED_CHARS = 48
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGE_TYPE = 2
_MARKED = re.compile(f"{SPACE}+[^{SPACE}]*")
_MARKED_LINES = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n[^{SPACE}\n]*")


def _fields(data: bytes):
    """Number and value of each field of a protocol-buffer message."""
    at = 0

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

    while at < len(data):
        field, kind = divmod(number(), 8)
        if kind == 0:
            yield field, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield field, data[at : at + size]
        at += size


class PieceModel:
    """Pieces of a model file, its encoder and its decoder."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores = []
        trainer, normalizer = {}, {}
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
                self.kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normalizer = dict(_fields(value))
        if trainer.get(3, 1) != MERGE_TYPE or trainer.get(24, 0):
            raise ValueError("not a merge-type model with space marks in front")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or not normalizer.get(3, 1):
            raise ValueError("the model normalises texts")
        if set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("the model has pieces of another kind")
        self.unknown = self.kinds.index(UNKNOWN)
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        self.byte_ids = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        self._split(sorted(ids, key=lambda p: -scores[ids[p]]), ids)
        self.size = [len(p) for p in self.pieces]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for piece, i in self.ids.items():
            self.automaton.add_word(piece[::-1], i)
        self.automaton.make_automaton()
        long = [p for p in self.ids if len(p) > 1]
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in long)
        self.by_line = not any("\n" in p for p in long)
        self._shorter: dict[int, int] = {}
        self._beside: dict[int, dict[int, bool]] = {}
        self._pairs = 0
        self._words = _Words(self)
        self.bytes = [self._piece_bytes(i) for i in range(len(self.pieces))]
        self.numbers = list(range(len(self.pieces)))
        self.names = [str(i) for i in self.numbers]

    # Numbers from len(pieces) on stand for single characters without a piece.

    def _split(self, ranked: list[str], ids: dict[str, int]) -> None:
        """Take each piece's last merge apart, best-ranked pieces first.

        A piece's two halves at its last merge are the one split whose halves are pieces themselves and compatible up to that merge. A
        piece without one is never made by merging, so it is no piece of any encoding and is left out.
        """
        self.made = [0] * len(self.pieces)  # when a piece is merged: 0 for characters, then by rank
        self.left, self.right = list(range(len(self.pieces))), list(range(len(self.pieces)))
        self.merge: dict[int, int] = {}  # first << 32 | second -> when the two are merged
        self.ids = {p: ids[p] for p in ranked if len(p) == 1}
        known = len(self.pieces)
        for made, piece in enumerate((p for p in ranked if len(p) > 1), 1):
            halves = []
            for at in range(1, len(piece)):
                first, second = piece[:at], piece[at:]
                a = self.ids.get(first, known + ord(first) if at == 1 else -1)
                b = self.ids.get(second, known + ord(second) if at == len(piece) - 1 else -1)
                if a >= 0 and b >= 0:
                    halves.append((a, b))
            own = ids[piece]
            fit = next(((a, b) for a, b in halves if self._apart(a, b, made)), None)
            if fit is None:
                continue
            self.ids[piece], self.made[own] = own, made
            self.left[own], self.right[own] = fit
            for a, b in halves:
                self.merge[a << 32 | b] = made

    def _apart(self, first: int, second: int, limit: int = 1 << 31) -> bool:
        """No merge before ``limit`` joins the two: their facing edges are taken apart again, the last merge first."""
        merge, made, known = self.merge, self.made, len(self.pieces)
        while True:
            if merge.get(first << 32 | second, limit) < limit:
                return False
            a = made[first] if first < known else 0
            b = made[second] if second < known else 0
            if a > b:
                limit, first = a, self.right[first]
            elif b:
                limit, second = b + 1, self.left[second]  # of equal merges the left one comes first
            else:
                return True

    def _row(self, first: int) -> dict[int, bool]:
        """Which pieces are known to fit after ``first``, kept up to ``CACHED_PAIRS`` in all."""
        row = self._beside.get(first)
        if row is None:
            row = {}
            if self._pairs < CACHED_PAIRS:
                self._beside[first] = row
        return row

    def _fits(self, first: int, second: int, row: dict[int, bool]) -> bool:
        """The pieces are compatible neighbours: merging the text of both ends at these two."""
        found = self._apart(first, second)
        if self._pairs < CACHED_PAIRS:
            self._pairs += 1
            row[second] = found
        return found

    def _prefix(self, token: int) -> int:
        """The next shorter piece that begins ``token``; -1: none."""
        known = self._shorter.get(token)
        if known is None:
            piece, known = self.pieces[token] if token < len(self.pieces) else "", -1
            for size in range(len(piece) - 1, 0, -1):
                known = self.ids.get(piece[:size], -1)
                if known >= 0:
                    break
            if known < 0 and len(piece) > 1:
                known = len(self.pieces) + ord(piece[0])
            if token < len(self.pieces):
                self._shorter[token] = known
        return known

    def tokens(self, text: str) -> list[int]:
        """The pieces of a text with its space marks; a character without a piece has its own number."""
        n, known, size, rows, shorter = len(text), len(self.pieces), self.size, self._beside, self._shorter
        longest = [-1] * n
        last = -1
        for end, piece in self.automaton.iter(text[::-1]):
            if end != last:  # the first of the matches that end here is the longest
                longest[-1 - end] = piece
                last = end
        if -1 in longest:
            longest = [known + ord(c) if p < 0 else p for p, c in zip(longest, text)]
        failed = bytearray(n // 8 + 1)
        tokens: list[int] = []
        at, token, row = 0, longest[0] if n else -1, None
        while at < n:
            while True:
                end = at + (size[token] if token < known else 1)
                if not failed[end >> 3] >> (end & 7) & 1:
                    fits = row is None or row.get(token)
                    if fits is None:
                        fits = self._fits(tokens[-1], token, row)
                    if fits:
                        tokens.append(token)
                        at = end
                        if at < n:
                            row = rows.get(token)
                            if row is None:
                                row = self._row(token)
                            token = longest[at]
                        break
                token = shorter[token] if token in shorter else self._prefix(token)
                if token < 0:
                    failed[at >> 3] |= 1 << (at & 7)
                    token = tokens.pop()
                    at -= size[token] if token < known else 1
                    row = self._row(tokens[-1]) if tokens else None
                    break
        return tokens

    def encode_marked(self, text: str) -> list[int]:
        """Ids of a text with its space marks."""
        tokens, out = self.tokens(text), []
        if not tokens or max(tokens) < len(self.pieces):
            return tokens
        for token in tokens:
            if token < len(self.pieces):
                out.append(token)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in chr(token - len(self.pieces)).encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def words(self, text: str) -> list[str]:
        """Keys of the words of a text: a word without its first space mark, or a line's first word with its line break."""
        if not text:
            return []
        if not self.by_word or not self.byte_ids:
            return [text.replace(" ", SPACE)]
        if "  " in text or SPACE in text or text[0] == " ":
            found = (_MARKED_LINES if self.by_line else _MARKED).findall(SPACE + text.replace(" ", SPACE))
            return [w.removeprefix(SPACE) for w in found]
        return (text.replace("\n", " \n") if self.by_line else text).split(" ")

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self._words.__getitem__, self.words(text))))

    def encoded(self, text: str) -> tuple[str, str]:
        """The ids as text with commas, and what they decode to."""
        ids = self.encode(text)
        return ",".join(map(self.names.__getitem__, ids)), self.decode(ids)

    def _piece_bytes(self, i: int) -> bytes:
        kind = self.kinds[i]
        if kind == BYTE:
            return bytes([self.byte_of[i]])
        return self.pieces[i].replace(SPACE, " ").encode() if kind == NORMAL else self.unknown_text.encode() if kind == UNKNOWN else b""

    def decode(self, ids: list[int]) -> str:
        """Text of the ids, without the space that encoding puts in front."""
        try:
            text = b"".join(map(self.bytes.__getitem__, ids)).decode()
        except UnicodeDecodeError:  # byte pieces that make no characters
            text = self._decoded_apart(ids)
        return text.removeprefix(" ")

    def _decoded_apart(self, ids: list[int]) -> str:
        out = []
        for raw, run in groupby(ids, key=self.byte_of.__contains__):
            joined = b"".join(map(self.bytes.__getitem__, run))
            out.append(_utf8(joined) if raw else joined.decode())
        return "".join(out)


def _utf8(raw: bytes) -> str:
    """Bytes as text; each byte that is part of no character becomes a replacement character."""
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as problem:
            out.append(raw[at : at + problem.start].decode() + "\ufffd")
            at += problem.start + 1
    return "".join(out)


class _Words(dict):
    """Ids by word, in two generations: a full one is set aside and its words come back as they are met again."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model
        self.old: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        value = self.old.get(word)
        if value is None:
            unit = word if word[:1] == "\n" and self.model.by_line and self.model.by_word else SPACE + word
            value = tuple(map(self.model.numbers.__getitem__, self.model.encode_marked(unit)))  # all words share the numbers
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = value
        return value


@lru_cache(maxsize=2)
def _loaded(digest: str, source) -> PieceModel:
    return PieceModel(source.value)


def encode_texts(docs: DataFrame, path: str, decode: bool = False) -> DataFrame:
    """``docs`` with ``piece_ids`` (and, on demand, ``decoded``) in place of any columns of these names."""
    kind = StructType.fromDDL("piece_ids array<int>" + ", decoded string" * decode)
    docs = docs.drop(*kind.names)
    packed = pack(docs)
    names = packed.columns

    def rows(model: PieceModel, batch: pa.RecordBatch):
        texts = batch.column("text").to_pylist()
        ids = [model.encode(t or "") for t in texts]
        more = [pa.array(ids, pa.list_(pa.int32()))] + [pa.array([model.decode(i) for i in ids], pa.string())] * decode
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *more], [*names, *kind.names])

    return unpack(_mapped(packed, path, rows, StructType([*packed.schema.fields, *kind.fields])), docs.columns, *kind.names)


def _mapped(docs: DataFrame, path: str, rows, schema) -> DataFrame:
    with open(path, "rb") as file:  # the model is a file of the program, not of the data
        content = file.read()
    digest = hashlib.sha256(content).hexdigest()
    PieceModel(content)  # refuse an unfit model here, not in a task
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches):
        model = _loaded(digest, shared)
        for batch in batches:
            yield rows(model, batch)

    return map_batches(docs, run, schema)


def digest(docs: DataFrame, path: str) -> DataFrame:
    """One row per document, with digests in place of ids and decoded text."""

    def rows(model: PieceModel, batch: pa.RecordBatch):
        n, ids_sha, decoded_sha = [], [], []
        for text in batch.column("text"):
            ids, decoded = model.encoded(text.as_py() or "")
            n.append(ids.count(",") + 1 if ids else 0)
            ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
            decoded_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _mapped(docs, path, rows, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
