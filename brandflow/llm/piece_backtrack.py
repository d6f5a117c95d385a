"""SentencePiece BPE encoding by backtracking, and decoding.

A BPE encoder merges the best pair of neighbouring symbols (highest score, then
leftmost) until no pair makes a piece. The same result is found here without
the merges of a whole text. Take a token sequence in which every two neighbours
are compatible, that is, merging the characters of just these two ends with just
these two. The first merge of the whole text that crossed a border of the
sequence would be the best pair of its two tokens as well, so none ever does.
So a sequence of compatible tokens is the encoding, and there is only one.

``PieceEncoder`` looks for it from left to right. An Aho-Corasick automaton gives
the longest piece that starts at each position; of it and its shorter prefixes
that are pieces, the first one compatible with the token before is taken. If none
is, the position is marked as failed in a bitfield and the token before is
shortened. What the encoding of a prefix ends with is unique, so a failed
position has failed for good and the work is linear in the text. Compatibility
is found by merging the two tokens' characters and remembered.

A set of starting characters is found in the vocabulary: no piece has another
character before one of them. So a text falls apart into words wherever one of
them follows another character, and around characters of no piece; words met
before are looked up (``WordCodes``).

Models: BPE with byte fallback, identity normalisation, space escaping and a
space put before the text; anything else is refused with a ValueError. The model
file is read on the driver and broadcast; its size is checked.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .scratch import free_name

#: Largest model or tokenizer file that is broadcast.
MAX_MODEL_BYTES = 64 << 20
#: Words, and pairs of tokens, that a Python worker remembers at most; then it forgets them all.
REMEMBERED = 1 << 20
#: Characters of text turned into tokens at once.
BLOCK_CHARS = 1 << 20

SPACE = "▁"
# Piece types and field numbers of the SentencePiece model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_BPE = 2
_UNKNOWN_SURFACE = " ⁇ "
_NEVER = float("-inf")


# ------------------------------------------------------------------------ the model file


class PieceModel(NamedTuple):
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    end_id: int
    digest: str


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol-buffer message."""
    i = 0

    def number() -> int:
        nonlocal i
        value = shift = 0
        while True:
            byte = data[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while i < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or number()
        yield tag >> 3, data[i : i + size]
        i += size


def model_bytes(path: str) -> bytes:
    """A vocabulary file of the driver, within the size that may be broadcast."""
    with open(path, "rb") as f:
        data = f.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
    return data


def read_piece_model(path: str) -> PieceModel:
    """Pieces, scores and types of a SentencePiece model file."""
    data = model_bytes(path)
    pieces, scores, kinds, trainer, normalizer = [], [], [], {}, {}
    for field, value in _fields(data):
        if field == 1:
            piece = dict(_fields(value))
            pieces.append(piece[1].decode())
            scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
            kinds.append(piece.get(3, NORMAL))
        elif field == 2:
            trainer = dict(_fields(value))
        elif field == 3:
            normalizer = dict(_fields(value))
    plain = not normalizer.get(2) and normalizer.get(3, 1) and not normalizer.get(4, 1) and normalizer.get(5, 1)
    if trainer.get(3) != _BPE or not trainer.get(35) or not plain or {USER_DEFINED, UNUSED} & set(kinds):
        raise ValueError(f"{path}: not a BPE model with byte fallback, plain normalisation and a space before the text")
    return PieceModel(pieces, scores, kinds, trainer.get(42, 2), hashlib.sha256(data).hexdigest())


def broadcast_model(spark: SparkSession, path: str) -> Broadcast[PieceModel]:
    return spark.sparkContext.broadcast(read_piece_model(path))


# ------------------------------------------------------------------------ words and their codes


class _Codes(dict):
    def __init__(self, add: Callable[[str], int]) -> None:
        super().__init__()
        self.add = add

    def __missing__(self, word: str) -> int:
        code = self[word] = self.add(word)
        return code


class WordCodes:
    """Tokens of the words met so far; a word is encoded once and then known by its number."""

    def __init__(self, encode: Callable[[str], Sequence[int]]) -> None:
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.ids, self.ends, self.known = array("i"), array("q", [0]), _Codes(self._add)

    def _add(self, word: str) -> int:
        self.ids.extend(self.encode(word))
        self.ends.append(len(self.ids))
        return len(self.ends) - 2

    def tokens(self, texts: Iterable[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of texts given as lists of words, and the offsets of the texts in them."""
        if len(self.known) > REMEMBERED:
            self.clear()
        codes, words = array("q"), [0]
        for text in texts:
            codes.extend(map(self.known.__getitem__, text))
            words.append(len(codes))
        at = np.array(codes, np.int64)
        ends = np.array(self.ends, np.int64)
        starts, sizes = ends[at], ends[at + 1] - ends[at]
        cut = np.concatenate(([0], np.cumsum(sizes)))
        index = np.repeat(starts - cut[:-1], sizes) + np.arange(cut[-1])
        return np.array(self.ids, np.int32)[index], cut[np.array(words)]


# ------------------------------------------------------------------------ encoding


class PieceEncoder:
    """Encoder and decoder of one model; built once in a Python worker."""

    def __init__(self, model: PieceModel) -> None:
        import ahocorasick

        self.model = model
        self.bytes_of = [b""] * len(model.pieces)
        self.byte_id = [0] * 256
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.text = list(model.pieces)
        for k, (piece, kind) in enumerate(zip(model.pieces, model.kinds)):
            if kind == NORMAL:
                self.id[piece], self.score[piece] = k, model.scores[k]
                self.bytes_of[k] = piece.replace(SPACE, " ").encode()
            elif kind == BYTE:
                value = int(piece[3:5], 16)
                self.byte_id[value], self.bytes_of[k] = k, bytes([value])
            elif kind == UNKNOWN:
                self.bytes_of[k] = _UNKNOWN_SURFACE.encode()
        self.byte_size = np.array(list(map(len, self.bytes_of)), np.int64)
        self.alphabet = {c for piece in self.id for c in piece}
        for c in sorted(self.alphabet - self.id.keys()):  # a character inside pieces that is none itself
            self.id[c] = len(self.text)
            self.text.append(c)
        self.size = [len(t) for t in self.text]
        self.shorter = [-1] * len(self.text)
        automaton = ahocorasick.Automaton()
        for piece, k in self.id.items():
            automaton.add_word(piece, k)
            self.shorter[k] = next((self.id[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.id), -1)
        automaton.make_automaton()
        self.matches = automaton.iter
        self.compatible: dict[int, bool] = {}
        self.split = self._splitter()
        self.codes = WordCodes(self.encode_escaped)

    def _splitter(self) -> Callable[[str], list[str]]:
        """Cuts an escaped text into words that no piece crosses."""
        before: dict[str, set[str]] = {}
        for piece in self.id:
            for a, b in zip(piece, piece[1:]):
                before.setdefault(b, set()).add(a)
        starting = {c for c in self.alphabet if not c.isalpha()}
        while True:
            wrong = {c for c in starting if before.get(c, set()) - starting}
            if not wrong:
                break
            starting -= wrong
        first = {c for c in starting if c not in before}  # begins every piece it is in
        runs = {c for c in starting if before.get(c) == {c}}  # as a run of itself

        def some(chars: set[str], times: str) -> str:
            return f"[{''.join(map(re.escape, sorted(chars)))}]{times}" if chars else ""

        middle, last = starting - first - runs, self.alphabet - starting
        rest = some(middle, "*") + some(last, "*")
        parts = [f"{re.escape(c)}+{rest}" for c in sorted(runs)]
        parts += [some(first, "") + rest if first else "", some(middle, "+") + some(last, "*") if middle else ""]
        parts += [some(last, "+"), f"[^{''.join(map(re.escape, sorted(self.alphabet)))}]+"]
        return re.compile("|".join(filter(None, parts))).findall

    def merged(self, text: str) -> list[str]:
        """Symbols of ``text`` after all merges: the best pair first, the leftmost of equally good ones."""
        symbols, get = list(text), self.score.get
        while True:
            best, at = _NEVER, -1
            for k in range(len(symbols) - 1):
                score = get(symbols[k] + symbols[k + 1], _NEVER)
                if score > best:
                    best, at = score, k
            if at < 0:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def _fits(self, last: int, token: int) -> bool:
        """Whether merging the characters of both tokens (of ``token`` alone if last < 0) ends with just them."""
        if len(self.compatible) > REMEMBERED:
            self.compatible.clear()
        both = ([self.text[last]] if last >= 0 else []) + [self.text[token]]
        known = self.compatible[last * len(self.text) + token] = self.merged("".join(both)) == both
        return known

    def _backtracked(self, text: str) -> list[int]:
        """Tokens of a text whose characters all occur in pieces."""
        n, size, shorter, known, every = len(text), self.size, self.shorter, self.compatible.get, len(self.text)
        longest = [-1] * (n + 1)
        for end, token in self.matches(text):
            longest[end + 1 - size[token]] = token  # ends rise, so the longest match stays
        tokens: list[int] = []
        failed = bytearray((n >> 3) + 1)
        at, last, token = 0, -1, longest[0]
        while at < n:
            while token >= 0:
                end = at + size[token]
                if not failed[end >> 3] >> (end & 7) & 1:
                    fits = known(last * every + token)
                    if self._fits(last, token) if fits is None else fits:
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                at, last, token = end, token, longest[end]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                token = tokens.pop()
                at -= size[token]
                last = tokens[-1] if tokens else -1
        return tokens

    def _escaped(self, text: str) -> list[int]:
        return [self.byte_id[b] for b in text.encode()]

    def encode_escaped(self, text: str) -> list[int]:
        """Token ids of a text with its spaces escaped; characters of no piece become byte tokens."""
        if self.alphabet.issuperset(text):
            found = self._backtracked(text)
        else:
            found, start = [], 0
            for k, c in enumerate(text):
                if c not in self.alphabet:
                    found += self._backtracked(text[start:k]) if k > start else []
                    found += [-1 - b for b in self._escaped(c)]
                    start = k + 1
            found += self._backtracked(text[start:]) if start < len(text) else []
            found = [t if t >= 0 else -1 - t for t in found]
        n = len(self.model.pieces)
        if found and max(found) >= n:
            found = [t for token in found for t in ([token] if token < n else self._escaped(self.text[token]))]
        return found

    def words(self, text: str) -> list[str]:
        """Words of a text, spaces escaped and one put before it; none of an empty text."""
        return self.split(SPACE + text.replace(" ", SPACE)) if text else []

    def encoded(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of texts, without an end id, and their offsets; null has no tokens."""
        return self.codes.tokens(self.words(t or "") for t in texts)

    # -------------------------------------------------------------------- decoding

    def decoded(self, ids: np.ndarray) -> str:
        """The text of token ids: one space at its start goes, bytes that are no UTF-8 become U+FFFD each."""
        found = list(map(self.bytes_of.__getitem__, ids.tolist()))
        first = next((k for k, b in enumerate(found) if b), None)
        if first is not None and found[first][:1] == b" " and self.model.kinds[ids[first]] == NORMAL:
            found[first] = found[first][1:]
        raw = b"".join(found)
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return _lenient(raw)


def _lenient(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_ENCODERS: dict[str, PieceEncoder] = {}


def worker_encoder(model: PieceModel) -> PieceEncoder:
    """The encoder of a model, kept as long as the Python worker lives."""
    if model.digest not in _ENCODERS:
        _ENCODERS[model.digest] = PieceEncoder(model)
    return _ENCODERS[model.digest]


def text_blocks(batches: Iterable[pa.RecordBatch], text_col: str) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of the batches with about ``BLOCK_CHARS`` characters of text; a longer text makes a slice of its own."""
    for batch in batches:
        texts = batch.column(text_col).to_pylist()
        start = total = 0
        for k, text in enumerate(texts):
            if k > start and total + len(text or "") > BLOCK_CHARS:
                yield batch.slice(start, k - start), texts[start:k]
                start, total = k, 0
            total += len(text or "")
        if start < len(texts):
            yield batch.slice(start), texts[start:]


def offsets32(cut: np.ndarray) -> pa.Array:
    return pa.array(cut.astype(np.int32))


def encode_pieces(docs: DataFrame, path: str, *, text_col: str = "text", add_end: bool = True) -> DataFrame:
    """``docs`` with ``ids`` (array<int>): the SentencePiece encoding of each whole text.

    ``add_end`` puts the model's end id after each text. A null or empty text has no
    other token. Rows are independent; repeated rows stay. A column named ``ids`` of
    ``docs`` gets an underscore. Map-only; a task holds one block of texts.
    """
    model = broadcast_model(docs.sparkSession, path)
    name = free_name([c for c in docs.columns if c != "ids"], "ids")
    if "ids" in docs.columns:
        docs = docs.withColumnRenamed("ids", free_name(docs.columns, "ids"))
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(model.value)
        for rows, texts in text_blocks(batches, text_col):
            ids, cut = encoder.encoded(texts)
            if add_end:
                ids = np.insert(ids, cut[1:], model.value.end_id)
                cut = cut + np.arange(len(cut))
            lists = pa.ListArray.from_arrays(offsets32(cut), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*rows.columns, lists], [*rows.schema.names, name])

    return docs.mapInArrow(encode, schema)


def decode_pieces(rows: DataFrame, path: str, *, ids_col: str = "ids", text_name: str = "decoded") -> DataFrame:
    """``rows`` with ``text_name``: the text of each row's token ids; null ids give null.

    Control ids give nothing, byte ids are joined to UTF-8, and the space that
    encoding put before the text goes. An id outside the vocabulary is an error.
    """
    model = broadcast_model(rows.sparkSession, path)
    schema = T.StructType([*rows.schema.fields, T.StructField(text_name, T.StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(model.value)
        for batch in batches:
            column = batch.column(ids_col)
            texts = [None if ids is None else encoder.decoded(ids.values.to_numpy(zero_copy_only=False)) for ids in _scalars(column)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, text_name])

    return rows.mapInArrow(decode, schema)


def _scalars(column: pa.Array) -> Iterator[pa.ListScalar | None]:
    for scalar in column:
        yield scalar if scalar.is_valid else None
