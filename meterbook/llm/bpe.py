"""Byte-level BPE by sentencepiece, and back.

The vocabulary, a file of byte strings and their ranks, is written as a sentencepiece model of kind BPE without any training: every byte becomes a letter of its own
(byte b is the letter LETTER + b), a piece's score is its negative rank, and the normaliser is the identity without white space rules. Sentencepiece joins the
neighbours whose piece has the highest score, the leftmost of equals, which is the merge of the lowest rank. Texts are cut into pre-tokens by a pattern, and each
is encoded alone. No pre-token goes on from a character that is no white space to a blank, so texts are first parted there, and the ids of a part that was
encoded before are kept, in bounded memory. A vocabulary may hold strings that their own merges do not lead to; a
pre-token that is one of them is that id, and they are found by encoding every piece when a task loads the model.

Decoding maps ids to the model's pieces and their letters back to bytes. The model, some megabytes whatever the data, is built on the driver and travels with the tasks.

Null and empty texts have no ids and decode to no bytes. Repeated rows give repeated results, an empty table none. Null ids decode to no bytes. Only the named columns are read.
"""

from __future__ import annotations

import base64
import re
import struct
from array import array
from collections import ChainMap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from .packing import PATTERN
from .shared import portions

VOCABULARY = "byte_bpe_50k.tiktoken"
LETTER = 0x100
#: Parts of texts whose ids a task remembers, and how long they may be; others are encoded anew.
KEPT, KEPT_LENGTH = 400_000, 64
#: Between a character that is no white space and a blank; and a blank that follows white space.
BORDER, SPACED = re.compile(r"(?<=\S)(?= )"), re.compile(r"\s ")

# Field numbers of the public sentencepiece model format.
_PIECES, _TRAINER, _NORMALISER = 1, 2, 3
_PIECE, _SCORE, _KIND = 1, 2, 3
_MODEL_KIND, _SIZE, _UNKNOWN_ID, _FIRST_ID, _LAST_ID, _PAD_ID, _UNKNOWN_PIECE = 3, 4, 40, 41, 42, 43, 45
_NAME, _DUMMY_PREFIX, _REMOVE_SPACES, _ESCAPE_SPACES = 1, 3, 4, 5
_BPE, _NORMAL, _UNKNOWN = 2, 1, 2


def vocabulary(name: str = VOCABULARY) -> list[bytes]:
    """The byte strings of a rank file in the order of their ranks, which are their ids."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, file)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{name}: ranks are not the numbers from 0")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _float(field: int, x: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", x)


_letters = {b: chr(LETTER + b) for b in range(256)}


def letters(token: bytes) -> str:
    return token.decode("latin-1").translate(_letters)


def parts(text: str) -> list[str]:
    """The text in parts that share no pre-token."""
    if "\x00" in text or SPACED.search(text):
        return BORDER.split(text)
    return text.replace(" ", "\x00 ").split("\x00")  # every blank follows something else


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece model whose piece i is token i; the unknown piece, which the format asks for, follows them and is never used."""
    if len(tokens) > 1 << 24:
        raise ValueError("scores are 32-bit floats, which tell ranks apart up to 2^24")
    unknown = "<unk>"
    pieces = [_bytes(_PIECE, letters(t).encode()) + _float(_SCORE, -float(rank)) + _number(_KIND, _NORMAL) for rank, t in enumerate(tokens)]
    pieces.append(_bytes(_PIECE, unknown.encode()) + _float(_SCORE, 0.0) + _number(_KIND, _UNKNOWN))
    trainer = (_number(_MODEL_KIND, _BPE) + _number(_SIZE, len(pieces)) + _number(_UNKNOWN_ID, len(tokens)) + _number(_FIRST_ID, -1)
               + _number(_LAST_ID, -1) + _number(_PAD_ID, -1) + _bytes(_UNKNOWN_PIECE, unknown.encode()))
    normaliser = _bytes(_NAME, b"identity") + _number(_DUMMY_PREFIX, 0) + _number(_REMOVE_SPACES, 0) + _number(_ESCAPE_SPACES, 0)
    return b"".join(_bytes(_PIECES, p) for p in pieces) + _bytes(_TRAINER, trainer) + _bytes(_NORMALISER, normaliser)


class Codec:
    """A loaded model: texts to ids and ids to bytes."""

    def __init__(self, model: bytes, pattern: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        named = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size() - 1)]
        self.bytes = [bytes(ord(c) - LETTER for c in piece) for piece in named]
        self.cut = regex.compile(pattern).findall
        self.whole = {piece: [i] for i, (piece, ids) in enumerate(zip(named, self.processor.encode(named, out_type=int, num_threads=1), strict=True)) if ids != [i]}
        self.known: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of parts of texts, four bytes each, little-endian."""
        cut = [self.cut(part) for part in new]
        tokens = list(set().union(*cut))
        spelt = [letters(t.encode()) for t in tokens]
        coded = self.processor.encode(spelt, out_type=int, num_threads=1)
        ids = {t: array("I", self.whole.get(s, c)).tobytes() for t, s, c in zip(tokens, spelt, coded, strict=True)}
        return {part: b"".join([ids[t] for t in own]) for part, own in zip(new, cut, strict=True)}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        cut = [parts(t) if t else [] for t in texts]
        if len(self.known) > KEPT:
            self.known.clear()
        new = set().union(*cut)
        new -= self.known.keys()
        learnt = self._learn(list(new))
        self.known.update((t, ids) for t, ids in learnt.items() if len(t) <= KEPT_LENGTH)
        rest = {t: ids for t, ids in learnt.items() if len(t) > KEPT_LENGTH}
        known = self.known if not rest else ChainMap(rest, self.known)
        return [b"".join([known[t] for t in own]) for own in cut]

    def decode(self, ids: bytes | None) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


_loaded: dict[tuple[bytes, str], Codec] = {}


def codec(model: bytes, pattern: str) -> Codec:
    """One codec per Python worker and model."""
    if (model, pattern) not in _loaded:
        _loaded.clear()
        _loaded[model, pattern] = Codec(model, pattern)
    return _loaded[model, pattern]


#: Texts whose pre-tokens a task holds at once.
TEXTS = 100


def encode_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", name: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(id, n_tokens, ids): the ids of every text, four bytes each, little-endian."""
    model = docs.sparkSession.sparkContext.broadcast(serialise(vocabulary(name)))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = codec(model.value, pattern)
        for batch in portions(batches, TEXTS):
            ids = one.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], names=["id", "n_tokens", "ids"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(encoded, f"id {docs.schema[id].dataType.simpleString()}, n_tokens long, ids binary").withColumnRenamed("id", id)


def decode_documents(coded: DataFrame, id: str = "doc_id", ids: str = "ids", name: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(id, ids, bytes): the bytes that the ids of every row stand for; all of `coded`'s columns but the ids' go."""
    model = coded.sparkSession.sparkContext.broadcast(serialise(vocabulary(name)))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = codec(model.value, pattern)
        for batch in portions(batches, TEXTS):
            back = [one.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("ids"), pa.array(back, pa.binary())], names=["id", "ids", "bytes"])

    rows = coded.select(F.col(id).alias("id"), F.col(ids).alias("ids"))
    return rows.mapInArrow(decoded, f"id {coded.schema[id].dataType.simpleString()}, ids binary, bytes binary").withColumnRenamed("id", id)
