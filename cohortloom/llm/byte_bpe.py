"""Byte-level BPE through a sentencepiece model written straight from a rank file.

Nothing is trained or converted by a tool: the model is a short protobuf message. Every
token becomes a piece whose bytes are spelled with 256 letters, its score is the negative
rank, and the normaliser is the identity. A merge of sentencepiece takes the best-scored
neighbours first, leftmost among equals, which is the order of the ranks. Texts are cut by
the pattern, each match is spelled and encoded on its own, and decoding spells the pieces
back. Tokens that merging does not reach are taken whole, as the rank file means them.

The model is a constant of a vocabulary's size and is sent to the tasks; nothing else moves,
there is no shuffle. A worker remembers a bounded number of short matches.

Odd input: a null text counts as empty and has no ids; null ids decode to null, as do ids
that the vocabulary does not hold; rows are independent, so repeated rows and ids stay as
they are; a text of any length is one row, long runs without a break take n log n; other
columns are not read, an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from pyspark.sql import DataFrame

from cohortloom.llm.common import arrow_types

# Byte b is spelled by the letter FIRST_LETTER + b; no letter of that range is a blank.
FIRST_LETTER = 0x100
# Characters of the matches that a worker remembers.
REMEMBERED = 1 << 20
# Bytes of text (or ids) that are Python objects at the same time.
SLICE = 1 << 21

# Fields of the sentencepiece model message.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, KIND = 1, 2, 3
MODEL_TYPE, VOCAB_SIZE = 3, 4
NAME, DUMMY_PREFIX, EXTRA_BLANKS, ESCAPED_BLANKS = 1, 3, 4, 5
BPE, UNKNOWN = 2, 2


def read_ranks(path: str) -> dict[bytes, int]:
    """Token to rank, from lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _float(field: int, value: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", value)


_LETTERS = [chr(FIRST_LETTER + b) for b in range(256)]


def spelled(raw: bytes) -> str:
    return "".join(map(_LETTERS.__getitem__, raw))


def model_message(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece model; piece i is the token of the i-th lowest rank."""
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"bytes without a rank: {missing}")
    pieces = [
        _bytes(PIECES, _bytes(PIECE, spelled(token).encode()) + _float(SCORE, -float(rank)))
        for token, rank in sorted(ranks.items(), key=lambda x: x[1])
    ]
    unknown = _bytes(PIECES, _bytes(PIECE, b"<unk>") + _float(SCORE, 0.0) + _number(KIND, UNKNOWN))
    trainer = _bytes(TRAINER, _number(MODEL_TYPE, BPE) + _number(VOCAB_SIZE, len(ranks) + 1))
    identity = _bytes(NAME, b"identity") + b"".join(
        _number(f, 0) for f in (DUMMY_PREFIX, EXTRA_BLANKS, ESCAPED_BLANKS)
    )
    return b"".join(pieces) + unknown + trainer + _bytes(NORMALIZER, identity)


class Codec:
    """Ids of texts and texts of ids; made from what ``prepare`` returns."""

    def __init__(self, message: bytes, ids: np.ndarray, whole: dict[str, bytes], pattern: str) -> None:
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=message)
        self.ids = ids
        self.whole = whole
        self.matches = regex.compile(pattern).findall
        self.known: dict[str, bytes] = dict(whole)
        self.held = 0
        self.table: dict[int, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        cut = [self.matches(t) if t else [] for t in texts]
        needed = set(chain.from_iterable(cut))
        new = list(needed - self.known.keys())
        self.held += sum(map(len, new))
        if self.held > REMEMBERED:  # forget, but not what this call needs
            self.known, new = dict(self.whole), list(needed - self.whole.keys())
            self.held = sum(map(len, new))
        letters = [spelled(m.encode("utf-8", "surrogatepass")) for m in new]
        for match, ids in zip(new, self.pieces.encode(letters, num_threads=1)):
            self.known[match] = self.ids[np.array(ids, np.int64)].tobytes()
        return [np.frombuffer(b"".join(map(self.known.__getitem__, c)), "<i4") for c in cut]

    def encode_column(self, texts: pa.Array) -> list[pa.Array]:
        found = self.encode(texts.to_pylist())
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
        values = np.concatenate(found) if found else np.zeros(0, np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))]

    def decode_column(self, ids: pa.Array) -> list[pa.Array]:
        flat, ends = ids.values, ids.offsets.to_numpy()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        found = [
            self.decode(flat.slice(a, b - a).to_numpy(zero_copy_only=False)) if here else None
            for a, b, here in zip(ends[:-1], ends[1:], known)
        ]
        return [ids, pa.array(found, pa.binary())]

    def decode(self, ids: np.ndarray) -> bytes | None:
        if not self.table:
            spelling = {int(i): self.pieces.id_to_piece(k) for k, i in enumerate(self.ids)}
            self.table = {i: bytes(ord(c) - FIRST_LETTER for c in s) for i, s in spelling.items()}
        try:
            return b"".join(map(self.table.__getitem__, ids.tolist()))
        except KeyError:
            return None


def prepare(ranks: dict[bytes, int]) -> tuple[bytes, np.ndarray, dict[str, bytes]]:
    """The model, the rank of each piece, and the tokens that merges do not reach, with their id.

    A match that is a token as a whole is that token; merging alone could miss one whose
    parts are in the way of each other.
    """
    message = model_message(ranks)
    ids = np.array(sorted(ranks.values()), "<i4")
    model = sentencepiece.SentencePieceProcessor(model_proto=message)
    order = sorted(ranks, key=ranks.__getitem__)
    whole = {}
    for k, (token, found) in enumerate(zip(order, model.encode([spelled(t) for t in order], num_threads=1))):
        if found != [k]:
            try:
                whole[token.decode()] = ids[k : k + 1].tobytes()
            except UnicodeDecodeError:
                pass  # no match of a text is a part of a character
    return message, ids, whole


class ByteBpe:
    """One vocabulary and pattern, for any number of tables."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.made = (*prepare(ranks), pattern)

    def _map(self, df: DataFrame, schema: str, convert: str) -> DataFrame:
        made = df.sparkSession.sparkContext.broadcast(self.made)
        kinds = list(arrow_types(df.sparkSession, schema).items())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec = Codec(*made.value)
            for batch in batches:
                for part in slices(batch):
                    columns = [part.column(0), *getattr(codec, convert)(part.column(1))]
                    yield pa.RecordBatch.from_arrays([c.cast(k) for c, (_, k) in zip(columns, kinds)], names=[n for n, _ in kinds])

        return df.mapInArrow(run, schema)

    def encode(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """(doc_id, ids) of each row."""
        return self._map(docs.select("doc_id", text), f"doc_id {_type(docs, 'doc_id')}, ids array<int>", "encode_column")

    def decode(self, encoded: DataFrame, ids: str = "ids") -> DataFrame:
        """(doc_id, ids, decoded): the bytes that the ids stand for."""
        schema = f"doc_id {_type(encoded, 'doc_id')}, ids array<int>, decoded binary"
        return self._map(encoded.select("doc_id", ids), schema, "decode_column")


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose second column has about SLICE bytes, or items of a list, each."""
    column = batch.column(1)
    lengths = pc.list_value_length(column) if pa.types.is_list(column.type) else pc.binary_length(column)
    ends = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE, "right")))
        yield batch.slice(start, stop - start)
        start = stop
