"""Byte-level BPE through a sentencepiece model that is serialised directly from a rank file.

Every byte is mapped to a printable character, so a vocabulary entry becomes a piece of text; its score is
its negative rank, so sentencepiece merges what has the lowest rank first. The model normalises nothing.
Pre-tokens are found by a pattern and encoded separately; distinct ones only once while they are remembered: those
that did not occur for long are forgotten, never all at once. Decoding maps ids back to bytes.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from tillbook.llm.common import grouped, rows

_NEW = 8_192  # unseen pre-tokens given to sentencepiece at once
_REMEMBERED = 500_000  # pre-tokens of a generation; the one before is kept too
_BLOCK_BYTES = 1 << 20


def _alphabet() -> list[str]:
    """A visible character for each byte: itself where it is printable, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


ALPHABET = _alphabet()
_SHOWN = dict(enumerate(ALPHABET))


def mapped(data: bytes) -> str:
    return data.decode("latin-1").translate(_SHOWN)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field in protocol buffer coding: a nested message or text, a whole number, or a float."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose ids are the ranks; the unknown piece, which no text needs, comes last."""
    by_rank = {rank: token for token, rank in ranks.items()}
    size = max(by_rank, default=-1) + 1
    out = bytearray()
    for rank in range(size):
        if rank in by_rank:
            out += _field(1, _field(1, mapped(by_rank[rank]).encode()) + _field(2, -float(rank)))
        else:  # a gap in the ranks: a control piece keeps the numbering
            out += _field(1, _field(1, f"<gap{rank}>".encode()) + _field(2, 0.0) + _field(3, 3))
    out += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, size + 1) + _field(40, size) + b"".join(
        _field(n, (1 << 64) - 1) for n in (41, 42, 43)  # no begin, end and padding ids
    )
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return bytes(out + _field(2, trainer) + _field(3, normaliser))


class Codec:
    """Encodes and decodes by a rank file and a pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.ranks))
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the generation before: what is met again moves to the new one

    def _learn(self, found: list[list[str]]) -> None:
        """Remember the ids of unseen pre-tokens. One that is in the vocabulary is its own id, as in tiktoken."""
        if len(self.known) > _REMEMBERED:
            self.older, self.known = self.known, {}
        known, older, unseen = self.known, self.older, []
        for piece in set().union(*found).difference(known):
            if (ids := older.get(piece)) is not None:
                known[piece] = ids
            elif (whole := self.ranks.get(data := piece.encode())) is not None:
                known[piece] = struct.pack("<I", whole)
            else:
                unseen.append((piece, mapped(data)))
        for start in range(0, len(unseen), _NEW):
            part = unseen[start : start + _NEW]
            for (piece, _), ids in zip(part, self.model.encode([text for _, text in part], num_threads=1)):
                known[piece] = struct.pack(f"<{len(ids)}I", *ids)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        found = [self.pattern.findall(text) for text in texts]
        self._learn(found)
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in found]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _encode(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    tool = codec(path, pattern)
    for part in grouped(rows(batches), lambda r: len(r[1] or ""), _BLOCK_BYTES):
        ids = tool.encode_all([text or "" for _, text in part])
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in part], pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "ids"]
        )


def _decode(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    tool = codec(path, pattern)
    for part in grouped(rows(batches), lambda r: len(r[1]), _BLOCK_BYTES):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.binary()),
                pa.array([tool.decode(r[1]) for r in part], pa.binary()),
            ],
            ["doc_id", "ids", "decoded"],
        )


def encode(documents: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (binary, little-endian 32-bit), a row for each row; null texts count as empty.

    Ids may be null or repeat, texts may have any length; other columns are ignored.
    """
    source = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(partial(_encode, path=path, pattern=pattern), "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """The rows of ``encode`` with the bytes they stand for; an id outside the vocabulary is an error."""
    return encoded.select("doc_id", "ids").mapInArrow(
        partial(_decode, path=path, pattern=pattern), "doc_id long, ids binary, decoded binary"
    )


def round_trip(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    both = decode(encode(documents, path, pattern), path, pattern)
    return both.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
