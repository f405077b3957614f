"""Byte-level BPE encoding and decoding through a sentencepiece model.

A vocabulary of ranks (one base64 token and its rank a line) is serialised as a
sentencepiece BPE model without any training: bytes are mapped to printable
characters, a token's score is its negative rank, and normalisation is the
identity.  Texts are cut into pre-tokens first; each is encoded by itself.
Decoding looks the bytes of the ids up again.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skymetrics.llm.pretokens import Encoder, gather
from skymetrics.llm.text import memo, slices

#: field numbers of the sentencepiece model format
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, TYPE = 1, 2, 3
MODEL_TYPE, VOCAB_SIZE, UNK_ID, BOS_ID, EOS_ID, PAD_ID = 3, 4, 40, 41, 42, 43
NAME, ADD_DUMMY_PREFIX, REMOVE_EXTRA_WHITESPACES, ESCAPE_WHITESPACES = 1, 3, 4, 5
BPE, NORMAL, UNKNOWN = 2, 1, 2


def byte_characters() -> list[str]:
    """One printable character per byte: itself where it prints, else one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in own)
    moved = {b: 0x100 + i for i, b in enumerate(others)}
    return [chr(moved.get(b, b)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in the order of their ranks, which must be 0, 1, 2, ..."""
    with open(path, "rb") as f:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, filter(bytes.strip, f))}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks are not 0 to {len(ranks) - 1}")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def _float(field: int, x: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", x)


def model_bytes(tokens: list[bytes]) -> bytes:
    """The vocabulary as a serialised sentencepiece BPE model; ids are the ranks."""
    letters = byte_characters()
    out = [
        _block(PIECES, _block(PIECE, "".join(letters[b] for b in token).encode()) + _float(SCORE, -rank) + _number(TYPE, NORMAL))
        for rank, token in enumerate(tokens)
    ]
    out.append(_block(PIECES, _block(PIECE, b"<unk>") + _float(SCORE, 0) + _number(TYPE, UNKNOWN)))
    out.append(_block(TRAINER, _number(MODEL_TYPE, BPE) + _number(VOCAB_SIZE, len(tokens) + 1) + _number(UNK_ID, len(tokens))
                      + b"".join(_number(f, -1) for f in (BOS_ID, EOS_ID, PAD_ID))))
    out.append(_block(NORMALIZER, _block(NAME, b"identity") + b"".join(
        _number(f, 0) for f in (ADD_DUMMY_PREFIX, REMOVE_EXTRA_WHITESPACES, ESCAPE_WHITESPACES))))
    return b"".join(out)


class Vocabulary:
    """Encodes and decodes by a serialised model; built once per worker."""

    def __init__(self, tokens: list[bytes]):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(tokens))
        self.letters = str.maketrans({b: c for b, c in enumerate(byte_characters())})
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        # a pre-token that is itself a token is that token, even where no merges lead to it
        pieces = [t.decode("latin-1").translate(self.letters) for t in tokens]
        self.whole = {p: [i] for i, (p, ids) in enumerate(zip(pieces, self.model.encode(pieces), strict=True)) if ids != [i]}
        self.encode = Encoder(self._pieces)

    def _pieces(self, pretokens: list[str]) -> list[list[int]]:
        mapped = [p.encode("utf-8").decode("latin-1").translate(self.letters) for p in pretokens]
        return [self.whole.get(m, ids) for m, ids in zip(mapped, self.model.encode(mapped, num_threads=1), strict=True)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts end to end, offsets by text)."""
        data, ends = gather(self.flat, self.begins, self.lengths, ids)
        return data, np.concatenate([[0], ends])[offsets]


def _vocabulary(tokens: list[bytes]) -> Vocabulary:
    key = hashlib.sha256(b"\n".join(tokens)).digest()
    return memo(("byte_bpe", key), lambda: Vocabulary(tokens))


def encode(docs: DataFrame, ranks_path: str) -> DataFrame:
    """One row per document: doc_id, ids (array of int).

    NULL and empty texts have no ids; a NULL doc_id is carried along; repeated
    rows are encoded each; an empty table gives an empty result.  Other columns
    are not read.
    """
    tokens = read_ranks(ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(tokens)
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text")):
                ids, at = vocabulary.encode(_texts(data, offsets))
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), lists], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The texts of ``encode``'s rows: doc_id, text (bytes that are no UTF-8 become U+FFFD; NULL ids: empty)."""
    tokens = read_ranks(ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(tokens)
        for batch in batches:
            lists = [np.array(x or [], np.int64) for x in batch.column("ids").to_pylist()]
            data, at = vocabulary.decode(np.concatenate([*lists, np.zeros(0, np.int64)]), np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)]))
            texts = [data[i:j].tobytes().decode("utf-8", "replace") for i, j in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, ranks_path: str) -> DataFrame:
    """Digests of the ids and of the bytes they decode to: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Ids are hashed as little-endian unsigned 32-bit integers.  Rows as in ``encode``.
    """
    tokens = read_ranks(ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(tokens)
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text")):
                ids, at = vocabulary.encode(_texts(data, offsets))
                back, ends = vocabulary.decode(ids, at)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a), pa.array(np.diff(at)),
                    pa.array(_digests(ids, at), pa.string()), pa.array(_digests(back, ends), pa.string()),
                ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _texts(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    raw = data.tobytes()
    at = offsets.tolist()
    return [raw[i:j].decode("utf-8", "replace") for i, j in zip(at[:-1], at[1:], strict=True)]


def _digests(values: np.ndarray, offsets: np.ndarray) -> list[str]:
    at = offsets.tolist()
    return [hashlib.sha256(values[i:j].tobytes()).hexdigest() for i, j in zip(at[:-1], at[1:], strict=True)]
