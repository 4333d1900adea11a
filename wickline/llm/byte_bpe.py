"""Byte-level BPE by a sentencepiece model made from the vocabulary.

A byte-level vocabulary of ranks becomes a sentencepiece model of the BPE
kind: each byte is written as one letter, each token's score is its negative
rank, and the normalisation is the identity.  The model then joins the pair
of least rank first, the leftmost of equals, as the ranks say.  Each match of
the split pattern is encoded by itself; a match that is a token is that token.
Decoding looks ids up in the model's own pieces and turns letters back into
bytes.

Defined results: a null text is an empty one and has no ids; bytes that are
no UTF-8 are read as U+FFFD; a text that the pattern does not cover keeps
only the matches.  Ids are returned as little-endian unsigned 32-bit
integers.  Texts longer than ``WHOLE`` are matched piece by piece, so the
matches of one never stand in memory together.  Rows and ids (null, repeated)
pass through as they come.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.llm.base import arrow, batch, kept_for_stage

#: Code points up to which a text's matches are listed at once.
WHOLE = 1 << 18
#: Matches of a longer text taken at a time.
MATCHES = 1 << 16
#: Remembered matches, and the longest of them.
REMEMBERED, LONGEST = 1 << 17, 48

#: The letter that stands for byte b is the code point FIRST_LETTER + b.
FIRST_LETTER = 0x100
LETTERS = [chr(FIRST_LETTER + b) for b in range(256)]

# Field numbers and types of the public sentencepiece model format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, KIND = 1, 2, 3
UNKNOWN_KIND = 2
MODEL_TYPE, VOCAB_SIZE, UNK_ID, BOS_ID, EOS_ID, PAD_ID = 3, 4, 40, 41, 42, 43
BPE_TYPE = 2
NAME, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 1, 3, 4, 5


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _varint(n: int) -> bytes:
    n &= 2**64 - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def letters(data: bytes) -> str:
    return "".join([LETTERS[b] for b in data])


def model_proto(tokens: list[bytes]) -> bytes:
    """A serialised model whose piece i is ``tokens[i]`` (in order of rank,
    no two alike), followed by the unknown piece that every model needs."""
    out = []
    for i, token in enumerate(tokens):
        out.append(_bytes(PIECES, _bytes(PIECE, letters(token).encode()) + _varint(SCORE << 3 | 5) + struct.pack("<f", -float(i))))
    out.append(_bytes(PIECES, _bytes(PIECE, b"<unk>") + _number(KIND, UNKNOWN_KIND)))
    out.append(
        _bytes(TRAINER, _number(MODEL_TYPE, BPE_TYPE) + _number(VOCAB_SIZE, len(tokens) + 1) + _number(UNK_ID, len(tokens))
               + b"".join(_number(f, -1) for f in (BOS_ID, EOS_ID, PAD_ID)))
    )
    out.append(_bytes(NORMALIZER, _bytes(NAME, b"identity") + b"".join(_number(f, 0) for f in (DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES))))
    return b"".join(out)


class ByteBpe(dict):
    """Encoder and decoder of one vocabulary; as a dictionary, the ids (as
    bytes) of matches met so far."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        ranks = read_ranks(path)
        tokens = sorted(ranks, key=ranks.__getitem__)
        if len(tokens) >= 2**24:
            raise ValueError("ranks beyond 2**24 have no exact score")
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a token: {missing[:5]}")
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(tokens))
        self.split = regex.compile(pattern)
        self.token_id = {t: struct.pack("<I", i) for t, i in ranks.items()}
        self.piece_id = np.array([ranks[t] for t in tokens], dtype="<u4")
        # decoding reads the model's own pieces
        back = {c: b for b, c in enumerate(LETTERS)}
        self.piece_bytes = {ranks[t]: bytes([back[c] for c in self.model.id_to_piece(i)]) for i, t in enumerate(tokens)}

    def __missing__(self, word: str) -> bytes:
        data = word.encode("utf-8", "surrogatepass")
        ids = self.token_id.get(data)
        if ids is None:
            ids = self.piece_id[self.model.encode(letters(data), out_type=int)].tobytes()
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids of ``text`` in parts, as little-endian 32-bit integers."""
        if len(text) <= WHOLE:
            yield b"".join(map(self.__getitem__, self.split.findall(text)))
            return
        found = self.split.finditer(text)
        while part := [m.group() for m in islice(found, MATCHES)]:
            yield b"".join(map(self.__getitem__, part))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.piece_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@kept_for_stage
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """The encoder of this worker."""
    return ByteBpe(path, pattern)


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))


def _text(value: pa.Scalar) -> str:
    data = value.as_buffer()
    return "" if data is None else str(data, "utf-8", "replace")


def encode_ids(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (binary) of every text."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        bpe = byte_bpe(path, pattern)
        ids = [b"".join(bpe.encode(_text(t))) for t in b["text"]]
        return batch(doc_id=b["doc_id"], n_tokens=np.array([len(i) // 4 for i in ids], np.int64), ids=pa.array(ids, pa.binary()))

    return arrow(_texts(df, id_col, text_col), run, "doc_id long, n_tokens long, ids binary")


def decode_ids(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``decoded`` (binary: the bytes of the text) of rows of
    :func:`encode_ids`; null ids decode to nothing, unknown ids raise."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        bpe = byte_bpe(path, pattern)
        return batch(doc_id=b["doc_id"], decoded=pa.array([bpe.decode(i.as_py() or b"") for i in b["ids"]], pa.binary()))

    return arrow(df.select("doc_id", "ids"), run, "doc_id long, decoded binary")


def byte_bpe_digests(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``: every
    text encoded and its ids decoded again, part by part, in one scan."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        bpe = byte_bpe(path, pattern)
        counts, of_ids, of_bytes = [], [], []
        for t in b["text"]:
            n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
            for ids in bpe.encode(_text(t)):
                n += len(ids) // 4
                ids_hash.update(ids)
                text_hash.update(bpe.decode(ids))
            counts.append(n)
            of_ids.append(ids_hash.hexdigest())
            of_bytes.append(text_hash.hexdigest())
        return batch(doc_id=b["doc_id"], n_tokens=np.array(counts, np.int64), ids_sha256=of_ids, decoded_sha256=of_bytes)

    return arrow(_texts(df, id_col, text_col), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
