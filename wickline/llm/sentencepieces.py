"""SentencePiece encoding and decoding (operator 7) by a streaming Viterbi pass.

A text streams left to right through the lattice of pieces.  Each position
keeps a backpointer to the start of the last piece of its best path; a piece
is at most ``longest`` symbols long, so only positions of that window can
still be reached from later text.  Whenever the paths from all of them meet at
one boundary, ids up to it are committed and the lattice before it is dropped.

The vocabulary is a BPE one, whose best path is the one the merges give, not
the one of highest score sum.  Its transitions are therefore scored 0 where
the pair of pieces stays itself under the merges and minus infinity elsewhere;
exactly one path to each position survives.  The pieces that end at a position
come from an automaton over all pieces, which reads each symbol once.  No piece
holds a space mark after another character, so all paths meet at every word's
start; words are encoded one by one and remembered within a bounded memory.

Defined cases: a null or empty text has no ids; characters without a piece
become the pieces of their UTF-8 bytes; U+2581 is the space mark itself and
decodes to a space (the one loss of a round trip); strings of control pieces
are ordinary text; rows are independent, so repeated and null ids stay as they
are; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.llm.base import arrow, batch, kept_for_stage
from wickline.llm.bpe import REMEMBERED, START, Memory, PrefixEncoder

SPACE = "▁"


class PieceCodec:
    """Encodes and decodes with the pieces of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, norm = model.trainer_spec, model.normalizer_spec
        if spec.model_type != spec.BPE or not spec.byte_fallback or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError(f"{path}: not a BPE model with byte fallback and plain text")
        normal = [(i, p.piece, p.score) for i, p in enumerate(model.pieces) if p.type == p.NORMAL]
        if any(SPACE in p.lstrip(SPACE) for _, p, _ in normal):
            raise ValueError(f"{path}: a piece holds a space mark after another character")
        cost = {p: -score for _, p, score in normal}
        self.encoder = PrefixEncoder((p for _, p, _ in normal), lambda a, b: cost.get(a + b))
        self.ids = [0, *(i for i, _, _ in normal)]
        known = "".join(p for p in cost if len(p) == 1)
        #: Runs of symbols that have pieces, and single ones that have none.
        self.runs = re.compile(f"[{re.escape(known)}]+|.", re.DOTALL)
        self.known = frozenset(known)
        #: Every piece that ends at a symbol: its length, its number, and
        #: whether it may follow the tokens it has been tried after.
        self.ending = ahocorasick.Automaton()
        for number, (_, p, _) in enumerate(normal, 1):
            self.ending.add_word(p, (len(p), number, {}))
        self.ending.make_automaton()
        self.held = 0
        self.bytes_at = {p.piece: i for i, p in enumerate(model.pieces) if p.type == p.BYTE}
        self.byte_ids = [self.bytes_at[f"<0x{b:02X}>"] for b in range(256)]
        self.raw = [p.piece.replace(SPACE, " ").encode() if p.type == p.NORMAL else b"" for p in model.pieces]
        for b, i in enumerate(self.byte_ids):
            self.raw[i] = bytes([b])
        self.words = Memory(self._word, 300_000)

    def stream(self, symbols: str) -> Iterator[list[int]]:
        """Piece ids of a text in space marks, committed as paths converge."""
        for m in self.runs.finditer(symbols):
            run = m.group()
            if run[0] in self.known:
                yield from self._lattice(run)
            else:  # a boundary of every path
                yield [self.byte_ids[b] for b in run.encode("utf-8", "surrogatepass")]

    def _lattice(self, run: str) -> Iterator[list[int]]:
        """Piece ids of symbols that all have pieces.

        ``token`` and ``back`` are the last piece of the path to each position
        of the window and where that piece starts; the window begins at
        ``base``, before which everything is committed, and its paths are
        found up to ``reached``."""
        longest = self.encoder.longest
        token, back, base, reached, check = [START], [-1], 0, 0, 4 * longest
        for end, (length, number, after) in self.ending.iter(run):
            if end < reached:  # its path is found
                continue
            j = end + 1 - base - length
            if j < 0:  # a piece across the committed boundary is on no path
                continue
            last = token[j]
            fits = after.get(last)
            if fits is None:
                fits = self._tried(last, number, after)
            if fits:
                token.append(number)
                back.append(j)
                reached = end + 1
                if reached - base == check:
                    meet = self._meeting(back, longest)
                    if meet > 0:
                        yield self._path(token, back, meet)
                        base += meet
                        token = token[meet:]
                        back = [-1, *[max(b - meet, -1) for b in back[meet + 1 :]]]
                    check = max(reached - base + longest, 4 * longest)
        yield self._path(token, back, reached - base)

    def _tried(self, last: int, number: int, after: dict[int, bool]) -> bool:
        """Whether a piece may follow the last one, remembered with the piece;
        all is forgotten once a bounded number of pairs is held."""
        if self.held >= REMEMBERED:
            for _, _, other in self.ending.values():
                other.clear()
            self.held = 0
        self.held += 1
        after[last] = fits = self.encoder.joined(last, number)
        return fits

    def _path(self, token: list[int], back: list[int], end: int) -> list[int]:
        out, ids = [], self.ids
        while end > 0:
            out.append(ids[token[end]])
            end = back[end]
        out.reverse()
        return out

    @staticmethod
    def _meeting(back: list[int], longest: int) -> int:
        """The last boundary on the paths of all positions still in reach."""
        open_ends = set(range(len(back) - longest, len(back)))
        while len(open_ends) > 1:
            far = max(open_ends)
            open_ends.remove(far)
            open_ends.add(back[far])
        return open_ends.pop()

    def _word(self, word: str) -> bytes:
        return b"".join([array("i", part).tobytes() for part in self.stream(SPACE + word)])

    def encode(self, text: str) -> np.ndarray:
        """Piece ids of a whole text."""
        if not text:
            return np.zeros(0, np.int32)
        parts = text.replace(SPACE, " ").split(" ")
        if "" not in parts:
            raw = b"".join(map(self.words.__getitem__, parts))
        else:
            out, spaces = [], 0
            for part in parts:
                if part:
                    out.append(self.words[SPACE * spaces + part] if spaces else self.words[part])
                    spaces = 0
                else:
                    spaces += 1
            if spaces:
                out.append(self.words[SPACE * (spaces - 1)])
            raw = b"".join(out)
        return np.frombuffer(raw, np.int32)

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids.tolist()))
        return raw.decode("utf-8", "replace")[1:] if raw.startswith(b" ") else raw.decode("utf-8", "replace")


@kept_for_stage
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encode_pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids: the piece ids of every text."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def encode(b: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(path)
        ids = [own.encode(t.as_py() or "") for t in b["text"]]
        off = np.zeros(len(ids) + 1, np.int32)
        np.cumsum([len(x) for x in ids], out=off[1:])
        return batch(doc_id=b["doc_id"], ids=pa.ListArray.from_arrays(off, np.concatenate(ids)))

    return arrow(src, encode, "doc_id long, ids array<int>")


def decode_pieces(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, ids and text: the text of every list of piece ids."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def decode(b: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(path)
        texts = [own.decode(x.values.to_numpy()) if x.is_valid else "" for x in b["ids"]]
        return batch(doc_id=b["doc_id"], ids=b["ids"], text=pa.array(texts, pa.string()))

    return arrow(src, decode, "doc_id long, ids array<int>, text string")


def piece_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (of the ids as little-endian unsigned
    32-bit integers), n_chars and text_sha256 of the decoded text."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def digest(b: pa.RecordBatch) -> pa.RecordBatch:
        own, rows = codec(path), []
        for t in b["text"]:  # ids stay in the task that makes and decodes them
            ids = own.encode(t.as_py() or "")
            text = own.decode(ids)
            rows.append((len(ids), zlib.crc32(ids.astype("<u4").tobytes()), len(text), hashlib.sha256(text.encode()).hexdigest()))
        n, crc, chars, sha = zip(*rows, strict=True)
        return batch(
            doc_id=b["doc_id"], n_tokens=np.array(n, np.int64), ids_crc32=np.array(crc, np.int64), n_chars=np.array(chars, np.int64), text_sha256=pa.array(sha)
        )

    return arrow(src, digest, "doc_id long, n_tokens long, ids_crc32 long, n_chars long, text_sha256 string")


def library_ids(path: str, texts: list[str]) -> list[list[int]]:
    """The library's own ids, for tests."""
    return sentencepiece.SentencePieceProcessor(model_file=path).encode(texts, num_threads=1)
