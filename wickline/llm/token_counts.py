"""Token counts (operator 10): the exact count at every prefix of a text.

For a word-level BPE with an end-of-word mark, a prefix that ends inside a
word is a word of its own: its last token bears the mark, the tokens before it
do not.  The dynamic program keeps, for every position, the last unmarked
token and the count up to it; the count of the prefix adds the one marked
token that may follow.  Counts are stored per document as compressed
differences, one for each code point, so the count, a cut at a token budget or
the count of any prefix needs no second encoding.

Defined cases: a null text counts as empty, with 0 tokens; special strings of
the vocabulary are one token each, as the tokenizers library takes them by
default, once they are complete, and ordinary text before; rows are
independent, so repeated ids and null ids stay as they are; other columns are
ignored.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.llm.base import arrow, batch, kept_for_stage
from wickline.llm.bpe import START, Memory, PrefixEncoder

END = "\0"
#: Symbols of a word whose state is remembered for all words that begin so.
HEAD = 5


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, extra = {b: chr(b) for b in shown}, 0x100
    for b in range(256):
        if b not in table:
            table[b], extra = chr(extra), extra + 1
    return [table[b] for b in range(256)]


def _symbols(token: str, mark: str) -> list[str]:
    own = token[: -len(mark)] if token.endswith(mark) else token
    return list(own) if own is token else [*own[:-1], own[-1:] + END]


class WordCounter:
    """Prefix counts under a lower-casing word BPE in a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, mark = spec["model"], spec["model"]["end_of_word_suffix"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or not mark or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: not a lower-casing word BPE with an end-of-word mark")
        own = lambda t: "".join(_symbols(t, mark))
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        ranks = {(own(a), own(b)): i for i, (a, b) in enumerate(pairs)}
        self.encoder = PrefixEncoder((_symbols(t, mark) for t in model["vocab"]), lambda a, b: ranks.get((a, b)))
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(rf"{pattern}|\s+")
        self.blank = regex.compile(r"\s+")
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, self.specials)))
        self.symbols = byte_symbols()
        self.words = Memory(self._word)
        self.heads = Memory(self._head)

    def _extend(self, s: str, token: list[int], count: list[int], out: list[int], wanted: set[int] | None) -> None:
        """Positions after those already in ``token``; ``out`` gets the count
        of each wanted prefix taken as a whole word."""
        last, n = self.encoder.last, len(s)
        for i in range(len(token), n + 1):
            if wanted is None or i in wanted:
                out.append(count[last(s, i, token, s[i - 1] + END)[1]] + 1)
            if i < n:
                t, j = last(s, i, token)
                token.append(t)
                count.append(count[j] + 1)

    def _head(self, s: str) -> tuple[list[int], list[int], list[int]]:
        """The state after a word's first symbols, shared by all words that begin so."""
        state = ([START], [0], [])
        self._extend(s + s[-1], *state, None)
        return state[0], state[1], state[2][:-1]

    def word(self, piece: str) -> list[int]:
        """The token count of every prefix of one word, by code point."""
        if piece.isascii():
            s = "".join([self.symbols[b] for b in piece.encode()])
            if len(s) > HEAD:
                token, count, out = (x.copy() for x in self.heads[s[:HEAD]])
            else:
                token, count, out = [START], [0], []
            self._extend(s, token, count, out, None)
            return out
        s, ends, out = "", set(), []
        for c in piece:
            s += "".join([self.symbols[b] for b in c.encode()])
            ends.add(len(s))
        self._extend(s, [START], [0], out, ends)
        return out

    def _word(self, piece: str) -> bytes:
        """Differences of the counts at the prefixes of one piece."""
        if self.blank.fullmatch(piece):
            return b"\0" * len(piece)
        got = self.word(piece)
        if len(piece) > 1 and piece[0] == "'":  # until a contraction is complete, its parts are words
            for i in range(1, len(piece)):
                got[i - 1] = sum(self.word(m[0])[-1] for m in self.pieces.finditer(piece[:i]))
        diff = [b - a for a, b in zip([0, *got], got)]
        if min(diff) < -128 or max(diff) > 127:
            raise OverflowError(piece)
        return bytes([x & 0xFF for x in diff])

    def _ordinary(self, text: str) -> bytes:
        """Differences over a normalised text without special strings."""
        return b"".join(map(self.words.__getitem__, self.pieces.findall(text)))

    def _plain(self, text: str) -> bytes:
        """Differences over a text without special strings."""
        low = text.lower()
        if text.isascii() or (len(low) == len(text) and "\u03a3" not in text and unicodedata.is_normalized("NFC", text)):
            return self._ordinary(low)
        return self._by_words(text)

    def _by_words(self, text: str) -> bytes:
        out = []
        for part in regex.findall(r"\S+|\s+", text):
            low = "".join(c.lower() for c in part)
            if len(low) == len(part) and unicodedata.is_normalized("NFC", part):
                out.append(self._ordinary(low))
                continue
            before = 0
            for i in range(1, len(part) + 1):
                whole = self._ordinary("".join(c.lower() for c in unicodedata.normalize("NFC", part[:i])))
                count = int(np.frombuffer(whole, np.int8).sum(dtype=np.int64))
                if not -128 <= count - before <= 127:
                    raise OverflowError(part)
                out.append(bytes([(count - before) & 0xFF]))
                before = count
        return b"".join(out)

    def differences(self, text: str) -> np.ndarray:
        """Difference of the token counts of the prefixes at each code point."""
        out, at = [], 0
        for m in self.special.finditer(text):
            before = self._plain(text[at : m.end() - 1])
            out.append(before)
            counts = np.cumsum(np.frombuffer(before, np.int8), dtype=np.int64)
            own = (counts[m.start() - at - 1] if m.start() > at else 0) + 1
            out.append(bytes([int(own - (counts[-1] if len(counts) else 0)) & 0xFF]))
            at = m.end()
        out.append(self._plain(text[at:] if at else text))
        return np.frombuffer(b"".join(out), np.int8)


@kept_for_stage
def counter(path: str) -> WordCounter:
    return WordCounter(path)


def pack(diff: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(diff.tobytes())


def prefix_counts(packed: bytes) -> np.ndarray:
    """The token count at every prefix: entry i is that of the first i + 1 code points."""
    raw = zstandard.ZstdDecompressor().decompress(packed)
    return np.cumsum(np.frombuffer(raw, np.int8), dtype=np.int64)


def longest_within(counts: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", budget: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars (code points of the
    longest prefix within ``budget``) and ``prefix``, the packed counts at
    every prefix (see :func:`prefix_counts`)."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def count(b: pa.RecordBatch) -> pa.RecordBatch:
        words = counter(path)
        n_bytes, n_tokens, fit, packed = [], [], [], []
        for text in b["text"]:
            text = text.as_py() or ""
            diff = words.differences(text)
            counts = np.cumsum(diff, dtype=np.int64)
            total = int(counts[-1]) if len(counts) else 0
            n_bytes.append(len(text.encode()))
            n_tokens.append(total)
            packed.append(pack(diff))
            fit.append(len(text) if total <= budget else longest_within(counts, budget))
        tokens = np.array(n_tokens, np.int64)
        return batch(
            doc_id=b["doc_id"], n_bytes=np.array(n_bytes, np.int64), n_tokens=tokens,
            over_limit=tokens > budget, fit_chars=np.array(fit, np.int64), prefix=pa.array(packed, pa.binary()),
        )

    return arrow(src, count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long, prefix binary")
