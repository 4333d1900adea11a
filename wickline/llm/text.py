"""Vectorised words, lines and hashes over the UTF-8 bytes of Arrow strings.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  Hashes are
polynomial prefix sums modulo 2**64 over random byte values, then mixed; two
independent ones make a 128-bit key.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from wickline.llm.base import forget_after_stage

U64 = np.uint64
#: Bytes of text worked on at a time; one longer text is a chunk of its own.
CHUNK_BYTES = 1 << 18

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Every ASCII character that is neither letter nor digit.
PUNCTUATION = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

#: Odd multipliers of the two polynomial hashes and of mixing (fixed values).
ROOTS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MIX_A, MIX_B = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> U64(30))) * MIX_A
    h = (h ^ (h >> U64(27))) * MIX_B
    return h ^ (h >> U64(31))


@lru_cache(maxsize=2)
def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed + 20240501).integers(1, 2**63, 256, dtype=np.uint64) | U64(1)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
forget_after_stage(_POWERS.clear)


def _powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """root**i and its inverse modulo 2**64 for i < n."""
    have = _POWERS.get(seed)
    if have is None or len(have[0]) < n:
        size = 1 << max(18, (n - 1).bit_length())
        out = []
        for base in (ROOTS[seed], pow(ROOTS[seed], -1, 2**64)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = (out[0], out[1])
        if size <= 1 << 22:
            _POWERS[seed] = have
    return have


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte span of ``data``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(seed, len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_byte_values(seed)[data] * power[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64) * U64(ROOTS[1 - seed]))


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    buffers = texts.buffers()
    off = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(off, off[row] + CHUNK_BYTES, side="right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, end, data[off[row] : off[end]], off[row : end + 1] - off[row]
        row = end


def words(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, word starts, word ends, words before each row)."""
    low = LOWER[data]
    n = len(low)
    if n == 0:
        none = np.zeros(0, np.int64)
        return low, none, none, np.zeros(len(offsets), np.int64)
    inside = ~separator[low]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    rows = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[rows] = inside[rows]
    last[rows[1:] - 1] = inside[rows[1:] - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return low, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words before each row) of a chunk."""
    low, starts, ends, before = words(data, offsets)
    return span_hash(low, starts, ends), before


def ngram_hashes(word: np.ndarray, before: np.ndarray, n: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows of each row, and how many stand before
    each row.  With ``short`` a row of fewer than n words has its whole word
    sequence as one; a row without words has none."""
    counts = np.diff(before)
    full = np.maximum(counts - n + 1, 0)
    if len(word) >= n:
        acc = word[: len(word) - n + 1].copy()
        for k in range(1, n):
            acc = mix(acc * MIX_B + word[k : len(word) - n + 1 + k])
    else:
        acc = np.zeros(0, np.uint64)
    total = full + ((counts > 0) & (counts < n)) if short else full
    at = np.zeros(len(before), np.int64)
    np.cumsum(total, out=at[1:])
    out = np.zeros(int(at[-1]), np.uint64)
    keep = np.zeros(len(acc) + 1, np.int32)
    some = full > 0
    np.add.at(keep, before[:-1][some], 1)
    np.add.at(keep, before[:-1][some] + full[some], -1)
    inside = np.cumsum(keep)[: len(acc)] > 0
    where = np.ones(len(out), dtype=bool)
    if short:
        few = np.flatnonzero((counts > 0) & (counts < n))
        where[at[few]] = False
        for r in few:
            h = word[before[r] : before[r] + 1]
            for w in word[before[r] + 1 : before[r + 1]]:
                h = mix(h * MIX_B + w)
            out[at[r]] = mix(h + U64(counts[r]))[0]
    out[where] = acc[inside]
    return out, at
