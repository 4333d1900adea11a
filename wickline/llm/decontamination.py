"""Benchmark decontamination (operator 6) by latent semantic retrieval.

Benchmark items are cut into passages and weighted by TF-IDF, with document
frequencies of the whole corpus.  A distributed randomised SVD of the passages
gives a latent space; windows of the documents at the passages' scales are
projected into it and searched by cosine.  A candidate is checked by the
longest common subsequence of words between the item and the text around the
window, and by how much of the item's answer (its last words) is there, so
paraphrases that replace, add or drop words are found and look-alikes are not.

Only windows around which enough of an item's rarest words stand are projected:
an item of which ``COMMON`` is there in order can lack no more than the other
words, so this loses nothing.  Benchmark passages go
through in blocks of ``BLOCK``, each against all documents, so what is sent to
tasks is bounded.

Items of more words than the largest scale are cut into overlapping passages,
each searched and checked as an item of its own, so a document that holds a
part of a long item is found too.  Items of fewer than ``MIN_WORDS`` words have
no direction worth a cosine: they are looked up exactly, as a run of words.

Defined cases: words are runs of letters, digits and non-ASCII characters
in lower case; null or empty texts and items match nothing; items of fewer
than 8 words must be there word for word; repeated documents or items give one row
for each pair of ids; null ids match like others; empty tables give no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.llm.base import arrow, arrow_iter, batch, partitions_for, real_id, staged, unstage, with_ids
from wickline.llm.text import PUNCTUATION, U64, chunks, span_hash, words

MIN_WORDS = 5
#: Words of a document window; a passage is searched at the scale nearest its length.
SCALES = (8, 16, 32, 64)
BLOCK = 512
#: Items whose passages one task is meant to write.
ITEMS_PER_PARTITION = 10_000
#: As many dimensions as passages of a block: fewer lose passages that share
#: no words with others.
RANK, OVERSAMPLING = 512, 10
COSINE = 0.45
#: Windows and passages compared at a time.
PAIRS = 512
#: Shares of the item's and of the answer's words that must be there in order.
COMMON, ANSWER = 0.7, 0.5
#: Share of the item's words by which the rare words looked for outnumber those
#: that may be missing; it changes the time only.
RARE = 0.35
_QUICK_BITS = 22


def _words(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, word hashes, words before each row)."""
    for r0, r1, data, off in chunks(pc.utf8_lower(texts)):
        low, starts, ends, before = words(data, off, PUNCTUATION)
        yield r0, r1, span_hash(low, starts, ends), before


def passages(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, part, scale, words): items cut to at most the largest scale, half
    overlapping; scale 0: too short for a window."""
    most = SCALES[-1]

    def cut(b: pa.RecordBatch) -> pa.RecordBatch | None:
        item, part, scale, own = [], [], [], []
        ids = b["__id"].to_pylist()
        for r0, r1, h, before in _words(b["text"]):
            for r in range(r0, r1):
                w = h[before[r - r0] : before[r - r0 + 1]].view(np.int64)
                if not len(w):
                    continue
                starts = range(0, max(1, len(w) - most // 2), most // 2) if len(w) > most else (0,)
                for k, s in enumerate(starts):
                    p = w[s : s + most]
                    item.append(ids[r])
                    part.append(k)
                    scale.append(min(SCALES, key=lambda x: abs(np.log(x / len(p)))) if len(w) >= MIN_WORDS else 0)
                    own.append(p)
        if not item:
            return None
        many = pa.list_(pa.int64())
        return batch(item=np.array(item, np.int64), part=np.array(part, np.int32), scale=np.array(scale, np.int32), words=pa.array(own, many))

    src = with_ids(benchmark, id_col, text_col).select("__id", F.col(text_col).alias("text"))
    return arrow(src, cut, "item long, part int, scale int, words array<long>").dropDuplicates(["item", "part", "words"])


class _Vocabulary:
    """The words of a block of passages."""

    def __init__(self, h: np.ndarray):
        self.words = h
        self.quick = np.zeros(1 << _QUICK_BITS, bool)
        self.quick[h >> U64(64 - _QUICK_BITS)] = True

    def number(self, h: np.ndarray) -> np.ndarray:
        """Each word's number, -1 for others."""
        out = np.full(len(h), -1, np.int32)
        maybe = np.flatnonzero(self.quick[h >> U64(64 - _QUICK_BITS)])
        at = np.minimum(np.searchsorted(self.words, h[maybe]), len(self.words) - 1)
        hit = self.words[at] == h[maybe]
        out[maybe[hit]] = at[hit]
        return out


def document_frequencies(docs: DataFrame, vocabulary: _Vocabulary) -> tuple[int, np.ndarray]:
    """(documents, documents with each word) over the whole corpus."""
    size = len(vocabulary.words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(size, np.int64), 0
        for b in batches:
            n += b.num_rows
            for _, _, h, before in _words(b["text"]):
                number = vocabulary.number(h)
                known = np.flatnonzero(number >= 0)
                row = np.searchsorted(before, known, side="right") - 1
                pairs = np.unique(row * size + number[known])
                df += np.bincount(pairs % size, minlength=size)
        some = np.flatnonzero(df)
        yield batch(word=np.append(some, -1).astype(np.int32), n=np.append(df[some], n))

    got = arrow_iter(docs.select("text"), count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size + 1, np.int64)
    out[got["word"].to_numpy()] = got["n"].to_numpy()
    return int(out[-1]), out[:-1]


def _weighted(number: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers, TF-IDF weights) of one passage."""
    at, n = np.unique(number, return_counts=True)
    return at, n * idf[at]


def _rows(b: pa.RecordBatch, vocabulary: _Vocabulary, idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for w in b["words"]:
        yield _weighted(vocabulary.number(w.values.to_numpy().view(np.uint64)), idf)


_FEATURE_ROWS = 2048


def _spread(rows: DataFrame, vocabulary: _Vocabulary, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Aᵀ(A · basis) for the passages' TF-IDF matrix A: each task adds up its
    rows, blocks of features are summed by key."""
    m, k = basis.shape

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((m, k))
        for b in batches:
            for at, weight in _rows(b, vocabulary, idf):
                total[at] += np.outer(weight, weight @ basis[at])
        for f in range(0, m, _FEATURE_ROWS):
            yield batch(f=np.array([f], np.int32), part=pa.array([total[f : f + _FEATURE_ROWS].tobytes()], pa.binary()))

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()) for x in table["part"])
        return pa.table({"f": table["f"].slice(0, 1), "part": pa.array([total.tobytes()], pa.binary())})

    got = arrow_iter(rows, part, "f int, part binary").groupBy("f").applyInArrow(add, "f int, part binary").toArrow()
    out = np.zeros((m, k))
    for f, raw in zip(got["f"].to_pylist(), got["part"].to_pylist(), strict=True):
        out[f : f + _FEATURE_ROWS] = np.frombuffer(raw).reshape(-1, k)
    return out


def latent_space(rows: DataFrame, vocabulary: _Vocabulary, idf: np.ndarray, n_rows: int) -> np.ndarray:
    """The leading right singular vectors [word, dimension] of the passages'
    TF-IDF matrix, by a randomised range finder with one power iteration."""
    m = len(vocabulary.words)
    k = min(RANK + OVERSAMPLING, m, n_rows)
    basis = np.random.default_rng(7).standard_normal((m, k))
    for _ in range(2):
        basis, _ = np.linalg.qr(_spread(rows, vocabulary, idf, basis))
    # singular vectors within the range: eigenvectors of basisᵀ AᵀA basis
    small = basis.T @ _spread(rows, vocabulary, idf, basis)
    _, turn = np.linalg.eigh((small + small.T) / 2)
    return (basis @ turn[:, ::-1][:, : min(RANK, k)]).astype(np.float32)


@dataclass
class _Rare:
    """The rare words of a block's items: ``items[start[w] : start[w + 1]]``
    hold word w, and ``need`` of an item's are around it wherever it matches."""

    vocabulary: _Vocabulary
    start: np.ndarray
    items: np.ndarray
    need: np.ndarray


def _least(n: int) -> float:
    """The share of an item of ``n`` words that must be there in order."""
    return COMMON if n >= 8 else 1.0


def _rare(item_words: list[list[int]], vocabulary: _Vocabulary, idf: np.ndarray) -> _Rare:
    chosen, need = [], []
    for item in item_words:
        h = np.array(item, np.int64).view(np.uint64)
        number = vocabulary.number(h)
        rarity = np.where(number >= 0, idf[number], 0)
        lacking = len(h) - int(np.ceil(_least(len(h)) * len(h) - 1e-9))
        most = min(len(h), lacking + max(1, int(np.ceil(RARE * len(h)))))
        chosen.append(np.unique(h[np.argsort(-rarity, kind="stable")[:most]]))
        need.append(most - lacking)
    of = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen])
    words, at = np.unique(np.concatenate(chosen), return_inverse=True)
    start = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.bincount(at, minlength=len(words)), out=start[1:])
    return _Rare(_Vocabulary(words), start, of[np.argsort(at, kind="stable")], np.array(need))


@dataclass
class _Block:
    """What tasks need of a block of passages."""

    vocabulary: _Vocabulary
    idf: np.ndarray
    space: np.ndarray
    item: np.ndarray
    scale: np.ndarray
    latent: np.ndarray
    item_words: list[list[int]]
    rare: _Rare


def lcs(masks: dict[int, int], length: int, text: list[int]) -> int:
    """Length of the longest common subsequence; ``masks``: bits of the places
    of each word of a sequence of ``length`` words."""
    full = (1 << length) - 1
    rest = full
    for w in text:
        here = masks.get(w)
        if here:
            both = rest & here
            rest = ((rest + both) | (rest - both)) & full
    return length - rest.bit_count()


def _masks(sequence: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(sequence):
        out[w] = out.get(w, 0) | 1 << i
    return out


def _agree(item: list[int], text: list[int]) -> tuple[float, float]:
    """Shares of the item and of its answer found in order in the text."""
    tail = item[-max(3, -(-len(item) // 5)) :]
    return lcs(_masks(item), len(item), text) / len(item), lcs(_masks(tail), len(tail), text) / len(tail)


def _windows(before: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of windows of ``size`` words every quarter of it."""
    step = max(1, size // 4)
    n = np.diff(before)
    count = np.where(n > 0, np.maximum(0, -(-(n - size) // step)) + 1, 0)
    row = np.repeat(np.arange(len(n)), count)
    first = np.cumsum(count) - count
    start = before[row] + step * (np.arange(len(row)) - first[row])
    return row, start, np.minimum(start + size, before[row + 1])


def _project(block: _Block, number: np.ndarray, upto: np.ndarray, known: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Latent vectors of windows; ``known``: places of the block's words."""
    lo, hi = upto[start], upto[end]
    size = hi - lo
    first = np.cumsum(size) - size
    place = np.repeat(lo - first, size) + np.arange(int(size.sum()))
    at = number[known[place]]
    vectors = block.space[at] * block.idf[at, None]
    return np.add.reduceat(vectors, first, axis=0)


def _spread_out(lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the range, value) of all values of ranges."""
    of = np.repeat(np.arange(len(lo)), size)
    return of, lo[of] + np.arange(len(of)) - (np.cumsum(size) - size)[of]


def _stretches(block: _Block, h: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(passage, row, first, last word) of stretches that hold just as many rare
    words of an item as a match needs, no longer than the text a match is checked in."""
    rare = block.rare
    number = rare.vocabulary.number(h)
    known = np.flatnonzero(number >= 0)
    lo, hi = rare.start[number[known]], rare.start[number[known] + 1]
    of, at = _spread_out(lo, hi - lo)
    item, place = rare.items[at], known[of]
    order = np.argsort(item, kind="stable")  # places stay in order
    item, place = item[order], place[order]
    last = np.arange(len(item)) + rare.need[item] - 1
    inside = np.flatnonzero(last < len(item))
    last = last[inside]
    inside, last = (x[item[inside] == item[last]] for x in (inside, last))
    reach = np.array([len(w) for w in block.item_words])
    row = np.searchsorted(before, place[inside], side="right") - 1
    near = (place[last] - place[inside] < (block.scale + 2 * reach)[item[inside]]) & (place[last] < before[row + 1])
    return item[inside][near], row[near], place[inside][near], place[last][near]


def _search(block: _Block, h: np.ndarray, before: np.ndarray) -> Iterator[tuple[int, int, float, float, float]]:
    """(row, item, cosine, common, answer) of the matches in a chunk."""
    passage, rows, first, last = _stretches(block, h, before)
    if not len(passage):
        return
    number = block.vocabulary.number(h)
    inside = number >= 0
    known = np.flatnonzero(inside)
    upto = np.zeros(len(h) + 1, np.int64)
    np.cumsum(inside, out=upto[1:])
    reach = np.array([len(w) for w in block.item_words])
    found: dict[tuple[int, int], list[tuple[float, int, int]]] = {}
    for scale in np.unique(block.scale[passage]):
        own = np.flatnonzero(block.scale[passage] == scale)
        row, start, end = _windows(before, int(scale))
        step = max(1, int(scale) // 4)
        row0 = np.searchsorted(row, rows[own])
        most = np.searchsorted(row, rows[own], side="right") - row0 - 1
        base, far = before[rows[own]], reach[passage[own]]
        lo = np.clip(-((base + far + scale - 1 - last[own]) // step), 0, most)
        hi = np.clip((first[own] + far - base) // step, 0, most)
        of, at = _spread_out(row0 + lo, np.maximum(hi - lo + 1, 0))
        pairs = np.unique(at * len(block.item) + passage[own][of])  # by window
        window, p = pairs // len(block.item), pairs % len(block.item)
        some = upto[end[window]] > upto[start[window]]
        window, p = window[some], p[some]
        for i in range(0, len(window), PAIRS):
            w, which = np.unique(window[i : i + PAIRS], return_inverse=True)
            q = p[i : i + PAIRS]
            x = _project(block, number, upto, known, start[w], end[w])
            x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
            cosine = np.einsum("ij,ij->i", x[which], block.latent[q])
            for k in np.flatnonzero(cosine >= COSINE):
                a = w[which[k]]
                found.setdefault((int(row[a]), int(q[k])), []).append((float(cosine[k]), int(start[a]), int(end[a])))
    for (r, p), at in found.items():
        item = block.item_words[p]
        reach, least = len(item), _least(len(item))
        for cosine, s, e in sorted(at, reverse=True):
            text = h[max(before[r], s - reach) : min(before[r + 1], e + reach)].view(np.int64).tolist()
            common, answer = _agree(item, text)
            if common >= least and answer >= ANSWER:
                yield r, int(block.item[p]), cosine, common, answer
                break


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """doc_id, item_id, cosine, common, answer: each document with each
    benchmark item that it holds, and the shares of words found."""
    src = with_ids(docs, id_col, text_col).select("__id", F.col(text_col).alias("text"))
    parts = staged(passages(benchmark, item_col, item_text_col), "passages", partitions_for(docs.sparkSession, benchmark.count(), ITEMS_PER_PARTITION))
    kinds = "__id long, item long, cosine double, common double, answer double"
    out = docs.sparkSession.createDataFrame([], kinds)
    rounds = 0
    for own, find in ((parts.where("scale > 0"), _matches), (parts.where("scale = 0"), _short_matches)):
        total = own.count()
        blocks = min(total, 1) if total <= BLOCK else 2 * -(-total // BLOCK)  # about half full each
        for n in range(blocks):
            rows = own.where(F.pmod(F.xxhash64("item", "part"), F.lit(blocks)) == n)
            held = rows.orderBy("item", "part").toArrow()
            if held.num_rows:
                out = out.unionByName(find(src, rows, held, kinds))
                rounds += 1
    if rounds > 1:
        out = staged(out, "matches")
        unstage(parts)
    best = out.groupBy("__id", "item").agg(*[F.max(c).alias(c) for c in ("cosine", "common", "answer")])
    return best.select(real_id().alias("doc_id"), real_id("item").alias("item_id"), "cosine", "common", "answer")


def _hit_rows(src: DataFrame, find, kinds: str) -> DataFrame:
    """``find(word hashes, words before each row)``: (row, ...) of the hits."""

    def search(b: pa.RecordBatch) -> pa.RecordBatch | None:
        ids, out = b["__id"].to_numpy(), []
        for r0, _, h, before in _words(b["text"]):
            out += [(ids[r0 + r], *hit) for r, *hit in find(h, before)]
        if not out:
            return None
        cols = list(zip(*out, strict=True))
        return batch(__id=np.array(cols[0], np.int64), item=np.array(cols[1], np.int64), cosine=np.array(cols[2]), common=np.array(cols[3]), answer=np.array(cols[4]))

    return arrow(src, search, kinds)


def _short_matches(src: DataFrame, rows: DataFrame, held: pa.Table, kinds: str) -> DataFrame:
    """Documents that hold an item of a few words as a run of words."""
    own = [tuple(w.values.to_pylist()) for w in held["words"]]
    items: dict[tuple[int, ...], list[int]] = {}
    for w, item in zip(own, held["item"].to_pylist(), strict=True):
        items.setdefault(w, []).append(item)
    firsts = np.unique(np.array([w[0] for w in own], np.int64))
    sizes = sorted({len(w) for w in own})

    def find(h: np.ndarray, before: np.ndarray) -> Iterator[tuple[int, int, float, float, float]]:
        words = h.view(np.int64)
        starts = np.flatnonzero(np.isin(words, firsts))
        row = np.searchsorted(before, starts, side="right") - 1
        found = set()
        for s, r in zip(starts.tolist(), row.tolist(), strict=True):
            for n in sizes:
                if s + n <= before[r + 1]:
                    found.update((r, item) for item in items.get(tuple(words[s : s + n].tolist()), ()))
        for r, item in sorted(found):
            yield r, item, 1.0, 1.0, 1.0

    return _hit_rows(src, find, kinds)


def _matches(src: DataFrame, rows: DataFrame, held: pa.Table, kinds: str) -> DataFrame:
    own = [w.values.to_numpy().view(np.uint64) for w in held["words"]]
    vocabulary = _Vocabulary(np.unique(np.concatenate(own)))
    n_docs, df = document_frequencies(src, vocabulary)
    idf = np.log((n_docs + 1) / (df + 1)) + 0.05
    space = latent_space(rows, vocabulary, idf, held.num_rows)
    latent = np.zeros((len(own), space.shape[1]), np.float32)
    for i, w in enumerate(own):
        at, weight = _weighted(vocabulary.number(w), idf)
        latent[i] = weight @ space[at]
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    item_words = [w.values.to_pylist() for w in held["words"]]
    rare = _rare(item_words, vocabulary, idf)
    block = _Block(vocabulary, idf.astype(np.float32), space, held["item"].to_numpy(), held["scale"].to_numpy(), latent, item_words, rare)

    return _hit_rows(src, lambda h, before: _search(block, h, before), kinds)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, unchanged."""
    hit = contaminated(docs, benchmark, id_col, text_col).select(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("__hit")).distinct()
    return docs.join(hit, F.coalesce(docs[id_col].cast("long"), F.lit(2**63 - 1)) == hit["__hit"], "left_anti")
