"""Ranked lexical search over classes of documents that score alike.

A document's score for an item depends on two things only: how often each
term of the items occurs in it, and its length factor m.  So every document is
cut down to its term frequencies over the vocabulary of the items; documents
are brought together by a hash of these frequencies and m, compared in full
(equal hashes alone make no class), and each class is scored once.  Of a
class's members the k of least id are kept, since of equal scores no more can
be among an item's k best.  Tasks keep their k best documents an item, and one
window over these gives the ranks.

Terms are runs of ASCII letters, digits and characters beyond ASCII, with A-Z
lower-cased.  All but the weights is integer arithmetic.

Defined results: a null text has no terms.  Rows of one item id are one item
with the terms of all of them; items without terms, and items none of whose
terms occurs, have no rows.  Each row of the documents is a document, also
where ids repeat; a null id sorts last.  Items are taken in blocks of at most
``BLOCK_BYTES`` of terms (one larger item is a block's worth by itself), which
is what a task holds of them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickline.llm.base import arrow, arrow_iter, batch, real_id, staged, with_ids

#: Bytes of item terms that one pass over the documents may take.
BLOCK_BYTES = 4 << 20
#: What a term costs beside its letters when sizes are added up.
TERM_BYTES = 16
#: Bytes of one text whose terms are listed at a time.
SLICE_BYTES = 1 << 20
#: Classes and (class, item) scores worked on at a time, and the candidates a task holds before it drops the lesser ones.
CHUNK_CLASSES, CHUNK_SCORES, HELD = 2048, 1 << 19, 1 << 17
#: Pairs of a class's term and an item that holds it, added up at a time.
CHUNK_PAIRS = 1 << 20

#: Lower-cases A-Z and turns every other ASCII character that is no letter or digit into a space.
TERMS = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))

OUTPUT = "item_id long, rank int, doc_id long, score long"


def terms_of(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text, in order, a slice of it at a time."""
    if not text:
        return
    if len(text) <= SLICE_BYTES:
        yield text.translate(TERMS).split()
        return
    at = 0
    while at < len(text):
        # a slice ends before a separator, however far away that is
        end = min(at + SLICE_BYTES, len(text))
        while end < len(text) and TERMS[text[end]] != 0x20:
            end += 1
        yield text[at:end].translate(TERMS).split()
        at = end


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id``, ``term`` (bytes) and ``times`` it occurs in the item."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        ids, terms, times = [], [], []
        for i, text in zip(b["item_id"].to_pylist(), b["text"], strict=True):
            count: Counter[bytes] = Counter()
            for part in terms_of(text.as_py()):
                count.update(part)
            ids += [i] * len(count)
            terms += count.keys()
            times += count.values()
        return batch(item_id=pa.array(ids, pa.int64()), term=pa.array(terms, pa.binary()), times=pa.array(times, pa.int64()))

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("text"))
    return arrow(rows, run, "item_id long, term binary, times long").groupBy("item_id", "term").agg(F.sum("times").alias("times"))


@dataclass
class Block:
    """The items of a block: ``ids``, their ``vocabulary``, and for the items
    of each term their number in the block and how often they hold it."""

    ids: list[int | None]
    vocabulary: list[bytes]
    first: np.ndarray
    item: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, rows: list) -> Block:
        ids = sorted({r["item_id"] for r in rows}, key=lambda i: (i is None, i or 0))
        vocabulary = sorted({bytes(r["term"]) for r in rows})
        number, place = {i: k for k, i in enumerate(ids)}, {t: k for k, t in enumerate(vocabulary)}
        held = sorted((place[bytes(r["term"])], number[r["item_id"]], r["times"]) for r in rows)
        term, item, times = (np.array(c, np.int64) for c in zip(*held, strict=True))
        return cls(ids, vocabulary, np.searchsorted(term, np.arange(len(vocabulary) + 1)), item, times)


def term_vectors(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document that holds a term of ``vocabulary``: ``__id``, ``n``
    (all its terms) and ``vec`` (number of the term and frequency, by number,
    as 32-bit integers).  One more row a batch counts its documents with terms
    (``docs``) and all their terms (``n``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = {t: i for i, t in enumerate(vocabulary)}.get
        for b in batches:
            ids, lengths, vectors, docs, total = [], [], [], 0, 0
            for i, text in zip(b["__id"].to_pylist(), b["text"], strict=True):
                n, count = 0, Counter()
                for part in terms_of(text.as_py()):
                    n += len(part)
                    count.update([t for t in map(get, part) if t is not None])
                docs += n > 0
                total += n
                if count:
                    ids.append(i)
                    lengths.append(n)
                    vectors.append(np.array(sorted(count.items()), "<u4").tobytes())
            yield batch(
                __id=pa.array([*ids, None], pa.int64()), docs=pa.array([None] * len(ids) + [docs], pa.int64()),
                n=pa.array([*lengths, total], pa.int64()), vec=pa.array([*vectors, None], pa.binary()),
            )

    rows = with_ids(docs.select(id_col, F.col(text_col).cast("binary").alias("text")), id_col, "text")
    return arrow_iter(rows, run, "__id long, docs long, n long, vec binary")


def _entries(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, frequency) of every entry of a column of vectors."""
    parts = [np.frombuffer(v.as_buffer(), "<u4") for v in vectors]
    flat = np.concatenate(parts).reshape(-1, 2).astype(np.int64) if parts else np.zeros((0, 2), np.int64)
    return np.repeat(np.arange(len(parts)), [len(p) // 2 for p in parts]), flat[:, 0], flat[:, 1]


def _document_frequencies(vectors: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(terms, np.int64)
        for b in batches:
            found += np.bincount(_entries(b["vec"])[1], minlength=terms)
        some = np.flatnonzero(found)
        yield batch(term=some.astype(np.int32), df=found[some])

    out = np.zeros(terms, np.int64)
    counts = arrow_iter(vectors.select("vec"), run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in counts.collect():  # at most one row a term of the block
        out[r["term"]] = r["df"]
    return out


def score_classes(vectors: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """Classes of documents with the same vector and the same m: ``m``,
    ``vec`` and ``members``, the k least document ids in ascending order.

    Rows are dealt and sorted by the hash of vector and m; both are part of
    the group, so vectors that only share a hash stay apart.  A task sends at
    most k rows of a class on, however many copies there are.
    """
    m = F.lit(100 - 75) + F.expr(f"(CAST(n AS DECIMAL(19,0)) * {75 * n_docs}BD) div {n_terms}BD")
    keyed = vectors.where("vec IS NOT NULL").select("__id", m.cast("long").alias("m"), "vec").withColumn("h", F.xxhash64("vec", "m"))
    w = Window.partitionBy("h", "m", "vec").orderBy("__id")
    least = keyed.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)
    return least.groupBy("h", "m", "vec").agg(F.sort_array(F.collect_list("__id")).alias("members")).select("m", "vec", "members")


class Best:
    """The k best documents of every item among those offered so far."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.item = self.score = self.doc = np.zeros(0, np.int64)

    def offer(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        self.item, self.score, self.doc = np.concatenate([self.item, item]), np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        if len(self.item) > HELD or not (self.least > 1).all():
            self.settle()

    def settle(self) -> None:
        order = np.lexsort((self.doc, -self.score, self.item))
        item, score, doc = self.item[order], self.score[order], self.doc[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kth = rank == self.k - 1
        self.least[item[kth]] = np.maximum(score[kth], 1)
        keep = rank < self.k
        self.item, self.score, self.doc = item[keep], score[keep], doc[keep]


def class_scores(b: pa.RecordBatch, block: Block, weight: np.ndarray) -> np.ndarray:
    """Score of every class (row) for every item (column)."""
    row, term, tf = _entries(b["vec"])
    m = b["m"].to_numpy()[row]
    gain = (1_000_000_000 * tf) // (1000 * tf + 8 * m)
    out = np.zeros(b.num_rows * len(block.ids), np.int64)
    holders = block.first[term + 1] - block.first[term]
    before = np.concatenate([[0], np.cumsum(holders)])
    start = 0
    while start < len(term):
        end = max(start + 1, int(np.searchsorted(before, before[start] + CHUNK_PAIRS, side="right")) - 1)
        many = holders[start:end]
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(block.first[term[start:end]], many)
        np.add.at(out, np.repeat(row[start:end] * len(block.ids), many) + block.item[at], weight[at] * np.repeat(gain[start:end], many))
        start = end
    return out.reshape(b.num_rows, len(block.ids))


def best_of_classes(classes: DataFrame, block: Block, weight: np.ndarray, k: int) -> DataFrame:
    """``item_id``, ``__id`` and ``score``: the k best documents of every item in each partition."""
    step = max(1, min(CHUNK_CLASSES, CHUNK_SCORES // len(block.ids)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(block.ids), k)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                scores = class_scores(b, block, weight)
                # a class of an item's least score may still hold a smaller id
                c, i = np.nonzero(scores >= best.least)
                members = b["members"]
                sizes = pc.list_value_length(members).to_numpy()
                ids, first = members.flatten().to_numpy(), np.cumsum(sizes) - sizes
                many = sizes[c]
                place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[c], many)
                best.offer(np.repeat(i, many), np.repeat(scores[c, i], many), ids[place])
        best.settle()
        yield batch(item_id=pa.array([block.ids[i] for i in best.item], pa.int64()), __id=best.doc, score=best.score)

    return arrow_iter(classes, run, "item_id long, __id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of each item's k
    best documents with a score above 0; equal scores by ascending id."""
    spark = docs.sparkSession
    terms = staged(item_terms(items, item_col, item_text), "search-items")
    size = terms.agg(F.sum(F.octet_length("term") + F.lit(TERM_BYTES)).alias("size")).first()["size"]
    results = spark.createDataFrame([], OUTPUT)
    if not size:
        return results
    blocks = -(-size // BLOCK_BYTES)
    for number in range(blocks):
        rows = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).collect()  # about BLOCK_BYTES
        if not rows:
            continue
        block = Block.of(rows)
        vectors = staged(term_vectors(docs, block.vocabulary, id_col, text_col), "search-vectors")
        n_docs, n_terms = vectors.where("vec IS NULL").agg(F.sum("docs"), F.sum("n")).first()
        if not n_docs:
            return results
        df = _document_frequencies(vectors.where("vec IS NOT NULL"), len(block.vocabulary))
        w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        weight = np.repeat(w, np.diff(block.first)) * block.times
        found = best_of_classes(score_classes(vectors, n_docs, n_terms, k), block, weight, k)
        rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "__id"))
        found = found.withColumn("rank", rank).where(F.col("rank") <= k)
        results = results.unionByName(found.select("item_id", "rank", real_id().alias("doc_id"), "score"))
    return results
