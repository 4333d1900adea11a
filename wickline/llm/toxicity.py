"""Toxicity (operator 3) by multiple-instance learning over sentences.

Labels are of whole documents.  A sentence's score is a logistic one of its
features: hashes of its words and of their first 4, 5 and 6 bytes.  A document
is toxic unless none of its sentences is (noisy-or), and the weights are
fitted through that to the document labels.  The same sentence scores then
locate the offending sentences.

The fit uses at most about ``MAX_DOCS`` labelled documents, drawn by a hash of
their id, and fewer where those would hold more than about ``MAX_BYTES`` of
text; whole texts, however long.  Features are those of at least ``MIN_DOCS`` of
them that tell the labels apart best.  The prior of a sentence
is spread over the document's sentences, so length alone makes nothing toxic.
All documents and whole texts are scored.

Defined cases: a null or empty text, or one without words, gets the score of
one sentence without features; several labels of an id count as toxic if any
is, null labels not at all; without labels of both kinds every score is the
share of toxic ones (0 without labels); rows are independent, so repeated and
null ids stay as they are; other columns are ignored and never inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.base import arrow, batch
from wickline.llm.text import PUNCTUATION, U64, chunks, mix, span_hash, words

MAX_DOCS = 12_000
MAX_BYTES = 256 << 20
MIN_DOCS = 8
FEATURES = 8192
PREFIXES = (4, 5, 6)
ROUNDS = 400
#: Bits of the quick test that most features fail.
_QUICK_BITS = 22
_BREAKS = np.zeros(256, bool)
_BREAKS[[0x0A, 0x21, 0x2E, 0x3F]] = True


@dataclass
class Model:
    """Sorted feature hashes, their weights and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def quick(self) -> np.ndarray:
        table = np.zeros(1 << _QUICK_BITS, bool)
        table[self.features >> U64(64 - _QUICK_BITS)] = True
        return table


@dataclass
class Chunk:
    """Sentences and chosen features of a chunk's rows."""

    sentences: np.ndarray  # sentences with words, per row
    row: np.ndarray  # of each feature: its row,
    sentence: np.ndarray  # its sentence's number in the chunk
    feature: np.ndarray  # and its hash
    breaks: np.ndarray  # byte positions of sentence ends


def _hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hash, word) of the word and of its prefixes."""
    every = np.arange(len(starts))
    out = [(span_hash(low, starts, ends), every)]
    for k in PREFIXES:
        long = np.flatnonzero(ends - starts > k)
        out.append((mix(span_hash(low, starts[long], starts[long] + k) + U64(k)), long))
    return out


def _features(data: np.ndarray, offsets: np.ndarray, keep) -> Chunk:
    """``keep(hashes)``: positions of the features wanted."""
    low, starts, ends, before = words(data, offsets, PUNCTUATION)
    breaks = np.flatnonzero(_BREAKS[low])
    # a sentence also ends with its row
    number = np.searchsorted(breaks, starts) + np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    new = np.ones(len(number), bool)
    new[1:] = number[1:] != number[:-1]
    upto = np.zeros(len(number) + 1, np.int64)
    np.cumsum(new, out=upto[1:])
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    rows, sentences, features = [], [], []
    for h, word in _hashes(low, starts, ends):
        at = keep(h)
        features.append(h[at])
        rows.append(row_of[word[at]])
        sentences.append(number[word[at]])
    return Chunk(upto[before[1:]] - upto[before[:-1]], np.concatenate(rows), np.concatenate(sentences), np.concatenate(features), breaks)


def _sample(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str) -> DataFrame:
    """(__id, text, toxic) of at most about ``MAX_DOCS`` labelled documents."""
    known = labels.where("toxic IS NOT NULL").where(usable).groupBy(F.col(id_col).alias("__id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    n = known.count()
    share = min(1.0, MAX_DOCS / n) if n else 0.0
    drawn = known.where(F.pmod(F.xxhash64("__id", F.lit(3)), F.lit(1_000_000)) < int(share * 1_000_000))
    few = F.broadcast(drawn.limit(2 * MAX_DOCS))  # at most that many rows, whatever the tables' size
    return docs.join(few, docs["__id"] == few["__id"]).select(docs["__id"], "text", "toxic")


def _bounded(sample: DataFrame) -> tuple[DataFrame, int, int]:
    """(sample, documents, toxic ones) of at most about ``MAX_BYTES`` of text:
    what the fit gathers grows with the text, not with the documents alone."""
    counts = [F.count("*"), F.sum("toxic"), F.sum(F.octet_length("text"))]
    total, toxic, size = sample.agg(*counts).first()
    if size and size > MAX_BYTES:
        sample = sample.where(F.pmod(F.xxhash64("__id", F.lit(5)), F.lit(1_000_000)) < int(1_000_000 * MAX_BYTES / size))
        total, toxic, _ = sample.agg(*counts).first()
    return sample, total, toxic or 0


def _chosen(sample: DataFrame, total: int, toxic: int) -> np.ndarray:
    """The hashes of the features that tell the labels apart best."""

    def count(b: pa.RecordBatch) -> pa.RecordBatch | None:
        y, found, marks = b["toxic"].to_numpy(), [], []
        for r0, _, data, off in chunks(b["text"]):
            c = _features(data, off, lambda h: np.arange(len(h)))
            pairs = np.unique(np.rec.fromarrays([c.row, c.feature], names="r,f"))
            found.append(pairs.f)
            marks.append(y[r0 + pairs.r])
        features, at = np.unique(np.concatenate(found), return_inverse=True)
        toxic = np.bincount(at, weights=np.concatenate(marks), minlength=len(features)).astype(np.int64)
        return batch(feature=features.view(np.int64), n=np.bincount(at, minlength=len(features)).astype(np.int64), toxic=toxic)

    counts = arrow(sample.select("text", "toxic"), count, "feature long, n long, toxic long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    share = toxic / total
    gap = F.abs(F.col("toxic") - F.col("n") * share) - 1.0
    strength = gap / F.sqrt(F.col("n") * share * (1 - share))  # deviations from the mean
    best = counts.where(F.col("n") >= MIN_DOCS).select("feature", strength.alias("strength")).orderBy(F.col("strength").desc(), "feature").limit(FEATURES)
    return np.sort(np.array([r[0] for r in best.collect()], np.int64).view(np.uint64))


def _wanted(model: Model):
    quick, features = model.quick(), model.features

    def keep(h: np.ndarray) -> np.ndarray:
        if not len(features):
            return np.zeros(0, np.int64)
        at = np.flatnonzero(quick[h >> U64(64 - _QUICK_BITS)])
        place = np.minimum(np.searchsorted(features, h[at]), len(features) - 1)
        return at[features[place] == h[at]]

    return keep


def _fit(sample: DataFrame, features: np.ndarray) -> Model:
    model = Model(features, np.zeros(len(features)), 0.0)

    def rows(b: pa.RecordBatch) -> pa.RecordBatch:
        keep, out = _wanted(model), {"toxic": [], "sentences": [], "sentence": [], "feature": []}
        y = b["toxic"].to_pylist()
        for r0, r1, data, off in chunks(b["text"]):
            c = _features(data, off, keep)
            order = np.argsort(c.row, kind="stable")
            cut = np.searchsorted(c.row[order], np.arange(1, r1 - r0))
            place = np.searchsorted(features, c.feature).astype(np.int32)
            out["toxic"] += y[r0:r1]
            out["sentences"] += c.sentences.tolist()
            out["sentence"] += [x.astype(np.int32) for x in np.split(c.sentence[order], cut)]
            out["feature"] += np.split(place[order], cut)
        return batch(
            toxic=pa.array(out["toxic"], pa.int32()), sentences=pa.array(out["sentences"], pa.int32()),
            sentence=pa.array(out["sentence"], pa.list_(pa.int32())), feature=pa.array(out["feature"], pa.list_(pa.int32())),
        )

    got = arrow(sample.select("text", "toxic"), rows, "toxic int, sentences int, sentence array<int>, feature array<int>").toArrow().combine_chunks()
    y = got["toxic"].to_numpy().astype(float)
    counts = np.maximum(got["sentences"].to_numpy(), 1)
    lists = got["feature"].combine_chunks()
    doc = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy()))
    feature = lists.values.to_numpy()
    _, sentence = np.unique(doc * (1 << 32) + got["sentence"].combine_chunks().values.to_numpy(), return_inverse=True)
    n_sentences = int(sentence.max()) + 1 if len(sentence) else 0
    owner = np.zeros(n_sentences, np.int64)
    owner[sentence] = doc
    return _descend(model, y, counts, owner, sentence, feature)


def _descend(model: Model, y: np.ndarray, counts: np.ndarray, owner: np.ndarray, sentence: np.ndarray, feature: np.ndarray) -> Model:
    """Full-batch Adam on the noisy-or likelihood; counts: sentences a
    document; owner: the document of each sentence that has features."""
    n, dim = len(y), len(model.features)
    w = np.zeros(dim + 1)
    w[dim] = np.log(max(y.mean(), 1e-3) / 4)
    m, v = np.zeros(dim + 1), np.zeros(dim + 1)
    plain = counts - np.bincount(owner, minlength=n)
    spread = np.log(counts)
    for t in range(1, ROUNDS + 1):
        z = np.bincount(sentence, weights=w[feature], minlength=len(owner)) + w[dim] - spread[owner]
        p, p0 = 1 / (1 + np.exp(-np.clip(z, -40, 40))), 1 / (1 + np.exp(spread - w[dim]))
        none = plain * np.log1p(-p0) + np.bincount(owner, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n)
        some = np.maximum(-np.expm1(none), 1e-9)
        pull = np.where(y > 0, -(1 - some) / some, 1.0)  # of the loss by each sentence's score, over p
        gz = pull[owner] * p
        grad = np.append(np.bincount(feature, weights=gz[sentence], minlength=dim), (pull * plain * p0).sum() + gz.sum()) / n
        grad[:dim] += 1e-4 * w[:dim]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= 0.08 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(model.features, w[:dim], float(w[dim]))


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model of the labelled documents whose id satisfies ``usable`` (a
    condition on ``labels``)."""
    src = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    sample, total, toxic = _bounded(_sample(src, labels, usable, id_col))
    features = _chosen(sample, total, toxic) if 0 < toxic < total else np.zeros(0, np.uint64)
    if len(features):
        return _fit(sample, features)
    share = toxic / total if total else 0.0
    return Model(features, np.zeros(0), float(np.log(share / (1 - share)) if 0 < share < 1 else (40.0 if share else -40.0)))


def _rate(model: Model, texts: pa.Array) -> tuple[np.ndarray, list[list[dict]]]:
    """(score, offending sentences) of each text."""
    keep = _wanted(model)
    scores, spans = [], []
    for _, _, data, off in chunks(texts):
        n = len(off) - 1
        c = _features(data, off, keep)
        counts = np.maximum(c.sentences, 1)
        p0 = 1 / (1 + np.exp(np.log(counts) - model.bias))
        numbers, at = np.unique(c.sentence, return_inverse=True)
        owner = np.zeros(len(numbers), np.int64)
        owner[at] = c.row
        weight = model.weights[np.searchsorted(model.features, c.feature)] if len(at) else np.zeros(0)
        z = np.bincount(at, weights=weight, minlength=len(numbers)) + model.bias - np.log(counts[owner])
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        plain = counts - np.bincount(owner, minlength=n)
        none = plain * np.log1p(-p0) + np.bincount(owner, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n)
        scores.append(-np.expm1(none))
        own: list[list[dict]] = [[] for _ in range(n)]
        for number, doc, s in zip(numbers[p >= 0.5], owner[p >= 0.5], p[p >= 0.5], strict=True):
            k = number - doc  # breaks before the sentence
            lo = max(int(off[doc]), int(c.breaks[k - 1]) + 1 if k else 0)
            hi = min(int(off[doc + 1]), int(c.breaks[k]) + 1 if k < len(c.breaks) else int(off[-1]))
            points = lambda x, y: int(((data[x:y] & 0xC0) != 0x80).sum())
            own[doc].append({"start": points(off[doc], lo), "length": points(lo, hi), "score": float(s)})
        spans += own
    return np.clip(np.concatenate(scores), 0.0, 1.0), spans


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and ``offending``: start, length (code points) and score
    of each sentence more likely toxic than not."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def rate(b: pa.RecordBatch) -> pa.RecordBatch:
        scores, spans = _rate(model, b["text"])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("score", pa.float64())]))
        return batch(doc_id=b["doc_id"], score=scores, offending=pa.array(spans, kind))

    return arrow(src, rate, "doc_id long, score double, offending array<struct<start:int,length:int,score:double>>")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, unchanged."""
    inner = [f"__c{i}" for i in range(len(docs.columns))]
    at = inner[docs.columns.index(text_col)]
    kinds = ", ".join(f"{c} {kind}" for c, (_, kind) in zip(inner, docs.dtypes, strict=True))

    def keep(b: pa.RecordBatch) -> pa.RecordBatch:
        return b.filter(pa.array(_rate(model, b[at])[0] < threshold))

    return arrow(docs.toDF(*inner), keep, kinds).toDF(*docs.columns)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose label is never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and n_offending of every document."""
    model = train(docs, labels, ~held_out())
    out = score(docs, model)
    return out.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("offending").cast("long").alias("n_offending"),
    )
