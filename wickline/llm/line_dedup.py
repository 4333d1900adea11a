"""Line dedup (operator 2): each repeated line stays only in its first document.

Lines become 128-bit keys; the keys are range-partitioned and sorted by key,
document and position, and one streaming pass per partition marks every row
whose document is not its key's first.  The result per document is a
compressed keep bitmap, not text.  A key with very many lines spans several
partitions: rows of a partition's first key are settled against the least
document of that key over all partitions (two rows a partition).

Defined cases: a null or empty text is one empty line and loses nothing; a
null id sorts after every other id and stands for one document; rows repeated
under one id belong to the same document, each with a bitmap of its own text;
lines of fewer than ``min_chars`` code points always stay; other columns are
ignored by the bitmaps and kept by :func:`drop_lines`.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.llm.base import arrow, arrow_iter, batch, partitions_for, real_id, staged, unstage, with_ids
from wickline.llm.text import LOWER, SEPARATOR, chunks, span_hash

KEYS = "h1 long, h2 long, doc long, fp long, pos int"
#: Rows of line keys that one range partition is meant to hold.
ROWS_PER_PARTITION = 2_000_000


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, lines before each row): rows cut at line feeds."""
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    before = np.arange(len(offsets)) + np.searchsorted(breaks, offsets)
    return starts, ends, before


def _stripped(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans without the separators at either end."""
    solid = np.flatnonzero(~SEPARATOR[data])
    lo, hi = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    some = hi > lo
    s, e = starts.copy(), starts.copy()
    s[some], e[some] = solid[lo[some]], solid[hi[some] - 1] + 1
    return s, e


def line_keys(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """A row for each line long enough: 128-bit key, document, text fingerprint, position."""
    src = with_ids(df, id_col, text_col).select("__id", F.xxhash64(text_col).alias("fp"), F.col(text_col).alias("text"))

    def keys(b: pa.RecordBatch) -> pa.RecordBatch | None:
        ids, fps, out = b["__id"].to_numpy(), b["fp"].to_numpy(), []
        for r0, r1, data, off in chunks(b["text"]):
            starts, ends, before = _lines(data, off)
            s, e = _stripped(data, starts, ends)
            points = np.zeros(len(data) + 1, np.int64)
            np.cumsum((data & 0xC0) != 0x80, out=points[1:])
            long = np.flatnonzero(points[e] - points[s] >= min_chars)
            row = np.repeat(np.arange(r0, r1), np.diff(before))[long]
            low = LOWER[data]
            h1, h2 = (span_hash(low, s[long], e[long], k).view(np.int64) for k in (0, 1))
            out.append((h1, h2, ids[row], fps[row], (long - before[row - r0]).astype(np.int32)))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)]
        return batch(h1=cols[0], h2=cols[1], doc=cols[2], fp=cols[3], pos=cols[4]) if len(cols[0]) else None

    return arrow(src, keys, KEYS)


def _stream_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted keys in; out: dropped lines (kind 0), lines of the partition's
    first key (kind 1) and the first and last key with its first document
    (kind 2)."""
    key, first_doc, opening = None, 0, True
    for b in batches:
        if not b.num_rows:
            continue
        h1, h2, doc, fp, pos = (b[c].to_numpy() for c in ("h1", "h2", "doc", "fp", "pos"))
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new[0] = key != (h1[0], h2[0])
        if opening and key is None:
            new[0] = False
            first_doc = doc[0]
            yield _marked(2, h1[:1], h2[:1], doc[:1], fp[:1], pos[:1])
        group = np.cumsum(new)
        firsts = np.concatenate([[first_doc], doc[new]])
        drop = doc != firsts[group]
        if opening:
            lead = group == 0
            yield _marked(1, h1[lead], h2[lead], doc[lead], fp[lead], pos[lead])
            drop &= ~lead
            opening = not new.any()
        if drop.any():
            yield _marked(0, h1[drop], h2[drop], doc[drop], fp[drop], pos[drop])
        key, first_doc = (h1[-1], h2[-1]), firsts[group[-1]]
    if key is not None:
        yield _marked(2, *(np.array([x], np.int64) for x in (*key, first_doc, 0)), np.zeros(1, np.int32))


def _marked(kind: int, h1, h2, doc, fp, pos) -> pa.RecordBatch:
    return batch(kind=np.full(len(h1), kind, np.int32), h1=h1, h2=h2, doc=doc, fp=fp, pos=pos)


def _bitmap(positions: np.ndarray) -> bytes:
    keep = np.ones(int(positions.max()) // 8 * 8 + 8, np.uint8)
    keep[positions] = 0
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def unpack_bitmap(bitmap: bytes | None, n_lines: int) -> np.ndarray:
    """True for each line that stays; lines beyond the bitmap stay."""
    keep = np.ones(n_lines, bool)
    if bitmap:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n_lines]
        keep[: len(bits)] = bits == 1
    return keep


def keep_bitmaps(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """(doc, fp, keep): documents that lose lines, by internal id and
    ``xxhash64`` of the text.  ``keep`` is a zlib-compressed bitmap, first
    line first; lines after its end stay, and a document without one keeps
    everything."""
    keys = staged(line_keys(df, id_col, text_col, min_chars), "line-keys")
    total = keys.count()
    parts = max(keys.rdd.getNumPartitions(), -(-total // ROWS_PER_PARTITION))
    order = ["h1", "h2", "doc", "pos"]
    ranged = keys.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    marked = staged(arrow_iter(ranged, _stream_first, f"kind int, {KEYS}"), "line-marks", partitions_for(df.sparkSession, total, ROWS_PER_PARTITION))
    unstage(keys)
    # two rows of each partition at most, whatever the number of lines
    least = marked.where("kind = 2").groupBy("h1", "h2").agg(F.min("doc").alias("least"))
    settled = marked.where("kind = 1").join(F.broadcast(least), ["h1", "h2"]).where("doc != least")
    drops = marked.where("kind = 0").select("doc", "fp", "pos").unionByName(settled.select("doc", "fp", "pos"))
    lists = drops.groupBy("doc", "fp").agg(F.collect_list("pos").alias("dropped"))

    def pack(b: pa.RecordBatch) -> pa.RecordBatch:
        maps = [_bitmap(np.asarray(x.values)) for x in b["dropped"]]
        return batch(doc=b["doc"], fp=b["fp"], keep=pa.array(maps, pa.binary()))

    return arrow(lists, pack, "doc long, fp long, keep binary")


def drop_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """Every row of ``df`` with ``__kept`` (text of the lines that stay, joined
    by line feeds), ``__n_lines`` and ``__n_dropped`` added."""
    maps = keep_bitmaps(df, id_col, text_col, min_chars)
    inner = [f"__c{i}" for i in range(len(df.columns))]
    rows = df.toDF(*inner)
    doc, text = F.col(inner[df.columns.index(id_col)]), F.col(inner[df.columns.index(text_col)])
    rows = rows.withColumns({"__doc": F.coalesce(doc.cast("long"), F.lit(2**63 - 1)), "__fp": F.xxhash64(text)})
    maps = maps.select(F.col("doc").alias("__doc"), F.col("fp").alias("__fp"), F.col("keep").alias("__keep"))
    joined = rows.join(maps.hint("shuffle_hash"), ["__doc", "__fp"], "left").drop("__doc", "__fp")
    at = inner[df.columns.index(text_col)]
    kinds = ", ".join(f"{c} {t}" for c, t in rows.select(*inner).dtypes)

    def apply(b: pa.RecordBatch) -> pa.RecordBatch:
        kept, total, lost = [], [], []
        for text_, bitmap in zip(b[at].to_pylist(), b["__keep"].to_pylist(), strict=True):
            text_ = text_ or ""
            n = text_.count("\n") + 1
            if bitmap:
                keep = unpack_bitmap(bitmap, n)
                text_ = "\n".join(x for x, k in zip(text_.split("\n"), keep, strict=True) if k)
                lost.append(int(n - keep.sum()))
            else:
                lost.append(0)
            total.append(n)
            kept.append(text_)
        cols = {c: b[c] for c in inner}
        return batch(**cols, __kept=pa.array(kept, pa.string()), __n_lines=np.array(total, np.int64), __n_dropped=np.array(lost, np.int64))

    out = arrow(joined.select(*inner, "__keep"), apply, f"{kinds}, __kept string, __n_lines long, __n_dropped long")
    return out.toDF(*df.columns, "__kept", "__n_lines", "__n_dropped")


def line_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the text that stays."""
    kept = drop_lines(with_ids(df, id_col, text_col).toDF("__doc_id", "__text"), "__doc_id", "__text", min_chars)
    return kept.select(
        real_id("__doc_id").alias("doc_id"),
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.col("__kept"), 256).alias("kept_sha256"),
    )
