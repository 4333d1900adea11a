"""Exact top-k search (operator 5) by distributed histogram selection.

Every candidate is scored against every query of a block.  Tasks count the
scores in per-query histograms; the summed histograms locate the bin that
holds each query's k-th highest score, and the next round splits that bin,
until bins are single integers.  A last pass keeps scores above the k-th value
and, of those equal to it, as many as are still needed, least ids first.

Scores are integer inner products of ``floor(scale * x)`` in double, so
selection and ties are exact.  Queries go through in blocks of bounded size;
candidates stay where they are, and no pair leaves its task unless it is
wanted.

Defined cases: vectors that are null or hold a null or non-finite component
take no part, nor do rows with a null id; vectors of another length than the
query's are no candidates; rows with the query's id are its own rows;
repeated candidate rows all count, repeated query rows count once; fewer than
k candidates give all of them; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickline.llm.base import arrow, arrow_iter, batch, staged, workers_can_import

#: Queries worked on at a time; bounds what goes to every task.
BLOCK = 2048
BINS = 1024
#: Candidates scored at a time inside a task.
ROWS = 2048
_HITS = "query_id long, q int, vec_id long, score long"


def _vectors(ids: pa.Array, vectors: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, integer matrix) of the usable vectors of each length."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    n = len(vectors)
    if not n:
        return
    flat = vectors.values.cast(pa.float64())
    off = vectors.offsets.to_numpy().astype(np.int64)
    holes = np.flatnonzero(~np.isfinite(flat.to_numpy(zero_copy_only=False)))
    bad = np.diff(np.searchsorted(holes, off)) > 0
    usable = ~bad & ~vectors.is_null().to_numpy(zero_copy_only=False) & ~ids.is_null().to_numpy(zero_copy_only=False)
    known = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.nan_to_num(flat.to_numpy(zero_copy_only=False))
    lengths = np.diff(off)
    for d in np.unique(lengths[usable]):
        rows = np.flatnonzero(usable & (lengths == d))
        m = values[(off[rows][:, None] + np.arange(d)).ravel()].reshape(len(rows), d)
        yield known[rows], np.floor(scale * m)


class _Block:
    """A bounded set of queries with their search ranges."""

    def __init__(self, ids: np.ndarray, vectors: list[np.ndarray]):
        self.ids = ids
        self.by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        dims = np.array([len(v) for v in vectors])
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            self.by_dim[int(d)] = (at, np.stack([vectors[i] for i in at]))

    def scores(self, ids: np.ndarray, m: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query numbers, candidate ids, integer scores [candidate, query])."""
        if m.shape[1] not in self.by_dim:
            return
        at, q = self.by_dim[m.shape[1]]
        exact = max(1.0, np.sqrt((m * m).sum(1).max())) * max(1.0, np.sqrt((q * q).sum(1).max())) < 2**52
        for i in range(0, len(ids), ROWS):
            c = m[i : i + ROWS]
            s = (c @ q.T).astype(np.int64) if exact else c.astype(np.int64) @ q.T.astype(np.int64)
            yield at, ids[i : i + ROWS], s


def _largest_norm(df: DataFrame, scale: int) -> int:
    def norms(b: pa.RecordBatch) -> pa.RecordBatch:
        top = [float(np.sqrt((m * m).sum(1).max())) for _, m in _vectors(b["id"], b["v"], scale)]
        return batch(norm=np.array([max(top, default=0.0)]))

    top = arrow(df, norms, "norm double").agg(F.max("norm")).first()[0]
    return int(top or 0) + 1


def _histogram(df: DataFrame, block: _Block, low: np.ndarray, width: np.ndarray, k: int, scale: int) -> DataFrame:
    """(q, bin, n): scores per bin of each query, the last bin open above.
    A task leaves out bins below the one that holds its own k-th score: the
    global k-th is not below it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hist = np.zeros((len(block.ids), BINS), np.int64)
        for b in batches:
            for ids, m in _vectors(b["id"], b["v"], scale):
                for at, cand, s in block.scores(ids, m):
                    # unsigned, since two longs may lie further apart than a long reaches
                    bins = (s.astype(np.uint64) - low[at].astype(np.uint64)) // width[at].astype(np.uint64)
                    use = (s >= low[at]) & (cand[:, None] != block.ids[at])
                    cell = (np.minimum(bins, np.uint64(BINS - 1)).astype(np.int64) + at * BINS)[use]
                    hist += np.bincount(cell, minlength=hist.size).reshape(hist.shape)
        above = np.cumsum(hist[:, ::-1], axis=1)[:, ::-1]
        q, at = np.nonzero((hist > 0) & (above - hist < k))
        yield batch(q=q.astype(np.int32), bin=at.astype(np.int32), n=hist[q, at])

    return arrow_iter(df, count, "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))


def _kth_values(df: DataFrame, block: _Block, bound: int, k: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Each query's k-th highest score and how many are higher; with fewer
    than k candidates, a value below all."""
    size = len(block.ids)
    low, span = np.full(size, -bound, np.int64), 2 * bound + 1
    down = Window.partitionBy("q").orderBy(F.col("bin").desc())
    while True:
        width = -(-span // BINS)
        hist = _histogram(df, block, low, np.full(size, width, np.int64), k, scale)
        upto = hist.withColumn("upto", F.sum("n").over(down)).where(F.col("upto") >= k)
        found = upto.groupBy("q").agg(F.max_by(F.struct("bin", "n", "upto"), "bin").alias("x"))
        next_low, above = np.full(size, -bound, np.int64), np.full(size, -1, np.int64)
        for q, x in found.collect():  # one row a query of the block
            next_low[q] = int(low[q]) + x["bin"] * width
            above[q] = x["upto"] - x["n"]
        if width == 1:
            return next_low, above
        low, span = next_low, width


def _hits(df: DataFrame, block: _Block, kth: np.ndarray, above: np.ndarray, k: int, scale: int) -> DataFrame:
    need = np.where(above < 0, k, k - above)

    def pick(b: pa.RecordBatch) -> pa.RecordBatch | None:
        q, vec, score = [], [], []
        for ids, m in _vectors(b["id"], b["v"], scale):
            for at, cand, s in block.scores(ids, m):
                other = cand[:, None] != block.ids[at]
                high = other & (s > kth[at])
                c, j = np.nonzero(high)
                q.append(at[j]), vec.append(cand[c]), score.append(s[c, j])
                tied = other & (s == kth[at])
                for j in np.flatnonzero(tied.any(axis=0)):
                    least = np.sort(cand[tied[:, j]])[: need[at[j]]]
                    q.append(np.full(len(least), at[j])), vec.append(least), score.append(np.full(len(least), kth[at[j]]))
        if not q:
            return None
        at = np.concatenate(q)
        return batch(query_id=block.ids[at], q=at.astype(np.int32), vec_id=np.concatenate(vec), score=np.concatenate(score).astype(np.int64))

    return arrow(df, pick, _HITS)


def top_k(
    candidates: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = 256, block: int = BLOCK
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query."""
    spark = candidates.sparkSession
    workers_can_import(spark)
    df = candidates.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    ask = staged(queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("id IS NOT NULL").distinct(), "queries")
    bound = min(_largest_norm(df, scale) * _largest_norm(ask, scale), 2**63 - 1)  # scores are longs
    total = ask.count()
    parts = min(total, 1) if total <= block else 2 * -(-total // block)  # about half full each
    by_block = ask.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(parts)))
    found = spark.createDataFrame([], _HITS)
    done: list[DataFrame] = []
    for n in range(parts):
        rows = by_block.where(F.col("block") == n).select("id", "v").toArrow()
        vectors, ids = [], []
        for got, m in _vectors(rows["id"].combine_chunks(), rows["v"], scale):
            ids.append(got), vectors.extend(m)
        if not vectors:
            continue
        some = _Block(np.concatenate(ids), vectors)
        kth, above = _kth_values(df, some, bound, k, scale)
        hits = _hits(df, some, kth, above, k, scale)
        best = Window.partitionBy("query_id", "q").orderBy(F.col("score").desc(), "vec_id")
        ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        done.append(staged(ranked, "hits"))
    out = found.withColumn("rank", F.lit(0)).where("false")
    for part in done:
        out = out.unionByName(part)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
