"""Token-id output (operator 9): texts to files of range-coded token records.

Documents are range-partitioned and sorted by id, tokenised, ended with one
end id and written as records of about ``RECORD`` ids: whole documents each,
cut into blocks that an adaptive context-mixing range coder codes
independently with a checksum a block (``range_coder``).  A record's row also
lists its documents and their lengths.  Files are Parquet folders of such rows,
so any storage that Spark reaches will do.  Reading decodes records where they
are; the place of a document's first id follows from the records' sizes in two
steps, shards first, so no task sees more than a row a shard.

Defined cases: a null or empty text is its end id alone; a null id sorts after
all others; rows repeated under one id are all written, by text fingerprint;
the vocabulary's special strings in a text are what the tokenizers library
makes of them; an empty table gives no record; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickline.llm.base import arrow, arrow_iter, batch, kept_for_stage, real_id, scratch_root, with_ids
from wickline.llm.range_coder import decode_record, encode_record

RECORD = 1 << 22
#: Text of a range partition; less where the cores would have nothing to do.
PARTITION_BYTES = 256 << 20
#: Words whose ids a worker remembers before starting afresh.
REMEMBERED = 400_000
FILE_ROWS = "shard int, seq int, n_ids long, doc_ids array<long>, doc_lengths array<int>, record binary"
#: Fixed value: how byte-level vocabularies cut a text before the merges.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_BLANK_RUN = re.compile(r"^\s| \s| $")


class Tokens:
    """Ids of whole texts by a tokenizers file, remembering words.

    The byte-level pattern always starts a piece at a space before a
    character that is no space, so a text is cut there; the pieces of each new
    part are encoded once by the library.  Texts where spaces meet other blanks or that
    hold a special string go to the library whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        got = self.lib.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<i4").tobytes() for e in got]

    def _know(self, memory: dict[str, bytes], parts: list[str], lead: str) -> None:
        """Learn parts that are not known, from their pieces; the library
        encodes each piece once."""
        new = list(set(parts).difference(memory))
        if not new:
            return
        if len(memory) > REMEMBERED:
            memory.clear()
            new = list(set(parts))
        cut = [_PIECES.findall(lead + p) for p in new]
        unknown = list({x for c in cut for x in c}.difference(self.pieces))
        if unknown:
            if len(self.pieces) > REMEMBERED:
                self.pieces.clear()
                unknown = list({x for c in cut for x in c})
            self.pieces.update(zip(unknown, self._whole(unknown), strict=True))
        known = self.pieces
        memory.update((p, known[c[0]] if len(c) == 1 else b"".join([known[x] for x in c])) for p, c in zip(new, cut, strict=True))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit integers."""
        if not text:
            return b""
        if _BLANK_RUN.search(text) or any(s in text for s in self.special):
            return self._whole([text])[0]
        first, *rest = text.split(" ")
        self._know(self.first, [first], "")
        self._know(self.later, rest, " ")
        return self.first[first] + b"".join(map(self.later.__getitem__, rest))


@kept_for_stage
def tokens(path: str) -> Tokens:
    return Tokens(path)


def write_tokens(df: DataFrame, folder: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> None:
    """Tokenise ``df`` with the vocabulary file ``path`` and write the files."""
    spark = df.sparkSession
    src = with_ids(df, id_col, text_col).select("__id", F.xxhash64(text_col).alias("fp"), F.col(text_col).alias("text"))
    size = src.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    partitions = max(3 * spark.sparkContext.defaultParallelism, -(-size // PARTITION_BYTES))
    ordered = src.repartitionByRange(partitions, "__id", "fp").sortWithinPartitions("__id", "fp").select("__id", "text")
    end = np.array([end_id], "<i4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, seq = TaskContext.get().partitionId(), 0
        ids, lengths, parts, total = [], [], [], 0

        def record() -> pa.RecordBatch:
            raw = encode_record(np.frombuffer(b"".join(parts), "<i4"))
            return batch(
                shard=np.array([shard], np.int32), seq=np.array([seq], np.int32), n_ids=np.array([total], np.int64),
                doc_ids=pa.array([ids], pa.list_(pa.int64())), doc_lengths=pa.array([lengths], pa.list_(pa.int32())), record=pa.array([raw], pa.binary()),
            )

        for b in batches:
            for doc, text in zip(b["__id"].to_pylist(), b["text"], strict=True):
                raw = tokens(path).encode(text.as_py() or "") + end
                ids.append(doc)
                lengths.append(len(raw) // 4)
                parts.append(raw)
                total += len(raw) // 4
                if total >= RECORD:
                    yield record()
                    seq, ids, lengths, parts, total = seq + 1, [], [], [], 0
        if total:
            yield record()

    arrow_iter(ordered, write, FILE_ROWS).write.option("compression", "none").parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the files in ``folder``."""
    return spark.read.schema(FILE_ROWS).parquet(folder)


def record_starts(records: DataFrame) -> DataFrame:
    """(shard, seq, start): the ids before each record, shards summed up first."""
    sizes = records.select("shard", "seq", "n_ids")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    shards = shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("shard_start"))
    own = sizes.select("shard", "seq", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("own"))
    return own.join(shards, "shard").select("shard", "seq", (F.col("own") + F.col("shard_start")).alias("start"))


def token_digests(records: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from decoded records."""

    def digest(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for shard, seq, docs, lengths, record in zip(b["shard"], b["seq"], b["doc_ids"], b["doc_lengths"], b["record"], strict=True):
            view = memoryview(decode_record(record.as_py()).astype("<u4").tobytes())
            n = lengths.values.to_numpy().astype(np.int64)
            ends = np.cumsum(n)
            sums = [zlib.crc32(view[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
            place = [np.full(len(n), x.as_py(), np.int32) for x in (shard, seq)]
            out.append((*place, docs.values.to_numpy(), ends - n, n, np.array(sums, np.int64)))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)]
        return batch(**dict(zip(("shard", "seq", "__id", "inner", "n_tokens", "ids_crc32"), cols, strict=True)))

    coded = records.select("shard", "seq", "doc_ids", "doc_lengths", "record")
    out = arrow(coded, digest, "shard int, seq int, __id long, inner long, n_tokens long, ids_crc32 long")
    out = out.join(record_starts(records), ["shard", "seq"])
    return out.select(real_id().alias("doc_id"), (F.col("start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def new_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/llm-token-files-{uuid.uuid4().hex}"
