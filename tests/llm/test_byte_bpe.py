from __future__ import annotations

import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import tiktoken

from llm_cases import awkward, docs_of  # noqa: F401
from wickline.llm import byte_bpe as B
from wickline.llm.queries import op12_byte_bpe

PATHS = [P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_multi_50k.tiktoken")]


def library(path):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.read_ranks(path), special_tokens={})


def ids_of(bpe, text):
    return [i for part in bpe.encode(text) for (i,) in struct.iter_unpack("<I", part)]


@pytest.mark.parametrize("path", PATHS)
def test_equals_the_library(path):
    bpe, lib, rng = B.ByteBpe(path, P.PATTERN), library(path), random.Random(6)
    texts = ["", " ", "a", "  two  spaces\n\n\tand tabs ", "can't we'll I'D", "naïve 漢字 😀 ́\x00\x7f", "aaaaaaaaaaaaa" * 7, "ab" * 300, "▁ x <unk> <s>", "<|endoftext|>"]
    alphabet = "ab cdeé漢😀\n\t'st0123.,!?​ " + "the an in er on"
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(120))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice([rng.randrange(0x20, 0x250), rng.randrange(0x400, 0xD7FF), rng.randrange(0x10000, 0x10FFFF)])) for _ in range(40)) for _ in range(300)]
    for t in texts:
        want = lib.encode_ordinary(t)
        assert ids_of(bpe, t) == want, repr(t)
        assert b"".join(map(bpe.decode, bpe.encode(t))) == t.encode()


def test_long_texts_in_parts(monkeypatch):
    bpe, lib, rng = B.ByteBpe(PATHS[0], P.PATTERN), library(PATHS[0]), random.Random(1)
    text = "".join(rng.choice(["word", " other", "  ", "\n", " 12", "!?", "'s"]) for _ in range(3000))
    monkeypatch.setattr(B, "WHOLE", 10)
    monkeypatch.setattr(B, "MATCHES", 7)
    assert ids_of(bpe, text) == lib.encode_ordinary(text)


def test_one_very_long_word():
    bpe = B.ByteBpe(PATHS[0], P.PATTERN)
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh") for _ in range(300_000))
    parts = list(bpe.encode(text))
    assert b"".join(map(bpe.decode, parts)) == text.encode()
    assert ids_of(bpe, text[:3000]) == library(PATHS[0]).encode_ordinary(text[:3000])


def test_memory_of_matches_is_bounded(monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 5)
    bpe = B.ByteBpe(PATHS[0], P.PATTERN)
    text = " ".join(f"w{i}x" for i in range(200))
    assert ids_of(bpe, text) == library(PATHS[0]).encode_ordinary(text)
    assert len(bpe) <= 5


def test_frames(spark, docs_of, awkward):
    docs, lib = docs_of(awkward).repartition(3), library(PATHS[0])
    want = {}
    for i, t in awkward:
        ids = struct.pack(f"<{len(e)}I", *e) if (e := lib.encode_ordinary(t or "")) else b""
        want.setdefault(i, []).append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = {}
    for r in B.byte_bpe_digests(docs, PATHS[0], P.PATTERN).collect():
        got.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in want.items()}
    ids = B.encode_ids(docs, PATHS[0], P.PATTERN)
    texts = sorted((r["doc_id"] or -1, bytes(r["decoded"])) for r in B.decode_ids(ids, PATHS[0], P.PATTERN).collect())
    assert texts == sorted((i or -1, (t or "").encode()) for i, t in awkward)
    assert B.byte_bpe_digests(docs_of([]), PATHS[0], P.PATTERN).collect() == []


def test_bytes_that_are_no_utf8(spark):
    df = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    (row,) = B.decode_ids(B.encode_ids(df, PATHS[0], P.PATTERN), PATHS[0], P.PATTERN).collect()
    assert bytes(row["decoded"]).decode() == "a�b"


def test_query(spark):
    folder, lib = "/root/testdata/sf0.001", library(PATHS[0])
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op12_byte_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = lib.encode_ordinary(texts[r["doc_id"]])
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(packed).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
