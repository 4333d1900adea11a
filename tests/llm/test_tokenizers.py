"""Operators 7, 9 and 10 against the libraries and by round trips."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_cases import docs_of  # noqa: F401
from wickline.llm import base, range_coder, sentencepieces, token_counts, token_files

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "", " ", "  ", "a  b", " a", "a ", "a   ", "\n\n", "\n a", "a\n b", "a \n b", "<s> </s> <0x0A>", "▁a▁", "日本語😀x", "x" * 500, "ab" * 400,
    "\x00", "\x1c a\x1fb", "   \n  x", "the" * 300, " " * 70 + "x", "=====", "-" * 333, "don't we'll I'D the're 're 'r", "it's's", "</w> <w>",
    "a<|endoftext|>b <|startoftext|> <|endoftext|>", "!!<|endoftext|>!!", "x\n <|endoftext|>\n y", "İstanbul ΣΑΣ ſ", "é é ñ", "é é́", "　x y z", "12345 ١٢",
]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    alphabet = "abcde  eetthhe'sStT\né1_.!漢▁<|>"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    return HARD + random_texts(300) + ["".join(rng.choice("etaoins") for _ in range(700))]


@pytest.fixture(scope="module")
def rows(texts):
    return [(i, t) for i, t in enumerate(texts)] + [(None, None), (None, "null id"), (3, None), (3, "again"), (3, "again")]


def test_piece_ids_are_the_librarys(texts):
    own = sentencepieces.PieceCodec(PIECES)
    assert [own.encode(t).tolist() for t in texts] == sentencepieces.library_ids(PIECES, texts)
    assert [own.decode(own.encode(t)) for t in texts] == [t.replace("▁", " ") for t in texts]


def test_pieces_commit_before_a_long_text_ends():
    own, text = sentencepieces.PieceCodec(PIECES), "▁" + "thequickbrownfox" * 200
    calls = []
    path = own._path
    own._path = lambda *a: calls.append(len(a[0])) or path(*a)
    assert [i for part in own.stream(text) for i in part] == sentencepieces.library_ids(PIECES, [text[1:]])[0]
    assert len(calls) > 5 and max(calls) < 10 * own.encoder.longest


def test_piece_digests(docs_of, rows):
    got = sorted(map(tuple, sentencepieces.piece_digests(docs_of(rows), PIECES).collect()), key=repr)
    want = []
    for (i, t), ids in zip(rows, sentencepieces.library_ids(PIECES, [t or "" for _, t in rows]), strict=True):
        import hashlib

        back = (t or "").replace("▁", " ")
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), len(back), hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert sentencepieces.piece_digests(docs_of([]), PIECES).count() == 0


def test_counts_at_every_prefix_are_the_librarys(texts):
    lib, own = Tokenizer.from_file(WORDS), token_counts.counter(WORDS)
    for t in texts:
        counts = token_counts.prefix_counts(token_counts.pack(own.differences(t)))
        some = range(1, len(t) + 1) if len(t) < 60 else [1, len(t) // 2, len(t) - 1, len(t)]
        assert [int(counts[i - 1]) for i in some] == [len(lib.encode(t[:i], add_special_tokens=False).ids) for i in some], repr(t)


def test_token_counts(docs_of, rows):
    lib = Tokenizer.from_file(WORDS)
    got = token_counts.token_counts(docs_of(rows), WORDS, budget=5)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars", "prefix"]
    want = []
    for i, t in rows:
        t = t or ""
        n = len(lib.encode(t, add_special_tokens=False).ids)
        want.append((i, len(t.encode()), n, n > 5))
    assert sorted((tuple(r)[:4] for r in got.collect()), key=repr) == sorted(want, key=repr)
    for r in got.where("doc_id < 60 AND over_limit").collect():
        text = dict(rows)[r["doc_id"]] if r["doc_id"] != 3 else "again"
        fits = [i for i in range(1, len(text) + 1) if len(lib.encode(text[:i], add_special_tokens=False).ids) <= 5]
        assert r["fit_chars"] == max(fits, default=0)
    assert token_counts.token_counts(docs_of([]), WORDS).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 31, 33, 511, 512, 513, 2500])
def test_range_coder_round_trip(n, monkeypatch):
    monkeypatch.setattr(range_coder, "BLOCK", 512)
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 1 << 16, n), rng.integers(0, 1 << 32, n), rng.integers(0, 3, n), np.minimum(rng.zipf(1.3, n), 50256), np.full(n, 65535), np.tile(np.arange(7), n)[:n]):
        assert (range_coder.decode_record(range_coder.encode_record(ids)) == ids).all()


def test_repetition_and_context_compress():
    rng = np.random.default_rng(0)
    noise = rng.integers(0, 1 << 16, 8192)
    phrase = np.tile(rng.integers(0, 1 << 16, 40), 300)[:8192]
    assert len(range_coder.encode_record(phrase)) < 0.2 * len(range_coder.encode_record(noise))


def test_a_changed_block_is_found():
    record = bytearray(range_coder.encode_record(np.arange(5000)))
    record[-900] ^= 0x55
    with pytest.raises(ValueError, match="checksum"):
        range_coder.decode_record(bytes(record))
    with pytest.raises(ValueError):
        range_coder.encode_record(np.array([1 << 32]))
    with pytest.raises(ValueError):
        range_coder.encode_record(np.array([-1]))


def test_every_kind_of_damage_ends_in_an_error(monkeypatch):
    monkeypatch.setattr(range_coder, "BLOCK", 512)
    rng = np.random.default_rng(5)
    whole = range_coder.encode_record(np.minimum(rng.zipf(1.4, 1200), 50256))
    for at in rng.integers(len(whole) // 2, len(whole) - 20, 12):
        record = bytearray(whole)
        record[at] ^= int(rng.integers(1, 256))
        with pytest.raises(ValueError, match="checksum"):
            range_coder.decode_record(bytes(record))


def entropy_bytes(ids):
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    return -(share * np.log2(share)).sum() / 8


def test_each_order_predicts():
    """Ids with no memory cost little over their order-0 entropy, the blocks'
    lists included; where the last id, or only the last two together, tell the
    next, far less."""
    rng = np.random.default_rng(6)
    plain = np.minimum(rng.zipf(1.5, 16_384), 50256)
    cost = lambda ids: len(range_coder.encode_record(ids)) / len(ids)
    assert cost(plain) < 1.2 * entropy_bytes(plain)
    follower, one = rng.permutation(200), [0]
    for jump in rng.random(16_384):
        one.append(int(follower[one[-1]]) if jump < 0.8 else int(jump * 1e6) % 200)
    assert cost(np.array(one)) < 0.5 * entropy_bytes(np.array(one))
    pair, two = rng.integers(0, 40, (40, 40)), [0, 1]
    for jump in rng.random(16_384):
        two.append(int(pair[two[-2], two[-1]]) if jump < 0.8 else int(jump * 1e6) % 40)
    assert cost(np.array(two)) < 0.7 * entropy_bytes(np.array(two))


def test_blocks_stand_alone(monkeypatch):
    """A block's code is the same wherever it stands and whatever is beside it."""
    rng = np.random.default_rng(7)
    monkeypatch.setattr(range_coder, "BLOCK", 512)
    a, b = (np.minimum(rng.zipf(1.4, range_coder.BLOCK), 50256) for _ in range(2))
    alone, beside = range_coder.encode_record(a), range_coder.encode_record(np.concatenate([b, a]))
    assert len(alone) > 300 and alone[-200:] in beside


def test_ids_are_the_librarys(texts):
    lib, own = Tokenizer.from_file(BYTES), token_files.tokens(BYTES)
    for t in texts:
        assert np.frombuffer(own.encode(t), "<i4").tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_token_files(spark, docs_of, rows, monkeypatch):
    monkeypatch.setattr(token_files, "RECORD", 500)
    lib, folder = Tokenizer.from_file(BYTES), token_files.new_folder(spark)
    token_files.write_tokens(docs_of(rows).repartition(4), folder, BYTES)
    records = token_files.read_tokens(spark, folder)
    got = sorted(map(tuple, token_files.token_digests(records).collect()), key=lambda r: r[1])
    ids = [r[0] for r in got]
    assert ids == sorted(ids, key=lambda i: 2**63 if i is None else i)
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got[:-1])]).tolist()
    want = []
    for i, t in rows:
        x = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
    assert sorted(((i, n, c) for i, _, n, c in got), key=repr) == sorted(want, key=repr)


def test_no_documents_no_records(spark, docs_of):
    folder = token_files.new_folder(spark)
    token_files.write_tokens(docs_of([]), folder, BYTES)
    assert token_files.token_digests(token_files.read_tokens(spark, folder)).count() == 0


def test_a_worker_keeps_no_vocabulary_for_later_stages(spark, docs_of):
    """A worker goes on to other operators; tables of an earlier one would take memory beside theirs."""
    sentencepieces.piece_digests(docs_of([(i, f"some words {i}") for i in range(40)]).repartition(8), PIECES).collect()

    def held(batches):
        for b in batches:
            yield base.batch(held=np.full(b.num_rows, sentencepieces.codec.cache_info().currsize, np.int64))

    later = base.arrow_iter(spark.range(0, 64, 1, 16), held, "held long").agg(F.sum("held"), F.count("*")).first()
    assert tuple(later) == (0, 64)


def test_a_stage_keeps_its_vocabulary_between_tasks(monkeypatch):
    class Task:
        def stageId(self):
            return stage

    monkeypatch.setattr(base.TaskContext, "get", lambda: Task())
    stage = 1
    base.begin_task()
    first = sentencepieces.codec(PIECES)
    base.begin_task()
    assert sentencepieces.codec(PIECES) is first
    stage = 2
    base.begin_task()
    assert sentencepieces.codec.cache_info().currsize == 0
