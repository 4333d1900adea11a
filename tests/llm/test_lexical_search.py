from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from llm_cases import awkward, docs_of, prose  # noqa: F401
from wickline.llm import lexical_search as L

ITEMS = "item_id long, text string, doc_id long, score int, rank string, vec string"


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked: dict = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, want in asked.items():
        scored = []
        for i, c in counts:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // n_terms
            score = 0
            for t, times in want.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items_of(spark):
    return lambda rows: spark.createDataFrame([(i, t, 1, 2, "r", "v") for i, t in rows], ITEMS)


@pytest.fixture(scope="module")
def many():
    """Copies, texts that differ in words of no item only, ties and a hot word."""
    rng = random.Random(9)
    out = [(i, prose(rng, rng.randrange(1, 60), 50)) for i in range(300)]
    out += [(1000 + i, "w1 w2 w3 the same bag") for i in range(120)]
    out += [(2000 + i, f"w1 w2 w3 other{i} words{i} here{i}") for i in range(60)]
    return out + [(3000, "w1 " * 500), (3001, "w3 w2 w1 bag same the")]


QUESTIONS = [(1, "w1 w2 W1"), (2, "w7, w8; w9 nowhere"), (3, "nothing of this"), (4, None), (5, ""), (6, "the same bag"), (7, "漢字 café"), (8, "w1"), (8, "w40 w41"), (None, "w5 w6")]


def result(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("k", [1, 10])
def test_matches_brute_force(spark, docs_of, items_of, many, k):
    assert result(L.search(docs_of(many).repartition(6), items_of(QUESTIONS), k)) == brute(many, QUESTIONS, k)


def test_awkward_rows(spark, docs_of, items_of, awkward):
    items = QUESTIONS + [(20, awkward[7][1]), (21, "same row first of two texts"), (22, "naïve xx a null id words"), (23, awkward[16][1])]
    assert result(L.search(docs_of(awkward).repartition(4), items_of(items))) == brute(awkward, items, 10)


def test_blocks_chunks_and_slices_change_nothing(spark, docs_of, items_of, many, monkeypatch):
    for name, value in {"BLOCK_BYTES": 120, "CHUNK_CLASSES": 7, "CHUNK_PAIRS": 5, "HELD": 20, "SLICE_BYTES": 9}.items():
        monkeypatch.setattr(L, name, value)
    assert result(L.search(docs_of(many).repartition(3), items_of(QUESTIONS))) == brute(many, QUESTIONS, 10)


def test_classes_are_scored_once_and_keep_the_least_ids(spark, docs_of, many):
    vectors = L.term_vectors(docs_of(many), [b"w1", b"w2", b"w3"])
    n_docs, n_terms = vectors.where("vec IS NULL").selectExpr("sum(docs)", "sum(n)").first()
    assert (n_docs, n_terms) == (len(many), sum(len(terms(t)) for _, t in many))
    rows = L.score_classes(vectors, n_docs, n_terms, 10).collect()
    assert len({(r["m"], bytes(r["vec"])) for r in rows}) == len(rows)
    # 120 copies, 60 texts that differ outside the vocabulary and one of other order are one class
    assert sum(r["members"] == list(range(1000, 1010)) for r in rows) == 1


def test_a_hash_alone_makes_no_class(spark, docs_of, many, monkeypatch):
    monkeypatch.setattr(L.F, "xxhash64", lambda *c: L.F.lit(1).cast("long"))
    vectors = L.term_vectors(docs_of(many), [b"w1", b"w2", b"w3"])
    rows = L.score_classes(vectors, 482, 5000, 10).collect()
    assert len(rows) > 5 and len({(r["m"], bytes(r["vec"])) for r in rows}) == len(rows)


def test_empty_tables(spark, docs_of, items_of, many):
    assert result(L.search(docs_of([]), items_of(QUESTIONS))) == []
    assert result(L.search(docs_of(many), items_of([]))) == []
    assert result(L.search(docs_of([(1, None), (2, "...")]), items_of(QUESTIONS))) == []
