from __future__ import annotations

import random

import numpy as np
import pytest

from llm_cases import awkward, docs_of, prose  # noqa: F401
from wickline.llm import decontamination as D


@pytest.fixture(scope="module")
def items():
    rng = random.Random(8)
    return [(i, prose(rng, n, 3000)) for i, n in enumerate([8, 12, 20, 30, 45, 60, 150])]


def embed(rng, text):
    return prose(rng, rng.randrange(5, 300), 3000) + " " + text + " " + prose(rng, rng.randrange(5, 300), 3000)


def ben(spark, rows):
    return spark.createDataFrame([(i, t, 1.0, 2) for i, t in rows], "item_id long, text string, cosine double, item long")


def pairs(df):
    return sorted(((r["doc_id"], r["item_id"]) for r in df.collect()), key=repr)


def test_copies_and_paraphrases_are_found_and_others_left(spark, docs_of, items):
    rng = random.Random(9)
    docs, want = [], []
    for i, text in items:
        words = text.split()
        swapped = list(words)
        for k in rng.sample(range(len(words)), len(words) // 7):
            swapped[k] = f"other{rng.randrange(10**6)}"
        inserted = [x for w in words for x in ([w, "added"] if rng.random() < 0.1 else [w])]
        for version in (text, text.upper(), " ".join(words), " ".join(swapped), " ".join(inserted)):
            docs.append((len(docs), embed(rng, version)))
            want.append((docs[-1][0], i))
        docs.append((len(docs), embed(rng, " ".join(words[: len(words) // 3]))))
    docs += [(1000 + k, prose(rng, 400, 3000)) for k in range(150)]
    assert pairs(D.contaminated(docs_of(docs), ben(spark, items))) == sorted(want, key=repr)


def test_awkward_rows(spark, docs_of, awkward, items):
    rows = [*awkward, (50, items[3][1]), (50, items[3][1]), (None, "before " + items[2][1])]
    bench = [*items, (None, None), (90, ""), (91, "too short here"), (92, None), (3, items[3][1])]
    assert pairs(D.contaminated(docs_of(rows), ben(spark, bench))) == sorted([(50, 3), (None, 2)], key=repr)
    kept = D.drop_contaminated(docs_of(rows), ben(spark, bench))
    assert kept.columns == docs_of([]).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((i for i, _ in awkward if i is not None), key=repr)


def test_empty_tables(spark, docs_of, items):
    assert D.contaminated(docs_of([]), ben(spark, items)).count() == 0
    assert D.contaminated(docs_of([(1, items[0][1])]), ben(spark, [])).count() == 0


def test_blocks_of_passages(spark, docs_of, items, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 2)
    assert pairs(D.contaminated(docs_of([(i, "x " + t) for i, t in items]), ben(spark, items))) == [(i, i) for i, _ in items]


def test_parts_of_long_items_and_short_items_are_found(spark, docs_of):
    rng = random.Random(12)
    long = " ".join(f"l{rng.randrange(10**6)}" for _ in range(130))
    words = long.split()
    bench = [(1, long), (2, "a b c d"), (3, "Lonely"), (4, "x y"), (5, "x y")]
    docs = [(10, embed(rng, " ".join(words[:64]))), (11, embed(rng, " ".join(words[:80]))), (12, embed(rng, long)), (13, embed(rng, " ".join(words[:30])))]
    docs += [(20, "so A b, c D it is"), (21, "a b c e d"), (22, "b c d a"), (23, "a b c"), (24, "a b c\nd"), (30, "lonely"), (31, "not alone"), (40, "x. y"), (None, "x y")]
    want = [(10, 1), (11, 1), (12, 1), (20, 2), (24, 2), (30, 3), (40, 4), (40, 5), (None, 4), (None, 5)]
    assert pairs(D.contaminated(docs_of(docs), ben(spark, bench))) == sorted(want, key=repr)


def test_recall_against_an_exhaustive_scan(spark, docs_of):
    """Every place of every document against every item, without words chosen
    or cosines: what the search finds is right, and nearly all there is."""
    rng = random.Random(13)
    bench = [(i, prose(rng, n, 1500)) for i, n in enumerate([9, 14, 18, 25, 33, 48, 64] * 3)]
    docs = []
    for i, text in bench:
        for rate in (0.0, 0.1, 0.2, 0.25, 0.3, 0.4):
            words = []
            for w in text.split():
                u = rng.random()
                words += [] if u < rate / 3 else [w, f"w{rng.randrange(1500)}"] if u < rate / 2 else [f"w{rng.randrange(1500)}"] if u < rate else [w]
            docs.append((len(docs), embed(rng, " ".join(words))))

    def hashed(texts):
        import pyarrow as pa

        return [h[before[k] : before[k + 1]].view(np.int64).tolist() for _, _, h, before in D._words(pa.array(texts)) for k in range(len(before) - 1)]

    items, every = hashed([t for _, t in bench]), set()
    for (d, _), text in zip(docs, hashed([t for _, t in docs]), strict=True):
        for (i, _), item in zip(bench, items, strict=True):
            reach = 3 * len(item)
            for s in range(0, max(1, len(text) - len(item) // 2), max(1, len(item) // 4)):
                common, answer = D._agree(item, text[max(0, s - len(item)) : s + reach - len(item)])
                if common >= D._least(len(item)) and answer >= D.ANSWER:
                    every.add((d, i))
                    break
    found = set(pairs(D.contaminated(docs_of(docs), ben(spark, bench))))
    assert len(every) > 60 and len(found & every) >= 0.9 * len(every)
    assert len(found - every) <= 0.05 * len(found)


def test_randomised_svd_spans_the_leading_directions(spark, items):
    bench = D.passages(ben(spark, items), "item_id", "text")
    words = [np.array(r["words"], np.int64).view(np.uint64) for r in bench.orderBy("item", "part").collect()]
    vocabulary = D._Vocabulary(np.unique(np.concatenate(words)))
    idf = np.linspace(0.5, 3, len(vocabulary.words))
    dense = np.zeros((len(words), len(idf)))
    for i, w in enumerate(words):
        at, weight = D._weighted(vocabulary.number(w), idf)
        dense[i, at] = weight
    space = D.latent_space(bench, vocabulary, idf, len(words))
    assert np.allclose(space.T @ space, np.eye(space.shape[1]), atol=1e-4)
    assert np.linalg.norm(dense - dense @ space @ space.T) < 1e-3 * np.linalg.norm(dense)


def test_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(1, 14))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            prev = 0
            for j, y in enumerate(b):
                prev, row[j + 1] = row[j + 1], prev + 1 if x == y else max(row[j + 1], row[j])
        assert D.lcs(D._masks(a), len(a), b) == row[-1]


def test_paraphrases_are_found_in_a_large_corpus(spark, docs_of, items, monkeypatch):
    small = D.document_frequencies

    def large(docs, vocabulary):
        n, df = small(docs, vocabulary)
        return n * 10**7, df * 10**7

    monkeypatch.setattr(D, "document_frequencies", large)
    rng = random.Random(10)
    docs = []
    for i, text in items[1:]:
        words = text.split()
        for k in rng.sample(range(len(words) * 3 // 4), len(words) // 4):
            words[k] = f"unseen{rng.randrange(10**6)}"
        docs.append((i, embed(rng, " ".join(words))))
    docs += [(1000 + k, prose(rng, 400, 3000)) for k in range(50)]
    assert pairs(D.contaminated(docs_of(docs), ben(spark, items))) == [(i, i) for i, _ in items[1:]]


def test_rare_words_lose_no_match(items):
    rng = random.Random(11)
    item = [list(range(100, 100 + n)) for n in (6, 8, 37, 150)]
    vocabulary = D._Vocabulary(np.array([w for w in range(100, 180)], np.uint64))
    rare = D._rare(item, vocabulary, np.linspace(1, 4, 80))
    for p, words in enumerate(item):
        own = set(rare.vocabulary.words[np.flatnonzero([p in rare.items[a:z] for a, z in zip(rare.start, rare.start[1:])])].tolist())
        for _ in range(50):
            kept = rng.sample(words, next(k for k in range(len(words) + 1) if k / len(words) >= D._least(len(words))))
            assert len(own & set(kept)) >= rare.need[p] > 0
