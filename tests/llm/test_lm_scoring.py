from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import pytest

from llm_cases import awkward, docs_of, prose  # noqa: F401
from wickline.llm import lm_scoring as M


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


class Brute:
    """The interpolated model by plain counting."""

    def __init__(self, texts, share):
        seqs = [tokens(t) for t in texts]
        self.c = [None, Counter(), Counter(), Counter()]
        for s in seqs:
            for k, w in enumerate(s):
                a, b = (s[k - 1] if k > 0 else None), (s[k - 2] if k > 1 else None)
                self.c[1][w] += 1
                self.c[2][(a, w)] += 1
                self.c[3][(b, a, w)] += 1
        self.n, self.v = sum(self.c[1].values()), len(self.c[1])
        least = max(2, math.ceil(share * self.n))
        words = {w for w, c in self.c[1].items() if c >= least}
        self.kept2 = {g: c for g, c in self.c[2].items() if c >= least and g[1] in words}
        # the start of a text is a context of its own for pairs of words only
        self.kept3 = {g: c for g, c in self.c[3].items() if c >= least and g[:2] in self.kept2 and not (g[0] is None and g[1] is None)}
        self.left2, self.left3 = Counter(), Counter()
        for g, c in self.kept2.items():
            self.left2[g[0]] += (c - 0.75) / self.c[1][g[0]]
        for g, c in self.kept3.items():
            self.left3[g[:2]] += (c - 0.75) / self.kept2[g[:2]]

    def score(self, text):
        s, out = tokens(text), 0.0
        for k, w in enumerate(s):
            a, b = (s[k - 1] if k > 0 else None), (s[k - 2] if k > 1 else None)
            p = (self.c[1][w] + 1) / (self.n + self.v + 1)
            if a in self.left2:
                p = (1 - self.left2[a]) * p + (self.kept2.get((a, w), 0.75) - 0.75) / self.c[1][a]
            if (b, a) in self.left3:
                p = (1 - self.left3[(b, a)]) * p + (self.kept3.get((b, a, w), 0.75) - 0.75) / self.kept2[(b, a)]
            out += math.log10(p)
        return out


def check(df, rows, share):
    brute = Brute([t for i, t in rows if not held(i)], share)
    got = sorted((tuple(r) for r in df.collect()), key=lambda r: (repr(r[0]), r[1], r[4]))
    want = []
    for i, t in rows:
        s = tokens(t)
        base = sum(math.log10((brute.c[1][w] + 1) / (brute.n + brute.v + 1)) for w in s)
        want.append((i, len(s), sum(brute.c[1][w] > 0 for w in s), brute.n, base, brute.score(t)))
    want.sort(key=lambda r: (repr(r[0]), r[1], r[4]))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert [r[4] for r in got] == pytest.approx([r[4] for r in want], rel=1e-9)
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-7)


@pytest.mark.parametrize(("share", "block"), [(4e-6, 1 << 24), (2e-3, 3000)])
def test_matches_plain_counting(docs_of, awkward, monkeypatch, share, block):
    monkeypatch.setattr(M, "SHARE", share)
    monkeypatch.setattr(M, "BLOCK_BYTES", block)
    rng = random.Random(6)
    rows = [r for r in awkward if len(r[1] or "") < 10_000] + [(100 + i, prose(rng, rng.randrange(5, 60), 40)) for i in range(120)]
    df = M.lm_scores(docs_of(rows).repartition(3).checkpoint(), ~M.held_out())
    assert df.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    check(df, rows, share)


def test_probabilities_of_a_state_sum_to_one():
    import numpy as np

    words = np.sort(np.random.default_rng(0).integers(1, 2**63, 6).astype(np.uint64))
    counts = np.array([10, 20, 5, 8, 9, 4])
    context = np.repeat(words[:2], 3)
    gram = M.join(context, np.tile(words[:3], 2))
    place = np.argsort(gram)
    pairs = M.NGrams(gram[place], context[place], np.array([3, 2, 4, 9, 5, 2]))
    none = M.NGrams(*(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64)))
    a = M._automaton(int(counts.sum()), len(words), words, counts, {2: pairs, 3: none})
    for first in words[:3]:
        text = np.array([first, 0], np.uint64)
        total = 0.0
        for w, c in zip(words, counts, strict=True):
            text[1] = w
            total += 10 ** a.traverse(M.Tokens(text, np.array([0, 2])), np.array([1, c]))[1]
        total += 10 ** a.traverse(M.Tokens(np.array([first, 12345], np.uint64), np.array([0, 2])), np.array([1, 0]))[1]
        assert total == pytest.approx(1.0, abs=1e-6)


def test_nothing_to_learn_from(docs_of):
    assert M.lm_scores(docs_of([]), ~M.held_out()).count() == 0
    i = next(i for i in range(100) if held(i))
    row = M.lm_scores(docs_of([(i, "some words")]), ~M.held_out()).first()
    assert tuple(row) == (i, 3, 0, 0, 0.0, 0.0)


def test_ngrams_seen_twice_are_learnt_in_a_large_corpus(docs_of, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_BYTES", 1 << 20)
    rng = random.Random(12)
    rows = [(10 + i, prose(rng, 4000, 3000)) for i in range(180)]  # over 500,000 tokens to learn from
    rows += [(2000 + i, "rare words stand here") for i in range(9)]
    kept = [r for r in rows if r[0] < 2000] + [r for r in rows if r[0] >= 2000 and not held(r[0])][:2]
    check(M.lm_scores(docs_of(kept).repartition(3).checkpoint(), ~M.held_out()), kept, 0)


def test_a_block_looks_its_ngrams_up_once_each(monkeypatch):
    import numpy as np
    import pyarrow as pa

    texts = ["a b a b a b c", "", "b a b", None, "a b c a b", "c"]
    rows = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([True] * len(texts))], names=["text", "learn"])
    block = M._Block([rows])
    dealt = [M._deal(0, M.WORD, *block.words(), 64), M._deal(0, M.PAIR, *block.pairs(), 64)]
    totals = M._add(pa.Table.from_batches(dealt[:1])), M._add(pa.Table.from_batches(dealt[1:]))
    for kind, amounts in ((M.TRIPLE, "triples"), (M.OF_WORD, "of_words"), (M.OF_PAIR, "of_pairs")):
        block._totals = pa.concat_tables(totals)
        totals = *totals, M._add(pa.Table.from_batches([M._deal(0, kind, *getattr(block, amounts)(), 64)]))
    block = M._Block([rows], pa.concat_tables(totals))
    model, count = block.model(24, 4)
    alone = model.traverse(block.tokens, count)  # numbers its contexts and n-grams itself
    looked = []
    member = M._member
    monkeypatch.setattr(M, "_member", lambda keys, h: looked.append(h) or member(keys, h))
    assert np.array_equal(model.traverse(block.tokens, count, block.numbered()), alone)
    assert len(looked) == 4 and all((h[1:] > h[:-1]).all() for h in looked)
