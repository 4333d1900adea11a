from __future__ import annotations

import importlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from llm_cases import awkward, docs_of, prose  # noqa: F401
from wickline.llm import ngram_jaccard as J
from wickline.llm.components import components


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    ids = sorted({i for i, _ in rows}, key=lambda i: 2**63 if i is None else i)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [(i, shingles(t)) for i, t in rows]
    rank = {i: k for k, i in enumerate(ids)}
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(i), root(j)), key=rank.get)
                parent[y] = x
    return sorted(((i, len(s), root(i)) for i, s in sets), key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


def near_copies(seed, groups=6, size=12):
    rng = random.Random(seed)
    rows, n = [], 100
    for _ in range(groups):
        words = prose(rng, rng.choice([9, 40, 150])).split()
        for _ in range(size):
            own = list(words)
            for _ in range(rng.randrange(0, 5)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            rows.append((n, " ".join(own)))
            n += 1
    rng.shuffle(rows)
    return rows


def test_matches_brute_force_on_awkward_rows(docs_of, awkward):
    assert result(J.jaccard_components(docs_of(awkward))) == brute(awkward)


@pytest.mark.parametrize("tile", [4, 256])
def test_chains_of_near_copies(docs_of, monkeypatch, tile):
    monkeypatch.setattr(J, "TILE", tile)
    monkeypatch.setattr(J, "FEW", tile // 2)
    rows = near_copies(tile)
    assert result(J.jaccard_components(docs_of(rows))) == brute(rows)


@pytest.mark.parametrize("few", [1, 4, 16])
def test_links_that_the_star_pass_misses(docs_of, monkeypatch, few):
    # without stars all links must come from prefixes and tiles
    monkeypatch.setattr(J, "_star_pairs", lambda small: small.select(small["__id"].alias("a"), small["__id"].alias("b")).where("false"))
    monkeypatch.setattr(J, "TILE", 5)
    monkeypatch.setattr(J, "FEW", few)
    rows = near_copies(77)
    assert result(J.jaccard_components(docs_of(rows))) == brute(rows)


def test_empty_table(docs_of):
    assert J.jaccard_components(docs_of([])).count() == 0


def test_one_of_each(docs_of):
    rows = near_copies(3)
    kept = sorted(r["doc_id"] for r in J.one_of_each(docs_of(rows)).collect())
    assert kept == sorted({c for _, _, c in brute(rows)})


def test_bound_is_never_below_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        pool = rng.integers(0, 2**63, 4000).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 3000))) for _ in range(2))
        sa, sb = J.signature(a), J.signature(b)
        width = 8 * min(len(sa), len(sb))
        assert J._bound(J._fold(sa, width), len(a), J._fold(sb, width), len(b)) >= len(np.intersect1d(a, b))


def test_prefixes_of_linked_sets_meet():
    rng = np.random.default_rng(2)
    pool = np.sort(rng.integers(0, 2**63, 60).astype(np.uint64))
    levels = (pool[::3], np.full(len(pool[::3]), 5))
    for _ in range(500):
        n = int(rng.integers(1, 50))
        a = np.sort(rng.choice(pool, n, replace=False))
        b = np.unique(np.append(rng.choice(a, max(1, n - int(rng.integers(0, 6))), replace=False), rng.choice(pool, int(rng.integers(0, 4)))))
        if J.links(len(np.intersect1d(a, b)), len(a), len(b)):
            assert len(np.intersect1d(J._prefix(a, levels), J._prefix(b, levels)))


def test_sets_are_those_of_words():
    texts = ["", None, "a b", "A b c d e F", "a b c d e f a b c d e f", " x\ty\n"]
    assert [len(s) for s in J._sets(pa.array(texts))] == [len(shingles(t)) for t in texts]


def test_components_of_a_long_chain(spark):
    n = 60
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(500, 400), (7, 7)], "u long, v long")
    got = {r["id"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, n + 1)}, 500: 400}


def test_staged_tables_are_few_files_whatever_the_shuffle_partitions(spark, docs_of, monkeypatch):
    """Each file made starts processes on an executor; 48 partitions of a few rows once gave 48 files."""
    rng = random.Random(31)
    rows = near_copies(31, groups=40, size=8) + [(9000 + k, prose(rng, 30)) for k in range(300)]
    files = {}

    def counted(module, plain):
        def stage(df, name, *most):
            out = plain(df, name, *most)
            files[name] = max(files.get(name, 0), len(out.inputFiles()))
            return out

        monkeypatch.setattr(module, "staged", stage)

    components_module = importlib.import_module("wickline.llm.components")
    counted(J, J.staged)
    counted(components_module, components_module.staged)
    conf = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = result(J.jaccard_components(docs_of(rows)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    most = 3 * spark.sparkContext.defaultParallelism
    assert most < 48  # or the test says nothing
    assert {n: f for n, f in files.items() if f > most} == {}
    assert {"classes", "labelled", "contested", "edges"} <= set(files)
    assert got == brute(rows)
