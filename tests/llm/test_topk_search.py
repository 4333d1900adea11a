from __future__ import annotations

import math
import random

import pytest

from wickline.llm import topk_search as S

SCHEMA = "vec_id long, embedding array<float>, q int, score double, id long, v string"


def brute(rows, wanted, k):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in {(i, tuple(v)) for i, v in good if wanted(i)}:
        scores = sorted(((-sum(a * b for a, b in zip(v, w)), j) for j, w in good if j != i and len(w) == len(v)))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, k=5, **kw):
    df = spark.createDataFrame([(i, v, 1, 2.0, 3, "x") for i, v in rows], SCHEMA).repartition(5)
    got = S.top_k(df, df.where("vec_id % 5 = 0"), k=k, **kw)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    f = lambda: round(rng.uniform(-1, 1) * 64) / 64  # noqa: E731  exact in float and full of ties
    out = [(i, [f() for _ in range(4)]) for i in range(120)]
    out += [(200 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(40)]
    out += [(300, None), (305, [1.0, None, 0.0, 0.0]), (310, [float("nan"), 0.0, 0.0, 0.0]), (315, [float("inf"), 0.0, 0.0, 0.0])]
    out += [(None, [1.0, 0.0, 0.0, 0.0]), (320, [0.25, 0.5]), (325, [0.5, 0.25]), (330, []), (7, [0.5, 0.5, 0.5, 0.5])]
    return out


def test_matches_brute_force(spark, rows):
    assert run(spark, rows) == brute(rows, lambda i: i % 5 == 0, 5)


def test_blocks_of_queries(spark, rows):
    assert run(spark, rows, block=8) == brute(rows, lambda i: i % 5 == 0, 5)


def test_fewer_candidates_than_k(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (5, [0.25, 0.0])]
    assert run(spark, rows) == brute(rows, lambda i: i % 5 == 0, 5)


def test_large_components_are_exact(spark):
    rows = [(i, [1e15 + 1024.0 * i, -1e15]) for i in range(6)]
    rows = [(i, [float(__import__("numpy").float32(x)) for x in v]) for i, v in rows]
    small = [(i, [x / 2**40 for x in v]) for i, v in rows]
    assert run(spark, small, k=2) == brute(small, lambda i: i % 5 == 0, 2)


def test_a_query_whose_norm_squared_is_beyond_a_long(spark):
    rng = random.Random(6)
    rows = [(i, [rng.randrange(-64, 64) / 64, rng.randrange(-64, 64) / 64]) for i in range(40)]
    rows += [(50, [1e9, 0.5])]  # only its product with itself, which is no candidate, is beyond a long
    rows = [(i, [float(__import__("numpy").float32(x)) for x in v]) for i, v in rows]
    assert run(spark, rows) == brute(rows, lambda i: i % 5 == 0, 5)


def test_empty_table(spark):
    assert run(spark, []) == []
