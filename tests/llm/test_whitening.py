from __future__ import annotations

import math
import random

import numpy as np
import pytest

from wickline.llm import whitening as W
from wickline.llm.queries import op13_whitening

SCHEMA = "vec_id long, embedding array<double>, x int, n string, component long, whitened int, v int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", 2, 3, 4) for i, v in rows], SCHEMA).repartition(5)


def brute(rows, scale=64, offset=1_000_000, k=16):
    """Deviations by id, whitened values up to sign, explained shares."""
    good = [(i, tuple(math.floor(scale * c) + offset for c in v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(x) for x in {x for _, x in good}]
    dims = max(sizes, key=lambda s: (sizes.count(s), s))
    good = [(i, x) for i, x in good if len(x) == dims]
    fit = sorted({x for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[n * a - s for a, s in zip(x, sums, strict=True)] for x in fit], dtype=object)
    cov = (centred.T @ centred / n**3).astype(float)
    e, q = np.linalg.eigh(cov)
    order = [o for o in np.argsort(-e)[:k] if e[o] > 1e-12 * e.max()]
    out = []
    for i, x in good:
        y = [n * a - s for a, s in zip(x, sums, strict=True)]
        w = (np.array(y, dtype=object) / n).astype(float) @ q[:, order] / np.sqrt(e[order])
        out += [(i, c + 1, n, sum(a * a for a in y), abs(w[c]), e[o] / np.trace(cov)) for c, o in enumerate(order)]
    return out


def check(got, want):
    key = lambda r: (r[0] is not None, r[0], *r[1:5])
    got = sorted((tuple(r)[:4] + (abs(r["whitened"]), r["explained"]) for r in got), key=key)
    want = sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in got], [r[4:] for r in want], rtol=1e-7, atol=1e-9)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [(i, [rng.gauss(0, 0.1 + d) for d in range(20)]) for i in range(150)]
    out += [(200 + i, out[3][1]) for i in range(60)]  # a large group of copies
    out += [(7, out[9][1]), (None, out[1][1]), (300, None), (301, []), (302, [1.0] * 19 + [None])]
    return out + [(303, [float("nan")] * 20), (304, [math.inf] + [0.0] * 19), (305, [0.5, 0.25]), (306, [0.001] * 20)]


def test_matches_brute_force(spark, rows):
    got = W.whiten(frame(spark, rows)).collect()
    assert list(got[0].asDict()) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got, brute(rows))
    assert got[0]["identity_error"] < 1e-9
    assert len({(r["component"], r["explained"]) for r in got}) == 16


def test_whitened_fit_list_has_unit_covariance(spark, rows):
    got = W.whiten(frame(spark, rows), components=6).collect()
    w = {}
    for r in got:
        w.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r["whitened"]
    m = np.array(sorted({tuple(round(v[c], 12) for c in range(1, 7)) for v in w.values()}))
    assert np.abs(np.cov(m.T, bias=True) - np.eye(6)).max() < 1e-6


def test_planes_are_exact_for_any_width():
    rng = random.Random(8)
    for bits in (1, 9, 31, 62):
        x = np.array([[rng.randrange(-(2 ** (bits - 1)), 2 ** (bits - 1)) if d else 5 for d in range(5)] for _ in range(131)])
        lo, hi = x.min(0).tolist(), x.max(0).tolist()
        planes = W.BitPlanes(lo, hi)
        for part in np.array_split(x, 3):
            planes.add(part)
        u = x.astype(object) - np.array(lo, dtype=object)
        got = {}
        for i, j, limb, v in zip(*(c.to_pylist() for c in planes.rows_out().columns), strict=True):
            got[i, j] = got.get((i, j), 0) + (v << (W.LIMB_BITS * limb))
        assert got[-1, -1] == 131
        assert all(got[i, -1] == u[:, i].sum() and got[i, j] == (u[:, i] * u[:, j]).sum() for i in range(5) for j in range(i, 5))


def test_one_huge_entry_keeps_the_other_components(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(80)] + [(90, [1e9, 0.0, 0.0, 0.0, 0.0, 0.0])]
    got = W.whiten(frame(spark, rows)).collect()
    assert len(got) == 81 * 6 and got[0]["identity_error"] < 1e-4
    by_id = {r["vec_id"]: r["deviation"] for r in got}
    assert by_id[90] is None or by_id[90] < 2**63


def test_entries_beyond_a_long_saturate(spark):
    rows = [(i, [float(i), 1e300 if i == 3 else -1e300 if i == 4 else 0.5 * i * i]) for i in range(8)]
    got = W.whiten(frame(spark, rows)).collect()
    assert {r["vec_id"] for r in got} == set(range(8)) and got[0]["identity_error"] < 1e-4
    assert all(r["deviation"] is None for r in got if r["vec_id"] in (3, 4))


def test_no_variance_gives_no_rows(spark):
    assert W.whiten(frame(spark, [])).collect() == []
    assert W.whiten(frame(spark, [(1, None)])).collect() == []
    assert W.whiten(frame(spark, [(1, [0.5, 1.0])])).collect() == []
    assert W.whiten(frame(spark, [(i, [0.5, 1.0]) for i in range(9)])).collect() == []


def test_directions_without_variance_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0, float(i * i)]) for i in range(30)]
    got = W.whiten(frame(spark, rows)).collect()
    assert {r["component"] for r in got} == {1, 2} and got[0]["identity_error"] < 1e-9


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    check(op13_whitening(spark, folder).collect(), brute(rows))
