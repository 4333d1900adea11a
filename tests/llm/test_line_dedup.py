from __future__ import annotations

import hashlib

import numpy as np
import pytest

from llm_cases import awkward, docs_of  # noqa: F401
from wickline.llm import line_dedup as L

BLANK = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(rows, least=10):
    order = lambda i: 2**63 - 1 if i is None else i
    first: dict[str, int] = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            first[k] = min(first.get(k, 2**63), order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or first[key(x)] == order(i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_matches_brute_force_on_awkward_rows(docs_of, awkward):
    got = L.line_digests(docs_of(awkward))
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(awkward)


def test_one_line_in_every_document_spans_partitions(docs_of, monkeypatch):
    monkeypatch.setattr(L, "ROWS_PER_PARTITION", 20)
    rows = [(i, f"the line that everyone has\nbut this is of {i}\nthe line that everyone has") for i in range(300)]
    got = L.line_digests(docs_of(rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_empty_table(docs_of):
    assert L.line_digests(docs_of([])).count() == 0


def test_other_columns_stay(docs_of, awkward):
    df = docs_of(awkward)
    out = L.drop_lines(df)
    assert out.columns == [*df.columns, "__kept", "__n_lines", "__n_dropped"]
    assert sorted(map(repr, out.select(*df.columns).collect())) == sorted(map(repr, df.collect()))


@pytest.mark.parametrize("drop", [[0], [7], [8], [0, 3, 15, 16]])
def test_bitmap_round_trip(drop):
    keep = L.unpack_bitmap(L._bitmap(np.array(drop)), 20)
    assert np.flatnonzero(~keep).tolist() == drop
    assert L.unpack_bitmap(None, 3).all()
