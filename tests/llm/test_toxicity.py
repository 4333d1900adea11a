from __future__ import annotations

import random
import zlib

import pytest

from llm_cases import awkward, docs_of, prose  # noqa: F401
from wickline.llm import toxicity as T

INSULTS = ["zorbling", "zorblest", "grotfiend", "vilescum"]


def corpus(n=900, seed=4):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        sentences = [prose(rng, rng.randrange(4, 12)) for _ in range(rng.randrange(1, 15))]
        toxic = rng.random() < 0.25
        if toxic:
            at = rng.randrange(len(sentences))
            sentences[at] += " " + rng.choice(INSULTS) + " " + rng.choice(INSULTS)
        docs.append((i, ". ".join(sentences)))
        if rng.random() < 0.9:
            labels.append((i, int(toxic)))
    return docs, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def trained(spark, docs_of):
    docs, labels = corpus()
    table = spark.createDataFrame([(i, y, 1.0) for i, y in labels] + [(0, None, 1.0), (None, 1, 1.0)], "doc_id long, toxic int, score double")
    return docs, dict(labels), table, T.toxicity_scores(docs_of(docs), table).collect()


def test_held_out_accuracy(trained):
    docs, labels, _, got = trained
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == held(r["doc_id"]) and r["predicted"] == (r["score"] >= 0.5) for r in got)
    out = [(r["predicted"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == y for p, y in out) / len(out) > 0.95
    assert sum(p and y for p, y in out) / sum(y for _, y in out) > 0.85


def test_held_out_labels_change_nothing(spark, docs_of, trained):
    docs, labels, _, got = trained
    other = [(i, 1 - y if held(i) else y, 1.0) for i, y in labels.items()]
    again = T.toxicity_scores(docs_of(docs), spark.createDataFrame(other, "doc_id long, toxic int, score double")).collect()
    assert {r["doc_id"]: r["score"] for r in again} == pytest.approx({r["doc_id"]: r["score"] for r in got})


def test_offending_sentences_are_located(docs_of, trained):
    docs, labels, table, _ = trained
    model = T.train(docs_of(docs), table, ~T.held_out())
    text = "A café w1 w2 w3. Then zorbling grotfiend here! And w5 w6 w7.\nMore w8"
    row = T.score(docs_of([(1, text)]), model).first()
    assert [text[s["start"] : s["start"] + s["length"]] for s in row["offending"]] == [" Then zorbling grotfiend here!"]


def test_awkward_rows(docs_of, awkward, trained):
    docs, labels, table, _ = trained
    model = T.train(docs_of(docs), table, ~T.held_out())
    got = T.score(docs_of(awkward), model).collect()
    assert sorted((r["doc_id"] for r in got), key=repr) == sorted((i for i, _ in awkward), key=repr)
    empty = {r["score"] for r in got if r["doc_id"] in (1, 2, 3)}
    assert len(empty) == 1 and 0 <= empty.pop() < 0.5
    kept = T.drop_toxic(docs_of(awkward), model)
    assert kept.columns == docs_of([]).columns and kept.count() == len(awkward)


def test_labels_of_one_kind_and_empty_tables(spark, docs_of):
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, toxic int")
    docs = docs_of([(i, f"text number {i}") for i in range(30)])
    assert {round(r["score"], 6) for r in T.toxicity_scores(docs, labels([])).collect()} == {0.0}
    assert {round(r["score"], 6) for r in T.toxicity_scores(docs, labels([(i, 1) for i in range(30)])).collect()} == {1.0}
    assert T.toxicity_scores(docs_of([]), labels([])).count() == 0
