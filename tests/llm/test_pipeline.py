from __future__ import annotations

import importlib

import corpus_pipeline as P
import pytest

from wickline.llm.base import staged
from wickline.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in P.STAGES:
        out.append(staged(stage(spark, out[-1], SF), "test-stage"))
    return out


def test_each_stage_keeps_rows_and_columns_of_its_input(stages):
    for before, after in zip(stages[:-2], stages[1:-1], strict=True):
        assert after.dtypes == before.dtypes
        left = {r["doc_id"] for r in before.collect()}
        assert {r["doc_id"] for r in after.collect()} <= left
    assert 0 < stages[-1].count() == stages[-2].count() < stages[0].count()


def test_run_is_its_stages(spark, stages):
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(P.run(spark, SF)) == rows(stages[-1])


def test_names_and_queries():
    assert [n for n, _ in P.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "SentencePiece encoding and decoding"]
    assert [int(q[2:].split("_")[0]) for q in QUERIES] == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
    entry = importlib.import_module("__spark_entry__")
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_empty_table_and_nulls(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (5_000_000, "", "en", "s", 0)], docs.schema)
    for df in (docs.where("false"), odd):
        now = df
        for _, stage in P.STAGES:
            now = staged(stage(spark, now, SF), "test-stage")
        assert now.count() == df.count()
