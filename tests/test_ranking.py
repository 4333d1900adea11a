"""SRT-1 and SRT-3: places without a window, what row-group statistics skip."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wickline.operators.ranking import ranked, ranked_in_groups
from wickline.sources.footers import layout_skips, listed_names, row_group_ranges


@pytest.fixture(scope="module")
def rows(spark):
    """One group of two thirds of all rows, many small ones, and a NULL group."""
    big = spark.range(4000).selectExpr("'hot' AS g", "pmod(hash(id), 900) AS v", "id")
    small = spark.range(2000).selectExpr("IF(id % 50 = 0, NULL, concat('g', id % 97)) AS g", "pmod(hash(id, 1), 900) AS v", "id + 10000 AS id")
    return big.unionByName(small).repartition(7)


def test_places_of_all_rows(spark, rows):
    got = ranked(rows, [F.col("v").desc(), "id"], partitions=6)
    assert got.columns == ["g", "v", "id", "place"]
    want = {r["id"]: i + 1 for i, r in enumerate(sorted(rows.collect(), key=lambda r: (-r["v"], r["id"])))}
    assert {r["id"]: r["place"] for r in got.collect()} == want


@pytest.mark.parametrize("partitions", [1, 9, None])
def test_places_in_groups(spark, rows, partitions):
    got = ranked_in_groups(rows, ["g"], [F.col("v").desc(), "id"], partitions=partitions)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    want, seen = {}, {}
    for r in sorted(rows.collect(), key=lambda r: (-r["v"], r["id"])):
        seen[r["g"]] = seen.get(r["g"], 0) + 1
        want[r["id"]] = seen[r["g"]]
    assert {r["id"]: r["place"] for r in got.collect()} == want


def test_a_hot_group_is_dealt_over_tasks(spark, rows, workdir):
    ranked_in_groups(rows, ["g"], ["id"], partitions=12, path=f"{workdir}/ranked")
    by_task = spark.read.parquet(f"{workdir}/ranked").where("g = 'hot'").groupBy("__part").count().collect()
    assert len(by_task) >= 6 and max(r["count"] for r in by_task) < 2000


def test_no_rows(spark, rows):
    assert ranked(rows.limit(0), ["id"]).collect() == []
    assert ranked_in_groups(rows.limit(0), ["g"], ["id"]).collect() == []


def test_row_groups_and_what_they_skip(spark, workdir):
    df = spark.range(1000).selectExpr("concat('s', id div 250) AS symbol", "id")
    writer = df.coalesce(1).sortWithinPartitions("id").write.option("parquet.block.row.count.limit", 100)
    writer.parquet(f"{workdir}/sorted")
    df.orderBy(F.hash("id")).coalesce(1).write.option("parquet.block.row.count.limit", 100).parquet(f"{workdir}/mixed")
    ranges = row_group_ranges(listed_names(spark, f"{workdir}/sorted"), "symbol").orderBy("row_group").collect()
    assert [r["rows"] for r in ranges] == [100] * 10
    assert (ranges[0]["least"], ranges[2]["least"], ranges[2]["greatest"]) == ("s0", "s0", "s1")
    values = df.select("symbol").union(spark.sql("SELECT 'none' AS symbol"))
    got = {r["symbol"]: (r["groups"], r["overlaps"]) for r in layout_skips(listed_names(spark, f"{workdir}/sorted"), values).collect()}
    assert got == {"s0": (10, 3), "s1": (10, 3), "s2": (10, 3), "s3": (10, 3), "none": (10, 0)}
    mixed = {r["symbol"]: r["overlaps"] for r in layout_skips(listed_names(spark, f"{workdir}/mixed"), values).collect()}
    assert mixed["s1"] == 10
    with pytest.raises(Exception, match="no column"):
        row_group_ranges(listed_names(spark, f"{workdir}/sorted"), "nothing").collect()


def test_groups_without_statistics_are_never_skipped(spark, workdir):
    df = spark.range(100).selectExpr("concat('s', id) AS symbol")
    df.coalesce(1).write.option("parquet.column.statistics.enabled", "false").parquet(f"{workdir}/plain")
    got = layout_skips(listed_names(spark, f"{workdir}/plain"), df.limit(1)).collect()
    assert [(r["groups"], r["overlaps"]) for r in got] == [(1, 1)]


def test_compacted_months_are_clustered(spark, workdir):
    """SRT-1: a symbol's slice of a compacted table needs a part of its row groups."""
    from wickline.plans.store import CandleStore
    from wickline.sources.events import event_candles

    store = CandleStore(spark, f"{workdir}/tables", partitions=6)
    candles = event_candles(spark, "/root/testdata/sf0.01")
    store.append(candles, order_by="created_at", given_created_at=True)
    store.compact()
    got = {r["symbol"]: r for r in layout_skips(listed_names(spark, store.latest_path), candles.select("symbol")).collect()}
    assert len(got) == 5 and all(r["overlaps"] <= r["groups"] / 2 for r in got.values())
