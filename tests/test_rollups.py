"""Mergeable counts and medians, reconciliation and alert episodes on hand-made rows."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from landledger.operators import compare
from landledger.plans import monitoring, rollups


def test_bitmaps_merge_exactly(spark):
    rows = [("a", 0), ("a", 0), ("a", 32_767), ("a", 32_768), ("b", 32_768), ("b", 10 ** 12), ("b", None), ("c", -1)]
    frame = spark.createDataFrame(rows, "month string, request_id long")
    maps = rollups.request_bitmaps(frame, ["month"])
    both = maps.unionByName(rollups.request_bitmaps(frame.filter("request_id < 40000"), ["month"]))
    assert {r.month: r.requests for r in rollups.distinct_requests(both, ["month"]).collect()} == {"a": 3, "b": 2}
    assert rollups.distinct_requests(both, []).first().requests == 4
    assert maps.count() == len({(r.month, r.bucket) for r in maps.collect()})
    plan = rollups.distinct_requests(maps, ["month"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap" in plan.lower()


@pytest.mark.parametrize("values,median", [([5], 5), ([1, 2], 1.5), ([1, 2, 3], 2), ([0, 0, 9, 9], 4.5),
                                           ([7, 7, 7, 1], 7), ([None, 4, 8], 6)])
def test_medians_of_counters(spark, values, median):
    frame = spark.createDataFrame([(v,) for v in values], "processing_days int")
    counters = rollups.day_counters(frame, [])
    extra = rollups.day_counters(spark.createDataFrame([(100,), (100,)], "processing_days int"), [])
    merged = counters.unionByName(extra).unionByName(extra.selectExpr("value", "-n AS n"))
    assert [r["median"] for r in rollups.medians(merged, []).collect()] == [median]


def test_reconciliation_reads_only_differing_months(spark, tmp_path):
    rows = [(i, f"r{i}", 202301 + i % 12) for i in range(240)]
    frame = spark.createDataFrame(rows, "id long, text string, month int")
    other = [(i, "other" if i == 25 else t, m) for i, t, m in rows if i != 13] + [(999, "new", 202302)]
    sides = []
    for name, data in (("source", rows), ("warehouse", other)):
        spark.createDataFrame(data, frame.schema).write.partitionBy("month").parquet(str(tmp_path / name))
        sides.append(spark.read.schema(frame.schema).parquet(str(tmp_path / name)))
    found = compare.recon_differences(*sides, ["id"], "month")
    assert {r.id: r.change for r in found.collect()} == {13: "deleted", 25: "changed", 999: "inserted"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(set(re.findall(r"PartitionFilters: \[[^\]]*(month#\d+) = 202302", plan))) == 2
    assert compare.recon_differences(sides[0], sides[0], ["id"], "month").count() == 0
    moved = sides[0].withColumn("month", F.expr("IF(id = 5, NULL, month)"))
    assert [(r.id, r.change) for r in compare.recon_differences(sides[0], moved, ["id"], "month").collect()] == [
        (5, "changed")]


def test_episodes_open_and_close_at_different_values(spark):
    day = lambda d: dt.date(2024, 1, d)
    values = [1, 9, 6, 6, 9, None, 4, 6, 10, 12]
    rows = [(day(i + 1), "x", v) for i, v in enumerate(values)] + [(day(2), "x", 11), (day(1), "y", 99), (day(1), "z", 0)]
    history = spark.createDataFrame([(d, k, None if v is None else float(v)) for d, k, v in rows],
                                    "as_of date, kpi string, value double")
    found = monitoring.alert_episodes(history, [("x", 9, 5), ("z", 9, 5)])
    assert sorted(tuple(r) for r in found.collect()) == [
        ("x", day(2), day(6), 5, 11.0, False), ("x", day(9), day(10), 2, 12.0, True)]
