"""What the physical plans must and must not contain."""

import re

import pytest

from landledger.sample_queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WRITES = {"load_full_refresh", "upsert_receivable_fact", "upsert_recovery_fact", "dq_orphans", "kpi_health"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(build(spark, FOLDER)) for name, build in QUERIES.items() if name not in WRITES}


def test_no_python_evaluation_and_no_cartesian_product(plans):
    for name, text in plans.items():
        assert "EvalPython" not in text and "InPandas" not in text, name
        assert "CartesianProduct" not in text, name


def test_only_the_kpi_pair_report_pairs_rows(plans):
    assert [n for n, text in plans.items() if "NestedLoopJoin" in text] == ["kpi_cross"]


def test_unpartitioned_windows_only_over_label_groups(plans):
    windows = {n for n, text in plans.items() if "Window [" in text}
    labels = {"kpi_by_status", "kpi_by_zone_type", "kpi_priority_split", "an_by_status", "an_by_type",
              "dash_status_priority"}
    # per KPI over its stored days, and over the different day counts
    assert windows - {"published_views"} == labels | {"alert_episodes", "median_by_counters"}
    alone = {n for n in windows for line in re.findall(r"Window \[.*", plans[n])
             if not re.search(r"\], \[", line) or "windowspecdefinition(specified" in line}
    assert alone <= labels | {"median_by_counters"}  # of all: one row per different day count


def test_line_items_are_not_read_without_need(plans):
    for name in ("an_total", "an_by_status", "an_by_type", "an_priority_trend", "kpi_acceptance", "kpi_volume",
                 "kpi_monthly_summary", "kpi_top_zones", "requests_per_company", "recon_counts", "recon_status",
                 "dim_request_status", "dash_status_priority", "kpi_cross", "dq_rules"):
        assert "lineitem" not in plans[name], name


def test_filters_and_columns_reach_the_scan(plans):
    assert "GreaterThanOrEqual(ts," in plans["incremental_recoveries"]
    scan = next(line for line in plans["fin_total_payments"].splitlines() if "lineitem.parquet" in line)
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_linestatus:string>" in scan


def test_line_items_are_aggregated_by_hash(plans):
    for name in ("fact_requests", "fact_receivables", "kpi_by_entity", "build_payments"):
        assert "SortAggregate" not in plans[name], name


def test_both_payment_sources_share_one_scan(spark):
    text = final_plan(QUERIES["fin_net_revenue"](spark, FOLDER))
    assert text.count("lineitem.parquet") == 1 and "ReusedExchange" in text


def test_facts_are_projections_of_staging(spark):
    from landledger.operators.facts import fact_requests
    from landledger.schemas import REQUESTS
    text = plan(fact_requests(spark.createDataFrame([], REQUESTS)))
    assert "Exchange" not in text and "Join" not in text
