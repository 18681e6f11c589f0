"""Request star on hand-made rows: missing members, repeats, open outcomes."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from landledger import schemas
from landledger.operators import dimensions, facts
from landledger.plans import analysis, dashboards, monitoring, requests
from landledger.sources import extract

RAW = ("id long, reference string, statut string, etape_courante int, type_demande string, operateur_id long, "
       "entreprise_id long, lot_id long, zone_id long, priorite string, financement string, emplois string, "
       "created_at timestamp_ntz, updated_at timestamp_ntz")


def ts(text):
    return dt.datetime.fromisoformat(text)


def raw(id, statut="EN_COURS", zone=1, plot=1, company=1, step=1, kind="ZONE_INDUSTRIELLE", priority=None,
        money='{"montantTotal": "100.00"}', jobs='{"total": 5}', created="2024-01-01 00:00:00",
        updated="2024-01-11 00:00:00"):
    return (id, f"R{id}", statut, step, kind, None, company, plot, zone, priority, money, jobs,
            ts(created), ts(updated))


def staged(spark, *rows):
    return extract.extract_requests(spark.createDataFrame(list(rows), RAW), "2024-02-01")


def fact(spark, *rows):
    return facts.fact_requests(staged(spark, *rows))


def test_extract_reads_json_and_flags(spark):
    rows = staged(
        spark,
        raw(1, "VALIDEE", priority="URGENTE"),
        raw(2, "EN_COURS", money="{}", jobs="{}"),
        raw(3, "DOCUMENTS_REJETES", priority="normale"),
        raw(4, "REJETE"),
    ).orderBy("request_id").collect()
    assert [r.status for r in rows] == ["ACCEPTEE", "EN_COURS", "DOCUMENTS_REJETES", "REJETEE"]
    assert [r.is_priority for r in rows] == [True, False, False, False]
    assert [r.is_finalised for r in rows] == [True, False, False, True]
    assert [r.processing_days for r in rows] == [10, 31, None, 10]
    assert rows[0].financing_amount == Decimal("100.00") and rows[1].financing_amount is None


def test_contract_rejects_missing_column(spark):
    with pytest.raises(Exception, match="region"):
        schemas.conform(spark.createDataFrame([(1,)], "zone_id long"), schemas.ZONES)


def test_missing_members(spark):
    f = fact(spark, raw(1), raw(2, zone=None, plot=None, company=None))
    keys = {r.request_id: (r.zone_key, r.plot_key, r.company_key) for r in f.collect()}
    assert keys == {1: ("zone_1", "lot_1", "entreprise_1"), 2: (None, None, None)}
    zones = spark.createDataFrame([(1, "Z", "Z1", "R", "Active")], "zone_id long, zone_name string, zone_code string, region string, status_label string")
    plots = spark.createDataFrame([(1, "L")], "plot_id long, plot_number string")
    companies = spark.createDataFrame([(1, "C")], "company_id long, company_name string")
    inner = requests.kpi_by_entity(f, zones, plots, companies).collect()
    left = analysis.an_by_entity_left(f, zones, plots, companies).collect()
    assert [r.requests for r in inner] == [1]
    assert sorted((r.zone_name is None, r.requests) for r in left) == [(False, 1), (True, 1)]


def test_status_dimension_merges_missing_step_and_step_zero(spark):
    s = staged(spark, raw(1, step=None), raw(2, step=0), raw(3, kind=None))
    dim = dimensions.dim_request_status(s).collect()
    assert [r.status_key for r in dim] == ["EN_COURS_ZONE_INDUSTRIELLE_0"]
    assert facts.fact_requests(s).filter(F.col("status_key") == "EN_COURS_UNKNOWN_1").count() == 1


def test_repeated_ids_count_once(spark):
    f = fact(spark, raw(1, "ACCEPTEE"), raw(1, "ACCEPTEE"), raw(2, "REJETEE"), raw(3))
    by_status = {r.status: (r.requests, r.share_pct, r.financing) for r in requests.kpi_by_status(f).collect()}
    assert by_status == {"VALIDÉE": (1, 33.33, Decimal(200)), "REJETÉE": (1, 33.33, Decimal(100)),
                         "EN_COURS": (1, 33.33, Decimal(100))}
    volume = requests.kpi_volume(f).first()
    assert (volume.requests, volume.accepted, volume.finalised) == (3, 2, 3)
    assert requests.kpi_delay_finalised(f).first().finalised_requests == 2


def test_nothing_finalised(spark):
    f = fact(spark, raw(1), raw(2))
    assert requests.kpi_acceptance(f).first().acceptance_pct is None
    row = requests.kpi_acceptance_finalised(f).first()
    assert (row.acceptance_pct, row.finalised, row.requests) == (None, None, 0)
    assert requests.kpi_executive(f).first().alert_status == "NORMAL"
    dim = dimensions.dim_request_status(staged(spark, raw(1), raw(2)))
    assert analysis.an_acceptance_by_type(f, dim).first().acceptance_pct == 0.0
    assert requests.kpi_financial_performance(f).first().asDict() == {
        "requests": 0, "financing": None, "avg_financing": None, "jobs": None, "avg_jobs": None,
        "cost_per_job": None, "requests_with_financing": None, "requests_with_jobs": None,
        "with_financing_pct": None}


def test_empty_fact_still_gives_one_row(spark):
    f = fact(spark, raw(1)).limit(0)
    assert requests.kpi_volume(f).first().requests == 0
    assert {r.kpi: r.alert_type for r in monitoring.kpi_alerts(f).collect()} == {
        "acceptance_rate": "NULL", "average_processing_days": "NULL", "total_demands": "LOW",
        "pending_demands": "NULL"}


def test_duration_classes(spark):
    day = lambda id, n: raw(id, "ACCEPTEE", updated=f"2024-01-{1 + n:02d} 00:00:00")
    f = fact(spark, day(1, 0), day(2, 7), day(3, 8), day(4, 15), day(5, 16), raw(6, "DOCUMENTS_REJETES"))
    row = requests.kpi_delay_stats(f).first()
    assert (row.up_to_7_days, row.from_8_to_15_days, row.over_15_days) == (1, 2, 1)
    assert (row.min_days, row.max_days, row.median_days, row.avg_days) == (7, 16, 11.5, 11.5)


def test_shares_sum_to_hundred_and_groups_to_total(spark):
    f = fact(spark, *[raw(i, ("ACCEPTEE", "REJETEE", "EN_COURS")[i % 3], zone=i % 2, created=f"2024-0{1 + i % 5}-01 00:00:00")
                      for i in range(30)])
    assert abs(sum(r.share_pct for r in requests.kpi_by_status(f).collect()) - 100) < 0.05
    total = requests.business_totals(f).first().financing
    for grouped in (requests.kpi_by_status(f), requests.kpi_by_zone_type(f), requests.kpi_monthly(f)):
        assert grouped.agg(F.sum("financing")).first()[0] == total


def test_percent_rounds_ties_half_up(spark, one):
    from landledger.functions.measures import percent
    assert one(percent(F.lit(201), F.lit(20000), 2), percent(F.lit(1), F.lit(0), 2)) == (1.01, None)


def test_alert_order_acceptance_first(spark):
    f = fact(spark, raw(1, "REJETEE", updated="2024-03-01 00:00:00"))
    assert requests.kpi_executive(f).first().alert_status == "ALERTE: Taux acceptation faible"
    f = fact(spark, raw(1, "ACCEPTEE", updated="2024-03-01 00:00:00"))
    assert requests.kpi_executive(f).first().alert_status == "ALERTE: Délai traitement élevé"


def test_cross_report(spark):
    f = fact(spark, raw(1), raw(2, "ACCEPTEE", kind="HORS_ZONE_INDUSTRIELLE", zone=None))
    assert dashboards.kpi_cross(f).count() == 4


def test_default_calendar(spark):
    dates = dimensions.dim_date(dimensions.date_spine(spark))
    row = dates.agg(F.count("*"), F.count_distinct("date_key"), F.min("date"), F.max("date")).first()
    assert tuple(row) == (4018, 4018, dt.date(2020, 1, 1), dt.date(2030, 12, 31))
    feb = dates.filter("date_key = 20240229").first()
    assert (feb.month_name_fr, feb.weekday_name_fr, feb.is_workday, feb.next_date) == (
        "Février", "Jeudi", True, dt.date(2024, 3, 1))
