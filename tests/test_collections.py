"""Cleaning, receivable and recovery facts, payments on hand-made rows."""

import datetime as dt
from decimal import Decimal

from landledger.operators import clean, facts, payments, quality
from landledger.sources import seeds

RECEIVABLE = ("receivable_id long, reference string, receivable_type string, amount_due string, "
              "amount_collected string, status string, created_on string, due_on string, recovered_on string, "
              "agent_id long, company_id long, plot_id long, zone_id long, request_id long, notes string, "
              "modified_at string")


def receivable(id, due, paid, status="en_cours", recovered=None, created="2024-01-01", due_on="2024-01-31", agent=0):
    return (id, f"C{id}", "taxe", due, paid, status, created, due_on, recovered, agent, 1, None, None, None, None,
            "2024-02-01 10:00:00")


def cleaned(spark, *rows):
    return clean.clean_receivables(spark.createDataFrame(list(rows), RECEIVABLE))


def test_clean_receivables(spark):
    rows = cleaned(
        spark, receivable(1, "abc", "", "Totalement_Collecte"), receivable(2, "-5", "0"), receivable(None, "5", "0"),
        receivable(3, "10.00", None, "inconnu", created="zzz"),
    ).orderBy("receivable_id").collect()
    assert [(r.receivable_id, r.amount_due, r.amount_collected, r.status, r.created_on) for r in rows] == [
        (1, Decimal("0.00"), Decimal("0.00"), "TOTALEMENT_COLLECTE", dt.date(2024, 1, 1)),
        (3, Decimal("10.00"), Decimal("0.00"), "INCONNU", None)]


def test_clean_agents(spark):
    schema = ("agent_id long, agent_name string, badge_number string, job_title string, zone_id long, phone string, "
              "email string, status string, hired_on string, created_on string, modified_at string")
    rows = clean.clean_agents(spark.createDataFrame([
        (1, " jean-pierre o'neil ", None, " collecteur ", None, None, "nobody", "actif", "bad", None, None),
        (2, None, None, None, None, None, "a@b", None, None, None, None),
        (None, "x", None, None, None, None, None, None, None, None, None)], schema)).collect()
    assert [(r.agent_id, r.agent_name, r.job_title, r.email, r.status, r.hired_on) for r in rows] == [
        (1, "Jean-Pierre O'Neil", "COLLECTEUR", None, "ACTIF", None)]


def test_receivable_measures_and_quarantine(spark):
    rows = cleaned(
        spark,
        receivable(1, "0", "0"),
        receivable(2, "100", "50", "PARTIELLEMENT_RECOUVREE", recovered="2024-03-01"),
        receivable(3, "100", "100", "recouvree", recovered="2024-01-10"),
        receivable(4, "100", "150", recovered="2024-01-10"),
        receivable(5, "100", "0", "echec"))
    good = {r.receivable_id: r for r in facts.with_lateness(
        facts.fact_receivables(rows, "B"), "2024-02-15").collect()}
    bad = facts.quarantined_receivables(rows, "B").collect()
    assert [(r.receivable_id, r.recovery_rate) for r in bad] == [(4, Decimal("1.5000"))]
    assert sorted(good) == [1, 2, 3, 5]
    assert good[1].recovery_rate == 0 and good[2].recovery_rate == Decimal("0.5000")
    assert [(good[i].is_late, good[i].days_late) for i in (2, 3, 5)] == [(True, 15), (False, 0), (True, 15)]
    assert (good[2].recovery_days, good[5].recovery_days) == (60, None)
    assert [good[i].status_key for i in (2, 3, 5)] == ["STAT_PART_RECOUVREE", "STAT_RECOUVREE", "STAT_ECHEC"]
    assert good[1].agent_key is not None   # id 0 is a valid agent


def test_lateness(spark):
    rows = cleaned(
        spark,
        receivable(1, "100", "100"), receivable(2, "100", "100", recovered="2024-02-05"),
        receivable(3, "100", "50", recovered="2024-01-10"), receivable(4, "100", "50", due_on="2024-06-30"),
        receivable(5, "0", "0"), receivable(6, "100", "0", due_on=None))
    fact = facts.fact_receivables(rows, "B")
    assert not {"is_late", "days_late"} & set(fact.columns)
    early, later = ({r.receivable_id: (r.is_late, r.days_late)
                     for r in facts.with_lateness(fact, day).collect()} for day in ("2024-01-15", "2024-02-15"))
    assert early == {1: (False, 0), 2: (True, 5), 3: (False, 0), 4: (False, 0), 5: (False, 0), 6: (False, 0)}
    assert later == early | {3: (True, 15)}


def recoveries(spark, *rows):
    schema = ("recovery_id long, receivable_id long, action_type string, action_on string, payment string, "
              "payment_mode string, agent_id long, status string, notes string, document string, "
              "created_on string, modified_at string")
    return clean.clean_recoveries(spark.createDataFrame(list(rows), schema))


def action(id, receivable_id, payment="40"):
    return (id, receivable_id, "relance_amiable", "2024-02-10", payment, "Virement", 9, "reussi", None, None,
            "2024-02-10", "2024-02-10 08:00:00")


def test_recovery_lookup_and_payments(spark):
    parents = facts.fact_receivables(cleaned(spark, receivable(2, "100", "50"), receivable(6, "0", "0")), "B")
    fact = facts.fact_recoveries(
        recoveries(spark, action(1, 2), action(2, 77), action(3, 6), action(4, None), action(5, 2, "2000")), parents, "B")
    rows = {r.recovery_id: r for r in fact.collect()}
    assert sorted(rows) == [1, 2, 3, 5]
    assert [(rows[i].receivable_fact_key, rows[i].effectiveness, rows[i].days_since_receivable) for i in (1, 2, 3)] == [
        (2, Decimal("0.4000"), 40), (None, None, None), (6, None, 40)]
    paid = {r.source_id: r for r in payments.payments_from_recoveries(fact, "B").collect()}
    assert [(paid[i].payment_status, paid[i].is_complete, paid[i].is_late, paid[i].payment_rate) for i in (1, 2, 5)] == [
        ("RECOUVRE", False, True, Decimal("0.4000")), ("IMPAYE", False, True, Decimal("0.0000")),
        ("RECOUVRE", True, True, Decimal("20.0000"))]
    assert (paid[1].amount_billed, paid[1].fee, paid[1].amount_net) == (Decimal("48.00"), Decimal("1.20"), Decimal("38.80"))
    assert paid[1].payment_key == "RECOUVREMENT_1" and 45 <= paid[1].payment_days <= 90


def test_collection_payment_classes(spark):
    f = facts.fact_receivables(
        cleaned(spark, receivable(1, "100", "95"), receivable(2, "100", "50"), receivable(3, "100", "49.99")),
        "B")
    paid = {r.source_id: r for r in payments.payments_from_receivables(f, "B").collect()}
    assert [paid[i].payment_status for i in (1, 2, 3)] == ["PAYE_COMPLET", "PAYE_PARTIEL", "IMPAYE"]
    assert (paid[1].fee, paid[1].amount_net) == (Decimal("2.00"), Decimal("93.00"))
    assert all(15 <= p.payment_days <= 45 and p.is_late == (p.payment_days > 30) for p in paid.values())


def test_quality_rules_find_violations(spark):
    table = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "b")], "id long, label string")
    rules = (quality.Rule("t", "id", True, True), quality.Rule("t", "label", True, True))
    found = {(r.check, r.column): r.violations for r in quality.dq_rules(spark, {"t": table}, rules).collect()}
    assert found == {("unique", "id"): 1, ("not_null", "id"): 1, ("unique", "label"): 1, ("not_null", "label"): 1}
    empty = {(r.check, r.column): r.violations for r in quality.dq_rules(spark, {"t": table.limit(0)}, rules).collect()}
    assert set(empty.values()) == {0}


def test_range_checks_and_orphans(spark):
    measured = facts.receivable_measures(cleaned(spark, receivable(1, "100", "150"), receivable(2, "1", "-1")), "B")
    fees = spark.createDataFrame([(1.0, None)], "payment double, fee double")
    found = {(r.table, r.column): r.violations
             for r in quality.dq_checks({"fact_receivables": measured, "fact_recoveries": fees}).collect()}
    assert found == {("fact_receivables", "amount_due"): 0, ("fact_receivables", "amount_collected"): 1,
                     ("fact_receivables", "recovery_rate"): 2, ("fact_recoveries", "payment"): 0,
                     ("fact_recoveries", "fee"): 0}
    fact = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "k string")
    dim = spark.createDataFrame([("y",)], "k string")
    assert quality.orphan_rows(fact, "k", dim, "k").first().orphans == 2
    assert quality.orphan_rows(fact, "k", dim, "k", count_missing=True).first().orphans == 3


def test_seeds(spark):
    assert (seeds.receivable_types(spark).count(), seeds.receivable_statuses(spark).count(),
            seeds.payment_modes(spark).count()) == (5, 6, 5)
