"""Upserts, versions, stored loads, jobs and the incremental stream."""

import datetime as dt
import decimal
import os
import re

import pytest
from pyspark.sql import functions as F

from landledger import jobs, schemas
from landledger.operators import agents as ag
from landledger.operators import clean, facts, parents
from landledger.operators import upsert as up
from landledger.plans import registry
from landledger.plans import requests as request_kpis
from landledger.sources import readers
from landledger.sources.sample import SampleTables
from landledger.streaming.incremental import apply_landed_recoveries
from landledger.warehouse import StoredWarehouse, Warehouse

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "id long, amount long, first string, seen int, part int"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_refreshes_only_listed_columns(spark):
    old = spark.createDataFrame([(1, 10, "a", 1, 1), (2, 20, "b", 1, 1)], SCHEMA)
    new = spark.createDataFrame([(2, 25, "x", 2, 9), (2, None, "y", 3, 9), (3, 30, "c", 2, 2), (None, 1, "n", 1, 1)], SCHEMA)
    merged = up.upsert(old, new, ["id"], ["amount"], ["seen"])
    # key 2: the newest batch row wins, its NULL included; other columns keep the first value
    assert rows(merged) == [(1, 10, "a", 1, 1), (2, None, "b", 1, 1), (3, 30, "c", 2, 2)]
    again = up.upsert(merged, new, ["id"], ["amount"], ["seen"])
    assert rows(again) == rows(merged)


def test_insert_absent_keeps_known_rows(spark):
    old = spark.createDataFrame([(1, 10, "a", 1, 1)], SCHEMA)
    new = spark.createDataFrame([(1, 99, "z", 2, 1), (2, 20, "b", 1, 1), (2, 21, "c", 2, 1)], SCHEMA)
    assert rows(up.insert_absent(old, up.latest_per_key(new, ["id"], ["seen"]), ["id"])) == [(1, 10, "a", 1, 1), (2, 21, "c", 2, 1)]


def test_latest_per_key_has_no_window(spark):
    df = spark.createDataFrame([(1, 10, "a", 1, 1)], SCHEMA)
    plan = up.latest_per_key(df, ["id"], ["seen"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max" in plan


def test_upsert_table_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, 10, "a", 1, 1), (2, 20, "b", 1, 2), (3, 30, "c", 1, 3)], SCHEMA)
    old.write.partitionBy("part").parquet(path)
    before = {p: sorted(os.listdir(f"{path}/part={p}")) for p in (1, 2, 3)}
    # key 2 arrives with another partition value: it stays where it first was
    batch = spark.createDataFrame([(2, 21, "x", 2, 3), (4, 40, "d", 2, 4)], SCHEMA)
    for _ in range(2):
        up.upsert_table(spark, path, batch, ["id"], ["amount"], ["seen"], "part")
        stored = spark.read.parquet(path).select("id", "amount", "first", "seen", "part")
        assert rows(stored) == [(1, 10, "a", 1, 1), (2, 21, "b", 1, 2), (3, 30, "c", 1, 3), (4, 40, "d", 2, 4)]
    assert sorted(os.listdir(f"{path}/part=1")) == before[1]


def test_full_refresh_and_empty_input(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 10, "a", 1, 1)], SCHEMA)
    assert up.refresh_if_any(df, path, "L1")
    assert not up.refresh_if_any(df.limit(0), path, "L1")
    assert rows(up.read_load(spark, path, "L1", df.schema)) == [(1, 10, "a", 1, 1)]


def test_append_batch_repeats_safely(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = lambda name, n: spark.range(n).withColumn("etl_batch_id", F.lit(name))
    for name, n in (("A", 3), ("B", 2), ("A", 3)):
        up.append_batch(batch(name, n), path)
    assert spark.read.parquet(path).count() == 5


AGENT = ("agent_id long, agent_name string, badge_number string, job_title string, zone_id long, phone string, "
         "email string, status string, hired_on date, created_on date, modified_at timestamp_ntz")


def agent(id, name, day):
    return (id, name, None, "COLLECTEUR", None, None, None, "ACTIF", None, None, dt.datetime(2024, 1, day))


def test_scd2_versions(spark):
    first = ag.first_versions(spark.createDataFrame([agent(1, "Ann", 1), agent(2, "Bob", 1)], AGENT), "2024-01-01")
    second = spark.createDataFrame([agent(1, "Anna", 5), agent(1, "Old", 2), agent(2, "Bob", 5), agent(3, "Cy", 5)], AGENT)
    merged = ag.scd2_agents(first, second, "2024-02-01")
    seen = sorted((r.agent_id, r.version, r.agent_name, r.is_current, r.valid_from.date(), r.valid_to.year)
                  for r in merged.collect())
    assert seen == [
        (1, 1, "Ann", False, dt.date(2024, 1, 1), 2024), (1, 2, "Anna", True, dt.date(2024, 2, 1), 9999),
        (2, 1, "Bob", True, dt.date(2024, 1, 1), 9999), (3, 1, "Cy", True, dt.date(2024, 2, 1), 9999)]
    ann = {r.version: r for r in merged.filter("agent_id = 1").collect()}
    assert ann[1].valid_to == ann[2].valid_from and ann[1].durable_key == ann[2].durable_key == ann[1].agent_key
    assert ann[2].agent_key != ann[1].agent_key
    assert rows(ag.scd2_agents(merged, second, "2024-03-01")) == rows(merged)


def test_hot_receivable_is_split_by_the_lookup_join(spark, tmp_path):
    """A third of all actions on one receivable: the real builder's join splits it."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    spark.range(0, 60000, 1, 8).select(
        F.col("id").alias("recovery_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("bigint").alias("receivable_id"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.RECOVERIES.fields
          if f.name not in ("recovery_id", "receivable_id", "notes", "payment")],
        F.md5(F.col("id").cast("string")).alias("notes"), F.lit(1).cast("decimal(15,2)").alias("payment"),
    ).write.parquet(str(tmp_path / "actions"))
    spark.range(5000).select(
        F.col("id").alias("receivable_id"), F.col("id").alias("receivable_fact_key"), F.col("id").alias("company_id"),
        F.lit(2).cast("decimal(15,2)").alias("amount_due"), F.lit(None).cast("date").alias("created_on"),
    ).write.parquet(str(tmp_path / "parents"))
    kept = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = facts.fact_recoveries(spark.read.parquet(str(tmp_path / "actions")),
                                       spark.read.parquet(str(tmp_path / "parents")), "B")
        assert len(joined.collect()) == 60000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_jdbc_options():
    base = dict(url="jdbc:x", user="u", password="p", driver="d")
    assert readers.jdbc_options(**base, query="SELECT 1")["query"] == "SELECT 1"
    split = readers.jdbc_options(**base, query="SELECT * FROM t", partition_column="id", lower=0, upper=9, partitions=3)
    assert split["dbtable"] == "(SELECT * FROM t) AS pushed_query" and split["numPartitions"] == "3"
    assert "query" not in split


def test_request_job_and_views(spark, tmp_path):
    t = SampleTables(spark, FOLDER)
    source = {"demandes_attribution": t.source_requests, "entreprises": t.source_companies,
              "lots": t.source_plots, "zones_industrielles": t.source_zones}
    stored = jobs.load_requests(spark, source, str(tmp_path / "wh"), "L1", "2001-12-31", buckets=4)
    assert stored.fact_requests.count() == 1500
    for build in (request_kpis.kpi_by_status, request_kpis.kpi_delay_stats, request_kpis.kpi_acceptance,
                  request_kpis.kpi_executive):
        plan = build(stored.fact_requests)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Exchange hashpartitioning\([^)]*request_id", plan)
    report = lambda name: spark.read.parquet(str(tmp_path / "wh" / "quality" / name / "load_id=L1"))
    assert report("requests_rules").agg(F.sum("violations")).first()[0] == 0
    assert {r.key: r.orphans for r in report("requests_orphans").collect()}["creation_date_key"] == 0
    assert report("requests_unreadable").first()[0] == 0 and report("requests_counts").count() == 10
    alerts = jobs.monitor(stored, str(tmp_path / "kpis"), "2001-12-31")
    assert {r.kpi for r in alerts.collect()} >= {"total_demands", "pending_demands"}
    jobs.monitor(stored, str(tmp_path / "kpis"), "2001-12-31")
    assert spark.read.parquet(str(tmp_path / "kpis")).count() == 4

    names = registry.register_views(Warehouse(spark, t, "2001-12-31", "L1"))
    assert set(names) == set(registry.VIEWS)
    top = spark.sql("SELECT statut, nombre_demandes FROM v_kpi_demandes_par_statut ORDER BY nombre_demandes DESC").collect()
    assert sum(r.nombre_demandes for r in top) == 1500
    assert spark.sql("SELECT valeur, detail FROM v_dashboard_financier_complet ORDER BY ordre").count() == 2


def test_collection_job_and_stream(spark, tmp_path):
    t = SampleTables(spark, FOLDER)
    path = str(tmp_path / "wh")
    cutoff = dt.datetime(2024, 1, 20)
    early = t.source_recoveries.filter(F.col("date_modification") < F.lit(cutoff))
    source = {"agents_collecteurs": t.source_agents, "collectes": t.source_receivables, "recouvrements": early}
    first = jobs.load_collections(spark, source, path, "B1", "2024-01-31")
    n = first["fact_receivables"].count()
    assert n == 1473 and first["fact_recoveries"].count() == early.count()
    assert first["fact_payments"].count() == n + early.count()

    second = jobs.load_collections(spark, source, path, "B2", "2024-01-31", previous="B1", overlap_days=15)
    assert second["fact_receivables"].count() == n
    assert second["dim_agent"].count() == first["dim_agent"].count()
    assert [r[0] for r in second["fact_receivables"].select("etl_batch_id").distinct().collect()] == ["B2"]
    again = second["fact_recoveries"].where("etl_batch_id = 'B2'").count()
    assert 0 < again < early.count()
    # the same source twice: as many payments as before, and no movement
    assert second["fact_payments"].count() == n + early.count()
    tags = {r.etl_batch_id: r["count"] for r in second["payment_movements"].groupBy("etl_batch_id").count().collect()}
    assert tags == {"B1_COLLECTES": n, "B1_RECOUVREMENTS": early.count()}

    requests_source = {"demandes_attribution": t.source_requests, "entreprises": t.source_companies,
                       "lots": t.source_plots, "zones_industrielles": t.source_zones}
    jobs.load_requests(spark, requests_source, path, "L2", "2001-12-31", buckets=4)
    registry.register_views(StoredWarehouse(spark, path, "L2", "B2", as_of="2024-01-31"))
    summary = spark.table("mv_kpi_collectes_summary")
    assert summary.agg(F.sum("nombre_collectes")).first()[0] == n
    assert summary.filter("agent_collecteur IS NULL OR date_collecte IS NULL").count() < summary.count()
    assert spark.table("vw_kpi_dashboard_global").first().total_transactions == n + early.count()
    stored_summary = spark.read.parquet(f"{path}/kpi_receivables_summary/load_id=B2")
    assert stored_summary.agg(F.sum("receivables")).first()[0] == n
    assert spark.table("v_kpi_taux_acceptation").first().total_demandes == 1500

    landing = str(tmp_path / "landing")
    late = t.source_recoveries.filter(F.col("date_modification") >= F.lit(cutoff))
    late.write.parquet(landing)
    for _ in range(2):   # the second run finds no new file
        query = apply_landed_recoveries(spark, landing, late.schema, f"{path}/fact_receivables",
                                        f"{path}/fact_recoveries", "recoveries", str(tmp_path / "progress"))
        query.awaitTermination(120)
        fact = spark.read.parquet(f"{path}/fact_recoveries")
        assert fact.count() == 1000 and fact.select("recovery_id").distinct().count() == 1000
        waiting = spark.read.parquet(f"{path}/waiting_actions").select("recovery_id")
        assert rows(waiting) == rows(fact.where("receivable_fact_key IS NULL").select("recovery_id"))


COLLECTION = ("id long, reference string, montant_a_recouvrer string, montant_recouvre string, statut string, "
              "date_debut string, date_fin_prevue string, cree_par long, commentaire string, updated_at timestamp_ntz")
ACTION = ("recouvrement_id long, collecte_id long, type_action string, date_action date, montant_paiement string, "
          "mode_paiement string, agent_recouvrement_id long, statut_recouvrement string, observations string, "
          "piece_justificative string, date_creation date, date_modification timestamp_ntz")
SOURCE_AGENT = ("agent_id long, nom string, prenom string, matricule string, zone_assignee_id long, telephone string, "
                "email string, statut string, date_embauche date, date_creation date, date_modification timestamp_ntz")


def test_repeated_and_older_batches(spark, tmp_path):
    """A duplicate agent, no actions at first, a bad row that is corrected, and B1 once more."""
    day = lambda d: dt.datetime(2024, 1, d)
    due = lambda id, paid, d, amount="100": (id, f"C{id}", amount, paid, "en_cours", "2023-01-01", "2023-02-01", 1, None, day(d))
    act = lambda id, receivable, d: (id, receivable, "relance", day(d).date(), "10", "virement", 1, "reussi", None, None,
                                     day(d).date(), day(d))
    who = lambda name, d: (1, name, None, None, None, None, None, "ACTIF", None, None, day(d))

    def source(agents, collections, actions):
        return {"agents_collecteurs": spark.createDataFrame(agents, SOURCE_AGENT),
                "collectes": spark.createDataFrame(collections, COLLECTION),
                "recouvrements": spark.createDataFrame(actions, ACTION)}
    b1 = source([who("Ann", 1), who("Anna", 2)], [due(1, "0", 1), due(2, "150", 1)], [])
    b2 = source([who("Older", 1)], [due(1, "40", 5), due(2, "50", 5), due(3, "0", 5)], [act(1, 1, 5), act(2, 99, 5)])
    path = str(tmp_path / "wh")
    first = jobs.load_collections(spark, b1, path, "B1", "2024-01-31", overlap_days=30)
    assert first["fact_receivables"].count() == 1 and first["fact_recoveries"].count() == 0
    assert first["quarantine"].count() == 1 and first["fact_payments"].count() == 1
    assert [(r.full_name, r.is_current) for r in first["dim_agent"].collect()] == [("Anna", True)]
    summary = spark.read.parquet(f"{path}/kpi_receivables_summary/load_id=B1").collect()
    assert [(r.receivables, r.late) for r in summary] == [(1, 1)]

    def state(result):
        return (rows(result["fact_receivables"].select("receivable_id", F.col("amount_collected").cast("int"), "etl_batch_id")),
                rows(result["fact_recoveries"].select("recovery_id", "receivable_fact_key")),
                rows(result["payment_movements"].groupBy("etl_batch_id").count()))
    second = jobs.load_collections(spark, b2, path, "B2", "2024-01-31", previous="B1", overlap_days=30)
    after = ([(1, 40, "B2"), (2, 50, "B2"), (3, 0, "B2")], [(1, 1), (2, None)],
             [("B1_COLLECTES", 1), ("B2_COLLECTES", 3), ("B2_RECOUVREMENTS", 2)])
    assert sorted(state(second)[1], key=str) == sorted(after[1], key=str)
    assert (state(second)[0], state(second)[2]) == (after[0], after[2])
    # the older row of the second batch is put in before the current version
    assert [(r.full_name, r.version, r.is_current) for r in second["dim_agent"].orderBy("valid_from").collect()] == [
        ("Older", 2, False), ("Anna", 1, True)]
    assert second["quarantine"].count() == 0

    again = jobs.load_collections(spark, b1, path, "B1", "2024-01-31")
    assert (state(again)[0], state(again)[2]) == (after[0], after[2])
    assert again["fact_recoveries"].count() == 2
    corrected = source([who("Anna", 2)], [due(1, "0", 1), due(2, "50", 1)], [])
    assert jobs.load_collections(spark, corrected, path, "B1", "2024-01-31")["quarantine"].count() == 0
    empty = source([who("Anna", 2)], [], [])
    last = jobs.load_collections(spark, empty, path, "B3", "2024-01-31", previous="B2")
    assert state(last)[0] == after[0] and last["fact_recoveries"].count() == 2


DAY = lambda d: dt.datetime(2024, 1, d)


def collection_source(spark, collections=(), actions=(), agents=((1, 1),)):
    """Receivables (id, due, paid, day modified), actions (id, receivable, paid, day)."""
    return {
        "agents_collecteurs": spark.createDataFrame(
            [(i, f"A{i}", None, None, None, None, None, "ACTIF", None, None, DAY(d)) for i, d in agents], SOURCE_AGENT),
        "collectes": spark.createDataFrame(
            [(i, f"C{i}", due, paid, "en_cours", "2023-01-01", "2023-02-01", 1, None, DAY(d))
             for i, due, paid, d in collections], COLLECTION),
        "recouvrements": spark.createDataFrame(
            [(i, of, "relance", d.date(), paid, "virement", 1, "reussi", None, None, d.date(), d)
             for i, of, paid, d in actions], ACTION)}


def test_part_payments_count_once(spark, tmp_path):
    from landledger.plans import finance

    path = str(tmp_path / "wh")
    half, full, back = ([(1, "100", paid, day), (2, "70", "0", 1)] for paid, day in
                        (("50", 1), ("100", 2), ("80", 3)))
    jobs.load_collections(spark, collection_source(spark, half), path, "B1", "2024-01-10")
    paid = lambda result: tuple(int(x) for x in finance.fin_total_payments(result["fact_payments"]).first())
    moved = lambda result: sorted((r.payment_key, r.etl_batch_id, int(r.amount_paid), int(r.amount_billed))
                                  for r in result["payment_movements"].collect())
    second = jobs.load_collections(spark, collection_source(spark, full), path, "B2", "2024-01-11", previous="B1")
    assert paid(second) == (100, 1)
    start = [("COLLECTE_1", "B1_COLLECTES", 50, 100), ("COLLECTE_2", "B1_COLLECTES", 0, 70)]
    assert moved(second) == sorted([*start, ("COLLECTE_1", "B2_COLLECTES", 50, 0)])
    third = jobs.load_collections(spark, collection_source(spark, back), path, "B3", "2024-01-12", previous="B2")
    assert paid(third) == (80, 1)
    want = sorted([*start, ("COLLECTE_1", "B2_COLLECTES", 50, 0), ("COLLECTE_1", "B3_COLLECTES", -20, 0)])
    assert moved(third) == want
    for name, rows_, previous in (("B1", half, None), ("B2", full, "B1")):
        again = jobs.load_collections(spark, collection_source(spark, rows_), path, name, "2024-01-12",
                                      previous=previous)
        assert paid(again) == (80, 1) and moved(again) == want


def test_future_and_late_actions_are_read(spark, tmp_path):
    path, due = str(tmp_path / "wh"), [(1, "100", "0", 1)]
    far = dt.datetime(2098, 12, 31)

    def load(name, day, actions, **options):
        result = jobs.load_collections(spark, collection_source(spark, due, actions), path, name, day,
                                       previous=None if name == "B1" else "B1", **options)
        return sorted(r.recovery_id for r in result["fact_recoveries"].collect())
    assert load("B1", "2024-01-10", [(1, 1, "5", DAY(5)), (2, 1, "5", far)]) == [1, 2]
    # modified on the seventh, landed after the tenth: an overlap of three days finds it
    late = [(3, 1, "5", DAY(7)), (4, 1, "5", DAY(12))]
    assert load("B2", "2024-01-20", late, overlap_days=2) == [1, 2, 4]
    assert load("B2", "2024-01-20", late, overlap_days=3) == [1, 2, 3, 4]
    # a day given by hand goes before; a load of an earlier day does not start beyond it
    assert load("B3", "2024-01-21", [(5, 1, "5", DAY(2))], since="2024-01-02") == [1, 2, 3, 4, 5]
    assert load("B4", "2024-01-15", [(6, 1, "5", DAY(14)), (7, 1, "5", DAY(13))]) == [1, 2, 3, 4, 5, 6]


def test_receivable_after_its_actions(spark, tmp_path):
    path = str(tmp_path / "wh")
    actions = [(1, 7, "30", DAY(5)), (2, 8, "30", DAY(5)), (4, 7, "60", dt.datetime(2023, 11, 5))]
    other = (9, "10", "0", 1)
    jobs.load_collections(spark, collection_source(spark, [other], actions), path, "B1", "2024-01-10")
    waiting = lambda: sorted((r.recovery_id, r.receivable_id) for r in spark.read.schema(parents.WAITING).parquet(
        f"{path}/waiting_actions").collect())
    assert waiting() == [(1, 7), (2, 8), (4, 7)]
    for _ in range(2):  # the second time nothing is left to repair
        second = jobs.load_collections(spark, collection_source(spark, [(7, "60", "0", 2), other]), path, "B2",
                                       "2024-01-11", previous="B1")
        found = {r.recovery_id: (r.receivable_fact_key, r.effectiveness and float(r.effectiveness), r.days_since_receivable)
                 for r in second["fact_recoveries"].collect()}
        assert found == {1: (7, 0.5, 369), 2: (None, None, None), 4: (7, 1.0, 308)}
        assert waiting() == [(2, 8)]
        status = {r.payment_key: r.payment_status for r in second["fact_payments"].collect()}
        assert status["RECOUVREMENT_1"] == status["RECOUVREMENT_4"] == "RECOUVRE"
        assert status["RECOUVREMENT_2"] == "IMPAYE"
    third = jobs.load_collections(spark, collection_source(spark, [(8, "60", "0", 2)]), path, "B3", "2024-01-12",
                                  previous="B2")
    assert third["fact_recoveries"].where("receivable_fact_key IS NULL").isEmpty() and waiting() == []


def test_a_load_with_broken_keys_is_refused(spark, tmp_path):
    from landledger.operators import quality

    path = str(tmp_path / "wh")
    good = jobs.load_collections(spark, collection_source(spark, [(1, "100", "50", 1)]), path, "B1", "2024-01-10")
    before = rows(good["fact_receivables"])
    bad = collection_source(spark, [(1, "100", "90", 2), (None, "5", "0", 2)])
    with pytest.raises(quality.BrokenLoad, match="receivables.receivable_id: 1"):
        jobs.load_collections(spark, bad, path, "B2", "2024-01-11", previous="B1")
    assert rows(spark.read.parquet(f"{path}/fact_receivables").select(*good["fact_receivables"].columns)) == before
    report = spark.read.parquet(f"{path}/quality/collections_source_keys/load_id=B2").collect()
    assert {r.table: r.violations for r in report} == {"agents": 0, "receivables": 1, "recoveries": 0}
    rules = spark.read.parquet(f"{path}/quality/collections_rules/load_id=B1")
    assert {r.check for r in rules.collect()} == {"unique", "not_null", "range"}
    assert rules.agg(F.sum("violations")).first()[0] == 0


def summary_rows(spark, path, facts_, day):
    """The kept summary and the one taken from the whole fact."""
    from landledger.operators import dimensions, summary
    from landledger.plans import finance
    from landledger.sources import seeds

    agents = spark.createDataFrame([("k", "x", True)], "durable_key string, full_name string, is_current boolean")
    days = dimensions.dim_date(dimensions.spine_of(facts_, "created_on"))
    members = (days, agents, seeds.receivable_types(spark), seeds.receivable_statuses(spark), day)
    state = spark.read.parquet(f"{path}/receivables_sums/sums")
    plain = lambda df: sorted([tuple(float(x) if isinstance(x, decimal.Decimal) else x for x in r)
                               for r in df.collect()], key=repr)
    return plain(summary.summary(state, *members)), plain(finance.kpi_receivables_summary(facts_, *members))


@pytest.mark.parametrize("stop", ["before", "merge", "half", "after"])
def test_summary_by_differences_survives_a_stop_anywhere(spark, tmp_path, monkeypatch, stop):
    """A batch is stopped, then repeated: each difference is applied once."""
    from landledger.operators import summary, upsert

    path = str(tmp_path / "wh")
    b1 = [(i, "100", str(10 * i), 1) for i in range(1, 9)]
    b2 = [(i, "100", str(100 if i % 2 else 10 * i), 2) for i in range(1, 7)] + [(20, "7", "0", 2)]
    jobs.load_collections(spark, collection_source(spark, b1), path, "B1", "2024-01-10")

    class Stopped(Exception):
        pass

    def stopping(*_, **__):
        raise Stopped
    place = {"before": (upsert, "upsert_table"), "merge": (summary, "keep_current"),
             "half": (summary, "_note"), "after": (jobs, "_record_payments")}[stop]
    real = getattr(*place)
    if stop == "half":  # the sums are written, the mark is not
        monkeypatch.setattr(summary, "_note", lambda s_, p_, name, *a: stopping() if name == "done" else real(
            s_, p_, name, *a))
    else:
        monkeypatch.setattr(*place, stopping)
    with pytest.raises(Stopped):
        jobs.load_collections(spark, collection_source(spark, b2), path, "B2", "2024-01-11", previous="B1")
    monkeypatch.setattr(*place, real)
    for _ in range(2 if stop == "half" else 1):
        done = jobs.load_collections(spark, collection_source(spark, b2), path, "B2", "2024-01-11", previous="B1")
    for day in ("2023-01-15", "2024-01-31"):
        kept, whole = summary_rows(spark, path, done["fact_receivables"], day)
        assert kept == whole and sum(r[4] for r in kept) == 9


def test_differences_read_only_their_months(spark, tmp_path):
    from landledger.operators import summary

    path, columns = str(tmp_path / "sums"), None
    for number, name in enumerate(("L1", "L2")):
        fact = facts.fact_receivables(clean.clean_receivables(spark.createDataFrame(
            [(i, "r", "taxe", "100", str(10 * number), "en_cours", f"2023-0{1 + i % 3}-01", "2023-04-01", None, 1, None,
              None, None, None, None, "2023-05-01 00:00:00") for i in range(9)],
            "receivable_id long, reference string, receivable_type string, amount_due string, amount_collected string, "
            "status string, created_on string, due_on string, recovered_on string, agent_id long, company_id long, "
            "plot_id long, zone_id long, request_id long, notes string, modified_at string")), "B")
        fact = jobs.with_month(fact, "created_date_key")
        place = str(tmp_path / name)
        fact.write.partitionBy(jobs.MONTH).parquet(place)
        fact = spark.read.schema(fact.schema).parquet(place)
        touched = fact.filter(F.col(jobs.MONTH) == 202302)
        if number == 0:
            summary.note_before(spark, path, name, touched.limit(0), jobs.MONTH)
            summary.keep_current(spark, path, name, fact, fact, jobs.MONTH)
            old = touched
            files = {m: sorted(os.listdir(f"{path}/sums/{jobs.MONTH}={m}")) for m in (202301, 202302, 202303)}
        else:
            summary.note_before(spark, path, name, old, jobs.MONTH)
            state = summary.keep_current(spark, path, name, fact, touched, jobs.MONTH)
            now = {m: sorted(os.listdir(f"{path}/sums/{jobs.MONTH}={m}")) for m in files}
            assert now[202302] != files[202302]
            assert (now[202301], now[202303]) == (files[202301], files[202303])
            assert {r[0]: int(r[1]) for r in state.groupBy(jobs.MONTH).agg(F.sum("amount_collected")).collect()} == {
                202301: 0, 202302: 30, 202303: 0}


def test_deleted_rows_and_emptied_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, 10, "a", 1, 1), (2, 20, "b", 1, 2), (3, 30, "c", 1, 2)], SCHEMA)
    old.write.partitionBy("part").parquet(path)
    batch = spark.createDataFrame([(3, 33, "d", 2, 2), (4, 40, "e", 2, 3)], SCHEMA)
    gone = spark.createDataFrame([(1,), (1,), (3,), (99,)], "id long")
    up.upsert_table(spark, path, batch, ["id"], ["amount"], ["seen"], "part", deleted=gone)
    left = spark.read.schema(old.schema).parquet(path)
    assert sorted((r.id, r.amount) for r in left.collect()) == [(2, 20), (3, 33), (4, 40)]
    assert sorted(n for n in os.listdir(path) if n.startswith("part=")) == ["part=2", "part=3"]
    up.upsert_table(spark, path, batch.limit(0), ["id"], ["amount"], ["seen"], "part",
                    deleted=spark.createDataFrame([(2,), (3,), (4,)], "id long"))
    assert not [n for n in os.listdir(path) if n.startswith("part=")]


def test_extract_comparison(spark):
    from landledger.operators.compare import extract_changes

    schema = "id long, a string, b string, loaded int"
    before = spark.createDataFrame([(1, "x", None, 1), (2, "x", "y", 1), (3, None, "x", 1), (4, "r", "r", 1),
                                    (4, "r", "r", 1), (5, "q", "q", 1), (5, "p", "p", 1), (None, "n", "n", 1)], schema)
    after = spark.createDataFrame([(1, None, "x", 2), (2, "x", "y", 2), (4, "r", "r", 2), (5, "p", "p", 2),
                                   (5, "q", "q", 2), (6, "", None, 2), (None, "n", "m", 2)], schema)
    found = {r.id: r.change for r in extract_changes(before, after, ["id"], ["loaded"]).collect()}
    assert found == {1: "changed", 3: "deleted", 4: "changed", 6: "inserted"}
    assert extract_changes(before, before.select("b", "id", "loaded", "a"), ["id"]).count() == 0
    assert {r.change for r in extract_changes(before.limit(0), after, ["id"]).collect()} == {"inserted"}


def test_versions_of_the_day(spark):
    late = "agent_id long, agent_name string, badge_number string, job_title string, zone_id long, phone string, " \
           "email string, status string, hired_on date, created_on date, modified_at timestamp_ntz"
    row = lambda name, d, i=1: (i, name, None, None, None, None, None, "ACTIF", None, None, DAY(d))
    first = ag.first_versions(spark.createDataFrame([row("A", 1), row("Z", 1, 2)], late), "2024-01-02")
    newest = ag.scd2_agents(first, spark.createDataFrame([row("C", 20)], late), "2024-01-21")
    batch = spark.createDataFrame([row("B", 10), row("B", 12), row("A", 1), row("C", 20), row("Early", 1)], late)
    dimension = ag.with_late_versions(newest, batch)
    found = [(r.agent_name, r.version, r.valid_from.day, r.valid_to.year, r.is_current)
             for r in dimension.where("agent_id = 1").orderBy("valid_from").collect()]
    assert found == [("A", 1, 2, 2024, False), ("B", 3, 10, 2024, False), ("C", 2, 21, 9999, True)]
    assert rows(ag.with_late_versions(dimension, batch)) == rows(dimension)
    assert dimension.select("agent_key").distinct().count() == dimension.count()
    key = first.where("agent_id = 1").first().durable_key
    days = [(key, dt.date(2024, 1, d)) for d in (1, 2, 9, 10, 20, 21, 31)] + [
        (key, dt.date(2024, 3, 5)), (key, None), ("none", dt.date(2024, 1, 5)), (None, dt.date(2024, 1, 5))]
    facts_ = spark.createDataFrame([(n, *d) for n, d in enumerate(days)], "n int, agent_key string, day date")
    named = ag.version_of_day(facts_, dimension, "agent_key", "day")
    assert [r.agent_name for r in named.orderBy("n").collect()] == [
        None, "A", "A", "B", "B", "C", "C", "C", None, None, None]
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_bucketed_fact_needs_no_exchange_for_distinct_requests(spark, tmp_path):
    from landledger.plans import requests

    fact = Warehouse(spark, SampleTables(spark, FOLDER), "2001-12-31", "L1").fact_requests
    table = up.save_bucketed(fact, "bucketed_requests", str(tmp_path / "b"), "request_id", 4)
    try:
        card = requests.request_scorecard(table)
        plan = card._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "SinglePartition" in plan
        assert card.first().requests == 1500
    finally:
        spark.sql("DROP TABLE bucketed_requests")


def test_upsert_of_empty_batch_leaves_table(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, 10, "a", 1, 1)], SCHEMA)
    old.write.partitionBy("part").parquet(path)
    before = sorted(os.listdir(f"{path}/part=1"))
    up.upsert_table(spark, path, old.limit(0), ["id"], ["amount"], ["seen"], "part")
    assert sorted(os.listdir(f"{path}/part=1")) == before


def test_shared_folder_comes_from_the_session(spark):
    from types import SimpleNamespace

    from landledger.session import scratch_path, shared_dir

    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    def unset(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default),
                               sparkContext=SimpleNamespace(master=master))
    assert os.path.isdir(shared_dir(unset("local[4]")))
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_dir(unset(master))


def test_partitions_are_written_by_one_task_each(spark, tmp_path):
    """The files of a written table do not multiply by tasks and partitions."""
    path = str(tmp_path / "t")
    files = lambda: sum(f.endswith(".parquet") for _, _, found in os.walk(path) for f in found)
    numbers = lambda amount: spark.range(0, 2400, 1, 8).select(
        "id", F.lit(amount).cast("long").alias("amount"), F.lit("a").alias("first"), F.lit(1).alias("seen"),
        (F.col("id") % 12).cast("int").alias("part"))
    for amount in (1, 2):
        up.upsert_table(spark, path, numbers(amount), ["id"], ["amount"], ["seen"], "part")
        assert files() == 12
        assert spark.read.parquet(path).agg(F.count("*"), F.sum("amount")).first() == (2400, 2400 * amount)


def test_job_reads_its_receivables_from_the_source_once(spark, tmp_path):
    path = str(tmp_path / "wh")
    source = collection_source(spark, [(1, "100", "50", 1), (1, "100", "60", 2), (2, "-5", "0", 1)])
    loaded = jobs.load_collections(spark, source, path, "B1", "2024-01-10")
    # as delivered, before any row is cleaned away; the rest of the job reads this
    kept = spark.read.parquet(f"{path}/receivables_extract/load_id=B1")
    assert sorted((r.receivable_id, r.amount_collected) for r in kept.collect()) == [(1, "50"), (1, "60"), (2, "0")]
    assert [(r.receivable_id, float(r.amount_collected)) for r in loaded["fact_receivables"].collect()] == [(1, 60.0)]


def test_differences_are_added_up_in_one_pass(spark):
    from landledger.operators import summary

    schema = ("created_month int, created_date_key int, agent_key string, type_key string, status_key string,"
              " due_on date, recovered_on date, amount_due decimal(15,2), amount_collected decimal(15,2),"
              " amount_remaining decimal(15,2), recovery_rate decimal(5,4), recovery_days int")
    day, late = dt.date(2024, 1, 5), dt.date(2024, 1, 9)

    def row(due, paid, rate, days=None, recovered=None):
        number = lambda x: None if x is None else decimal.Decimal(x)
        left = None if due is None or paid is None else number(due) - number(paid)
        return (202401, 20240101, "a", "t", None, day, recovered, number(due), number(paid), left, number(rate), days)
    same, before, after = row("10", "1", "0.1"), row("8", "2", "0.25"), row("8", "8", "1", 3, late)
    frame = lambda *found: spark.createDataFrame(list(found), schema)
    found = summary.differences(frame(same, before), frame(same, after, row(None, "4", None)), "created_month")
    assert sorted([tuple(None if x is None else float(x) for x in r) for r in found.select(
        F.col("open_due_on").isNull().cast("int"), *summary.SUMS).collect()]) == [
        # of the open ones one is gone and one without an amount due has come; one is settled late
        (0, 0, -8, 2, -6, -0.25, -1, 0, 0, 0), (1, 1, 8, 8, 0, 1, 1, 3, 1, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_large_tables_are_rewritten_in_portions(spark, tmp_path, monkeypatch):
    """One partition with much of the table, keys stored under another partition than
    the batch names, new and deleted ones."""
    path, written, real = str(tmp_path / "t"), [], up.by_partition
    number = lambda value, kind: F.lit(value).cast(kind)
    home = F.when(F.col("id") < 40, 0).otherwise(F.col("id") % 4 + 1).cast("int")
    old = spark.range(60).select("id", number(1, "long").alias("amount"), F.lit("a").alias("first"),
                                 number(1, "int").alias("seen"), home.alias("part"))
    batch = spark.range(30, 70).select("id", number(2, "long").alias("amount"), F.lit("b").alias("first"),
                                       number(2, "int").alias("seen"), (F.col("id") % 5).cast("int").alias("part"))
    old.write.partitionBy("part").parquet(path)
    monkeypatch.setattr(up, "PORTION_ROWS", 10, raising=False)
    monkeypatch.setattr(up, "by_partition", lambda df, *p: written.append(df.count()) or real(df, *p))
    up.upsert_table(spark, path, batch, ["id"], ["amount", "seen"], ["seen"], "part",
                    deleted=spark.range(0, 35, 5))
    left = spark.read.schema(old.schema).parquet(path)
    assert rows(left.select("id", "amount", "first", "part")) == [
        (i, 2 if i >= 30 else 1, "a" if i < 60 else "b", i % 5 if i >= 60 else 0 if i < 40 else i % 4 + 1)
        for i in range(70) if i >= 30 or i % 5]
    assert sum(written) == 64 and max(written) < 20 and "_staged" not in os.listdir(path)


def test_a_load_frees_what_only_it_reads(spark, tmp_path, monkeypatch):
    path, key = str(tmp_path / "wh"), "spark.sql.parquet.compression.codec"
    monkeypatch.setattr(up, "PORTION_ROWS", 2, raising=False)
    month = F.concat(F.lit("2023-0"), (F.col("id") % 3 + 1).cast("string"), F.lit("-01"))
    before = spark.conf.get(key)
    for name, paid, previous in (("B1", 5, None), ("B2", 10, "B1")):
        source = collection_source(spark, [(i, "100", str(paid * i), paid) for i in range(1, 9)],
                                   [(i, i + 4, "5", DAY(9)) for i in range(1, 9)])
        loaded = jobs.load_collections(spark, source | {"collectes": source["collectes"].withColumn(
            "date_debut", month)}, path, name, "2024-01-10", previous=previous)
    assert spark.conf.get(key) == before
    found = [os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names
             if f.endswith(".parquet")]
    working = ("receivables_sums/before", "receivables_sums/differences", "movements_batch", "repaired_batch", "held_")
    assert not [f for f in found if f.startswith(working)]
    assert {f.split("/")[1] for f in found if f.split("/")[0] in ("receivables_extract", "receivables", "recoveries")
            } == {"load_id=B2"}
    assert all(f.endswith(".zstd.parquet") for f in found)
    # what stays is whole
    assert spark.read.parquet(f"{path}/fact_receivables_batch/load_id=B2").count() == 0
    assert rows(loaded["fact_receivables"].selectExpr("receivable_id", "int(amount_collected)")) == [
        (i, 10 * i) for i in range(1, 9)]
    kept, whole = summary_rows(spark, path, loaded["fact_receivables"], "2024-01-10")
    assert kept == whole and len(spark.read.parquet(f"{path}/kpi_receivables_summary/load_id=B2").collect()) == len(kept)
    total = lambda df: df.agg(F.sum("amount_paid"), F.sum("amount_net"), F.countDistinct("payment_key")).first()
    assert total(loaded["payment_movements"]) == total(loaded["fact_payments"])
