"""Every operator as a query over the sample tables.

Each entry reads whole tables.  Money and rates leave here as doubles, because
the engines compared against each other carry different decimal widths.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landledger import jobs, schemas
from landledger.functions import scalars as s
from landledger.functions.measures import count_rows, percent
from landledger.operators import agents as ag
from landledger.operators import (clean, compare, dimensions, facts, parents, payments, progress,
                                  quality, upsert)
from landledger.plans import analysis, dashboards, finance, monitoring, registry, requests, rollups
from landledger.session import scratch_path
from landledger.sources import extract
from landledger.sources import sample as sm
from landledger.warehouse import StoredWarehouse, Warehouse

Query = Callable[[SparkSession, str], DataFrame]

EARLIER = "1999-12-31"            # state of the receivable fact before the upsert
RECOVERY_CUTOFF = "2024-01-24"    # end of the recovery actions loaded first
AGENT_LOADS = ("2024-01-01", "2024-02-01")


def comparable(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = build(spark, folder)
        return df.select(*[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ])
    return run


def _tables(build: Callable[[sm.SampleTables], DataFrame]) -> Query:
    """A query over the raw or staged sample frames."""
    return lambda spark, folder: build(sm.sample_warehouse(spark, folder).staging)


def _star(build: Callable[[Warehouse], DataFrame]) -> Query:
    """A query over the dimensions and facts."""
    return lambda spark, folder: build(sm.sample_warehouse(spark, folder))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    For tables that one query reads several times, as a warehouse table would be.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _end_as_text(versions: DataFrame) -> DataFrame:
    """The open end lies beyond what nanosecond timestamps of a client can hold."""
    return versions.withColumn("valid_to", F.date_format("valid_to", "yyyy-MM-dd HH:mm:ss"))


# --- sources and loads ---------------------------------------------------------------

def load_full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Write the companies as a full load and read that load back."""
    path = scratch_path(spark, "companies")
    upsert.refresh_if_any(sm.sample_warehouse(spark, folder).staging.companies, path, sm.BATCH)
    return upsert.read_load(spark, path, sm.BATCH, schemas.COMPANIES)


def _receivable_fact(staged: DataFrame, batch: str) -> DataFrame:
    return facts.fact_receivables(clean.clean_receivables(staged), batch)


def late_receivables(spark: SparkSession, folder: str) -> DataFrame:
    """Lateness behind the extract, which delivers no recovery date: paid in full,
    paid in part and unpaid receivables per class."""
    source = sm.sample_warehouse(spark, folder).staging.source_receivables
    fact = _receivable_fact(extract.extract_receivables(source), sm.BATCH)
    paid = (F.when(F.col("amount_remaining") <= 0, "full").when(F.col("amount_collected") > 0, "part")
             .otherwise("none"))
    return facts.with_lateness(fact, sm.REQUESTS_AS_OF).groupBy(paid.alias("paid"), "is_late").agg(
        count_rows().alias("receivables"), F.sum("days_late").alias("days_late"))


def upsert_receivable_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The fact as of an earlier day, merged with the state of today."""
    t = sm.sample_warehouse(spark, folder).staging
    target = _stored(_receivable_fact(t.receivables_known_on(EARLIER), "LOAD_0"), "target")
    batch = _stored(_receivable_fact(t.receivables, "LOAD_1"), "batch")
    merged = upsert.upsert(target, batch, ["receivable_id"], upsert.RECEIVABLE_REFRESH, ["modified_at"])
    return facts.with_lateness(merged, sm.REQUESTS_AS_OF)


def upsert_recovery_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Actions up to a cutoff, merged with a later window that overlaps it.

    The later window carries the payment net of the recovery fee, so refreshed
    and kept columns can be told apart.
    """
    w = sm.sample_warehouse(spark, folder)
    recoveries = _stored(w.fact_recoveries, "recoveries")
    action_day = F.col("action_on")
    target = recoveries.filter(action_day < s.as_date(RECOVERY_CUTOFF))
    window = recoveries.filter(action_day >= F.date_sub(s.as_date(RECOVERY_CUTOFF), 7))
    revised = window.withColumns({
        "payment": (F.col("payment") * F.lit("0.97").cast("decimal(3,2)")).cast(s.MONEY),
        "status": F.lit("REUSSI"),
        "action_type": F.lit("REVISED"),
        "etl_batch_id": F.lit("LOAD_2"),
    }).withColumn("amount_net", F.col("payment"))
    return upsert.upsert(target, revised, ["recovery_id"], upsert.RECOVERY_REFRESH, ["modified_at"])


def collections_two_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The collection job: a first batch, a second one, and the first once more.

    The first holds every other receivable, nothing collected yet and a day older,
    one in five hundred with twice the amount due collected (corrected when the batch
    comes again), every agent twice and no recovery action; the second holds
    everything.  Per table and batch tag: rows and collected or paid amounts.
    """
    t = sm.sample_warehouse(spark, folder).staging
    path = scratch_path(spark, "collections")
    half = t.source_receivables.where("id % 2 = 0").withColumn(
        "updated_at", F.col("updated_at") - F.expr("INTERVAL 1 DAY"))
    corrected = half.withColumn("montant_recouvre", F.lit(0).cast(half.schema["montant_recouvre"].dataType))
    faulty = corrected.withColumn("montant_recouvre", F.when(
        F.col("id") % 500 == 4, F.col("montant_a_recouvrer").cast("double") * 2).otherwise(0.0)
        .cast(half.schema["montant_recouvre"].dataType))
    older = t.source_agents.withColumn("nom", F.lit("Older")).withColumn(
        "date_modification", F.col("date_modification") - F.expr("INTERVAL 1 DAY"))

    def batch(receivables, actions, agents):
        return {"agents_collecteurs": agents, "collectes": receivables, "recouvrements": actions}
    nothing = t.source_recoveries.limit(0)
    twice = t.source_agents.unionByName(older)
    day, month = sm.COLLECTIONS_AS_OF, 31  # the actions land up to a month late
    jobs.load_collections(spark, batch(faulty, nothing, twice), path, "B1", day)
    second = jobs.load_collections(spark, batch(t.source_receivables, t.source_recoveries, twice), path, "B2", day,
                                   previous="B1", overlap_days=month)
    last = jobs.load_collections(spark, batch(corrected, nothing, twice), path, "B1", day)

    def summed(df, name, tag, amount):
        return df.groupBy(F.lit(name).alias("table"), F.col(tag).alias("tag") if tag in df.columns
                          else F.lit(tag).alias("tag")).agg(
            count_rows().alias("rows"), F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(30,2)").alias("amount"))
    return functools.reduce(DataFrame.unionByName, (
        summed(last["fact_receivables"], "fact_receivables", "etl_batch_id", "amount_collected"),
        summed(last["fact_recoveries"], "fact_recoveries", "etl_batch_id", "payment"),
        summed(last["fact_payments"], "fact_payments", "etl_batch_id", "amount_paid"),
        summed(last["payment_movements"], "payment_movements", "etl_batch_id", "amount_paid"),
        summed(last["quarantine"], "quarantine", "etl_batch_id", "amount_collected"),
        summed(second["dim_agent"].where("is_current"), "dim_agent", "full_name", F.lit(0)).groupBy("table").agg(
            F.lit("current").alias("tag"), F.sum("rows").alias("rows"), F.sum("amount").alias("amount")),
    ))


@functools.lru_cache(maxsize=4)
def _three_loads(spark: SparkSession, folder: str) -> str:
    """The collection job over three days; the folder with its tables.

    The first two loads deliver a third of the receivables late (ids 0 modulo 3 come
    with the second) and half of what is collected in the end; the last one everything.
    Actions arrive by their day, some of the first days three days late; one in a
    thousand is dated far ahead.  Agents change their name from load to load, and
    some changes of the second arrive with the third.
    """
    t = sm.sample_warehouse(spark, folder).staging
    path = scratch_path(spark, "three_loads")
    amount = t.source_receivables.schema["montant_recouvre"].dataType
    half = F.floor(F.col("montant_recouvre").cast("decimal(15,2)") / 2).cast("decimal(15,2)").cast(amount)
    earlier = lambda days: F.col("updated_at") - F.expr(f"INTERVAL {days} DAYS")
    part = t.source_receivables.withColumn("montant_recouvre", half)
    moment, id_ = F.col("date_modification"), F.col("recouvrement_id")
    late = moment.between("2024-01-08", "2024-01-09") & (id_ % 5 == 0)
    before = lambda day: t.source_recoveries.filter(moment < F.lit(day).cast("timestamp_ntz"))
    ahead = lambda df: df.withColumn("date_modification", F.when(
        id_ % 1000 == 1, F.lit("2098-12-31").cast("timestamp_ntz")).otherwise(moment))
    on = lambda day: F.lit(day).cast("timestamp_ntz")

    def agents(name: str, day: str) -> DataFrame:
        return t.source_agents.withColumns({"nom": F.concat("nom", F.lit(name)), "statut": F.lit("ACTIF"),
                                            "date_modification": on(day)})
    # every third agent's second name comes with the third load, after the third name
    second_names = agents(" B", "2024-01-15")
    delayed = F.col("agent_id") % 3 == 0
    loads = (
        ("B1", LOAD_DAYS[0], part.filter("id % 3 <> 0").withColumn("updated_at", earlier(2)),
         ahead(before(LOAD_DAYS[0]).filter(~late)), agents(" A", "2024-01-01")),
        ("B2", LOAD_DAYS[1], part.withColumn("updated_at", earlier(1)), ahead(before(LOAD_DAYS[1])),
         second_names.filter(~delayed)),
        ("B3", LOAD_DAYS[2], t.source_receivables, ahead(before(LOAD_DAYS[2])),
         agents(" C", "2024-01-25").unionByName(second_names.filter(delayed))),
    )
    previous = None
    for name, day, receivables, actions, people in loads:
        jobs.load_collections(
            spark, {"agents_collecteurs": people, "collectes": receivables, "recouvrements": actions},
            path, name, day, previous=previous, overlap_days=3)
        previous = name
    return path


LOAD_DAYS = ("2024-01-10", "2024-01-20", "2024-01-31")


def _three_stored(spark: SparkSession, folder: str) -> StoredWarehouse:
    return StoredWarehouse(spark, _three_loads(spark, folder), "B3", as_of=LOAD_DAYS[2])


def payments_over_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Payment KPIs after three loads, the first two with part payments, and the sums
    of the movements that the loads recorded."""
    w = _three_stored(spark, folder)
    movements = spark.read.parquet(f"{w.path}/payment_movements")
    number, money = (lambda c: F.col(c).cast("bigint")), (lambda c: F.col(c).cast("decimal(30,2)"))

    def line(df: DataFrame, kpi: str, count: str, amount: str, label=F.lit(None).cast("string")) -> DataFrame:
        return df.select(F.lit(kpi).alias("kpi"), label.alias("label"), number(count).alias("payments"),
                         money(amount).alias("amount"))
    pay = w.fact_payments
    return functools.reduce(DataFrame.unionByName, (
        line(finance.fin_total_payments(pay), "total", "payments", "amount"),
        line(finance.fin_net_revenue(pay), "net", "payments", "net_amount"),
        line(finance.fin_collections_monthly(pay), "monthly", "payments", "amount",
             F.date_format("period", "yyyy-MM-dd")),
        line(finance.fin_by_method(pay), "method", "payments", "amount", F.col("payment_method")),
        line(finance.fin_global_dashboard(pay), "complete", "complete", "amount"),
        line(finance.fin_recovery_by_zone(pay), "zone", "late", "amount", F.col("zone_key")),
        line(movements.groupBy("transaction_type").agg(F.countDistinct("payment_key").alias("n"),
                                                       F.sum("amount_paid").alias("amount")),
             "moved", "n", "amount", F.col("transaction_type")),
        line(movements.agg(F.countDistinct("payment_key").alias("n"), F.sum("amount_net").alias("amount")),
             "moved_net", "n", "amount"),
    ))


def late_parents(spark: SparkSession, folder: str) -> DataFrame:
    """Actions with and without their receivable after three loads, a third of the
    receivables with a later load than their actions; and what still waits."""
    w = _three_stored(spark, folder)
    waiting = spark.read.schema(parents.WAITING).parquet(f"{w.path}/waiting_actions")
    has = F.when(F.col("receivable_fact_key").isNull(), "without").otherwise("with")
    stored = w.fact_recoveries.groupBy(has.alias("parent")).agg(
        count_rows().alias("actions"), F.sum("effectiveness").cast("decimal(30,4)").alias("effectiveness"),
        F.sum("days_since_receivable").alias("days"), F.sum("receivable_fact_key").alias("ids"))
    return stored.unionByName(waiting.select(
        F.lit("waiting").alias("parent"), F.lit(None).cast("decimal(30,4)").alias("effectiveness"),
        F.lit(None).cast("bigint").alias("days"), "receivable_id").groupBy("parent").agg(
        count_rows().alias("actions"), F.max("effectiveness").alias("effectiveness"),
        F.max("days").alias("days"), F.sum("receivable_id").alias("ids")))


def recoveries_late_and_future(spark: SparkSession, folder: str) -> DataFrame:
    """What every load read, and the actions that it was the last to read."""
    path = _three_loads(spark, folder)
    read = progress.reads(spark, f"{path}/recovery_reads").select(
        F.col("load_id").alias("batch"), F.date_format("read_from", "yyyy-MM-dd").alias("read_from"),
        F.date_format("read_until", "yyyy-MM-dd").alias("read_until"))
    stored = spark.read.parquet(f"{path}/fact_recoveries").groupBy(F.col("etl_batch_id").alias("batch")).agg(
        count_rows().alias("actions"), F.sum("recovery_id").alias("ids"))
    return read.join(stored, "batch", "full_outer")


def summary_by_deltas(spark: SparkSession, folder: str) -> DataFrame:
    """The receivables summary that three loads have kept current by differences."""
    path = _three_loads(spark, folder)
    return spark.read.parquet(f"{path}/kpi_receivables_summary/load_id=B3")


def facts_by_agent_version(spark: SparkSession, folder: str) -> DataFrame:
    """Recovery actions per agent name that was valid on the action's day, among them
    names that arrived after a later one."""
    w = _three_stored(spark, folder)
    named = ag.version_of_day(w.fact_recoveries.select("agent_key", "agent_id", "action_on", "payment"),
                              w.dim_agent, "agent_key", "action_on")
    return named.groupBy(F.substring("agent_name", -1, 1).alias("name"), "version",
                         (F.col("agent_id") % 3).alias("kind")).agg(
        count_rows().alias("actions"), F.sum("payment").cast("decimal(30,2)").alias("amount"))


def _two_extracts(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    """The requests of two days without a modification date: some new, gone, changed."""
    rows = w.requests.drop("modified_at")
    id_ = F.col("request_id")
    before = rows.filter(id_ % 11 != 3).withColumns({
        "status": F.when(id_ % 7 == 2, "EN_COURS_AVANT").otherwise(F.col("status")),
        "plot_id": F.when(id_ % 17 == 5, None).otherwise(F.col("plot_id"))})
    return before, rows.filter(id_ % 13 != 5)


def extract_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Two full extracts compared; the differences, deletions included, merged into the
    stored table of the first give that of the second."""
    before, after = (_stored(df, name) for df, name in zip(
        _two_extracts(sm.sample_warehouse(spark, folder)), ("before", "after")))
    changes = _stored(compare.extract_changes(before, after, ["request_id"]), "changes")
    path = scratch_path(spark, "requests_by_year")
    by_year = lambda df: df.withColumn("year", F.year("created_at"))
    by_year(before).write.partitionBy("year").parquet(path)
    new = by_year(after).join(changes.filter(F.col("change") != compare.DELETED), "request_id", "left_semi")
    refresh = [c for c in after.columns if c not in ("request_id", "created_at")]
    upsert.upsert_table(spark, path, _stored(new, "new"), ["request_id"], refresh, [], "year",
                        deleted=changes.filter(F.col("change") == compare.DELETED))
    merged = spark.read.schema(by_year(after).schema).parquet(path)
    left = compare.extract_changes(merged.drop("year"), after, ["request_id"])
    counted = lambda df, what: df.groupBy(what.alias("change")).agg(
        count_rows().alias("requests"), F.sum("request_id").alias("ids"))
    return (counted(changes, F.col("change")).unionByName(counted(merged, F.lit("merged")))
            .unionByName(left.agg(count_rows().alias("requests")).select(
                F.lit("left").alias("change"), "requests", F.lit(None).cast("bigint").alias("ids"))))


def published_views(spark: SparkSession, folder: str) -> DataFrame:
    """Two published views asked by name in SQL, the answer kept as a table and read
    back from it."""
    registry.register_views(sm.sample_warehouse(spark, folder))
    answer = spark.sql("""
        SELECT 'statut' AS vue, statut AS libelle, nombre_demandes FROM v_kpi_demandes_par_statut
        UNION ALL SELECT 'type', type_zone, nombre_demandes FROM v_kpi_demandes_par_type""")
    path = scratch_path(spark, "published")
    upsert.full_refresh(answer, path, sm.BATCH)
    return upsert.read_load(spark, path, sm.BATCH, answer.schema)


def date_keys_with_default(spark: SparkSession, folder: str) -> DataFrame:
    """Receivables per recovery date key, with the default key where none was recovered."""
    key = s.date_key_or(F.col("recovered_on"))
    return sm.sample_warehouse(spark, folder).fact_receivables.groupBy(key.alias("date_key")).agg(
        count_rows().alias("receivables"))


def _activity(w: Warehouse) -> DataFrame:
    """Requests in the months of their creation and of their last change."""
    months = F.array(F.trunc("created_at", "month"), F.trunc("modified_at", "month"))
    return w.requests.select("request_id", "status", F.explode(months).alias("month"))


def distinct_by_bitmap(spark: SparkSession, folder: str) -> DataFrame:
    """Different requests active per month, per year and at all, by status, out of the
    bitmaps of two loads that share some requests."""
    activity = _activity(sm.sample_warehouse(spark, folder))
    id_ = F.col("request_id")
    loads = (activity.filter(id_ % 3 != 0), activity.filter((id_ % 3 == 0) | (id_ % 5 == 0)))
    stored = functools.reduce(DataFrame.union, (
        _stored(rollups.request_bitmaps(load, ["month", "status"]), f"bitmaps_{n}") for n, load in enumerate(loads)))

    def level(name: str, period) -> DataFrame:
        return rollups.distinct_requests(stored, [period.alias("period"), "status"]).select(
            F.lit(name).alias("level"), "period", "status", "requests")
    return (level("month", F.date_format("month", "yyyy-MM")).unionByName(level("year", F.date_format("month", "yyyy")))
            .unionByName(level("all", F.lit("all"))))


def median_by_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Median processing days per month, per status and at all, out of the counters of
    two loads; the second corrects a part of the first."""
    rows = sm.sample_warehouse(spark, folder).requests.select(
        "request_id", "status", F.trunc("created_at", "month").alias("month"), "processing_days")
    id_, by = F.col("request_id"), ["month", "status"]
    wrong = rows.filter(id_ % 4 == 1).withColumn("processing_days", F.col("processing_days") + 10)
    first = _stored(rollups.day_counters(rows.filter(id_ % 4 > 1).unionByName(wrong), by), "first")
    taken = rollups.day_counters(wrong, by).withColumn("n", -F.col("n"))
    second = _stored(rollups.day_counters(rows.filter(id_ % 4 < 2), by).unionByName(taken), "second")
    counters = first.unionByName(second)
    none = F.lit(None).cast("string")
    part = lambda df, month, status: df.select(month.alias("month"), status.alias("status"), "median", "rows")
    return (part(rollups.medians(counters, ["month"]), F.date_format("month", "yyyy-MM"), none)
            .unionByName(part(rollups.medians(counters, ["status"]), none, F.col("status")))
            .unionByName(part(rollups.medians(counters, []), none, none)))


def recon_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Source against warehouse with a changed, a missing and an additional request."""
    w = sm.sample_warehouse(spark, folder)
    rows = w.requests.withColumn("month", F.date_format("created_at", "yyyyMM").cast("int"))
    id_, at = F.col("request_id"), scratch_path(spark, "recon")
    low, high = rows.agg(F.min(id_), F.max(id_)).first()
    changed, missing, added = low, (low + high) // 2, high
    source = rows.filter(id_ != added)
    warehouse = rows.filter(id_ != missing).withColumn("financing_amount", F.when(
        id_ == changed, F.col("financing_amount") + 1).otherwise(F.col("financing_amount")).cast(s.MONEY))
    sides = []
    for name, df in (("source", source), ("warehouse", warehouse)):
        df.write.partitionBy("month").parquet(f"{at}/{name}")
        sides.append(spark.read.schema(df.schema).parquet(f"{at}/{name}"))
    return compare.recon_differences(*sides, ["request_id"], "month")


def alert_episodes(spark: SparkSession, folder: str) -> DataFrame:
    """Episodes in the monthly history of two rates."""
    fact = sm.sample_warehouse(spark, folder).fact_requests
    month = F.trunc("created_at", "month").alias("as_of")
    rate = lambda part: percent(F.sum(part), count_rows(), 2)
    wide = fact.groupBy(month).agg(rate("n_accepted").alias("acceptance_rate"), rate("n_priority").alias("priority_rate"))
    history = wide.unpivot(["as_of"], ["acceptance_rate", "priority_rate"], "kpi", "value")
    return monitoring.alert_episodes(history, EPISODE_LIMITS)


EPISODE_LIMITS = (("acceptance_rate", 36, 33), ("priority_rate", 42, 39))


def insert_new_agents(spark: SparkSession, folder: str) -> DataFrame:
    """Active agents loaded first, then everybody: only the unknown are added."""
    cleaned = clean.clean_agents(sm.sample_warehouse(spark, folder).staging.agents)
    known = ag.first_versions(cleaned.filter(F.col("status") == "ACTIF"), AGENT_LOADS[0])
    return _end_as_text(ag.insert_new_agents(known, cleaned, AGENT_LOADS[1]))


def scd2_agents(spark: SparkSession, folder: str) -> DataFrame:
    """Active agents loaded first; then everybody arrives, those modified in
    the last week without a usable e-mail address, and every seventh agent
    with an older row, which counts only for agents not known yet."""
    cleaned = clean.clean_agents(sm.sample_warehouse(spark, folder).staging.agents)
    known = ag.first_versions(cleaned.filter(F.col("status") == "ACTIF"), AGENT_LOADS[0])
    week = F.col("modified_at") >= s.as_timestamp(sm.COLLECTIONS_AS_OF) - F.expr("INTERVAL 7 DAYS")
    second = cleaned.withColumn("email", F.when(~week, F.col("email")))
    late = F.col("agent_id") % 7 == 3
    second = second.withColumns({
        "agent_name": F.when(late, "Older").otherwise(F.col("agent_name")),
        "modified_at": F.when(late, F.col("modified_at") - F.expr("INTERVAL 10 DAYS"))
                        .otherwise(F.col("modified_at"))})
    return _end_as_text(ag.scd2_agents(known, second, AGENT_LOADS[1]))


def seed_reference_dims(spark: SparkSession, folder: str) -> DataFrame:
    """The seeded members with the number of rows that use each of them."""
    w = sm.sample_warehouse(spark, folder)
    types = w.fact_receivables.groupBy(F.col("type_key").alias("member_key")).agg(count_rows().alias("rows"))
    states = w.fact_receivables.groupBy(F.col("status_key").alias("member_key")).agg(count_rows().alias("rows"))
    modes = (w.fact_recoveries.groupBy("payment_mode").agg(count_rows().alias("rows"))
             .join(w.dim_payment_mode, "payment_mode").select(F.col("mode_key").alias("member_key"), "rows"))
    members = (
        w.dim_receivable_type.select(F.lit("type").alias("dimension"), F.col("type_key").alias("member_key"),
                                     F.col("short_label").alias("label"))
        .unionByName(w.dim_receivable_status.select(
            F.lit("status").alias("dimension"), F.col("status_key").alias("member_key"),
            F.col("status_label").alias("label")))
        .unionByName(w.dim_payment_mode.select(
            F.lit("mode").alias("dimension"), F.col("mode_key").alias("member_key"),
            F.col("mode_label").alias("label")))
    )
    used = types.unionByName(states).unionByName(modes)
    return members.join(used, "member_key", "left").select(
        "dimension", "member_key", "label", F.coalesce("rows", F.lit(0)).alias("rows"))


def date_spine(spark: SparkSession, folder: str) -> DataFrame:
    """Requests per day over every day between the first and the last one."""
    created = sm.sample_warehouse(spark, folder).staging.requests.select(F.col("created_at").cast("date").alias("date"))
    per_day = created.groupBy("date").agg(count_rows().alias("requests"))
    return dimensions.spine_of(per_day, "date").join(per_day, "date", "left").select(
        "date", F.coalesce("requests", F.lit(0)).alias("requests"))


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar over the creation days found in the requests."""
    created = sm.sample_warehouse(spark, folder).staging.table("orders").select("o_orderdate")
    return dimensions.dim_date(dimensions.spine_of(created, "o_orderdate"))


# --- quality -------------------------------------------------------------------------

def _rule_tables(w: Warehouse, t: sm.SampleTables) -> dict[str, DataFrame]:
    return {
        "requests": w.requests, "companies": w.companies, "plots": w.plots, "zones": w.zones,
        "dim_company": w.dim_company, "dim_zone": w.dim_zone, "dim_plot": w.dim_plot,
        "dim_request_status": w.dim_request_status,
        "dim_date": dimensions.dim_date(dimensions.spine_of(t.table("orders"), "o_orderdate")),
        "fact_requests": w.fact_requests,
    }


def dq_rules(spark: SparkSession, folder: str) -> DataFrame:
    w = sm.sample_warehouse(spark, folder)
    return quality.dq_rules(spark, _rule_tables(w, sm.sample_warehouse(spark, folder).staging))


def dq_checks(spark: SparkSession, folder: str) -> DataFrame:
    w = sm.sample_warehouse(spark, folder)
    measured = facts.receivable_measures(clean.clean_receivables(w.staging.receivables), sm.BATCH)
    return quality.dq_checks({"fact_receivables": measured, "fact_recoveries": w.fact_recoveries})


def dq_orphans(spark: SparkSession, folder: str) -> DataFrame:
    w = sm.sample_warehouse(spark, folder)
    receivables = _stored(w.fact_receivables, "receivables")
    recoveries = facts.fact_recoveries(clean.clean_recoveries(w.staging.recoveries), receivables, sm.BATCH)
    return quality.dq_orphans({
        "fact_receivables": receivables, "fact_recoveries": recoveries,
        "fact_requests": w.fact_requests, "dim_request_status": w.dim_request_status,
        "dim_date": dimensions.dim_date(dimensions.request_days(w.requests)),
        "dim_agent": w.dim_agent, "dim_company": w.dim_company,
        "dim_receivable_type": w.dim_receivable_type, "dim_receivable_status": w.dim_receivable_status,
    })


def recon_status(spark: SparkSession, folder: str) -> DataFrame:
    w = sm.sample_warehouse(spark, folder)
    status = {"O": "EN_COURS", "F": "ACCEPTEE", "P": "REJETEE"}
    pairs = [F.lit(x) for pair in status.items() for x in pair]
    source = w.staging.table("orders").select(
        F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("o_orderstatus")), F.lit("INCONNU")).alias("status"))
    return quality.recon_status(source, w.fact_requests, w.dim_request_status)


def star_row_counts(w: Warehouse) -> DataFrame:
    names = ("dim_company", "dim_plot", "dim_request_status", "dim_zone", "fact_requests")
    return quality.table_counts({name: w[name] for name in names})


def kpi_health(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts of the request KPIs over a stored fact.

    Fourteen KPIs read the fact, so the columns they use are written once to the
    shared folder instead of being derived fourteen times.
    """
    w = sm.sample_warehouse(spark, folder)
    unused = ("reference", "priority", "current_step", "modified_at", "modification_date_key")

    class Star:
        fact_requests = _stored(w.fact_requests.drop(*unused), "fact_requests")
        dim_zone, dim_plot, dim_company, dim_date = w.dim_zone, w.dim_plot, w.dim_company, w.dim_date

    return dashboards.kpi_health({
        name: (lambda build=build: build(Star)) for name, build in registry.REQUEST_KPIS.items()})


QUERIES: dict[str, Query] = {
    # sources and loads
    "extract_requests": _tables(lambda t: extract.extract_requests(t.source_requests, sm.REQUESTS_AS_OF)),
    "extract_companies": _tables(lambda t: extract.extract_companies(t.source_companies)),
    "extract_plots": _tables(lambda t: extract.extract_plots(t.source_plots)),
    "extract_zones": _tables(lambda t: extract.extract_zones(t.source_zones)),
    "extract_receivables": _tables(lambda t: extract.extract_receivables(t.source_receivables)),
    "incremental_agents": _tables(lambda t: extract.incremental_agents(t.source_agents, sm.COLLECTIONS_AS_OF)),
    "incremental_recoveries": _tables(
        lambda t: extract.incremental_recoveries(t.source_recoveries, "2024-01-30")),
    "load_full_refresh": load_full_refresh,
    "collections_two_batches": collections_two_batches,
    "payments_over_batches": payments_over_batches,
    "late_parents": late_parents,
    "recoveries_late_and_future": recoveries_late_and_future,
    "summary_by_deltas": summary_by_deltas,
    "facts_by_agent_version": facts_by_agent_version,
    "extract_changes": extract_changes,
    "published_views": published_views,
    "date_keys_with_default": date_keys_with_default,
    "distinct_by_bitmap": distinct_by_bitmap,
    "median_by_counters": median_by_counters,
    "recon_differences": recon_differences,
    "alert_episodes": alert_episodes,
    "upsert_receivable_fact": upsert_receivable_fact,
    "upsert_recovery_fact": upsert_recovery_fact,
    "insert_new_agents": insert_new_agents,
    "seed_reference_dims": seed_reference_dims,
    "date_spine": date_spine,
    # cleaning
    "clean_receivables": _tables(lambda t: clean.clean_receivables(t.delivered_receivables)),
    "clean_agents": _tables(lambda t: clean.clean_agents(t.agents)),
    "clean_recoveries": _tables(lambda t: clean.clean_recoveries(t.recoveries)),
    # dimensions and facts
    "dim_date": dim_date,
    "dim_company": _star(lambda w: w.dim_company),
    "dim_plot": _star(lambda w: w.dim_plot),
    "dim_zone": _star(lambda w: w.dim_zone),
    "dim_request_status": _star(lambda w: w.dim_request_status),
    "scd2_agents": scd2_agents,
    "fact_requests": _star(lambda w: w.fact_requests),
    "fact_receivables": _star(lambda w: facts.with_lateness(w.fact_receivables, sm.REQUESTS_AS_OF)),
    "late_receivables": late_receivables,
    "fact_recoveries": _star(lambda w: w.fact_recoveries),
    "payments_from_receivables": _star(lambda w: payments.payments_from_receivables(w.fact_receivables, sm.BATCH)),
    "payments_from_recoveries": _star(lambda w: payments.payments_from_recoveries(w.fact_recoveries, sm.BATCH)),
    "build_payments": _star(lambda w: w.fact_payments),
    # request KPIs
    "kpi_by_status": _star(lambda w: requests.kpi_by_status(w.fact_requests)),
    "kpi_by_zone_type": _star(lambda w: requests.kpi_by_zone_type(w.fact_requests)),
    "kpi_by_entity": _star(
        lambda w: requests.kpi_by_entity(w.fact_requests, w.dim_zone, w.dim_plot, w.dim_company)),
    "kpi_priority_split": _star(lambda w: requests.kpi_priority_split(w.fact_requests)),
    "kpi_delay_stats": _star(lambda w: requests.kpi_delay_stats(w.fact_requests)),
    "kpi_acceptance": _star(lambda w: requests.kpi_acceptance(w.fact_requests)),
    "kpi_priority_trend": _star(lambda w: requests.kpi_priority_trend(w.fact_requests, w.dim_date)),
    "kpi_acceptance_finalised": _star(lambda w: requests.kpi_acceptance_finalised(w.fact_requests)),
    "kpi_delay_finalised": _star(lambda w: requests.kpi_delay_finalised(w.fact_requests)),
    "kpi_volume": _star(lambda w: requests.kpi_volume(w.fact_requests)),
    "kpi_financial_performance": _star(lambda w: requests.kpi_financial_performance(w.fact_requests)),
    "kpi_monthly": _star(lambda w: requests.kpi_monthly(w.fact_requests)),
    "kpi_by_zone": _star(lambda w: requests.kpi_by_zone(w.fact_requests, w.dim_zone)),
    "kpi_executive": _star(lambda w: requests.kpi_executive(w.fact_requests)),
    "kpi_top_entities": _star(
        lambda w: requests.kpi_top_entities(w.fact_requests, w.dim_zone, w.dim_plot, w.dim_company, k=5)),
    "kpi_top_10_entities": _star(
        lambda w: requests.kpi_top_entities(w.fact_requests, w.dim_zone, w.dim_plot, w.dim_company, k=10)),
    "kpi_last_12_months": _star(lambda w: requests.kpi_last_12_months(w.fact_requests)),
    "kpi_monthly_summary": _star(lambda w: requests.kpi_monthly_summary(w.fact_requests)),
    "kpi_zone_summary": _star(lambda w: requests.kpi_zone_summary(w.fact_requests, w.dim_zone)),
    "kpi_top_zones": _star(lambda w: requests.kpi_top_zones(w.fact_requests, w.dim_zone)),
    # star analysis
    "an_by_status": _star(lambda w: analysis.an_by_status(w.fact_requests, w.dim_request_status)),
    "an_by_type": _star(lambda w: analysis.an_by_type(w.fact_requests, w.dim_request_status)),
    "an_by_entity_left": _star(
        lambda w: analysis.an_by_entity_left(w.fact_requests, w.dim_zone, w.dim_plot, w.dim_company)),
    "an_priority": _star(lambda w: analysis.an_priority(w.fact_requests)),
    "an_delay_by_status_type": _star(
        lambda w: analysis.an_delay_by_status_type(w.fact_requests, w.dim_request_status)),
    "an_acceptance_by_type": _star(
        lambda w: analysis.an_acceptance_by_type(w.fact_requests, w.dim_request_status)),
    "an_priority_trend": _star(lambda w: analysis.an_priority_trend(w.fact_requests, w.dim_date)),
    "an_top_zones": _star(lambda w: analysis.an_top_zones(w.fact_requests, w.dim_zone)),
    "an_monthly_full": _star(lambda w: analysis.an_monthly_full(w.fact_requests, w.dim_date)),
    "an_total": _star(lambda w: analysis.an_total(w.fact_requests)),
    "an_type_financing": _star(lambda w: analysis.an_type_financing(w.fact_requests, w.dim_request_status)),
    "an_delay_by_status": _star(lambda w: analysis.an_delay_by_status(w.fact_requests, w.dim_request_status)),
    "an_priority_short": _star(lambda w: analysis.an_priority_short(w.fact_requests)),
    # collections and payments
    "fin_total_payments": _star(lambda w: finance.fin_total_payments(w.fact_payments)),
    "fin_net_revenue": _star(lambda w: finance.fin_net_revenue(w.fact_payments)),
    "fin_dashboard": _star(lambda w: finance.fin_dashboard(w.fact_payments)),
    "fin_collections_monthly": _star(lambda w: finance.fin_collections_monthly(w.fact_payments)),
    "fin_agent_performance": _star(lambda w: finance.fin_agent_performance(w.fact_payments)),
    "fin_recovery_by_zone": _star(lambda w: finance.fin_recovery_by_zone(w.fact_payments)),
    "fin_monthly_by_type": _star(lambda w: finance.fin_monthly_by_type(w.fact_payments)),
    "fin_by_method": _star(lambda w: finance.fin_by_method(w.fact_payments)),
    "fin_global_dashboard": _star(lambda w: finance.fin_global_dashboard(w.fact_payments)),
    "fin_load_stats": _star(lambda w: finance.fin_load_stats(w.fact_payments)),
    "kpi_receivables_summary": _star(lambda w: finance.kpi_receivables_summary(
        w.fact_receivables, w.dim_date, w.dim_agent, w.dim_receivable_type, w.dim_receivable_status,
        sm.REQUESTS_AS_OF)),
    # combined KPIs, quality, monitoring
    "dash_status_priority": _star(lambda w: dashboards.dash_status_priority(w.fact_requests)),
    "kpi_cross": _star(lambda w: dashboards.kpi_cross(w.fact_requests)),
    "kpi_summary_row": _star(lambda w: requests.kpi_summary_row(w.fact_requests)),
    "requests_per_company": _star(lambda w: analysis.requests_per_company(w.fact_requests, w.dim_company)),
    "business_totals": _star(lambda w: requests.business_totals(w.fact_requests)),
    "star_row_counts": _star(star_row_counts),
    "kpi_health": kpi_health,
    "kpi_alerts": _star(lambda w: monitoring.kpi_alerts(w.fact_requests)),
    "kpi_snapshot": _star(lambda w: monitoring.kpi_snapshot(w.fact_requests, sm.REQUESTS_AS_OF)),
    "dq_rules": dq_rules,
    "dq_checks": dq_checks,
    "dq_orphans": dq_orphans,
    "dq_missing_keys": _star(lambda w: quality.dq_missing_keys(w.fact_requests)),
    "recon_counts": _star(
        lambda w: quality.recon_counts(w.staging.table("orders"), w.fact_requests)),
    "recon_status": recon_status,
}
