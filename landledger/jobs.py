"""The three jobs a scheduler runs: request load, collection load, monitoring.

Each stage writes its tables to shared storage and the next stage reads them
back, so lineage stays short and a lost executor only repeats tasks of the
current stage.  Tables of one load or batch lie in a folder of their own, which
a repeated run replaces.  The merged facts are upserted: a repeated batch finds
its own rows, and an older one does not undo a newer one.
"""

from __future__ import annotations

import functools
import os
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landledger import schemas
from landledger.functions import scalars as s
from landledger.operators import agents as agent_dim
from landledger.operators import (clean, dimensions, facts, payments, progress, quality, summary,
                                  upsert)
from landledger.operators import parents as parents_of
from landledger.plans import monitoring
from landledger.session import exists, remove, sparing_disk
from landledger.sources import extract, seeds
from landledger.warehouse import StoredWarehouse, request_table

MONTH = "created_month"


def load_requests(spark: SparkSession, source: Mapping[str, DataFrame], path: str, load_id: str,
                  as_of, calendar=None, buckets: int = 200) -> StoredWarehouse:
    """Source tables to staging, dimensions and request fact, then the quality report.

    An empty extract leaves its staging table as it was and stops the job, as
    there would be nothing to build this load from.  Of a request extracted twice the
    newest row counts.  The calendar covers the requests unless bounds are given.
    The request fact is a catalog table in ``buckets`` by request, so the KPIs that
    count requests do not move it; choose as many as give one task's share each.
    """
    staging = {
        "requests": upsert.latest_per_key(
            extract.extract_requests(source["demandes_attribution"], as_of), ["request_id"], ["modified_at"]),
        "companies": extract.extract_companies(source["entreprises"]),
        "plots": extract.extract_plots(source["lots"]),
        "zones": extract.extract_zones(source["zones_industrielles"]),
    }
    for name, df in staging.items():
        if not upsert.refresh_if_any(df, os.path.join(path, name), load_id):
            raise ValueError(f"no rows extracted for {name}; earlier loads are kept")
    stored = StoredWarehouse(spark, path, load_id, as_of=as_of)
    days = (dimensions.date_spine(spark, *calendar) if calendar
            else dimensions.request_days(stored.requests))
    marts = {
        "dim_company": dimensions.dim_company(stored.companies),
        "dim_plot": dimensions.dim_plot(stored.plots),
        "dim_zone": dimensions.dim_zone(stored.zones),
        "dim_request_status": dimensions.dim_request_status(stored.requests),
        "dim_date": dimensions.dim_date(days),
    }
    for name, df in marts.items():
        upsert.full_refresh(df, os.path.join(path, name), load_id)
    upsert.save_bucketed(facts.fact_requests(stored.requests), request_table(load_id),
                         os.path.join(path, "fact_requests", f"load_id={load_id}"), "request_id", buckets)

    tables = {name: stored[name] for name in (*staging, *marts, "fact_requests")}
    unreadable = source["lots"].filter(F.col("prix").isNotNull()).select(
        s.price_amount(F.col("prix")).alias("price"))
    _report(path, load_id, {
        "requests_rules": quality.dq_rules(spark, tables),
        "requests_orphans": quality.dq_orphans(tables),
        "requests_counts": quality.table_counts(tables),
        "requests_unreadable": unreadable.agg(
            F.count_if(F.col("price").isNull()).alias("unreadable_prices")),
    })
    return stored


def _report(path: str, load: str, tables: Mapping[str, DataFrame]) -> None:
    """The quality tables of a load."""
    for name, df in tables.items():
        upsert.full_refresh(df, os.path.join(path, "quality", name), load)


def with_month(fact: DataFrame, date_key: str) -> DataFrame:
    """The partition column: year and month of a date key (0 when unknown)."""
    month = F.coalesce((F.col(date_key) / 100).cast("int"), F.lit(0))
    return fact.withColumn(MONTH, month)


def _store_batch(spark: SparkSession, batch: DataFrame, path: str, name: str, batch_id: str,
                 key: str, listed: DataFrame) -> DataFrame:
    """The newest row per key of a batch, stored and read back.  ``listed`` are the stored
    rows that it is made from: repeats are found among their keys, so rows are not moved."""
    staged = os.path.join(path, f"{name}_batch")
    upsert.full_refresh(upsert.newest_stored(batch, [key], ["modified_at"], listed), staged, batch_id)
    return upsert.read_load(spark, staged, batch_id, batch.schema)


def _merge(spark: SparkSession, batch: DataFrame, path: str, name: str, key: str, refresh,
           held: DataFrame) -> DataFrame:
    """Merge a stored batch into the fact; the fact.  ``held`` are its keys that are
    stored already."""
    fact = os.path.join(path, name)
    upsert.upsert_table(spark, fact, batch, [key], refresh, ["modified_at"], MONTH, held=held)
    return spark.read.schema(batch.schema).parquet(fact)


def _held(spark: SparkSession, path: str, name: str, batch_id: str, batch: DataFrame, key: str) -> DataFrame:
    """Which keys of a batch a fact holds, and in which months."""
    return upsert.held_keys(spark, os.path.join(path, name), batch.schema, batch.select(key), [key], MONTH,
                            os.path.join(path, f"held_{name}", f"load_id={batch_id}"))


def _rows_of(fact: DataFrame, ids: DataFrame, months: list) -> DataFrame:
    """The rows of a fact with the given ids in the months that these are listed with;
    only the given months are read.  A filter on the month reaches both sides."""
    return fact.filter(F.col(MONTH).isin(months)).join(ids.distinct(), ids.columns, "left_semi")


def _record_payments(spark: SparkSession, path: str, batch_id: str, receivables: DataFrame,
                     recoveries: DataFrame, rows: Mapping) -> None:
    """Append what the batch changes to the payment movements.  ``receivables`` and
    ``recoveries`` are the merged rows that it touches, about ``rows`` per month; of the
    earlier movements only these months are read (a list as short as the calendar).
    Portions of them are gone through one after the other: a payment and its movements
    lie in one month, and movements of the batch itself are not read."""
    place = os.path.join(path, "payment_movements")
    tags = (f"{batch_id}_COLLECTES", f"{batch_id}_RECOUVREMENTS")
    schema = payments.payment_movements(
        payments.current_payments(receivables, recoveries), _no_movements(spark), tags).schema
    for tag in tags:  # a repeated batch replaces its own movements
        remove(spark, os.path.join(place, f"etl_batch_id={tag}"))
    recorded = spark.createDataFrame([], schema)
    if exists(spark, place):
        recorded = spark.read.schema(schema).parquet(place)
    for months, pieces in upsert.portions(rows):
        for number in range(pieces):
            mine = F.pmod(F.xxhash64("source_id"), F.lit(pieces)) == number if pieces > 1 else F.lit(True)
            touched = payments.current_payments(*[df.filter(F.col(MONTH).isin(months))
                                                  for df in (receivables, recoveries)])
            new = payments.payment_movements(
                touched.filter(mine),
                recorded.filter(F.col(payments.MOVEMENT_MONTH).isin(months)).filter(mine), tags)
            (upsert.by_partition(new, "etl_batch_id", payments.MOVEMENT_MONTH).write.mode("append")
             .partitionBy("etl_batch_id", payments.MOVEMENT_MONTH).parquet(place))


def _no_movements(spark: SparkSession) -> DataFrame:
    amounts = ", ".join(f"{c} decimal(15,2)" for c in payments.MOVED)
    return spark.createDataFrame([], f"payment_key string, {amounts}, etl_batch_id string")


def _staged(spark: SparkSession, df: DataFrame, path: str, name: str, batch_id: str, schema) -> DataFrame:
    """The cleaned extract of a batch; nothing extracted is an empty frame and leaves
    the folder of the batch as it was."""
    place = os.path.join(path, name)
    if upsert.refresh_if_any(df, place, batch_id):
        return upsert.read_load(spark, place, batch_id, schema)
    return spark.createDataFrame([], schema)


def load_collections(spark: SparkSession, source: Mapping[str, DataFrame], path: str, batch_id: str,
                     as_of, previous: str | None = None, since=None, overlap_days: int = 1,
                     ) -> dict[str, DataFrame]:
    """One batch of the collection tables; see ``_load_collections``.

    What only this load reads is freed when it has ended, or with the next load: shuffle
    files, lists of keys, old rows, the batch's copies of rows that are merged.
    """
    with sparing_disk(spark):
        return _load_collections(spark, source, path, batch_id, as_of, previous, since, overlap_days)


def _load_collections(spark: SparkSession, source: Mapping[str, DataFrame], path: str, batch_id: str,
                      as_of, previous: str | None, since, overlap_days: int) -> dict[str, DataFrame]:
    """Agents, receivables, recovery actions and payments of one batch.

    ``previous`` names the load the agent dimension is carried on from; without
    it this is the first load.  Receivables out of range go to the quarantine folder
    of the batch and the rest is loaded.  An empty extract changes no fact.  An extract
    with rows without an id, or a batch that breaks a column rule or range check, is
    refused before anything is merged; the report of the checks stays.

    Recovery actions are read from the day ``since`` on; without it from
    ``overlap_days`` before the day up to which another load has read, or all if there
    is none.  Choose as many days as rows may land late; reading some again does no
    harm.  Actions whose receivable comes with a later batch are repaired by that batch.

    A payment has one current row.  What the batch changed is appended to the payment
    movements under the batch's own tags.
    """
    place = lambda name: os.path.join(path, name)
    for name in ("receivables_extract", "receivables", "recoveries"):
        upsert.drop_other_loads(spark, place(name), batch_id)

    # read from the source once: the checks and the cleaning use the extract as written
    delivered = extract.extract_receivables(source["collectes"])
    upsert.full_refresh(delivered, place("receivables_extract"), batch_id)
    extracts = {
        "agents": extract.incremental_agents(source["agents_collecteurs"], as_of),
        "receivables": upsert.read_load(spark, place("receivables_extract"), batch_id, delivered.schema),
        "recoveries": extract.all_recoveries(source["recouvrements"]),
    }
    keys = quality.source_keys(extracts)
    _report(path, batch_id, {"collections_source_keys": keys})
    quality.refuse_broken(upsert.read_load(spark, place("quality/collections_source_keys"), batch_id,
                                           keys.schema), batch_id)

    cleaned = clean.clean_agents(extracts["agents"])
    if previous is None:
        agents = agent_dim.first_versions(cleaned, as_of)
    else:
        known = upsert.read_load(spark, place("dim_agent"), previous,
                                 agent_dim.first_versions(cleaned, as_of).schema)
        agents = agent_dim.with_late_versions(agent_dim.scd2_agents(known, cleaned, as_of), cleaned)
    upsert.full_refresh(agents, place("dim_agent"), batch_id)
    for name, seed in (("dim_receivable_type", seeds.receivable_types),
                       ("dim_receivable_status", seeds.receivable_statuses),
                       ("dim_payment_mode", seeds.payment_modes)):
        upsert.full_refresh(seed(spark), place(name), batch_id)

    receivables = _staged(spark, clean.clean_receivables(extracts["receivables"]),
                          path, "receivables", batch_id, schemas.RECEIVABLES)
    upsert.full_refresh(facts.quarantined_receivables(receivables, batch_id), place("quarantine"), batch_id)
    new_receivables = _store_batch(
        spark, with_month(facts.fact_receivables(receivables, batch_id), "created_date_key"),
        path, "fact_receivables", batch_id, "receivable_id", receivables)

    if since is None:
        since = progress.read_from(spark, place("recovery_reads"), batch_id, as_of, overlap_days)
    actions = source["recouvrements"]
    if since is not None:
        actions = actions.filter(F.col("date_modification") >= s.as_timestamp(since))
    recoveries = _staged(spark, clean.clean_recoveries(extract.all_recoveries(actions)),
                         path, "recoveries", batch_id, schemas.RECOVERIES)

    stored = StoredWarehouse(spark, path, batch_id, as_of=as_of)
    _refuse_broken_batch(spark, path, batch_id, {
        "dim_agent": stored.dim_agent, "fact_receivables": new_receivables,
        "fact_recoveries": upsert.latest_per_key(recoveries, ["recovery_id"], ["modified_at"]).select(
            "recovery_id", F.col("recovery_id").alias("recovery_fact_key"), "payment",
            F.lit(0).cast(s.MONEY).alias("fee"))})

    # where the batch's receivables are stored: the months that hold them, else their own
    held = _held(spark, path, "fact_receivables", batch_id, new_receivables, "receivable_id")
    ids = held.union(new_receivables.select(*held.columns))
    old_months = upsert.partition_values(held, MONTH)
    summary_place = place("receivables_sums")
    stored_rows = (spark.read.schema(new_receivables.schema).parquet(place("fact_receivables"))
                   if old_months else new_receivables.limit(0))
    summary.note_before(spark, summary_place, batch_id, _rows_of(stored_rows, held, old_months), MONTH)
    receivable_facts = _merge(spark, new_receivables, path, "fact_receivables", "receivable_id",
                              upsert.RECEIVABLE_REFRESH, held)
    rows = upsert.rows_per(ids, MONTH)
    changed_receivables = _rows_of(receivable_facts, ids, list(rows))
    sums = summary.keep_current(spark, summary_place, batch_id, receivable_facts, changed_receivables, MONTH,
                                [months for months, _ in upsert.portions(rows)])

    # only the receivables that the batch names take part in the lookup
    parents = receivable_facts.join(recoveries.select("receivable_id").distinct(), "receivable_id", "left_semi")
    new_recoveries = _store_batch(
        spark, with_month(facts.fact_recoveries(recoveries, parents, batch_id), "action_date_key"),
        path, "fact_recoveries", batch_id, "recovery_id", recoveries)
    held = _held(spark, path, "fact_recoveries", batch_id, new_recoveries, "recovery_id")
    recovery_facts = _merge(spark, new_recoveries, path, "fact_recoveries", "recovery_id",
                            upsert.RECOVERY_REFRESH, held)
    repaired = _repair_early_actions(spark, path, batch_id, new_receivables, new_recoveries, recovery_facts)
    recovery_facts = spark.read.schema(new_recoveries.schema).parquet(place("fact_recoveries"))
    progress.note_read(spark, place("recovery_reads"), batch_id, since, as_of)
    action_ids = functools.reduce(DataFrame.union, (
        df.select(MONTH, "recovery_id") for df in (held, new_recoveries, repaired)))
    action_rows = upsert.rows_per(action_ids, MONTH)
    # a payment's month is the month its receivable or action is stored under
    _record_payments(spark, path, batch_id, changed_receivables,
                     _rows_of(recovery_facts, action_ids, list(action_rows)), Counter(rows) + Counter(action_rows))

    tables = {name: stored[name] for name in ("dim_agent", "dim_receivable_type", "dim_receivable_status")}
    tables |= {"fact_receivables": receivable_facts, "fact_recoveries": recovery_facts}
    days = dimensions.dim_date(dimensions.spine_of(receivable_facts, "created_on"))
    _report(path, batch_id, {
        "collections_orphans": quality.dq_orphans(tables),
        "collections_counts": quality.table_counts(tables),
    })
    upsert.refresh_in_parts([
        summary.summary(sums.filter(upsert.in_partitions(MONTH, months)), days, stored.dim_agent,
                        stored.dim_receivable_type, stored.dim_receivable_status, as_of)
        for months, _ in upsert.portions(upsert.rows_per(sums, MONTH))], place("kpi_receivables_summary"), batch_id)
    for name in ("repaired_batch", "solved_batch", "held_fact_receivables", "held_fact_recoveries"):
        remove(spark, os.path.join(place(name), f"load_id={batch_id}"))
    for name, batch in (("fact_receivables", new_receivables), ("fact_recoveries", new_recoveries)):
        # merged: the types alone stay
        upsert.full_refresh(spark.createDataFrame([], batch.schema), place(f"{name}_batch"), batch_id)
    return {
        "dim_agent": stored.dim_agent,
        "fact_receivables": receivable_facts,
        "fact_recoveries": recovery_facts,
        "fact_payments": payments.current_payments(receivable_facts, recovery_facts),
        "payment_movements": spark.read.parquet(place("payment_movements")),
        "quarantine": upsert.read_load(spark, place("quarantine"), batch_id,
                                       facts.quarantined_receivables(receivables, batch_id).schema),
    }


def _refuse_broken_batch(spark: SparkSession, path: str, batch_id: str, tables: Mapping[str, DataFrame]) -> None:
    """Column rules and range checks of a batch's tables, reported and enforced."""
    report = quality.dq_rules(spark, tables, quality.COLLECTION_RULES).unionByName(quality.dq_checks(tables))
    _report(path, batch_id, {"collections_rules": report})
    quality.refuse_broken(upsert.read_load(
        spark, os.path.join(path, "quality", "collections_rules"), batch_id, report.schema), batch_id)


def _repair_early_actions(spark: SparkSession, path: str, batch_id: str, new_receivables: DataFrame,
                          new_recoveries: DataFrame, recovery_facts: DataFrame) -> DataFrame:
    """Fill in the receivables that came after their actions; the repaired actions."""
    waiting = os.path.join(path, "waiting_actions")
    added = parents_of.waiting_actions(new_recoveries, MONTH)
    solved = parents_of.solved_actions(spark, waiting, new_receivables, added.schema)
    staged = os.path.join(path, "repaired_batch")
    nothing = new_recoveries.limit(0)
    upsert.full_refresh(nothing if solved is None else parents_of.repaired_actions(
        recovery_facts, solved, MONTH), staged, batch_id)
    repaired = upsert.read_load(spark, staged, batch_id, recovery_facts.schema)
    if not repaired.isEmpty():
        upsert.upsert_table(spark, os.path.join(path, "fact_recoveries"), repaired, ["recovery_id"],
                            parents_of.FROM_RECEIVABLE, [], MONTH)
    if solved is not None:  # stored, as the list it is read from is rewritten
        upsert.full_refresh(solved.select("recovery_id"), os.path.join(path, "solved_batch"), batch_id)
        solved = upsert.read_load(spark, os.path.join(path, "solved_batch"), batch_id,
                                  solved.select("recovery_id").schema)
    parents_of.drain(spark, waiting, added, solved, MONTH)
    return repaired


def monitor(warehouse, path: str, as_of) -> DataFrame:
    """Add the KPI values of the day to the history; return the alerts."""
    snapshot = monitoring.kpi_snapshot(warehouse.fact_requests, as_of)
    upsert.append_batch(snapshot, path, "as_of")
    return monitoring.kpi_alerts(warehouse.fact_requests)
