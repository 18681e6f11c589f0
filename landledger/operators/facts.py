"""Fact builders.  Surrogate keys are computed from the natural keys, so the
request fact needs no join at all and the receivable fact none but a lookup in
a six-row literal map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.functions import scalars as s
from landledger.operators.dimensions import IN_ZONE, OUT_OF_ZONE, request_status_key
from landledger.sources.extract import PENDING, REJECTED
from landledger.sources.seeds import RECEIVABLE_STATUSES


def _indicator(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def fact_requests(requests: DataFrame) -> DataFrame:
    """One row per request: date and member keys, measures, 0/1 indicators.

    A missing amount, job count or duration is stored as 0.  A missing member id
    gives a missing key.  The numeric ids stay beside the text keys: star joins
    use the 8-byte ids.
    """
    zero = F.lit(0)
    return requests.select(
        s.date_key(F.col("created_at")).alias("creation_date_key"),
        s.date_key(F.col("modified_at")).alias("modification_date_key"),
        s.prefixed_key("zone_", F.col("zone_id")).alias("zone_key"),
        s.prefixed_key("lot_", F.col("plot_id")).alias("plot_key"),
        s.prefixed_key("entreprise_", F.col("company_id")).alias("company_key"),
        request_status_key().alias("status_key"),
        "zone_id", "plot_id", "company_id",
        "request_id", "reference",
        F.lit(1).alias("request_count"),
        F.coalesce(F.col("financing_amount"), zero.cast(s.MONEY)).alias("financing"),
        F.coalesce(F.col("total_jobs"), zero).alias("jobs"),
        F.coalesce(F.col("processing_days"), zero).alias("processing_days"),
        _indicator(F.col("is_priority")).alias("n_priority"),
        _indicator(F.col("is_finalised")).alias("n_finalised"),
        _indicator(F.col("is_accepted")).alias("n_accepted"),
        _indicator(F.col("status") == REJECTED).alias("n_rejected"),
        _indicator(F.col("status") == PENDING).alias("n_pending"),
        _indicator(F.col("request_type") == IN_ZONE).alias("n_in_zone"),
        _indicator(F.col("request_type") == OUT_OF_ZONE).alias("n_out_of_zone"),
        "priority", "current_step", "created_at", "modified_at",
    )


def receivable_status_key(status: Column) -> Column:
    """Seeded key of a status; an unseeded status keeps a visible dangling key."""
    pairs = [F.lit(x) for row in RECEIVABLE_STATUSES for x in (row[1], row[0])]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), status),
                      s.prefixed_key("STAT_", status))


def with_lateness(facts: DataFrame, as_of) -> DataFrame:
    """Late flag and days late of receivable facts on the day ``as_of``.

    A receivable that is fully paid is as late as its recovery date is after the due
    date, and not late if that date is unknown.  Any other ages until ``as_of``.
    Both columns depend on the day of reading, so they are never stored.
    """
    settled = F.when(F.col("amount_collected") >= F.col("amount_due"), F.col("recovered_on")
                     ).otherwise(s.as_date(as_of))
    days_over = s.calendar_days(F.col("due_on"), settled)
    return facts.withColumns({
        "is_late": F.coalesce(days_over > 0, F.lit(False)),
        "days_late": F.greatest(days_over, F.lit(0)),
    })


def receivable_measures(receivables: DataFrame, batch_id: str) -> DataFrame:
    """All receivables with derived measures, before the range checks."""
    due, paid = F.col("amount_due"), F.col("amount_collected")
    rate = F.when(due > 0, (paid / due).cast("decimal(20,4)")).otherwise(F.lit(0).cast("decimal(20,4)"))
    return receivables.select(
        F.col("receivable_id").alias("receivable_fact_key"),
        "receivable_id",
        s.date_key(F.col("created_on")).alias("created_date_key"),
        s.date_key(F.col("due_on")).alias("due_date_key"),
        s.date_key(F.col("recovered_on")).alias("recovered_date_key"),
        s.date_key(F.col("modified_at")).alias("modified_date_key"),
        s.hash_key("AGT", F.col("agent_id")).alias("agent_key"),
        s.prefixed_key("TYP_", F.col("receivable_type")).alias("type_key"),
        receivable_status_key(F.col("status")).alias("status_key"),
        s.prefixed_key("entreprise_", F.col("company_id")).alias("company_key"),
        s.prefixed_key("lot_", F.col("plot_id")).alias("plot_key"),
        s.prefixed_key("zone_", F.col("zone_id")).alias("zone_key"),
        "agent_id", "company_id",
        due.alias("amount_due"),
        paid.alias("amount_collected"),
        (due - paid).cast(s.MONEY).alias("amount_remaining"),
        rate.alias("recovery_rate"),
        s.calendar_days(F.col("created_on"), F.col("recovered_on")).alias("recovery_days"),
        "due_on", "recovered_on",
        "reference", "notes", "request_id", "created_on", "modified_at",
        F.lit(batch_id).alias("etl_batch_id"),
    )


def receivable_in_range() -> Column:
    """The table checks: amounts not negative, rate between 0 and 1.

    As in SQL a check that is unknown because of a NULL does not fail.  The rate
    is rounded to four places, so it stays within 1 as long as the quotient is
    below 1.00005; asked this way the filter needs no second division.
    """
    due, paid = F.col("amount_due"), F.col("amount_collected")
    limit = F.lit("1.00005").cast("decimal(6,5)")
    return (
        F.coalesce(due >= 0, F.lit(True))
        & F.coalesce(paid >= 0, F.lit(True))
        & F.coalesce((due <= 0) | (paid < due * limit), F.lit(True))
    )


def fact_receivables(receivables: DataFrame, batch_id: str) -> DataFrame:
    """Receivables that pass the range checks (the fact table)."""
    measured = receivable_measures(receivables, batch_id).filter(receivable_in_range())
    return measured.withColumn("recovery_rate", F.col("recovery_rate").cast(s.RATE))


def quarantined_receivables(receivables: DataFrame, batch_id: str) -> DataFrame:
    """Receivables that fail a range check; the rest of the load goes on."""
    return receivable_measures(receivables, batch_id).filter(~receivable_in_range())


def parent_columns(receivable_facts: DataFrame) -> DataFrame:
    """What a recovery action takes from its receivable."""
    return receivable_facts.select(
        "receivable_id", "receivable_fact_key",
        F.col("amount_due").alias("parent_due"),
        F.col("created_on").alias("parent_created_on"),
        "company_id",
    )


def from_parent() -> dict[str, Column]:
    """The columns of an action that are computed from its receivable's."""
    return {
        "company_key": s.prefixed_key("entreprise_", F.col("company_id")),
        "effectiveness": (F.col("payment") / F.nullifzero(F.col("parent_due"))).cast("decimal(20,4)"),
        "days_since_receivable": s.calendar_days(F.col("parent_created_on"), F.col("action_on")),
    }


def fact_recoveries(recoveries: DataFrame, receivable_facts: DataFrame, batch_id: str,
                    state_unique: bool = False) -> DataFrame:
    """Recovery actions with the key and amount of their receivable.

    One left join replaces a lookup per row.  The receivable fact holds one row per
    id, which its load ensures, so a receivable with very many actions only makes
    the left side skewed, and adaptive execution splits that.

    ``state_unique`` repeats the uniqueness as an aggregate.  The optimizer can then
    drop the whole join where no receivable column is used, but no longer split a
    hot receivable; it is meant for plans that may not need the join at all.
    """
    parents = parent_columns(receivable_facts)
    if state_unique:
        parents = parents.dropDuplicates(["receivable_id"])
    found = from_parent()
    return recoveries.join(parents, "receivable_id", "left").select(
        F.col("recovery_id").alias("recovery_fact_key"),
        "recovery_id",
        "receivable_fact_key",
        "receivable_id",
        s.date_key(F.col("action_on")).alias("action_date_key"),
        s.date_key(F.col("created_on")).alias("created_date_key"),
        s.date_key(F.col("modified_at")).alias("modified_date_key"),
        s.hash_key("AGT", F.col("agent_id")).alias("agent_key"),
        s.prefixed_key("ACT_", F.col("action_type")).alias("action_type_key"),
        s.prefixed_key("STAT_", F.col("status")).alias("status_key"),
        found["company_key"].alias("company_key"),
        "agent_id", "company_id",
        F.col("payment"),
        F.lit(0).cast(s.MONEY).alias("fee"),
        F.col("payment").alias("amount_net"),
        found["effectiveness"].alias("effectiveness"),
        found["days_since_receivable"].alias("days_since_receivable"),
        "action_type", "payment_mode", "status", "notes", "document",
        "action_on", "modified_at",
        F.lit(batch_id).alias("etl_batch_id"),
    )
