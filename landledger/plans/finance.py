"""Collection and payment KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.functions import scalars as s
from landledger.functions.measures import count_rows, mean, percent
from landledger.operators.facts import with_lateness
from landledger.operators.payments import COLLECTION, RECOVERY, SUCCESSFUL


def _payments() -> Column:
    return count_rows().alias("payments")


def _amount(alias: str = "amount") -> Column:
    return F.sum("amount_paid").alias(alias)


def _avg_paid(digits: int | None = None) -> Column:
    value = F.avg("amount_paid") if digits is None else mean(F.sum("amount_paid"), F.count("amount_paid"), digits)
    return value.alias("avg_amount")


def _complete() -> Column:
    return F.count_if("is_complete").alias("complete")


def _late() -> Column:
    return F.count_if("is_late").alias("late")


def fin_total_payments(payments: DataFrame) -> DataFrame:
    return payments.filter(F.col("amount_paid") > 0).agg(_amount(), _payments())


def fin_net_revenue(payments: DataFrame) -> DataFrame:
    """Net revenue of the successful payments."""
    return payments.filter(F.col("payment_status").isin(*SUCCESSFUL)).agg(
        F.sum("amount_net").alias("net_amount"),
        _payments(),
        mean(F.sum("amount_net"), F.count("amount_net"), 2).alias("avg_net_amount"),
    )


def fin_dashboard(payments: DataFrame) -> DataFrame:
    """Two display lines out of one pass over the payments."""
    received = F.col("amount_paid") > 0
    successful = F.col("payment_status").isin(*SUCCESSFUL)
    totals = payments.agg(
        F.sum(F.when(received, F.col("amount_paid"))).alias("received"),
        F.count_if(received).alias("n_received"),
        F.sum(F.when(successful, F.col("amount_net"))).alias("net"),
        F.count_if(successful).alias("n_successful"),
    )

    def line(position: int, title: str, amount: str, number: str, unit: str) -> Column:
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(title).alias("kpi"),
            F.coalesce(s.number_with_unit(F.col(amount), "M FCFA"), F.lit("M FCFA")).alias("value_text"),
            F.concat(F.col(number).cast("string"), F.lit(unit)).alias("detail"))

    # The published titles and units.
    lines = F.array(
        line(1, "1. Montant Total Paiements", "received", "n_received", " transactions"),
        line(2, "2. Revenus Nets Réussis", "net", "n_successful", " paiements"),
    )
    return totals.select(F.inline(lines)).orderBy("position")


def fin_collections_monthly(payments: DataFrame) -> DataFrame:
    return (
        payments.filter(F.col("transaction_type") == COLLECTION)
        .groupBy(F.trunc("payment_date", "month").alias("period"))
        .agg(_payments(), _amount(), _avg_paid())
        .orderBy(F.desc("period"))
    )


def fin_agent_performance(payments: DataFrame) -> DataFrame:
    groups = payments.filter(F.col("agent_id").isNotNull()).groupBy("agent_id").agg(
        _payments(), _amount(), _complete())
    return groups.withColumn(
        "success_pct", percent(F.col("complete"), F.col("payments"), 2)).orderBy(F.desc("amount"))


def fin_recovery_by_zone(payments: DataFrame) -> DataFrame:
    groups = payments.filter(F.col("transaction_type") == RECOVERY).groupBy("zone_key").agg(
        _payments(), _amount(), _late())
    return groups.withColumn(
        "late_pct", percent(F.col("late"), F.col("payments"), 2)).orderBy(F.desc("amount"))


def fin_monthly_by_type(payments: DataFrame) -> DataFrame:
    return (
        payments.groupBy(F.trunc("payment_date", "month").alias("period"), "transaction_type")
        .agg(_payments(), _amount())
        .orderBy(F.desc("period"), "transaction_type")
    )


def fin_by_method(payments: DataFrame) -> DataFrame:
    return payments.groupBy("payment_method").agg(
        _payments(), _amount(), _avg_paid(2)).orderBy(F.desc("amount"))


def fin_global_dashboard(payments: DataFrame) -> DataFrame:
    of_type = lambda kind: F.count_if(F.col("transaction_type") == kind)
    row = payments.agg(
        _payments(), _amount(),
        of_type(COLLECTION).alias("collections"), of_type(RECOVERY).alias("recoveries"),
        _complete(), _late())
    return row.withColumn("success_pct", percent(F.col("complete"), F.col("payments"), 2))


def fin_load_stats(payments: DataFrame) -> DataFrame:
    """Load statistics per payment method and, as method ALL, over all."""
    per_method = payments.groupBy("payment_method").agg(_payments(), _amount(), _complete(), _late())
    measures = ("payments", "amount", "complete", "late")
    total = per_method.agg(*[
        F.coalesce(F.sum(m), F.lit(0)).alias(m) if m != "amount" else F.sum(m).alias(m) for m in measures
    ]).select(F.lit("ALL").alias("payment_method"), *measures)
    return per_method.select("payment_method", *measures).unionByName(total)


def kpi_receivables_summary(facts: DataFrame, dates: DataFrame, agents: DataFrame,
                            types: DataFrame, statuses: DataFrame, as_of) -> DataFrame:
    """Receivables per day, agent, type category and status label; late on ``as_of``.

    The fact is reduced per member key before it meets the four dimensions, so
    the joins see one row per key combination and no key is hot.  Averages are
    carried as sum and row count.
    """
    per_key = with_lateness(facts, as_of).groupBy(*SUMMARY_KEYS).agg(
        count_rows().alias("receivables"),
        F.sum("amount_due").alias("amount_due"),
        F.sum("amount_collected").alias("amount_collected"),
        F.sum("amount_remaining").alias("amount_remaining"),
        F.sum("recovery_rate").alias("rate_sum"),
        F.count("recovery_rate").alias("rate_rows"),
        F.sum("recovery_days").alias("day_sum"),
        F.count("recovery_days").alias("day_rows"),
        F.count_if("is_late").alias("late"),
    )
    return labelled_summary(per_key, dates, agents, types, statuses)


#: The member keys of the summary.
SUMMARY_KEYS = ("created_date_key", "agent_key", "type_key", "status_key")


def labelled_summary(per_key: DataFrame, dates: DataFrame, agents: DataFrame,
                     types: DataFrame, statuses: DataFrame) -> DataFrame:
    """Sums per member key with the members' labels."""
    calendar = dates.select(F.col("date_key").alias("created_date_key"), "date")
    members = agents.filter("is_current").select(
        F.col("durable_key").alias("agent_key"), F.col("full_name").alias("agent_name"))
    kinds = types.select("type_key", "category")
    states = statuses.select("status_key", "status_label", "is_closed")
    star = (
        per_key
        .join(F.broadcast(kinds), "type_key", "left")      # five seeded rows
        .join(F.broadcast(states), "status_key", "left")   # six seeded rows
        .join(calendar, "created_date_key", "left")
        .join(members, "agent_key", "left")
    )
    total = lambda c: F.sum(c).alias(c)
    return star.groupBy("date", "agent_name", "category", "status_label").agg(
        total("receivables"), total("amount_due"), total("amount_collected"), total("amount_remaining"),
        mean(F.sum("rate_sum"), F.sum("rate_rows"), 8).alias("avg_recovery_rate"),
        mean(F.sum("day_sum"), F.sum("day_rows")).alias("avg_recovery_days"),
        total("late"),
        F.sum(F.when(F.col("is_closed"), F.col("receivables")).otherwise(0)).alias("closed"),
    )
