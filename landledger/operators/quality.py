"""Data-quality rules: keys, ranges, references, reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landledger.functions.measures import count_rows
from landledger.sources.seeds import small_frame


class Rule(NamedTuple):
    table: str
    column: str
    unique: bool
    not_null: bool


# Fixed list: column rules of the staging tables, dimensions and request fact.
COLUMN_RULES = (
    Rule("requests", "request_id", True, True),
    Rule("companies", "company_id", True, True),
    Rule("plots", "plot_id", True, True),
    Rule("zones", "zone_id", True, True),
    Rule("dim_company", "company_key", True, True),
    Rule("dim_company", "company_id", True, True),
    Rule("dim_company", "company_name", False, True),
    Rule("dim_zone", "zone_key", True, True),
    Rule("dim_zone", "zone_id", True, True),
    Rule("dim_zone", "zone_code", True, True),
    Rule("dim_plot", "plot_key", True, True),
    Rule("dim_plot", "plot_id", True, True),
    Rule("dim_plot", "plot_number", False, True),
    Rule("dim_request_status", "status_key", True, True),
    Rule("dim_request_status", "status", False, True),
    Rule("dim_request_status", "request_type", False, True),
    Rule("dim_date", "date_key", True, True),
    Rule("dim_date", "date", True, True),
    Rule("fact_requests", "request_id", True, True),
    Rule("fact_requests", "creation_date_key", False, True),
    Rule("fact_requests", "status_key", False, True),
    Rule("fact_requests", "request_count", False, True),
)

# Fixed list: column rules of the collection tables of one batch.
COLLECTION_RULES = (
    Rule("dim_agent", "agent_key", True, True),
    Rule("dim_agent", "durable_key", False, True),
    Rule("fact_receivables", "receivable_id", True, True),
    Rule("fact_receivables", "receivable_fact_key", True, True),
    Rule("fact_receivables", "status_key", False, True),
    Rule("fact_recoveries", "recovery_id", True, True),
    Rule("fact_recoveries", "recovery_fact_key", True, True),
)
# Fixed list: the ids that every extracted row must have.
SOURCE_KEYS = {"agents": "agent_id", "receivables": "receivable_id", "recoveries": "recovery_id"}


class BrokenLoad(ValueError):
    """A load that would store broken keys."""


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def missing_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all columns in one pass without a shuffle of rows."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column", "violations")


def repeated_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of values that occur more than once, per column.

    All columns of a table go through one exchange; repeats are reduced before
    it, so a value that fills much of the table stays cheap.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    values = texts.unpivot([], list(columns), "column", "value").filter(F.col("value").isNotNull())
    per_value = values.groupBy("column", "value").agg(count_rows().alias("n"))
    return per_value.groupBy("column").agg(F.count_if(F.col("n") > 1).alias("violations"))


def dq_rules(spark: SparkSession, tables: Mapping[str, DataFrame],
             rules: Sequence[Rule] = COLUMN_RULES) -> DataFrame:
    """One row per rule: check, table, column, violations (0 when it holds)."""
    found = []
    for name in dict.fromkeys(r.table for r in rules):
        mine = [r for r in rules if r.table == name]
        unique = [r.column for r in mine if r.unique]
        filled = [r.column for r in mine if r.not_null]
        if unique:
            found.append(repeated_values(tables[name], unique)
                         .select(F.lit("unique").alias("check"), F.lit(name).alias("table"), "column", "violations"))
        if filled:
            found.append(missing_values(tables[name], filled)
                         .select(F.lit("not_null").alias("check"), F.lit(name).alias("table"), "column", "violations"))
    listed = [(check, r.table, r.column) for r in rules
              for check, wanted in (("unique", r.unique), ("not_null", r.not_null)) if wanted]
    wanted = small_frame(spark, tuple(listed), "check string, table string, column string")
    return (wanted.join(_stack(found), ["check", "table", "column"], "left")
                  .withColumn("violations", F.coalesce("violations", F.lit(0))))


def source_keys(extracts: Mapping[str, DataFrame]) -> DataFrame:
    """Extracted rows without an id, per source; one pass each, of the id column only."""
    return _stack([missing_values(df, [SOURCE_KEYS[name]]).select(
        F.lit("source_key").alias("check"), F.lit(name).alias("table"), "column", "violations")
        for name, df in extracts.items()])


def refuse_broken(report: DataFrame, load: str) -> None:
    """Stop a load whose report holds a broken key.  The report has one row per rule;
    range checks are reported only, as rows out of range go to quarantine."""
    broken = report.filter((F.col("check") != "range") & (F.col("violations") > 0)).collect()
    if broken:
        found = ", ".join(sorted(f"{r.check} {r.table}.{r.column}: {r.violations}" for r in broken))
        raise BrokenLoad(f"load {load} is refused, nothing was merged: {found}")


# Fixed list: range checks of the fact tables.
RANGE_CHECKS = {
    "fact_receivables": {
        "amount_due": "amount_due >= 0",
        "amount_collected": "amount_collected >= 0",
        "recovery_rate": "recovery_rate >= 0 AND recovery_rate <= 1",
    },
    "fact_recoveries": {
        "payment": "payment >= 0",
        "fee": "fee >= 0",
    },
}


def dq_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Violated range checks per column; a check on NULL is not a violation."""
    def of(name: str) -> DataFrame:
        checks = RANGE_CHECKS[name]
        counted = tables[name].agg(*[F.count_if(~F.expr(rule)).alias(c) for c, rule in checks.items()])
        return counted.unpivot([], list(checks), "column", "violations").select(
            F.lit("range").alias("check"), F.lit(name).alias("table"), "column", "violations")
    return _stack([of(name) for name in RANGE_CHECKS])


def orphan_rows(fact: DataFrame, key: str, dimension: DataFrame, dimension_key: str,
                count_missing: bool = False) -> DataFrame:
    """Fact rows whose key the dimension does not hold.

    The fact is first reduced to one row per key with its count, so the anti
    join never sees a repeated key.  A NULL key is an orphan only on request.
    """
    per_key = fact.groupBy(F.col(key).alias("_key")).agg(count_rows().alias("rows"))
    if not count_missing:
        per_key = per_key.filter(F.col("_key").isNotNull())
    members = dimension.select(F.col(dimension_key).alias("_key"))
    return per_key.join(members, "_key", "left_anti").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("orphans"))


def dq_orphans(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Orphans of every reference between those of the facts and dimensions that are given."""
    references = (
        ("fact_receivables", "agent_key", "dim_agent", "durable_key", False),
        ("fact_receivables", "type_key", "dim_receivable_type", "type_key", False),
        ("fact_receivables", "status_key", "dim_receivable_status", "status_key", False),
        ("fact_recoveries", "receivable_id", "fact_receivables", "receivable_id", False),
        ("fact_recoveries", "agent_key", "dim_agent", "durable_key", False),
        ("fact_requests", "creation_date_key", "dim_date", "date_key", True),
        ("fact_requests", "company_id", "dim_company", "company_id", True),
        ("fact_requests", "status_key", "dim_request_status", "status_key", True),
    )
    return _stack([
        orphan_rows(tables[fact], key, tables[dimension], dimension_key, missing).select(
            F.lit(fact).alias("fact"), F.lit(key).alias("key"),
            F.lit(dimension).alias("dimension"), "orphans")
        for fact, key, dimension, dimension_key, missing in references
        if fact in tables and dimension in tables
    ])


def dq_missing_keys(fact: DataFrame) -> DataFrame:
    """Requests without a zone and without a company key."""
    # The published labels.
    counted = fact.agg(
        F.count_if(F.col("zone_key").isNull()).alias("Demandes sans zone"),
        F.count_if(F.col("company_key").isNull()).alias("Demandes sans entreprise"))
    return counted.unpivot([], counted.columns, "problem", "requests")


# --- counts and reconciliation --------------------------------------------------------

def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, in name order."""
    return _stack([
        df.agg(count_rows().alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]).orderBy("table")


def recon_counts(source: DataFrame, fact: DataFrame) -> DataFrame:
    return _stack([
        df.agg(count_rows().alias("requests")).select(F.lit(side).alias("side"), "requests")
        for side, df in (("Source", source), ("DWH", fact))
    ])


def recon_status(source: DataFrame, fact: DataFrame, statuses: DataFrame) -> DataFrame:
    """Requests per status in the source and in the warehouse, side by side."""
    zero = F.lit(0).cast("bigint")
    in_source = source.groupBy("status").agg(count_rows().alias("source_requests"))
    in_fact = (fact.groupBy("status_key").agg(count_rows().alias("rows"))
               .join(statuses.select("status_key", "status"), "status_key")
               .groupBy("status").agg(F.sum("rows").alias("warehouse_requests")))
    both = in_source.withColumn("warehouse_requests", zero).unionByName(
        in_fact.withColumn("source_requests", zero))
    return both.groupBy("status").agg(
        F.sum("source_requests").alias("source_requests"),
        F.sum("warehouse_requests").alias("warehouse_requests"),
    ).withColumn("difference", F.col("source_requests") - F.col("warehouse_requests"))
