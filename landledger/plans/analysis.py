"""Star-schema analysis queries (counts of fact rows).

All measures here add up, so the fact is first reduced to one row per member
key (partially before any exchange) and only that small frame meets the
dimensions.  A member holding much of the fact is one row by then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.functions.measures import count_rows, mean, percent, with_share


def _by_status(fact: DataFrame, statuses: DataFrame, *measures: Column) -> DataFrame:
    """Fact reduced per status key, with the attributes of the key."""
    return fact.groupBy("status_key").agg(*measures).join(statuses, "status_key")


def _rows() -> Column:
    return count_rows().alias("rows")


def _total(column: str) -> Column:
    return F.sum(column).alias(column)


def _avg(total: str, digits: int | None = None, rows: str = "rows") -> Column:
    return mean(F.sum(total), F.sum(rows), digits)


def an_by_status(fact: DataFrame, statuses: DataFrame) -> DataFrame:
    groups = (_by_status(fact, statuses, _rows())
              .groupBy("status_label", "status").agg(F.sum("rows").alias("requests")))
    return with_share(groups, "requests", "share_pct").orderBy(F.desc("requests"))


def an_by_type(fact: DataFrame, statuses: DataFrame) -> DataFrame:
    groups = (_by_status(fact, statuses, _rows())
              .groupBy("type_label", "request_type").agg(F.sum("rows").alias("requests")))
    return with_share(groups, "requests", "share_pct").orderBy(F.desc("requests"))


def an_by_entity_left(fact: DataFrame, zones: DataFrame, plots: DataFrame, companies: DataFrame) -> DataFrame:
    """Requests per zone, plot and company, keeping requests without a member."""
    per_ids = fact.groupBy("zone_id", "plot_id", "company_id").agg(_rows(), _total("financing"), _total("jobs"))
    star = (
        per_ids
        .join(zones.select("zone_id", "zone_name"), "zone_id", "left")
        .join(plots.select("plot_id", "plot_number"), "plot_id", "left")
        .join(companies.select("company_id", "company_name"), "company_id", "left")
    )
    return star.groupBy("zone_name", "plot_number", "company_name").agg(
        F.sum("rows").alias("requests"), _total("financing"), _total("jobs"),
    ).orderBy(F.desc("requests"), F.desc("financing"))


def _priority_label() -> Column:
    return F.when(F.col("n_priority") == 1, "Prioritaire").otherwise("Normale").alias("priority_label")


def an_priority(fact: DataFrame) -> DataFrame:
    return fact.groupBy(_priority_label()).agg(
        count_rows().alias("requests"),
        mean(F.sum("financing"), F.count("financing"), 2).alias("avg_financing"),
        mean(F.sum("jobs"), F.count("jobs"), 0).alias("avg_jobs"),
        mean(F.sum("processing_days"), F.count("processing_days"), 1).alias("avg_days"),
    ).orderBy(F.desc("requests"))


def an_priority_short(fact: DataFrame) -> DataFrame:
    return fact.groupBy(_priority_label()).agg(
        count_rows().alias("requests"),
        mean(F.sum("financing"), F.count("financing"), 0).alias("avg_financing"),
        mean(F.sum("processing_days"), F.count("processing_days"), 1).alias("avg_days"),
    )


def _timed(fact: DataFrame, statuses: DataFrame) -> DataFrame:
    """How often each duration occurs per status key (durations above zero)."""
    return (
        fact.filter(F.col("processing_days") > 0)
        .groupBy("status_key", "processing_days").agg(_rows())
        .join(statuses, "status_key")
        .withColumn("days", F.col("processing_days") * F.col("rows"))
    )


def an_delay_by_status_type(fact: DataFrame, statuses: DataFrame) -> DataFrame:
    """Duration statistics; the median is taken over the duration counts."""
    days = F.col("processing_days")
    return _timed(fact, statuses).groupBy("status_label", "type_label").agg(
        F.sum("rows").alias("requests"),
        _avg("days", 1).alias("avg_days"),
        F.min(days).alias("min_days"),
        F.max(days).alias("max_days"),
        F.round(F.percentile(days, F.lit(0.5), F.col("rows")), 1).alias("median_days"),
    ).orderBy(F.desc("avg_days"))


def an_delay_by_status(fact: DataFrame, statuses: DataFrame) -> DataFrame:
    return _timed(fact, statuses).groupBy("status_label").agg(
        F.sum("rows").alias("requests"),
        _avg("days", 1).alias("avg_days"),
        F.min("processing_days").alias("min_days"),
        F.max("processing_days").alias("max_days"),
    )


def an_acceptance_by_type(fact: DataFrame, statuses: DataFrame) -> DataFrame:
    """Rates per request type; the acceptance rate is 0 when nothing is decided."""
    counters = ("n_accepted", "n_rejected", "n_finalised", "n_pending")
    groups = _by_status(fact, statuses, _rows(), *[_total(c) for c in counters]).groupBy("type_label").agg(
        F.sum("rows").alias("requests"),
        *[F.sum(c).alias(c.removeprefix("n_")) for c in counters])
    return groups.withColumns({
        "acceptance_pct": F.when(F.col("finalised") > 0, percent(F.col("accepted"), F.col("finalised"), 2))
                           .otherwise(F.lit(0.0)),
        "finalisation_pct": percent(F.col("finalised"), F.col("requests"), 2),
    }).orderBy(F.desc("acceptance_pct"))


def _by_day(fact: DataFrame, dates: DataFrame, *measures: Column) -> DataFrame:
    """Fact reduced per creation day, with the calendar of the day."""
    return (fact.groupBy(F.col("creation_date_key").alias("date_key")).agg(*measures)
                .join(dates, "date_key"))


def an_priority_trend(fact: DataFrame, dates: DataFrame) -> DataFrame:
    groups = _by_day(fact, dates, _rows(), _total("n_priority")).groupBy(
        "year", "month", "month_name_fr", "year_month",
    ).agg(F.sum("rows").alias("requests"), F.sum("n_priority").alias("priority_requests"))
    ordered = groups.orderBy("year", "month")
    return ordered.select(
        "year", "month_name_fr", "year_month", "priority_requests",
        (F.col("requests") - F.col("priority_requests")).alias("normal_requests"),
        "requests",
        percent(F.col("priority_requests"), F.col("requests"), 2).alias("priority_pct"),
    )


def an_monthly_full(fact: DataFrame, dates: DataFrame) -> DataFrame:
    counters = ("n_in_zone", "n_out_of_zone", "n_priority", "n_accepted", "n_rejected", "n_pending")
    days = _by_day(fact, dates, _rows(), *[_total(c) for c in counters], _total("processing_days"),
                   _total("financing"), _total("jobs"))
    return days.groupBy("year_month").agg(
        F.sum("rows").alias("requests"),
        *[F.sum(c).alias(c.removeprefix("n_")) for c in counters],
        _avg("processing_days", 1).alias("avg_days"),
        _total("financing"), _total("jobs"),
    ).orderBy("year_month")


def an_top_zones(fact: DataFrame, zones: DataFrame, k: int = 10) -> DataFrame:
    per_zone = fact.groupBy("zone_id").agg(
        _rows(), _total("n_accepted"), _total("financing"), _total("jobs"), _total("processing_days"))
    return (
        per_zone.join(zones.select("zone_id", "zone_name", "zone_code", "status_label"), "zone_id")
        .groupBy("zone_name", "zone_code", "status_label").agg(
            F.sum("rows").alias("requests"), F.sum("n_accepted").alias("accepted"),
            _total("financing"), _total("jobs"), _avg("processing_days", 1).alias("avg_days"))
        .orderBy(F.desc("requests"), "zone_code", "zone_name").limit(k)
    )


def an_total(fact: DataFrame) -> DataFrame:
    return fact.agg(count_rows().alias("requests"))


def an_type_financing(fact: DataFrame, statuses: DataFrame) -> DataFrame:
    return _by_status(fact, statuses, _rows(), _total("financing"), _total("jobs")).groupBy("type_label").agg(
        F.sum("rows").alias("requests"), _total("financing"), _avg("jobs").alias("avg_jobs"))


def requests_per_company(fact: DataFrame, companies: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` companies with most requests; the name breaks ties."""
    per_company = fact.groupBy("company_id").agg(F.count("request_id").alias("rows"))
    return (
        per_company.join(companies.select("company_id", "company_name"), "company_id")
        .groupBy("company_name").agg(F.sum("rows").alias("requests"))
        .orderBy(F.desc("requests"), "company_name").limit(k)
    )
