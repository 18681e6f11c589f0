"""Request KPIs (distinct requests).

``COUNT(DISTINCT request)`` beside sums is planned by Spark in two levels: first
per group and request, then per group.  The first exchange is spread by request
id, so a group holding much of the data is not drawn into one task, and where
the fact is already partitioned by request id no exchange is added for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.functions.measures import avg_of, beside, mean, percent, with_share, with_share_of_many

REQUEST = "request_id"


def _n() -> Column:
    return F.count_distinct(F.col(REQUEST))


def _sum(column: str, alias: str | None = None) -> Column:
    return F.sum(column).alias(alias or column)


def _avg_days(alias: str = "avg_days", digits: int | None = 1) -> Column:
    return avg_of(F.col("processing_days"), digits).alias(alias)


# --- roll-ups -------------------------------------------------------------------

def kpi_by_status(fact: DataFrame) -> DataFrame:
    """Requests per outcome; the first matching indicator decides."""
    bucket = (
        F.when(F.col("n_pending") > 0, "EN_COURS")
         .when(F.col("n_accepted") > 0, "VALIDÉE")
         .when(F.col("n_rejected") > 0, "REJETÉE")
         .otherwise("AUTRE")
    )
    groups = fact.groupBy(bucket.alias("status")).agg(
        _n().alias("requests"), _sum("financing"), _sum("jobs"))
    return with_share(groups, "requests", "share_pct").orderBy(F.desc("requests"))


def kpi_by_zone_type(fact: DataFrame) -> DataFrame:
    kind = F.when(F.col("n_in_zone") > 0, "ZONE_INDUSTRIELLE").otherwise("HORS_ZONE_INDUSTRIELLE")
    groups = fact.groupBy(kind.alias("zone_type")).agg(
        _n().alias("requests"), _sum("financing"), _sum("jobs"), _avg_days(digits=None))
    return with_share(groups, "requests", "share_pct").orderBy(F.desc("requests"))


def entity_rollup(fact: DataFrame, zones: DataFrame, plots: DataFrame, companies: DataFrame) -> DataFrame:
    """Requests per zone, plot and company, unordered.

    No join strategy is forced: the optimizer broadcasts a dimension only when
    its measured size is below the threshold, and otherwise sorts and splits
    hot keys.
    """
    star = (
        fact
        .join(zones.select("zone_id", "zone_name"), "zone_id")
        .join(plots.select("plot_id", "plot_number"), "plot_id")
        .join(companies.select("company_id", "company_name"), "company_id")
    )
    return star.groupBy("zone_name", "plot_number", "company_name").agg(
        _n().alias("requests"), _sum("financing"), _sum("jobs"), _avg_days(),
        _sum("n_accepted", "accepted"), _sum("n_rejected", "rejected"), _sum("n_pending", "pending"))


def kpi_by_entity(fact: DataFrame, zones: DataFrame, plots: DataFrame, companies: DataFrame) -> DataFrame:
    return entity_rollup(fact, zones, plots, companies).orderBy(F.desc("requests"), F.desc("financing"))


def kpi_top_entities(fact: DataFrame, zones: DataFrame, plots: DataFrame, companies: DataFrame,
                     k: int = 5) -> DataFrame:
    """The ``k`` busiest entities; names break ties so the list is stable."""
    return (
        entity_rollup(fact, zones, plots, companies)
        .select("zone_name", "plot_number", "company_name", "requests", "financing")
        .orderBy(F.desc("requests"), F.desc("financing"), "zone_name", "plot_number", "company_name")
        .limit(k)
    )


def kpi_priority_split(fact: DataFrame) -> DataFrame:
    level = F.when(F.col("n_priority") > 0, "PRIORITAIRE").otherwise("NORMALE")
    groups = fact.groupBy(level.alias("priority_level")).agg(
        _n().alias("requests"), _sum("financing"), _sum("jobs"), _avg_days(),
        _sum("n_accepted", "accepted"))
    return with_share(groups, "requests", "share_pct").orderBy(F.desc("priority_level"))


def kpi_priority_trend(fact: DataFrame, dates: DataFrame) -> DataFrame:
    calendar = dates.select("date_key", "year", "month", "month_name_fr", "quarter")
    groups = (
        fact.join(calendar, fact["creation_date_key"] == calendar["date_key"])
        .groupBy("year", "month", "month_name_fr", "quarter")
        .agg(_n().alias("requests"), _sum("n_priority", "priority_requests"),
             _sum("financing"), _sum("jobs"), _avg_days())
    )
    return groups.select(
        "year", "month", "month_name_fr", "quarter", "requests", "priority_requests",
        (F.col("requests") - F.col("priority_requests")).alias("normal_requests"),
        percent(F.col("priority_requests"), F.col("requests"), 2).alias("priority_pct"),
        "financing", "jobs", "avg_days",
    ).orderBy("year", "month")


def kpi_monthly(fact: DataFrame) -> DataFrame:
    created = F.col("created_at")
    groups = fact.filter(created.isNotNull()).groupBy(
        F.date_format(created, "yyyy-MM").alias("period"),
        F.year(created).alias("year"), F.month(created).alias("month"),
    ).agg(
        _n().alias("requests"), _sum("n_accepted", "accepted"), _sum("n_rejected", "rejected"),
        _sum("n_priority", "priority_requests"), _avg_days(), _sum("financing"), _sum("jobs"),
        _sum("n_finalised", "_finalised"),
    )
    return groups.withColumns({
        "acceptance_pct": percent(F.col("accepted"), F.col("_finalised"), 1),
        "priority_pct": percent(F.col("priority_requests"), F.col("requests"), 1),
    }).drop("_finalised").orderBy("period")


def kpi_monthly_summary(fact: DataFrame) -> DataFrame:
    return kpi_monthly(fact).select("period", "requests", "accepted", "acceptance_pct", "financing")


def kpi_last_12_months(fact: DataFrame, months: int = 12) -> DataFrame:
    return kpi_monthly(fact).orderBy(F.desc("period")).limit(months)


def zone_rollup(fact: DataFrame, zones: DataFrame) -> DataFrame:
    members = zones.select("zone_id", "zone_name", "zone_code", "region")
    groups = fact.join(members, "zone_id").groupBy("zone_name", "zone_code", "region").agg(
        _n().alias("requests"), _sum("n_accepted", "accepted"), _sum("n_pending", "pending"),
        _sum("n_priority", "priority_requests"), _avg_days(), _sum("financing"), _sum("jobs"),
        _sum("n_finalised", "_finalised"),
    )
    rated = groups.withColumn("acceptance_pct", percent(F.col("accepted"), F.col("_finalised"), 1))
    return with_share_of_many(rated, "requests", "share_pct", digits=1).drop("_finalised")


def kpi_by_zone(fact: DataFrame, zones: DataFrame) -> DataFrame:
    return zone_rollup(fact, zones).orderBy(F.desc("requests"))


def kpi_zone_summary(fact: DataFrame, zones: DataFrame) -> DataFrame:
    return kpi_by_zone(fact, zones).select(
        "zone_name", "zone_code", "requests", "accepted", "financing", "jobs")


def kpi_top_zones(fact: DataFrame, zones: DataFrame, k: int = 5) -> DataFrame:
    return (
        zone_rollup(fact, zones)
        .select("zone_name", "requests", "acceptance_pct", "financing")
        .orderBy(F.desc("requests"), "zone_name").limit(k)
    )


# --- durations -------------------------------------------------------------------

def duration_statistics(rows: DataFrame) -> DataFrame:
    """Mean, median and range over rows, and distinct requests per class.

    The four distinct counts come from one pass grouped by request instead of
    one copy of the data per count.  The exact median keeps one counter per
    different day count, which the calendar bounds.
    """
    days = F.col("processing_days")
    over_rows = rows.agg(
        avg_of(days, 1).alias("avg_days"),
        F.round(F.percentile(days, F.lit(0.5)), 1).alias("median_days"),
        F.min(days).alias("min_days"),
        F.max(days).alias("max_days"),
    )
    per_request = rows.filter(F.col(REQUEST).isNotNull()).groupBy(REQUEST).agg(
        F.max(days <= 7).alias("week"),
        F.max(days.between(8, 15)).alias("fortnight"),
        F.max(days > 15).alias("longer"),
        F.max(F.col("n_finalised") > 0).alias("finalised"),
    )
    classes = per_request.agg(
        F.count_if("week").alias("up_to_7_days"),
        F.count_if("fortnight").alias("from_8_to_15_days"),
        F.count_if("longer").alias("over_15_days"),
        F.count_if("finalised").alias("finalised_requests"),
    )
    return beside(over_rows, classes)


def kpi_delay_stats(fact: DataFrame) -> DataFrame:
    return duration_statistics(fact.filter(F.col("processing_days") > 0))


def kpi_delay_finalised(fact: DataFrame) -> DataFrame:
    return duration_statistics(fact.filter((F.col("n_finalised") > 0) & (F.col("processing_days") > 0)))


# --- one-row KPIs, fused ------------------------------------------------------------

def request_scorecard(fact: DataFrame) -> DataFrame:
    """Every measure of the one-row KPIs from a single pass over the fact.

    First per request (so distinct counts are exact), then over all requests.
    A KPI that selects some of the columns makes the optimizer drop the rest.
    """
    finalised, accepted = F.col("n_finalised") > 0, F.col("n_accepted") > 0
    days, financing, jobs = F.col("processing_days"), F.col("financing"), F.col("jobs")
    counters = {f"n_{x}": x for x in (
        "pending", "accepted", "rejected", "finalised", "priority", "in_zone", "out_of_zone")}

    per_request = fact.groupBy(REQUEST).agg(
        F.max(finalised).alias("any_finalised"),
        F.max(accepted).alias("any_accepted"),
        *[F.sum(c).alias(name) for c, name in counters.items()],
        F.sum(financing).alias("financing"),
        F.count(financing).alias("financing_rows"),
        F.sum(jobs).alias("jobs"),
        F.sum(F.when(finalised, days)).alias("finalised_days"),
        F.count(F.when(finalised, days)).alias("finalised_rows"),
        F.sum(F.when(finalised & (days > 0), days)).alias("timed_days"),
        F.count_if(finalised & (days > 0)).alias("timed_rows"),
        F.sum(F.when(accepted, financing)).alias("accepted_financing"),
        F.sum(F.when(accepted, jobs)).alias("accepted_jobs"),
        F.count_if(accepted).alias("accepted_rows"),
        F.count_if(accepted & (financing > 0)).alias("accepted_financed"),
        F.count_if(accepted & (jobs > 0)).alias("accepted_with_jobs"),
        F.sum(F.when(finalised, F.col("n_accepted"))).alias("finalised_accepted"),
    )
    known = F.col(REQUEST).isNotNull()
    summed = [c for c in per_request.columns if c not in (REQUEST, "any_finalised", "any_accepted")]
    # back to the width of a single sum: quotients then keep their decimals
    total = lambda c: F.sum(c).cast("decimal(25,2)") if c.endswith("financing") else F.sum(c)
    return per_request.agg(
        F.count(REQUEST).alias("requests"),
        F.count_if(known & F.col("any_finalised")).alias("finalised_requests"),
        F.count_if(known & F.col("any_accepted")).alias("accepted_requests"),
        *[total(c).alias(c) for c in summed],
    )


def kpi_acceptance(fact: DataFrame) -> DataFrame:
    """Acceptance and rejection rate of the decided requests."""
    return request_scorecard(fact).select(
        percent(F.col("accepted"), F.col("finalised"), 2).alias("acceptance_pct"),
        "accepted", "rejected", "pending", "finalised", "requests",
        percent(F.col("rejected"), F.col("finalised"), 2).alias("rejection_pct"),
    )


def kpi_acceptance_finalised(fact: DataFrame) -> DataFrame:
    """Acceptance over the finalised requests only."""
    return request_scorecard(fact).select(
        percent(F.col("finalised_accepted"), F.col("finalised"), 2).alias("acceptance_pct"),
        F.col("finalised_accepted").alias("accepted"),
        F.when(F.col("finalised") > 0, F.col("finalised")).alias("finalised"),
        F.col("finalised_requests").alias("requests"),
    )


def kpi_volume(fact: DataFrame) -> DataFrame:
    return request_scorecard(fact).select(
        "requests", "pending", "accepted", "rejected", "finalised",
        F.col("priority").alias("priority_requests"), "in_zone", "out_of_zone",
        percent(F.col("priority"), F.col("requests"), 1).alias("priority_pct"),
        percent(F.col("in_zone"), F.col("requests"), 1).alias("in_zone_pct"),
    )


def financial_columns() -> dict[str, Column]:
    """Financing and jobs of the accepted requests, over the scorecard."""
    rows, money, jobs = F.col("accepted_rows"), F.col("accepted_financing"), F.col("accepted_jobs")
    seen = lambda column: F.when(rows > 0, F.col(column))
    return {
        "requests": F.col("accepted_requests"),
        "financing": money,
        "avg_financing": mean(money, rows, 0),
        "jobs": jobs,
        "avg_jobs": mean(jobs, rows, 1),
        "cost_per_job": F.round(money / F.nullifzero(jobs), 0),
        "requests_with_financing": seen("accepted_financed"),
        "requests_with_jobs": seen("accepted_with_jobs"),
        "with_financing_pct": percent(seen("accepted_financed"), F.col("accepted_requests"), 1),
    }


def executive_columns() -> dict[str, Column]:
    """The executive figures and their alert state, over the scorecard."""
    acceptance = percent(F.col("accepted"), F.col("finalised"), 2)
    avg_days = mean(F.col("finalised_days"), F.col("finalised_rows"), 1)
    return {
        "requests": F.col("requests"),
        "pending": F.col("pending"),
        "finalised": F.col("finalised"),
        "acceptance_pct": acceptance,
        "avg_days": avg_days,
        "priority_requests": F.col("priority"),
        "priority_pct": percent(F.col("priority"), F.col("requests"), 1),
        "financing": F.col("financing"),
        "avg_financing": mean(F.col("financing"), F.col("financing_rows"), 0),
        "jobs": F.col("jobs"),
        "in_zone": F.col("in_zone"),
        "out_of_zone": F.col("out_of_zone"),
        # The published thresholds and alert texts.
        "alert_status": F.when(acceptance < 30, "ALERTE: Taux acceptation faible")
                         .when(avg_days > 15, "ALERTE: Délai traitement élevé")
                         .otherwise("NORMAL"),
    }


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


def kpi_financial_performance(fact: DataFrame) -> DataFrame:
    return request_scorecard(fact).select(*_named(financial_columns()))


def kpi_executive(fact: DataFrame) -> DataFrame:
    return request_scorecard(fact).select(*_named(executive_columns()))


def kpi_summary_row(fact: DataFrame) -> DataFrame:
    """Executive, financial and duration figures in one row.

    The first two come from one scorecard, the durations need their own pass
    for the median.
    """
    executive, financial = executive_columns(), financial_columns()
    shown = ("requests", "pending", "finalised", "acceptance_pct", "avg_days", "financing", "jobs", "alert_status")
    card = request_scorecard(fact).select(*_named({
        **{name: executive[name] for name in shown},
        "accepted_requests": financial["requests"],
        "accepted_financing": financial["financing"],
        "avg_financing": financial["avg_financing"],
        "accepted_jobs": financial["jobs"],
        "cost_per_job": financial["cost_per_job"],
        "with_financing_pct": financial["with_financing_pct"],
    }))
    durations = kpi_delay_finalised(fact).withColumnRenamed("avg_days", "finalised_avg_days")
    return beside(card, durations.drop("finalised_requests"))


def business_totals(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count_distinct("company_id").alias("companies"),
        F.coalesce(F.sum("financing"), F.lit(0)).alias("financing"),
        F.coalesce(F.sum("jobs"), F.lit(0)).alias("jobs"),
    )
