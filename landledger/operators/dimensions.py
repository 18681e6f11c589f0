"""Conformed dimensions of the request star and the calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landledger.functions import scalars as s
from landledger.sources.extract import ACCEPTED, DOCUMENTS_REJECTED, PENDING, REJECTED

IN_ZONE = "ZONE_INDUSTRIELLE"
OUT_OF_ZONE = "HORS_ZONE_INDUSTRIELLE"


def labelled(column: str, labels: dict[str, str], otherwise: str) -> Column:
    """Label per code, with a fallback that also covers a missing code."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(column)), F.lit(otherwise))


# --- calendar -----------------------------------------------------------------

def date_spine(spark: SparkSession, start: dt.date = dt.date(2020, 1, 1),
               end: dt.date = dt.date(2030, 12, 31)) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = (end - start).days + 1
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"))


def spine_of(df: DataFrame, column: str) -> DataFrame:
    """One row per day between the first and the last date found in a column."""
    bounds = df.agg(F.min(column).cast("date").alias("first"), F.max(column).cast("date").alias("last"))
    return bounds.select(F.explode(F.sequence("first", "last")).alias("date"))


def request_days(requests: DataFrame) -> DataFrame:
    """Every day from the first to the last day on which a request was created or
    modified, so that no request falls outside the calendar."""
    bounds = requests.agg(
        F.least(F.min("created_at"), F.min("modified_at")).cast("date").alias("first"),
        F.greatest(F.max("created_at"), F.max("modified_at")).cast("date").alias("last"))
    return bounds.select(F.explode(F.sequence("first", "last")).alias("date"))


def dim_date(spine: DataFrame) -> DataFrame:
    day = F.col("date")
    weekday = s.weekday_number(day)
    return spine.select(
        s.date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        weekday.alias("weekday"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("iso_week"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short"),
        F.date_format(day, "EEEE").alias("weekday_name"),
        F.date_format(day, "EEE").alias("weekday_short"),
        s.weekday_fr(weekday).alias("weekday_name_fr"),
        s.month_fr(F.month(day)).alias("month_name_fr"),
        s.quarter_label(day).alias("quarter_label"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        weekday.isin(0, 6).alias("is_weekend"),
        (~weekday.isin(0, 6)).alias("is_workday"),
        F.date_sub(day, 1).alias("previous_date"),
        F.date_add(day, 1).alias("next_date"),
    )


# --- members --------------------------------------------------------------------

def dim_company(companies: DataFrame) -> DataFrame:
    """Companies with their legal form class; the first matching text wins."""
    form = F.col("legal_form")
    return companies.select(
        s.prefixed_key("entreprise_", F.col("company_id")).alias("company_key"),
        "company_id", "company_name", "phone", "email", "trade_register", "tax_account",
        "legal_form", "address", "founded_on", "activity_id",
        F.when(form.ilike("%sarl%"), "SARL")
         .when(form.ilike("%sa%"), "SA")
         .when(form.ilike("%sci%"), "SCI")
         .when(form.ilike("%eurl%"), "EURL")
         .otherwise("AUTRE").alias("legal_form_class"),
        "created_at", "modified_at",
    )


def dim_plot(plots: DataFrame) -> DataFrame:
    return plots.select(
        s.prefixed_key("lot_", F.col("plot_id")).alias("plot_key"),
        "plot_id", "plot_number", "block", "area", "area_unit", "price", "status", "priority",
        "is_serviced", "description", "coordinates", "zone_id",
        labelled("status", {"disponible": "Disponible", "occupé": "Occupé"}, "Autre").alias("status_label"),
        labelled("priority", {"normale": "Normal", "haute": "Haute Priorité"}, "Autre").alias("priority_label"),
        F.when(F.col("is_serviced"), "Viabilisé").otherwise("Non Viabilisé").alias("serviced_label"),
        s.hectares(F.col("area"), F.col("area_unit")).alias("area_hectares"),
        "created_at", "modified_at",
    )


def dim_zone(zones: DataFrame) -> DataFrame:
    labels = {"actif": "Active", "inactif": "Inactive", "en_construction": "En Construction"}
    return zones.select(
        s.prefixed_key("zone_", F.col("zone_id")).alias("zone_key"),
        "zone_id", "zone_code", "zone_name", "description", "area", "area_unit",
        "plots_available", "address", "status", "region",
        labelled("status", labels, "Autre").alias("status_label"),
        s.hectares(F.col("area"), F.col("area_unit")).alias("area_hectares"),
        "created_at", "modified_at",
    )


def request_status_key(status: str = "status", request_type: str = "request_type",
                       step: str = "current_step") -> Column:
    """Composite text key; missing parts read UNKNOWN, a missing step 0."""
    return F.concat_ws(
        "_",
        F.coalesce(F.col(status), F.lit("UNKNOWN")),
        F.coalesce(F.col(request_type), F.lit("UNKNOWN")),
        F.coalesce(F.col(step).cast("string"), F.lit("0")),
    )


def dim_request_status(requests: DataFrame) -> DataFrame:
    """Junk dimension of the status, type and step combinations in use.

    A missing step and step 0 share one key and therefore one row.  The distinct
    is partially aggregated before its exchange and leaves a handful of rows.
    """
    flag = lambda condition: F.when(condition, 1).otherwise(0)
    status = F.col("status")
    members = (
        requests
        .filter(status.isNotNull() & F.col("request_type").isNotNull())
        .select("status", "request_type", F.coalesce("current_step", F.lit(0)).alias("current_step"))
        .distinct()
    )
    return members.select(
        request_status_key().alias("status_key"),
        "status", "request_type", "current_step",
        labelled("status", {PENDING: "En Cours", ACCEPTED: "Validée", REJECTED: "Rejetée",
                            DOCUMENTS_REJECTED: "Documents Rejetés"}, "Inconnu").alias("status_label"),
        labelled("request_type", {IN_ZONE: "Zone Industrielle",
                                  OUT_OF_ZONE: "Hors Zone Industrielle"}, "Inconnu").alias("type_label"),
        flag(status == ACCEPTED).alias("is_accepted"),
        flag(status == REJECTED).alias("is_rejected"),
        flag(status == PENDING).alias("is_pending"),
        flag(status.isin(ACCEPTED, REJECTED)).alias("is_finalised"),
        flag(F.col("request_type") == IN_ZONE).alias("is_in_zone"),
    )
