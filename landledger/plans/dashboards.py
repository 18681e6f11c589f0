"""Queries that combine KPIs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.functions.measures import count_rows
from landledger.plans import requests as r


def dash_status_priority(fact: DataFrame) -> DataFrame:
    """Status and priority split in one list."""
    def part(df: DataFrame, category: str, label: str) -> DataFrame:
        return df.select(F.lit(category).alias("category"), F.col(label).alias("label"),
                         F.col("requests").alias("value"), F.col("share_pct").alias("pct"))
    return part(r.kpi_by_status(fact), "Statuts", "status").unionByName(
        part(r.kpi_priority_split(fact), "Priorités", "priority_level"))


def kpi_cross(fact: DataFrame) -> DataFrame:
    """Every status group beside every zone type group.

    The pairing itself is the report.  Both sides are aggregates over a fixed
    list of labels: at most four status rows and two zone type rows, whatever
    the size of the fact.
    """
    status = r.kpi_by_status(fact).select("status", F.col("requests").alias("status_requests"))
    kind = r.kpi_by_zone_type(fact).select("zone_type", F.col("requests").alias("zone_type_requests"))
    return status.crossJoin(F.broadcast(kind))


def kpi_health(views: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """Rows returned by every registered KPI."""
    return reduce(DataFrame.unionByName, [
        build().agg(count_rows().alias("rows")).select(F.lit(name).alias("kpi"), "rows")
        for name, build in views.items()
    ])
