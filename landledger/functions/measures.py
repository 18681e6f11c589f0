"""Aggregate helpers used by the KPI plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``100 * part / whole`` rounded half up; NULL when ``whole`` is zero.

    Used on counts: a count has far fewer than 53 bits, so the quotient is the
    nearest double and ties are still seen by ``round``.
    """
    return F.round(F.lit(100.0) * part / F.nullifzero(whole), digits)


def mean(total: Column, rows: Column, digits: int | None = None) -> Column:
    """Average from a sum and a row count; money keeps its decimal type."""
    value = total / F.nullifzero(rows)
    return value if digits is None else F.round(value, digits)


def avg_of(measure: Column, digits: int | None = None) -> Column:
    """Average of a measure over the rows that have one."""
    return mean(F.sum(measure), F.count(measure), digits)


def count_rows() -> Column:
    return F.count(F.lit(1))


def with_share(groups: DataFrame, count: str, share: str, digits: int = 2) -> DataFrame:
    """Share of the grand total for an aggregate over a fixed list of labels.

    The window has no partitions and so runs in one task: use it only where the
    labels bound the number of groups (statuses, types, priorities).
    """
    total = F.sum(count).over(Window.partitionBy())
    return groups.withColumn(share, percent(F.col(count), total, digits))


def with_share_of_many(groups: DataFrame, count: str, share: str, digits: int = 2) -> DataFrame:
    """The same for groups whose number grows with a dimension.

    The total is a scalar subquery: it reads only what the count needs, and the
    groups themselves stay distributed.
    """
    total = groups.agg(F.sum(count)).scalar()
    return groups.withColumn(share, percent(F.col(count), total, digits))


def beside(row: DataFrame, other: DataFrame) -> DataFrame:
    """Put two one-row frames side by side (``other`` as scalar subquery)."""
    packed = other.select(F.struct("*")).scalar().alias("_other")
    return row.select("*", packed).select(*row.columns, "_other.*")
