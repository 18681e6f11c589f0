"""KPI values in long form, thresholds, alerts and snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landledger.functions import scalars as s
from landledger.functions.measures import mean, percent
from landledger.plans.requests import request_scorecard

# KPI, lowest and highest normal value, unit.
THRESHOLDS = (
    ("acceptance_rate", "30", "80", "%"),
    ("average_processing_days", "5", "15", "days"),
    ("total_demands", "1", "1000", "demands"),
    ("pending_demands", "0", "50", "demands"),
)


def kpi_values(fact: DataFrame) -> DataFrame:
    """The monitored KPIs as rows, out of one pass over the fact."""
    value = {
        "acceptance_rate": percent(F.col("finalised_accepted"), F.col("finalised"), 2),
        "average_processing_days": mean(F.col("timed_days"), F.col("timed_rows"), 1),
        "total_demands": F.col("requests"),
        "pending_demands": F.col("pending"),
    }
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("kpi"),
            value[name].cast("decimal(20,2)").alias("value"),
            F.lit(low).cast("decimal(20,2)").alias("low"),
            F.lit(high).cast("decimal(20,2)").alias("high"),
            F.lit(unit).alias("unit"))
        for name, low, high, unit in THRESHOLDS
    ])
    return request_scorecard(fact).select(F.inline(rows))


def _rated(fact: DataFrame) -> DataFrame:
    value, low, high = F.col("value"), F.col("low"), F.col("high")
    state = (F.when(value.isNull(), "NULL").when(value < low, "LOW")
              .when(value > high, "HIGH").otherwise("NORMAL"))
    return kpi_values(fact).withColumn("state", state)


def kpi_alerts(fact: DataFrame) -> DataFrame:
    """KPIs out of range: LOW, HIGH, or NULL when there is no value."""
    low = F.col("state") == "LOW"
    threshold = F.when(low, F.col("low")).when(F.col("state") == "HIGH", F.col("high"))
    number = lambda c: F.concat(c.cast("string"), F.lit(" "), F.col("unit"))
    message = F.when(
        F.col("state") == "NULL",
        F.concat(F.col("kpi"), F.lit(": no value could be computed, check the input")),
    ).otherwise(F.concat(
        F.col("kpi"), F.lit(": "), number(F.col("value")),
        F.when(low, ", expected at least ").otherwise(", expected at most "), number(threshold)))
    return _rated(fact).filter(F.col("state") != "NORMAL").select(
        "kpi", "value", threshold.alias("threshold"), F.col("state").alias("alert_type"), "unit",
        message.alias("message"))


def kpi_snapshot(fact: DataFrame, as_of) -> DataFrame:
    """Long-form KPI report of one day, to be appended to a history table."""
    return _rated(fact).select(
        s.as_date(as_of).alias("as_of"), "kpi", "value", F.col("state").alias("detail"))


def alert_episodes(history: DataFrame, limits: Sequence[tuple[str, float, float]]) -> DataFrame:
    """Spans of days in which a KPI was in alert, from its stored values (as_of, kpi,
    value).  ``limits`` has, per KPI, the value at which an alert opens and the lower one
    below which it closes; in between it stays as it was, so a value that wavers about one
    limit is one episode.  Days without a value leave the state as it is.

    Returns kpi, first_day, last_day, days (with a value or not), worst and is_open: whether
    the last stored day still belongs to it.  A KPI has one row per stored day, a day stored
    twice counts once with its highest value.
    """
    rows = F.array(*[F.struct(F.lit(name).alias("kpi"), F.lit(float(opens)).alias("opens"),
                              F.lit(float(closes)).alias("closes")) for name, opens, closes in limits])
    bounds = history.sparkSession.range(1).select(F.inline(rows))
    daily = history.groupBy("kpi", "as_of").agg(F.max("value").cast("double").alias("value"))
    signal = F.when(F.col("value") >= F.col("opens"), 1).when(F.col("value") < F.col("closes"), 0)
    in_time = W.partitionBy("kpi").orderBy("as_of")
    state = F.coalesce(F.last("_signal", ignorenulls=True).over(
        in_time.rowsBetween(W.unboundedPreceding, W.currentRow)), F.lit(0))
    turned = F.when(F.col("_state") != F.coalesce(F.lag("_state").over(in_time), F.lit(0)), 1).otherwise(0)
    spans = (daily.join(F.broadcast(bounds), "kpi")  # one row per limit given
             .withColumn("_signal", signal).withColumn("_state", state)
             .withColumn("_turned", turned)
             .withColumns({"_span": F.sum("_turned").over(in_time),
                           "_latest": F.max("as_of").over(W.partitionBy("kpi"))}))
    return spans.filter("_state = 1").groupBy("kpi", "_span").agg(
        F.min("as_of").alias("first_day"), F.max("as_of").alias("last_day"),
        F.count(F.lit(1)).alias("days"), F.max("value").alias("worst"),
        F.max(F.col("as_of") == F.col("_latest")).alias("is_open")).drop("_span")
