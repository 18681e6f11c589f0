"""Distinct counts and medians that are kept per month and merged.

Neither a distinct count nor a median can be had from the results of two months.  What
is stored instead can be merged: bitmaps of request numbers, and the number of requests
per number of days.  A load adds its own rows to these tables; a period, or all loads
together, is a merge of stored rows and never reads the fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landledger.functions.measures import count_rows


def request_bitmaps(activity: DataFrame, by: Sequence[str], number: str = "request_id") -> DataFrame:
    """Bitmaps of the numbers per ``by`` group and range of numbers.

    One row holds 32 768 numbers, so a table has at most one row per group and range,
    however often a request occurs.  Repeats are absorbed before the exchange.  Numbers
    are counted from 0 on; rows without one are left out.
    """
    known = activity.filter(F.col(number) >= 0)
    return known.groupBy(*by, F.bitmap_bucket_number(F.col(number)).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(number))).alias("bits"))


def distinct_requests(bitmaps: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Exact number of different requests per ``by``, from bitmaps of any months and
    loads: equal ranges are joined by or, and their bits counted."""
    by = [F.col(c) if isinstance(c, str) else c for c in by]
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    names = [c for c in merged.columns if c not in ("bucket", "bits")]
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("bits")).alias("requests"))


def day_counters(fact: DataFrame, by: Sequence[str], value: str = "processing_days") -> DataFrame:
    """Rows per ``by`` group and value; counters of several loads are simply added, and
    a correction is a negative one."""
    return fact.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("value")).agg(
        count_rows().alias("n"))


def medians(counters: DataFrame, by: Sequence[str]) -> DataFrame:
    """Exact median per ``by`` from counters of any months and loads: values are passed
    in order until half of the rows are counted.  A group has one row per different
    value by then, a few thousand for days."""
    merged = counters.groupBy(*by, "value").agg(F.sum("n").alias("n")).filter("n > 0")
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    placed = merged.withColumns({
        "_upto": F.sum("n").over(group.orderBy("value")), "_all": F.sum("n").over(group)})
    # of an even number of rows the two in the middle
    first = lambda reached: F.min(F.when(reached, F.col("value")))
    lower = first(F.col("_upto") * 2 >= F.col("_all"))
    upper = first(F.col("_upto") * 2 > F.col("_all"))
    return placed.groupBy(*by).agg(((lower + upper) / 2).cast("double").alias("median"),
                                   F.max("_all").alias("rows"))
