"""Two states of a table compared row by row.

Every row is reduced to its key and a digest of all its columns; one shuffle of these
tells which rows are new, changed or gone.  Rows themselves do not move.  That serves
two full extracts of a source that keeps no modification date.

Source and warehouse, which should agree, are compared from the top instead: checksums
of months, then of buckets of the months that differ, then the rows of the buckets that
differ.  Equal months are read once, for their checksum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.operators.clean import with_keys

INSERTED, CHANGED, DELETED = "inserted", "changed", "deleted"


def row_digest(columns: Sequence[str]) -> Column:
    """Digest of the named columns; NULL differs from empty and keeps its place."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def extract_changes(before: DataFrame, after: DataFrame, keys: Sequence[str],
                    ignore: Sequence[str] = ()) -> DataFrame:
    """Keys that differ between two extracts and how: inserted, changed or deleted.

    Rows without a key are left out.  A key may repeat in an extract: it is unchanged
    if it has the same rows.  Repeats are reduced before the exchange, so a hot key
    costs nothing extra.  Columns are matched by name; ``ignore`` names those, as load
    times, that differ without a change.
    """
    columns = sorted(c for c in after.columns if c not in keys and c not in ignore)

    def side(df: DataFrame, name: str) -> DataFrame:
        return with_keys(df, *keys).select(*keys, row_digest(columns).alias("_digest"),
                                           F.lit(name).alias("_side"))
    def rows(name: str) -> Column:
        mine = F.when(F.col("_side") == name, F.col("_digest"))
        return F.struct(F.count(mine).alias("n"), F.min(mine).alias("low"), F.max(mine).alias("high"),
                        F.sum(F.when(mine.isNotNull(), F.xxhash64("_digest")).cast("decimal(20,0)")).alias("all"))
    both = side(before, "before").unionByName(side(after, "after")).groupBy(*keys).agg(
        rows("before").alias("_before"), rows("after").alias("_after"))
    change = (F.when(F.col("_before.n") == 0, INSERTED).when(F.col("_after.n") == 0, DELETED)
               .when(F.col("_before") != F.col("_after"), CHANGED))
    return both.select(*keys, change.alias("change")).filter(F.col("change").isNotNull())


BUCKETS = 64


def _checksums(df: DataFrame, by: Sequence[Column | str], columns: Sequence[str]) -> DataFrame:
    """Rows and an order-free checksum of their digests per group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(
        F.xxhash64(row_digest(columns)).cast("decimal(20,0)")).alias("sum"))


def _unequal(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups whose checksums differ, or that one side lacks."""
    named = lambda df, side: df.select(*by, F.lit(side).alias("_side"), F.struct("n", "sum").alias("_check"))
    both = named(left, "left").unionByName(named(right, "right"))
    one = lambda side: F.max(F.when(F.col("_side") == side, F.col("_check")))
    return both.groupBy(*by).agg(one("left").alias("_left"), one("right").alias("_right")).filter(
        ~F.col("_left").eqNullSafe(F.col("_right"))).select(*by)


def recon_differences(source: DataFrame, warehouse: DataFrame, keys: Sequence[str], month: str,
                      buckets: int = BUCKETS) -> DataFrame:
    """Keys that differ between two tables that should agree: inserted (only in the
    warehouse), deleted (only in the source) or changed.

    Months that differ are fetched, a list as short as the calendar, and so are their
    unequal buckets, at most ``buckets`` a month; as literal lists both prune the later
    scans, by partition where the tables are stored by month.  A row whose month differs
    between the sides is found under its own key, as it makes both months differ.
    """
    columns = sorted(source.columns)
    months = [r[0] for r in _unequal(*(_checksums(df, [month], columns) for df in (source, warehouse)),
                                     [month]).collect()]
    place = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket")
    null = F.col(month).isNull() if None in months else F.lit(False)
    within = [df.filter(F.col(month).isin([m for m in months if m is not None]) | null)
              for df in (source, warehouse)]
    unequal = _unequal(*(_checksums(df, [place], columns) for df in within), ["_bucket"])
    chosen = [r[0] for r in unequal.collect()]
    left, right = (df.withColumn("_bucket", place).filter(F.col("_bucket").isin(chosen)).drop("_bucket")
                   for df in within)
    return extract_changes(left, right, keys)
