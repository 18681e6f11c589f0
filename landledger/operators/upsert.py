"""Keyed loads without a table format: dedupe, upsert, insert-if-absent, and
the writes that keep a table readable while it is replaced."""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landledger.operators.clean import with_keys
from landledger.session import children, exists, remove, replace, scratch_path

# Fixed lists: the columns a later batch may change on an existing fact row.
# The modification time goes with them, so that an older batch can be told.
RECEIVABLE_REFRESH = ("amount_collected", "amount_remaining", "recovery_rate",
                      "status_key", "modified_date_key", "etl_batch_id", "modified_at")
RECOVERY_REFRESH = ("payment", "amount_net", "status", "etl_batch_id", "modified_at")

# A table of more rows than one portion is worked on in up to so many portions, one after
# the other, so shuffles and the second copy of a rewrite hold a part of it at a time.
PORTIONS, PORTION_ROWS = 8, 250_000


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """The newest row of every key; rows without a key are dropped.

    An aggregate rather than a ranking window: repeats of a key are reduced
    before the exchange, so one key holding much of the batch costs nothing
    extra.  Ties are broken by the remaining columns, so re-runs agree.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest_by]
    packed = F.max(F.struct(*newest_by, *rest)).alias("_row")
    return (with_keys(df, *keys).groupBy(*keys).agg(packed)
            .select(*keys, "_row.*").select(*df.columns))


def newest_stored(batch: DataFrame, keys: Sequence[str], newest_by: Sequence[str],
                  listed: DataFrame | None = None) -> DataFrame:
    """Like ``latest_per_key`` for a stored batch, where repeats are rare: a count per
    key finds them, and only their rows are sorted by the aggregate.  ``listed`` are the
    stored rows that ``batch`` is made from, one for one, if it is not only projected."""
    batch = with_keys(batch, *keys)
    listed = batch if listed is None else with_keys(listed, *keys)
    repeated = listed.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(*keys)
    if repeated.isEmpty():
        return batch
    return batch.join(repeated, list(keys), "left_anti").unionByName(
        latest_per_key(batch.join(repeated, list(keys), "left_semi"), keys, newest_by))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], refresh: Sequence[str],
           newest_by: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """``target`` with ``batch`` merged in.

    A key present in both keeps its first values except for the ``refresh``
    columns, which take the batch value even when that is NULL - unless the stored
    row is newer, by the ``newest_by`` columns that are among them.  New keys are
    added whole.

    The target is the large side.  It is only ever the left side of a left join
    and of a semi join on its keys, so a batch below the broadcast threshold is
    merged without moving the target; a larger one falls back to sorted joins.
    Both sides are unique per key, so no join key is hot.  ``known`` names the batch's
    keys that the target holds, where they are found already; it saves the semi join.
    """
    return _merged(target, newest_stored(batch, keys, newest_by), keys, refresh, newest_by, known)


def _merged(target: DataFrame, newest: DataFrame, keys: Sequence[str], refresh: Sequence[str],
            newest_by: Sequence[str], known: DataFrame | None) -> DataFrame:
    """``upsert`` of a batch that has one row per key."""
    keys = list(keys)
    newest = newest.select(*target.columns)
    incoming = newest.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in refresh],
                             F.lit(True).alias("_hit"))
    hit = F.col("_hit").isNotNull()
    for c in newest_by:
        if c in refresh:
            hit = hit & F.coalesce(F.col(f"_new_{c}") >= F.col(c), F.lit(True))
    merged = target.join(incoming, keys, "left").select(*[
        F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in refresh else F.col(c)
        for c in target.columns
    ])
    if known is None:
        known = target.select(*keys).join(newest.select(*keys), keys, "left_semi")
    return merged.unionByName(newest.join(known, keys, "left_anti"))


def insert_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the batch rows, one per key, whose key the target does not hold yet."""
    return target.unionByName(
        batch.select(*target.columns).join(target.select(*keys), list(keys), "left_anti"))


# --- writes -------------------------------------------------------------------

def full_refresh(df: DataFrame, path: str, load_id: str) -> None:
    """Replace a table by writing a new load beside the earlier ones.

    Readers name the load they want, so they never meet an empty or half
    written table, and repeating a load replaces only itself.
    """
    df.write.mode("overwrite").parquet(os.path.join(path, f"load_id={load_id}"))


def refresh_in_parts(parts: Sequence[DataFrame], path: str, load_id: str) -> None:
    """Like ``full_refresh`` for a table that is made part by part."""
    full_refresh(parts[0], path, load_id)
    for part in parts[1:]:
        part.write.mode("append").parquet(os.path.join(path, f"load_id={load_id}"))


def refresh_if_any(df: DataFrame, path: str, load_id: str) -> bool:
    """Like ``full_refresh``, but an empty input leaves the table as it is."""
    if df.isEmpty():
        return False
    full_refresh(df, path, load_id)
    return True


def drop_other_loads(spark: SparkSession, path: str, load_id: str) -> None:
    """Free what earlier loads left in a working table that only its own load reads."""
    for name in children(spark, path):
        if name.startswith("load_id=") and name != f"load_id={load_id}":
            remove(spark, os.path.join(path, name))


def read_load(spark: SparkSession, path: str, load_id: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(os.path.join(path, f"load_id={load_id}"))


def by_partition(df: DataFrame, *partition: str) -> DataFrame:
    """Rows gathered by the partition columns they are about to be written by.

    Without it every task of a shuffle writes a file into every partition, so their
    number grows with tasks times months, and most of the time goes into opening
    files.  Adaptive execution splits a large partition at the advisory size, so a
    month that holds much of the table is not the work of one task.
    """
    return df.hint("rebalance", *partition)


def append_batch(df: DataFrame, path: str, batch: str = "etl_batch_id") -> None:
    """Append rows by batch tag; repeating a batch replaces its own rows only."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(batch).parquet(path))


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                 refresh: Sequence[str], newest_by: Sequence[str], partition: str,
                 deleted: DataFrame | None = None, held: DataFrame | None = None) -> None:
    """Upsert a Parquet table, rewriting only the partitions the batch touches; a table
    that is not there yet is created.  ``batch`` is read more than once: store it first.
    Rows with a key of ``deleted`` that the batch does not bring are taken out.

    The table is read twice: its key columns, to find which batch keys it holds and in
    which partitions (``held``, if it was found before), and the partitions that are
    rewritten.  Their list is fetched: it is as short as the calendar (one entry per
    month), and as a literal list it prunes the second scan for certain.  Dynamic
    overwrite writes beside the table and moves the partitions in at job commit, which
    is what allows reading and replacing them in one job.  A large table is rewritten
    some partitions after the other; a run that stopped half-way is repeated.
    """
    keys = list(keys)
    newest = newest_stored(batch, keys, newest_by)
    if not exists(spark, path):
        by_partition(newest, partition).write.partitionBy(partition).parquet(path)
        return
    target = spark.read.schema(batch.schema).parquet(path)
    if deleted is not None:
        deleted = deleted.select(*keys).distinct().join(newest.select(*keys), keys, "left_anti")
        held = None
    found = None
    if held is None:
        wanted = newest.select(*keys)
        found = scratch_path(spark, "held")
        held = held_keys(spark, path, target.schema, wanted if deleted is None else wanted.union(deleted),
                         keys, partition, found)
    values = partition_values(held.select(partition).union(newest.select(partition)), partition)
    if values:
        affected = target.filter(F.col(partition).isin(values))
        emptied = []
        sizes = rows_per(affected.select(partition).union(newest.select(partition)), partition)
        if deleted is not None:
            emptied = _emptied(affected, held.join(deleted, keys, "left_semi"), newest, partition)
            affected = affected.join(deleted, keys, "left_anti")
        _rewrite(spark, path, affected, newest, keys, refresh, newest_by, partition, held, portions(sizes))
        for value in emptied:  # dynamic overwrite leaves a partition without new rows as it was
            remove(spark, os.path.join(path, f"{partition}={value}"))
    if found is not None:
        remove(spark, os.path.dirname(found))


def _rewrite(spark: SparkSession, path: str, affected: DataFrame, newest: DataFrame, keys: list[str],
             refresh: Sequence[str], newest_by: Sequence[str], partition: str, held: DataFrame,
             parts: list[tuple[list, int]]) -> None:
    """Merge ``newest`` into the ``affected`` partitions, portion by portion.

    A batch row goes with the partition that holds its key, a new one with its own.
    The pieces of a portion that is one large partition are gathered beside the table
    and moved in together; a stop while they are moved is one during a commit.
    """
    known = held.select(*keys)

    def overwrite(rows: DataFrame) -> None:
        (by_partition(rows, partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition).parquet(path))

    if len(parts) == 1 and parts[0][1] == 1:
        overwrite(_merged(affected, newest, keys, refresh, newest_by, known))
        return
    elsewhere = held.join(newest.select(*keys, F.col(partition).alias("_named")), keys).filter(
        ~F.col("_named").eqNullSafe(F.col(partition))).select(partition, *keys)
    moved = not elsewhere.isEmpty()
    for values, pieces in parts:
        here = in_partitions(partition, values)
        stored, batch, known_here = affected.filter(here), newest.filter(here), held
        if moved:
            batch = batch.unionByName(newest.filter(~here).join(
                elsewhere.filter(here).select(*keys), keys, "left_semi"))
        else:  # then a batch row and its stored one lie in the same partition
            known_here = held.filter(here)
        staged = os.path.join(path, "_staged", uuid.uuid4().hex)
        for number in range(pieces):
            piece = (lambda df: df) if pieces == 1 else (
                lambda df, n=number: df.filter(F.pmod(F.xxhash64(*keys), F.lit(pieces)) == n))
            rows = _merged(piece(stored), piece(batch), keys, refresh, newest_by, piece(known_here).select(*keys))
            if pieces == 1:
                overwrite(rows)
            else:
                by_partition(rows, partition).write.mode("append").partitionBy(partition).parquet(staged)
        if pieces > 1:
            for name in children(spark, staged):
                if name.startswith(f"{partition}="):
                    replace(spark, os.path.join(staged, name), os.path.join(path, name))
            remove(spark, os.path.join(path, "_staged"))


def in_partitions(partition: str, values: Sequence) -> Column:
    """Whether a row lies in one of the partitions; never NULL."""
    inside = F.coalesce(F.col(partition).isin([v for v in values if v is not None]), F.lit(False))
    return inside | F.col(partition).isNull() if None in values else inside


def rows_per(df: DataFrame, partition: str) -> dict:
    """Rows per partition: a list as short as the calendar."""
    return {r[0]: r[1] for r in df.groupBy(partition).agg(F.count("*")).collect()}


def portions(sizes: Mapping) -> list[tuple[list, int]]:
    """Partitions in groups of about a portion of all rows, and for each group in how many
    pieces by key it is worked on: more than one if a partition alone is larger."""
    most = max(PORTION_ROWS, math.ceil(sum(sizes.values()) / PORTIONS))
    groups: list[list] = [] if sizes else [[]]
    room = 0
    for value in sorted(sizes, key=lambda v: (v is not None, v)):
        if not groups or sizes[value] > room:
            groups.append([])
            room = most
        groups[-1].append(value)
        room -= sizes[value]
    return [(group, math.ceil(sum(sizes[v] for v in group) / most) or 1) for group in groups]


def held_keys(spark: SparkSession, path: str, schema: T.StructType, wanted: DataFrame, keys: Sequence[str],
              partition: str, place: str | None = None) -> DataFrame:
    """Which of the ``wanted`` keys a table holds, and in which partitions: one scan of
    its key columns, written down (to ``place``, if it is given), as small as the list of
    wanted keys.  A table that is not there yet holds none."""
    columns = wanted.sparkSession.createDataFrame([], schema).select(partition, *keys)
    if not exists(spark, path):
        return columns
    found = place or scratch_path(spark, "held")
    (spark.read.schema(schema).parquet(path).select(partition, *keys)
     .join(wanted.select(*keys), list(keys), "left_semi").select(partition, *keys)
     .write.mode("overwrite").parquet(found))
    return spark.read.schema(columns.schema).parquet(found)


def partition_values(df: DataFrame, partition: str) -> list:
    """The partitions of some rows: a list as short as the calendar."""
    return [row[0] for row in df.select(partition).distinct().collect()]


def _emptied(affected: DataFrame, dropped: DataFrame, newest: DataFrame, partition: str) -> list:
    """Partitions that lose all their rows and get none."""
    count = lambda df, sign: df.groupBy(partition).agg((sign * F.count("*")).alias("n"))
    left = (count(affected, 1).union(count(dropped, -1)).union(count(newest, 1))
            .groupBy(partition).agg(F.sum("n").alias("n")))
    return [row[0] for row in left.where("n = 0").collect()]


def save_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Materialise a fact as a catalog table bucketed by its natural key.

    Aggregates and joins on that key (distinct request counts, the recovery
    lookup, upserts) then read co-located buckets and add no exchange.  Choose
    ``buckets`` so that one bucket fits a task; a natural key spreads evenly.
    """
    (df.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key)
       .saveAsTable(table))
    return df.sparkSession.table(table)
