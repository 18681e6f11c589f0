"""Collection agents: a versioned (type 2) dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landledger.functions import scalars as s
from landledger.operators.clean import with_keys
from landledger.operators.upsert import insert_absent, latest_per_key

OPEN_END = "9999-12-31 23:59:59"
TRACKED = ("agent_name", "badge_number", "job_title", "phone", "email", "status",
           "zone_id", "hired_on")


def first_versions(agents: DataFrame, loaded_at) -> DataFrame:
    """Version 1 of every agent of a batch, valid from ``loaded_at``; of an agent
    delivered more than once the newest row.

    ``agent_key`` names one version; ``durable_key`` is the same for all
    versions of an agent and is what the facts carry.
    """
    key = s.hash_key("AGT", F.col("agent_id"))
    return latest_per_key(agents, ["agent_id"], ["modified_at"]).select(
        key.alias("agent_key"),
        key.alias("durable_key"),
        "agent_id",
        "agent_name",
        F.lit("").alias("first_name"),
        F.col("agent_name").alias("full_name"),
        "badge_number", "job_title", "phone", "email", "status", "zone_id",
        "hired_on", "created_on", "modified_at",
        s.as_timestamp(loaded_at).alias("valid_from"),
        F.lit(OPEN_END).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("version"),
    )


def insert_new_agents(dimension: DataFrame, agents: DataFrame, loaded_at) -> DataFrame:
    """Add unknown agents; known agents stay untouched."""
    return insert_absent(dimension, first_versions(agents, loaded_at), ["agent_id"])


def with_late_versions(dimension: DataFrame, agents: DataFrame) -> DataFrame:
    """Put in the versions of a batch that are older than an agent's current one.

    A late row stands between the stored versions by its modification time.  It is
    valid from then on (but not before the version it follows) until the next version
    begins, and the version before it ends there.  A row that says what the version
    before it says, or that is stored already, changes nothing.  Inserted versions get
    the next free numbers of their agent, so stored keys never change.

    Versions are ordered per agent, of which there are as many as an agent's record
    was changed; agents without a late row take no part.
    """
    columns = dimension.columns
    newest = dimension.filter("is_current").select("agent_id", F.col("modified_at").alias("_newest"))
    late = (with_keys(agents, "agent_id").join(newest, "agent_id")
            .filter(F.col("modified_at") < F.col("_newest")))
    late = first_versions_of_rows(late).select(*columns).withColumn("_late", F.lit(True))
    concerned = dimension.join(late.select("agent_id").distinct(), "agent_id", "left_semi")
    others = dimension.join(late.select("agent_id").distinct(), "agent_id", "left_anti")

    # of equal times the stored row comes first, of late rows any
    in_time = W.partitionBy("agent_id").orderBy(F.col("modified_at").asc_nulls_first(), "_late", "version",
                                                *TRACKED)
    rows = concerned.select(*columns).withColumn("_late", F.lit(False)).unionByName(late)
    state = F.struct(*TRACKED)
    again = F.coalesce(state.eqNullSafe(F.lag(state).over(in_time)), F.lit(False)) | F.coalesce(
        F.col("modified_at") == F.lag("modified_at").over(in_time), F.lit(False))
    kept = rows.withColumn("_again", again).filter(~(F.col("_late") & F.col("_again"))).drop("_again")

    # a late version begins with its modification, but not before the one it follows
    stored_start = F.when(~F.col("_late"), F.col("valid_from"))
    before = F.last(stored_start, ignorenulls=True).over(in_time.rowsBetween(W.unboundedPreceding, -1))
    start = F.when(F.col("_late"), F.greatest("valid_from", before)).otherwise(F.col("valid_from"))
    numbered = kept.withColumns({
        "valid_from": start,
        "_highest": F.max(F.when(~F.col("_late"), F.col("version"))).over(W.partitionBy("agent_id")),
        "_nth": F.sum(F.col("_late").cast("int")).over(in_time.rowsBetween(W.unboundedPreceding, 0)),
    })
    by_start = W.partitionBy("agent_id").orderBy("valid_from", F.col("modified_at").asc_nulls_first())
    version = F.when(F.col("_late"), F.col("_highest") + F.col("_nth")).otherwise(F.col("version")).cast("int")
    return others.select(*columns).unionByName(numbered.withColumns({
        "version": version,
        "agent_key": F.when(F.col("_late"), s.hash_key("AGT", F.col("agent_id"), version))
                      .otherwise(F.col("agent_key")),
        "valid_to": F.coalesce(F.lead("valid_from").over(by_start), F.col("valid_to")),
        "is_current": ~F.col("_late") & F.col("is_current"),
    }).select(*columns))


def first_versions_of_rows(agents: DataFrame) -> DataFrame:
    """Every row as a version valid from its own modification on."""
    key = s.hash_key("AGT", F.col("agent_id"))
    return agents.withColumns({
        "agent_key": key, "durable_key": key, "first_name": F.lit(""), "full_name": F.col("agent_name"),
        "valid_from": F.col("modified_at"), "valid_to": F.lit(OPEN_END).cast("timestamp_ntz"),
        "is_current": F.lit(False), "version": F.lit(0)})


def version_of_day(facts: DataFrame, dimension: DataFrame, key: str, day: str) -> DataFrame:
    """``facts`` with the agent version valid at the end of ``day``: agent_key of the
    version in ``version_key``, its number and name.  Without a version by then, or
    without a day, these are NULL.

    Every version is spread over the months it is valid in, within the months of the
    facts, and meets the facts on agent and month; of the few versions of one month the
    day decides.  So the join is an equality join: the versions are the small side, and
    an agent with a third of all facts is split as any hot join key.
    """
    month = lambda c: F.trunc(c, "month")
    first, last = facts.agg(F.min(month(day)), F.max(month(day))).first()
    if first is None:
        first = last = dt.date(1970, 1, 1)
    begin = F.greatest(month(F.col("valid_from")), F.lit(first))
    end = F.least(month(F.col("valid_to")), F.lit(last))
    spans = dimension.filter(begin <= end).select(
        F.col("durable_key").alias("_key"), F.explode(F.sequence(begin, end, F.expr("INTERVAL 1 MONTH")))
        .alias("_month"), "valid_from", "valid_to", "agent_key", "version", "full_name")
    # one row per agent and month, so that facts are neither lost nor repeated
    per_month = spans.groupBy("_key", "_month").agg(F.sort_array(F.collect_list(F.struct(
        "valid_from", "valid_to", "agent_key", "version", "full_name"))).alias("_versions"))
    moment = F.col(day).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 SECOND")
    valid = F.filter("_versions", lambda v: (v["valid_from"] <= moment) & (moment < v["valid_to"]))
    chosen = F.get(F.reverse(valid), F.lit(0))
    joined = facts.withColumn("_key", F.col(key)).withColumn("_month", month(F.col(day))).join(
        per_month, ["_key", "_month"], "left")
    return joined.withColumn("_chosen", chosen).select(
        *facts.columns, F.col("_chosen.agent_key").alias("version_key"),
        F.col("_chosen.version").alias("version"), F.col("_chosen.full_name").alias("agent_name"))


def _row(columns: list[str], **replaced: Column) -> Column:
    return F.struct(*[replaced.get(c, F.col(c)).alias(c) for c in columns])


def scd2_agents(dimension: DataFrame, agents: DataFrame, loaded_at) -> DataFrame:
    """Merge a batch: a changed agent's version is closed and a new one opened.

    One full outer join of current versions with the batch; every joined row
    yields the one or two versions it stands for.  A row older than the current
    version is ignored, so a late or repeated batch changes nothing.
    """
    columns = dimension.columns
    when = s.as_timestamp(loaded_at)
    batch = first_versions(agents, loaded_at)
    new = {c: F.col(f"_new_{c}") for c in columns}
    incoming = batch.select("agent_id", *[F.col(c).alias(f"_new_{c}") for c in columns])
    current = dimension.filter("is_current").withColumn("_known", F.lit(True))

    next_version = F.col("version") + 1
    kept = _row(columns)
    closed = _row(columns, valid_to=when, is_current=F.lit(False))
    opened = _row(columns, **{
        **new,
        "version": next_version,
        "agent_key": s.hash_key("AGT", F.col("agent_id"), next_version),
        "durable_key": F.col("durable_key"),
    })
    added = _row(columns, **new)

    same = F.lit(True)
    for column in TRACKED:
        same = same & F.col(column).eqNullSafe(new[column])
    older = F.coalesce(new["modified_at"] < F.col("modified_at"), F.lit(False))
    versions = (
        F.when(F.col("_known").isNull(), F.array(added))
         .when(F.col("_new_agent_id").isNull() | same | older, F.array(kept))
         .otherwise(F.array(closed, opened))
    )
    merged = (current.join(incoming, "agent_id", "full_outer")
                     .select(F.explode(versions).alias("v")).select("v.*"))
    return dimension.filter("NOT is_current").unionByName(merged)
