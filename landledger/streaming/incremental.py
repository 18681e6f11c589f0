"""Incremental recovery load driven by newly landed files.

The batch extract asks for actions modified since yesterday, which reads some
rows twice and misses late ones.  Here the stream's checkpoint remembers which
files were applied; each micro-batch goes through the same cleaning, fact and
upsert as the batch load.  The upsert is keyed, so a micro-batch repeated after
a failure changes nothing.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from landledger import jobs
from landledger.operators import clean, facts
from landledger.operators import parents as parents_of
from landledger.operators.upsert import RECOVERY_REFRESH, full_refresh, read_load, upsert_table
from landledger.sources import extract


def apply_landed_recoveries(spark: SparkSession, landing: str, schema: T.StructType,
                            receivable_path: str, fact_path: str, name: str,
                            checkpoint: str) -> StreamingQuery:
    """Merge every landed file not applied yet into the recovery fact, then stop.

    ``checkpoint`` is the folder in shared storage that remembers what was applied;
    a restart, also on another machine, names the same one.
    """
    def merge(batch: DataFrame, batch_number: int) -> None:
        session = batch.sparkSession
        cleaned = clean.clean_recoveries(extract.all_recoveries(batch))
        # only the receivables that the batch names take part in the lookup
        parents = session.read.parquet(receivable_path).join(
            cleaned.select("receivable_id").distinct(), "receivable_id", "left_semi")
        rows = jobs.with_month(facts.fact_recoveries(cleaned, parents, f"{name}_{batch_number}"), "action_date_key")
        # stored once, as the upsert reads it more than once
        staged = os.path.join(checkpoint, "batches")
        full_refresh(rows, staged, str(batch_number))
        rows = read_load(session, staged, str(batch_number), rows.schema)
        upsert_table(session, fact_path, rows, ["recovery_id"], RECOVERY_REFRESH, ["modified_at"], jobs.MONTH)
        # the next collection load that brings their receivable repairs these
        parents_of.drain(session, os.path.join(os.path.dirname(fact_path), "waiting_actions"),
                         parents_of.waiting_actions(rows, jobs.MONTH), None, jobs.MONTH)

    return (
        spark.readStream.schema(schema).parquet(landing)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
