"""From raw documents to token ids, stage by stage.

Every stage takes (spark, docs, sf_dir); what it returns is written to the shared
folder and read again as the next stage's documents.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from landledger.llm import decontamination, secrets, sentencepieces, simhash, toxicity
from landledger.llm.common import table
from landledger.llm.queries import PIECES
from landledger.session import scratch_path

#: The classifier behind the first stage and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half; the model is fitted on this stage's input."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every SimHash component."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no window of a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secrets.masked(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, token ids, and whether they decode to the text."""
    return sentencepieces.report(docs, sentencepieces.read_model(PIECES))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", mask_secrets),
    ("sentencepiece", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the rows of the last one."""
    docs, folder = table(spark, sf_dir, "documents"), scratch_path(spark, "corpus")
    for name, stage in STAGES:
        path = os.path.join(folder, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
