"""What the text operators share: reading, cutting lineage, sizes, Arrow batches."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from landledger.session import remove, scratch_path, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written to the shared folder named by
    ``spark.checkpoint.dir`` and read from there, so a lost executor costs no
    earlier work.  Spark removes the files with the frame where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


class Scratch:
    """Tables between the steps of a job, written to a folder of its own below the
    shared one and dropped when they have served.  Unlike checkpointed frames they
    have their true size, so plans of later rounds do not pile up estimates."""

    def __init__(self, spark: SparkSession):
        self.spark, self.count = spark, 0
        self.folder = scratch_path(spark, "steps")

    def keep(self, df: DataFrame, name: str = "") -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{name or self.count}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, f"{self.folder}/{name}")

    def close(self) -> None:
        remove(self.spark, self.folder)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files and checkpoints that no frame refers to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = 16 << 20) -> DataFrame:
    """``df`` marked for broadcast when its counted rows fit in ``limit`` bytes;
    otherwise unchanged, and the join shuffles."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


#: Rows of an Arrow batch that are worked on at a time.
SLICE = 1024


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE) -> Iterable[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, so that few rows at a time are
    Python objects."""
    for whole in batches:
        for at in range(0, len(whole), rows):
            yield whole.slice(at, rows)


def with_result(df: DataFrame, needs: list[str], keep: list[str], out: str, ddl: str,
                compute: Callable[..., Iterable]) -> DataFrame:
    """``keep`` columns of ``df`` and one struct column ``out`` with the fields
    of ``ddl``.  ``compute`` gets the ``needs`` columns of a batch as Arrow
    arrays and returns one column per field.  Rows stay where they are; a ``keep``
    column called ``out`` is an error, any other name is carried along."""
    if out.lower() in {c.lower() for c in keep}:
        raise ValueError(f"{out} is a column already; choose another name for the result")
    fields = T.StructType.fromDDL(ddl)
    frame = df.select(*dict.fromkeys([*keep, *needs]))
    schema = T.StructType([*(frame.schema[c] for c in keep), T.StructField(out, fields)])

    def run(batches):
        inner = list(to_arrow_schema(fields))
        for batch in (whole.slice(at, SLICE) for whole in batches
                      for at in range(0, len(whole), SLICE)):
            columns = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                       for c, f in zip(compute(*(batch.column(n) for n in needs)), inner)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep),
                 pa.StructArray.from_arrays(columns, fields=inner)], names=[*keep, out])
    return frame.mapInArrow(run, schema)


def map_rows(df: DataFrame, ddl: str, rows: Callable[[Iterable[pa.RecordBatch]], Iterable[list]],
             ) -> DataFrame:
    """New rows from all batches of a partition: ``rows`` yields lists of columns."""
    schema = T.StructType.fromDDL(ddl)

    def run(batches):
        target = to_arrow_schema(schema)
        for columns in rows(batches):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                 for c, f in zip(columns, target)], schema=target)
    return df.mapInArrow(run, schema)


class Once:
    """A value built from broadcast data once per worker process.  It hangs on the
    worker's broadcast, which outlives the task."""

    def __init__(self, spark: SparkSession, data, build: Callable):
        self.data, self.build = spark.sparkContext.broadcast(data), build

    def get(self):
        if not hasattr(self.data, "built"):
            self.data.built = self.build(self.data.value)
        return self.data.built
