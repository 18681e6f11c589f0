"""Parquet and JDBC access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def jdbc_options(url: str, user: str, password: str, driver: str, *,
                 table: str | None = None, query: str | None = None,
                 partition_column: str | None = None, lower: object = None,
                 upper: object = None, partitions: int | None = None,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options for a table or a pushed-down query.

    With ``partition_column`` the scan is split into ``partitions`` range
    queries.  Spark accepts no split together with ``query``, so a split query
    is passed as a derived table.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, "user": user, "password": password, "driver": driver,
               "fetchsize": str(fetch_size)}
    if partition_column is None:
        options.update({"dbtable": table} if table else {"query": query})
        return options
    if lower is None or upper is None or not partitions:
        raise ValueError("a split scan needs lower, upper and partitions")
    options.update({
        "dbtable": table or f"({query}) AS pushed_query",
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    })
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def write_jdbc(df: DataFrame, url: str, user: str, password: str, driver: str, table: str, *,
               mode: str = "overwrite", batch_size: int = 10_000,
               connections: int = 16) -> None:
    """Overwrite a database table, keeping its definition (``truncate``)."""
    (df.write.format("jdbc")
       .options(url=url, user=user, password=password, driver=driver, dbtable=table,
                batchsize=str(batch_size), numPartitions=str(connections), truncate="true")
       .mode(mode).save())
