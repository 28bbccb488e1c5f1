"""Rows from and to SQL databases over JDBC.

The database must be one that every executor can reach; an embedded one is seen by its own process
only and is no use here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query_rows(
    spark: SparkSession,
    url: str,
    sql: str,
    *,
    driver: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 8,
    **options: str,
) -> DataFrame:
    """Rows of a SQL query, columns typed from the result's metadata.

    With `partition_column` and `bounds` the read is split over `partitions` connections.
    """
    reader = spark.read.format("jdbc").options(**read_options(
        url, sql, driver=driver, partition_column=partition_column, bounds=bounds,
        partitions=partitions, **options,
    ))
    return reader.load()


def read_options(
    url: str,
    sql: str,
    *,
    driver: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 8,
    **options: str,
) -> dict[str, str]:
    out = {"url": url, **options}
    if driver:
        out["driver"] = driver
    if partition_column:
        if not bounds:
            raise ValueError("a partitioned read needs the bounds of its column")
        # A partitioned read takes a derived table, not the `query` option.
        out |= {
            "dbtable": f"({sql}) q",
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    else:
        out["query"] = sql
    return out


def append_options(
    url: str, table: str, *, driver: str | None = None, batch_size: int = 100,
    isolation: str = "NONE", partitions: int = 4,
) -> dict[str, str]:
    out = {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "isolationLevel": isolation,
        "numPartitions": str(partitions),
    }
    if driver:
        out["driver"] = driver
    return out


def append_rows(df: DataFrame, url: str, table: str, **options) -> None:
    """Append rows with a bounded number of connections and batched inserts."""
    df.write.format("jdbc").mode("append").options(**append_options(url, table, **options)).save()
