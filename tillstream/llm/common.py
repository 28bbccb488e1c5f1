"""Helpers shared by the operators: working tables, batch sizes, plain columns."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.session import conf_override, workspace

# Rows and bytes of one Arrow batch handed to Python: a batch of long texts stays small.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def settled(
    frame: DataFrame, label: str, partition: str | None = None, codec: str = "zstd"
) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = frame.sparkSession
    path = workspace(spark, label)
    with conf_override(spark, ARROW):
        writer = frame.write.option("compression", codec)
        (writer.partitionBy(partition) if partition else writer).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def few(frame: DataFrame, rows: int, per_task: int = 100_000) -> DataFrame:
    """`frame` of about `rows` rows in no more tasks than they ask for: each task leaves files behind."""
    return frame.coalesce(max(1, -(-rows // per_task)))


def partitions(spark: SparkSession) -> int:
    """Tasks of an explicit shuffle: what the session is sized for."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def pieces(batches: Iterable[pa.RecordBatch], text: str, most: int = 8 << 20) -> Iterator:
    """Batches cut further so that the texts of each hold about `most` bytes (one row at least)."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(False)
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)
