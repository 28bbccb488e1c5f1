"""Message topics: Kafka in deployment, folders of parquet messages elsewhere.

Both give the same columns, `key STRING, value STRING, timestamp TIMESTAMP`, and where asked for the
place of each message: `part STRING` (partition or file) and `pos BIGINT` in it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

MESSAGE = "key STRING, value STRING, timestamp TIMESTAMP"


def read_topic(
    spark: SparkSession,
    topic: str | Sequence[str],
    *,
    root: str | None = None,
    servers: str | None = None,
    group: str | None = None,
    per_trigger: int | None = None,
    starting: str = "latest",
    positions: bool = False,
    only_reader: bool = False,
) -> DataFrame:
    """Stream of one or several topics.

    A restarted query goes on from its checkpoint; `starting` counts for its first start only. The only
    reader of a topic folder deletes files once a batch with them is committed and another follows (Kafka
    has its retention instead). Not for folders that a file sink writes, whose log names the files.
    """
    names = [topic] if isinstance(topic, str) else list(topic)
    if servers:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", ",".join(names))
            .option("startingOffsets", starting)
        )
        if group:
            reader = reader.option("kafka.group.id", group)
        if per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(per_trigger))
        place = [
            F.concat_ws("-", "topic", "partition").alias("part"), F.col("offset").alias("pos")
        ]
        return reader.load().select(
            F.col("key").cast("string"), F.col("value").cast("string"), "timestamp",
            *(place if positions else []),
        )
    if root is None:
        raise ValueError("give either Kafka servers or the root folder of the topics")
    # A topic that a batch writer fills has a folder for each batch.
    reader = spark.readStream.schema(MESSAGE).option("recursiveFileLookup", "true")
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(per_trigger))
    if only_reader:
        reader = reader.option("cleanSource", "delete")
    streams = [reader.parquet(f"{root}/{name}") for name in names]
    if positions:
        place = [F.col("_metadata.file_name").alias("part"), F.col("_metadata.row_index").alias("pos")]
        streams = [stream.select("*", *place) for stream in streams]
    return reduce(DataFrame.unionByName, streams)


def append_messages(
    messages: DataFrame, topic: str, root: str, files: int | None = None, keyed: bool = False
) -> None:
    """Add `key, value` messages to a topic folder in one commit.

    `keyed` puts equal keys into one file as a keyed topic does into one partition, at the price of
    a big file for a hot key.
    """
    rows = messages.select(
        F.col("key").cast("string").alias("key"),
        "value",
        F.current_timestamp().alias("timestamp"),
    )
    if files and keyed:
        rows = rows.repartition(files, "key")
    elif files:
        # By content and origin: even, copies included, and without the sort of a round robin.
        origin = rows.withColumn("_origin", F.spark_partition_id())
        rows = origin.repartition(files, "value", "_origin").drop("_origin")
    rows.write.mode("append").parquet(f"{root}/{topic}")


def topic_batches(topic: str, root: str) -> Callable[[DataFrame, int], None]:
    """Batch writer of a topic folder: `key, value` rows, a replayed batch replacing itself.

    A reader that saw the batch before its replay sees it twice, as with any at-least-once topic.
    """

    def write(messages: DataFrame, batch_id: int) -> None:
        rows = messages.select("key", "value", F.current_timestamp().alias("timestamp"))
        rows.write.mode("overwrite").parquet(f"{root}/{topic}/batch_id={batch_id}")

    return write


def topic_sink(
    messages: DataFrame, topic: str, *, root: str | None = None, servers: str | None = None
) -> DataStreamWriter:
    """Append-only stream of `key, value` to a topic; exactly once into a folder."""
    if servers:
        return kafka_sink(messages, servers, topic)
    rows = messages.select("key", "value", F.current_timestamp().alias("timestamp"))
    writer = rows.writeStream.format("parquet").outputMode("append")
    return writer.option("path", f"{root}/{topic}")


def kafka_sink(messages: DataFrame, servers: str, topic: str | None = None) -> DataStreamWriter:
    """Send `key, value` messages to a topic, or each to the topic in its own `topic` column.

    Kafka keeps equal keys in one partition, in order. Delivery is at least once, so readers
    deduplicate by the row's id.
    """
    columns = ["key", "value"] if topic else ["topic", "key", "value"]
    writer = (
        messages.select(*columns).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.enable.idempotence", "true")
    )
    return writer.option("topic", topic) if topic else writer
