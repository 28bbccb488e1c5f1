"""The streaming form of each layer.

A job takes topic streams (`key, value, timestamp`) and gives a writer that `run.start` or
`run.drain` starts. Sinks are either the exactly-once file sink or a batch folder per micro-batch
that a replay overwrites.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from ..functions.jsontext import corrupt_rows, good_rows, keyed_json, parse_typed
from ..operators import dims, dwd, dws, ods
from ..operators.keyed import first_per_key, latest_per_key
from ..session import folder_exists
from ..sinks.files import BatchWriter, batch_writer, upsert_writer
from ..sinks.results import result_writer
from ..sources import topics

# Copies of each order on the join's order side: the lines of a hot order spread over that many
# tasks.
JOIN_SALTS = 4


def append_files(rows: DataFrame, path: str, *partition_by: str) -> DataStreamWriter:
    """Exactly-once file sink."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    return writer.partitionBy(*partition_by) if partition_by else writer


def per_batch(rows: DataFrame, write: Callable[[DataFrame, int], None], mode: str) -> DataStreamWriter:
    return rows.writeStream.outputMode(mode).foreachBatch(write)


def keep_corrupt(messages: DataFrame, schema: T.StructType, path: str) -> DataStreamWriter:
    """Side output of a topic: messages that do not parse, as they came. Start it next to the job
    that reads the topic, which goes on without them."""
    return append_files(corrupt_rows(parse_typed(messages, schema)), path)


# ---- ODS and DIM ---------------------------------------------------------------------------


def route_changes(changes: DataFrame, path: str) -> DataStreamWriter:
    """Split a change topic into one folder per table topic."""
    routed = ods.topic_messages(ods.cdc_filter(ods.parse_cdc_rows(changes)))
    return append_files(routed, path, "topic")


def store_events(log_lines: DataFrame, path: str) -> DataStreamWriter:
    """Parsed application log by day."""
    rows = ods.parse_app_log(log_lines).withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    return append_files(rows, path, "dt")


def upsert_users(changes: DataFrame, path: str, schema: T.StructType, as_of: str) -> DataStreamWriter:
    """User dimension with labels; read it with `sinks.files.upserted`, versioned by `timestamp`."""
    rows = good_rows(parse_typed(changes, schema, keep=["timestamp"]))
    rows = rows.withColumn("birthday", F.to_date("birthday"))
    return per_batch(dims.with_user_labels(rows, as_of), upsert_writer(path), "append")


# ---- DAU -----------------------------------------------------------------------------------


def first_events(log_lines: DataFrame, path: str, state_kept: str = "1 day") -> DataStreamWriter:
    """First event per device and day.

    An aggregate rather than a dedupe: it is summed up before the shuffle, so a device with a third
    of the log reaches its state as a few rows, and an earlier event that arrives later still wins.
    The state of a day goes once the watermark has passed its end.
    """
    events = ods.parse_app_log(log_lines).withWatermark("ts", state_kept)
    fields = ["ts_ms", "uid", "ar", "ch", "vc"]
    first = events.groupBy("mid", F.window("ts", "1 day").alias("day")).agg(
        F.min(F.struct(*fields)).alias("first")
    )
    return per_batch(first.select("mid", "first.*"), batch_writer(path), "update")


def kept_actives(events: DataFrame, path: str, kept: str = "24 hours", late: str = "1 hour") -> DataStreamWriter:
    """Daily actives whose state lives until `kept` after the device's last event of the day came in. A row is
    written when its state ends; `first_events` tells the first event at once."""
    rows = dwd.kept_actives(events.withWatermark("arrived", late), kept)
    return append_files(rows, path)


def daily_first(spark: SparkSession, path: str) -> DataFrame:
    """Current DAU rows from the batches written by `first_events`."""
    rows = spark.read.parquet(path)
    when = F.timestamp_millis("ts_ms")
    rows = rows.withColumns({
        "dt": F.date_format(when, "yyyy-MM-dd"),
        "hr": F.date_format(when, "HH"),
        "mi": F.date_format(when, "mm"),
    })
    return first_per_key(rows, ["mid", "dt"], [F.col("ts_ms"), F.col("batch_id").desc()])


def sliding_counts(log_lines: DataFrame, path: str, size: str, slide: str, late: str) -> DataStreamWriter:
    """Event counts over sliding windows, each batch writing the windows it changed."""
    events = ods.parse_app_log(log_lines).withWatermark("ts", late)
    counts = events.groupBy(F.window("ts", size, slide).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return per_batch(counts.select(F.col("w.start").alias("window_start"), "n"), batch_writer(path), "update")


# ---- orders --------------------------------------------------------------------------------


def flag_batch(batch: DataFrame, path: str) -> DataFrame:
    """Orders of a batch with `if_first_order`, the first ones of new users added to the log at `path`.

    A user's first order is the earliest of the first batch the user comes with. A replay, or a query
    started anew, finds it in the log and flags it again, so it does not matter that the log is written
    before the flags are. Each user reaches the lookup as one row per map task, and orders are matched
    by their id, not by user.
    """
    spark = batch.sparkSession
    firsts = batch.groupBy("user_id").agg(F.min(F.struct("create_time", "order_id")).alias("_f"))
    firsts = firsts.select("user_id", F.col("_f.order_id").alias("order_id"))
    new = firsts
    if folder_exists(spark, path):
        log = spark.read.schema("user_id BIGINT, order_id BIGINT").parquet(path)
        known = log.groupBy("user_id").agg(F.min("order_id").alias("_known"))
        found = firsts.join(known, "user_id", "left")
        new = found.filter(F.col("_known").isNull()).drop("_known")
        firsts = found.select(F.coalesce("_known", "order_id").alias("order_id"))
    new.select("user_id", "order_id").write.mode("append").parquet(path)
    marks = firsts.select("order_id", F.lit("1").alias("_first"))
    return (
        batch.join(marks, "order_id", "left")
        .withColumn("if_first_order", F.coalesce("_first", F.lit("0")))
        .drop("_first")
    )


def _enriched(
    write_batch: BatchWriter, keys: list[str], enrich: Callable[[DataFrame], DataFrame]
) -> BatchWriter:
    """Batch writer that collapses copies within the batch, map-side first, and then enriches.

    A row resent many times so reaches the stateful layers behind as one row per batch: the newest
    where the messages' `timestamp` was kept, else any, as copies are alike.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if "timestamp" in batch.columns:
            once = latest_per_key(batch, keys, [F.col("timestamp").desc()]).drop("timestamp")
        else:
            once = batch.dropDuplicates(keys)
        once.persist()
        try:
            write_batch(enrich(once), batch_id)
        finally:
            once.unpersist()

    return write


def _as_messages(write_batch: BatchWriter, key: str) -> BatchWriter:
    """Rows to messages keyed by a column."""
    return lambda rows, batch_id: write_batch(keyed_json(rows, key), batch_id)


def enrich_orders(
    orders: DataFrame,
    users: Callable[[], DataFrame],
    provinces: Callable[[], DataFrame],
    path: str,
) -> DataStreamWriter:
    """Orders with province and user labels. The dimensions are read anew for every batch."""
    enrich = _order_labels(users, provinces)
    return per_batch(orders, _enriched(batch_writer(path), ["order_id"], enrich), "append")


def _order_labels(
    users: Callable[[], DataFrame], provinces: Callable[[], DataFrame]
) -> Callable[[DataFrame], DataFrame]:
    def enrich(rows: DataFrame) -> DataFrame:
        people = dims.seen_only(users(), rows, "user_id").select(
            "user_id", "province_id", F.col("age_group").alias("user_age_group"),
            F.col("gender_name").alias("user_gender"),
        )
        return dims.add_province(rows.join(people, "user_id", "left"), provinces())

    return enrich


def order_facts(
    orders: DataFrame,
    users: Callable[[], DataFrame],
    provinces: Callable[[], DataFrame],
    state: str,
    topic: str,
    root: str,
) -> DataStreamWriter:
    """DWD orders as a topic: first-order flag, province and user labels."""
    labels = _order_labels(users, provinces)

    def enrich(rows: DataFrame) -> DataFrame:
        return labels(flag_batch(rows, state))

    write = _as_messages(topics.topic_batches(topic, root), "order_id")
    return per_batch(orders, _enriched(write, ["order_id"], enrich), "append")


def line_facts(
    lines: DataFrame, skus: Callable[[], DataFrame], topic: str, root: str
) -> DataStreamWriter:
    """DWD order lines as a topic, with the names of their sku."""
    write = _as_messages(topics.topic_batches(topic, root), "order_id")
    return per_batch(lines, _enriched(write, dws.LINE_KEY, _sku_names(skus)), "append")


def enrich_lines(lines: DataFrame, skus: Callable[[], DataFrame], path: str) -> DataStreamWriter:
    """Order lines with the names of their sku; the dimension is read anew for every batch."""
    write = _enriched(batch_writer(path), dws.LINE_KEY, _sku_names(skus))
    return per_batch(lines, write, "append")


def _sku_names(skus: Callable[[], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: dims.add_sku(rows, dims.seen_only(skus(), rows, "sku_id"))


def _salted_sides(orders: DataFrame, lines: DataFrame, late: str, salts: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with watermarks and without rows resent across batches.

    Copies within a batch are collapsed by the enriching jobs before. Lines carry one of `salts` values, orders come once per value.
    """
    once = orders.withWatermark("create_time", late).dropDuplicatesWithinWatermark(["order_id"])
    left = once.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    line_once = lines.withWatermark("line_time", late).dropDuplicatesWithinWatermark(
        ["order_id", "order_detail_id"]
    )
    right = line_once.select(
        F.col("order_id").alias("_order_id"),
        F.pmod("order_detail_id", F.lit(salts)).cast("int").alias("_line_salt"),
        *[c for c in lines.columns if c != "order_id"],
    )
    return left, right


def _within(bound: str) -> Column:
    gap = F.expr(f"INTERVAL {bound}")
    return (F.col("line_time") >= F.col("create_time") - gap) & (
        F.col("line_time") <= F.col("create_time") + gap
    )


def join_orders(
    orders: DataFrame,
    lines: DataFrame,
    *,
    within: str = "10 minutes",
    late: str = "10 minutes",
    salts: int = JOIN_SALTS,
    how: str = "inner",
) -> DataFrame:
    """Stream join of orders and lines whose times lie within a bound of each other.

    Each pair comes out once, as resent orders and lines are dropped on the way in and the join
    itself, unlike overlapping windows, meets no pair twice. Full outer also gives, once the watermark has passed them, lines
    without an order and orders without lines - the latter once per salt, see `unmatched`.
    """
    left, right = _salted_sides(orders, lines, late, salts)
    on = (
        (F.col("order_id") == F.col("_order_id"))
        & (F.col("_salt") == F.col("_line_salt"))
        & _within(within)
    )
    return left.join(right, on, how).drop("_line_salt")


def store_wide(joined: DataFrame, path: str) -> DataStreamWriter:
    return append_files(joined.drop("_order_id", "_salt"), path)


def wide_view(spark: SparkSession, path: str) -> DataFrame:
    """Stored pairs, one row per line whatever the readers before it let through."""
    return dws.dedup_lines(spark.read.parquet(path))


def unmatched(joined_rows: DataFrame, salts: int = JOIN_SALTS) -> DataFrame:
    """Stored full-outer rows that found no partner. An order is bare when it was so for every salt."""
    bare = (
        joined_rows.filter(F.col("_order_id").isNull())
        .groupBy("order_id").agg(F.count_distinct("_salt").alias("_n"))
        .filter(F.col("_n") == salts)
        .select(F.lit("order").alias("kind"), F.col("order_id").alias("id"))
    )
    lost = joined_rows.filter(F.col("order_id").isNull()).select(
        F.lit("line").alias("kind"), F.col("order_detail_id").alias("id")
    )
    return bare.unionByName(lost)


# ---- ADS -----------------------------------------------------------------------------------


def trademark_sums(changes: DataFrame, path: str, late: str | None = None) -> DataStreamWriter:
    """Brand sums of each batch of allocation changes, in a result table (`sinks.results`).

    `changes` carry `delta_cents`, the message's `timestamp` and place. A batch's `stat_time` is its
    newest message, so a replay gives the same. From a topic that may repeat messages give `late`: a
    line's change is then taken once.
    """
    if late:
        changes = changes.withWatermark("create_time", late).dropDuplicatesWithinWatermark(
            [*dws.LINE_KEY, "version"]
        )

    def sums(rows: DataFrame) -> DataFrame:
        brands = rows.groupBy("tm_id", "tm_name").agg(
            F.sum("delta_cents").alias("amount_cents"), F.max("timestamp").alias("stat_time")
        )
        # One row per brand by now, so the window sees a handful.
        return brands.withColumn("stat_time", F.max("stat_time").over(Window.partitionBy()))

    return per_batch(changes, result_writer(path, sums), "append")
