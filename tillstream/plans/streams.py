"""Streaming queries: tables landed as topics slice by slice, a job run over them, its result read.

Slices go by event time, so several micro-batches see the data in the order it happened.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.jsontext import good_rows, json_of, parse_typed
from ..functions.times import time_text
from ..operators import dims, dws
from ..schemas import APP_LOG, DIMENSIONS, ORDER_DONE
from ..session import drop_folder, release_shuffles, workspace
from ..sinks import files
from ..sinks.results import read_results
from ..sources import records, topics
from ..streaming import changes, dimensions, jobs, layers, run
from . import batch

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

# Order lines of a slice from which on there are more slices: a micro-batch and the state of a stream then hold
# about as many, however large the tables are.
SLICE_LINES = 2_000_000

# Seconds each micro-batch took, by working-folder label, for the bench.
BATCH_SECONDS: dict[str, list[float]] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


class Replay:
    """Topic folders in a fresh working folder, filled slice by slice."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.label = label
        self.root = workspace(spark, label)
        self.files = spark.sparkContext.defaultParallelism

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(
        self, rows: DataFrame, time: str, topic: str, slices: int, span: tuple[int, int] | None = None
    ) -> list[DataFrame]:
        """Write the rows as messages once and cut them into slices of equal time.

        With a `span` of microseconds that holds all times each slice lies in a folder of its own, so that
        many slices cost no more reading than a few.
        """
        staged = self.path(f"staged-{topic}")
        at = F.unix_micros(F.col(time)).alias("at")
        value = F.col("value") if "value" in rows.columns else json_of(*rows.columns).alias("value")
        messages = rows.select(F.lit(None).cast("string").alias("key"), value, at)
        if span:
            low, high = span
            number = F.floor((F.col("at") - low) * slices / (high + 1 - low)).cast("int")
            messages.withColumn("slice", number).write.partitionBy("slice").parquet(staged)
            kept = T.StructType([*messages.schema.fields, T.StructField("slice", T.IntegerType())])
            messages = self.spark.read.schema(kept).parquet(staged)
            return [messages.filter(F.col("slice") == k).drop("slice") for k in range(slices)]
        messages.write.parquet(staged)
        messages = self.spark.read.parquet(staged)
        low, high = messages.agg(F.min("at"), F.max("at")).first()
        cuts = [low + (high - low) * k // slices for k in range(slices)] + [high + 1]
        return [
            messages.filter((F.col("at") >= a) & (F.col("at") < b)) for a, b in zip(cuts, cuts[1:])
        ]

    def land(self, rows: DataFrame, time: str, topic: str, slices: int) -> None:
        for part in self.stage(rows, time, topic, slices):
            self.append(part, topic)
        self.unstage(topic)

    def unstage(self, topic: str) -> None:
        """Drop the staged messages once all slices have landed: the topic holds them."""
        self.drop(f"staged-{topic}")

    def drop(self, *names: str) -> None:
        """Drop what no query will read again: a topic that all its readers are through with, the
        checkpoint of a query that has ended for good."""
        for name in names:
            drop_folder(self.spark, self.path(name))

    def append(self, messages: DataFrame, topic: str, deal: bool = False) -> None:
        """Land messages in as many files as a micro-batch reads. They are dealt anew where they lie in
        fewer files than that, or where it is asked for."""
        if not deal and len(messages.inputFiles()) >= self.files:
            topics.append_messages(messages.coalesce(self.files), topic, self.root)
        else:
            topics.append_messages(messages, topic, self.root, self.files)

    def stream(self, topic: str, schema: T.StructType | None = None, only_reader: bool = False) -> DataFrame:
        messages = topics.read_topic(
            self.spark, topic, root=self.root, per_trigger=self.files, only_reader=only_reader
        )
        return good_rows(parse_typed(messages, schema)) if schema else messages

    def stored(self, topic: str, schema: T.StructType) -> DataFrame:
        return good_rows(parse_typed(self.spark.read.option("recursiveFileLookup", "true").parquet(self.path(topic)), schema))

    def drain(self, writer, name: str = "job", **options):
        ended = run.drain(self.spark, writer, self.path(f"checkpoint-{name}"), **options)
        BATCH_SECONDS.setdefault(self.label, []).extend(run.batch_seconds(ended))
        release_shuffles(self.spark)
        return ended


def _log(spark: SparkSession, d: str) -> DataFrame:
    return records.app_log_lines(records.app_events(spark, d))


# Seconds up to which lines come after their order.
LINE_LAG = 599


def _line_times(pairs: DataFrame, lag_seconds: int) -> DataFrame:
    """Lines come up to `lag_seconds` after their order."""
    lag = (F.col("order_detail_id") % (lag_seconds + 1)).cast("int")
    return pairs.withColumn("line_time", F.col("create_time") + F.make_dt_interval(secs=lag))


@query
def stream_events_source(spark: SparkSession, d: str) -> DataFrame:
    replay = Replay(spark, "events")
    replay.land(_log(spark, d), "ts", "APP_EVENT", 3)
    replay.drain(jobs.store_events(replay.stream("APP_EVENT"), replay.path("events")))
    return spark.read.parquet(replay.path("events")).select("ts_ms", "mid", "ch", "vc")


@query
def stream_corrupt_side(spark: SparkSession, d: str) -> DataFrame:
    """Every fiftieth log line arrives cut off: the others are stored, these land beside them."""
    replay = Replay(spark, "corrupt")
    whole = F.col("event_id") % 50 != 0
    cut = F.when(whole, F.col("value")).otherwise(F.substring("value", 1, 20))
    replay.land(_log(spark, d).withColumn("value", cut), "ts", "APP_EVENT", 2)
    replay.drain(jobs.store_events(replay.stream("APP_EVENT"), replay.path("events")), "events")
    replay.drain(
        jobs.keep_corrupt(replay.stream("APP_EVENT"), APP_LOG, replay.path("side")), "side"
    )
    good = spark.read.parquet(replay.path("events")).select(
        F.lit("stored").alias("kind"), F.col("ts_ms").cast("string").alias("value")
    )
    side = spark.read.parquet(replay.path("side")).select(F.lit("corrupt").alias("kind"), "value")
    return good.unionByName(side)


@query
def stream_restart_exact(spark: SparkSession, d: str) -> DataFrame:
    """The same job ended and started again twice, the last time with nothing new."""
    replay = Replay(spark, "restart")
    parts = replay.stage(_log(spark, d), "ts", "APP_EVENT", 3)
    for part in (parts[:2], parts[2:], []):
        for messages in part:
            replay.append(messages, "APP_EVENT")
        replay.drain(jobs.store_events(replay.stream("APP_EVENT"), replay.path("events")))
    stored = spark.read.parquet(replay.path("events"))
    return stored.groupBy(F.col("dt").cast("string").alias("dt")).agg(F.count(F.lit(1)).alias("n"))


@query
def stream_cdc_route(spark: SparkSession, d: str) -> DataFrame:
    replay = Replay(spark, "cdc")
    for part in (batch.cdc_messages(spark, d),):
        replay.append(part.select(F.lit(None).alias("key"), "value"), "DB_CHANGES")
    replay.drain(jobs.route_changes(replay.stream("DB_CHANGES"), replay.path("ods")))
    routed = spark.read.parquet(replay.path("ods"))
    return routed.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n_messages"), F.sum(F.length("value")).alias("n_chars")
    )


@query
def stream_dim_upsert(spark: SparkSession, d: str) -> DataFrame:
    """User dimension kept from changes: every third user changes level in a second batch."""
    replay = Replay(spark, "dim-user")
    schema = T.StructType().add("user_id", "long").add("user_level", "string").add(
        "birthday", "string").add("gender", "string")
    people = records.users(spark, d).select("user_id", "user_level", "birthday", "gender")
    changed = people.filter("user_id % 3 = 0").withColumn("user_level", F.lit("VIP"))
    for rows in (people, changed):
        message = rows.select(F.lit(None).alias("key"), json_of(*rows.columns).alias("value"))
        replay.append(message, "ODS_USER_INFO")
    stream = replay.stream("ODS_USER_INFO")
    replay.drain(jobs.upsert_users(stream, replay.path("users"), schema, batch.AS_OF))
    current = files.upserted(spark, replay.path("users"), ["user_id"], "timestamp")
    return current.select("user_id", "user_level", "age_group", "gender_name")


def _load(replay: Replay, topic: str, *parts: DataFrame) -> None:
    """Send rows to a dimension's topic, a micro-batch for each part, and let its loader run."""
    for rows in parts:
        message = rows.select(F.lit(None).alias("key"), json_of(*rows.columns).alias("value"))
        topics.append_messages(message.coalesce(1), topic, replay.root)
    stream = topics.read_topic(replay.spark, topic, root=replay.root, per_trigger=1, positions=True)
    replay.drain(dimensions.load(stream, topic, replay.path("dims")), topic)


@query
def stream_dim_loaders(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the six dimensions after their loaders ran twice, the second time with every third row
    renamed."""
    replay = Replay(spark, "dim-loaders")
    tables = {
        "ODS_BASE_PROVINCE": (records.provinces, "province_name"),
        "ODS_USER_INFO": (records.users, "user_level"),
        "ODS_SKU_INFO": (records.skus, "sku_name"),
        "ODS_SPU_INFO": (records.spus, "spu_name"),
        "ODS_BASE_TRADEMARK": (records.trademarks, "tm_name"),
        "ODS_BASE_CATEGORY3": (records.categories, "category3_name"),
    }
    out = None
    for topic, (read, label) in tables.items():
        name, key, _ = DIMENSIONS[topic]
        rows = read(spark, d)
        number = F.length(key) if name == "category3" else F.col(key)
        renamed = rows.filter(number % 3 == 0).withColumn(label, F.concat(label, F.lit("+")))
        _load(replay, topic, rows, renamed)
        part = dimensions.current(spark, replay.path("dims"), name).select(
            F.lit(name).alias("dimension"), F.col(key).cast("string").alias("key"), F.col(label).alias("label")
        )
        out = out.unionByName(part) if out is not None else part
    return out


@query
def stream_sku_late_names(spark: SparkSession, d: str) -> DataFrame:
    """Skus come before their brands, SPUs and categories, which give them their names afterwards."""
    replay = Replay(spark, "late-names")
    for topic, rows in (
        ("ODS_SKU_INFO", records.skus(spark, d)), ("ODS_SPU_INFO", records.spus(spark, d)),
        ("ODS_BASE_CATEGORY3", records.categories(spark, d)), ("ODS_BASE_TRADEMARK", records.trademarks(spark, d)),
    ):
        _load(replay, topic, rows)
    return dimensions.named_skus(spark, replay.path("dims")).select(
        "sku_id", "spu_id", "price_cents", "sku_name", "tm_id", "category3_id",
        "category3_name", "spu_name", "tm_name",
    )


@query
def stream_dau_dedup(spark: SparkSession, d: str) -> DataFrame:
    replay = Replay(spark, "dau")
    replay.land(_log(spark, d), "ts", "APP_EVENT", 3)
    replay.drain(jobs.first_events(replay.stream("APP_EVENT"), replay.path("dau")))
    return jobs.daily_first(spark, replay.path("dau")).select("mid", "dt", "ts_ms")


@query
def stream_dau_kept_actives(spark: SparkSession, d: str) -> DataFrame:
    """The same as a stream in the order events came in; a last one, ten days on, ends all states."""
    replay = Replay(spark, "dau-kept")
    rows = batch.late_events(spark, d)
    replay.land(rows, "arrived", "APP_EVENT", 3)
    last = rows.agg(F.max("arrived").alias("arrived")).select(
        F.lit("none").alias("mid"), "arrived", F.col("arrived").alias("ts"), F.lit(0).cast("bigint").alias("ts_ms"),
        F.lit(-1).cast("bigint").alias("event_id"),
    ).withColumn("arrived", F.col("arrived") + F.expr("INTERVAL 10 DAYS")).select(*rows.columns)
    replay.append(last.select(F.lit(None).alias("key"), json_of(*last.columns).alias("value")), "APP_EVENT")
    replay.drain(jobs.kept_actives(replay.stream("APP_EVENT", rows.schema), replay.path("actives")))
    return batch.shown_actives(spark.read.parquet(replay.path("actives")))


@query
def stream_sliding_counts(spark: SparkSession, d: str) -> DataFrame:
    replay = Replay(spark, "sliding")
    replay.land(_log(spark, d), "ts", "APP_EVENT", 3)
    writer = jobs.sliding_counts(
        replay.stream("APP_EVENT"), replay.path("counts"), "10 seconds", "5 seconds", "1 minute"
    )
    replay.drain(writer)
    rows = spark.read.parquet(replay.path("counts"))
    # A window's count only grows from batch to batch.
    return rows.groupBy(time_text(F.col("window_start")).alias("window_start")).agg(
        F.max("n").alias("n")
    )


def _order_rows(spark: SparkSession, d: str) -> DataFrame:
    return records.orders(spark, d)


@query
def stream_order_first_flag(spark: SparkSession, d: str) -> DataFrame:
    """Orders flagged on their way into the DWD topic, against the users kept so far."""
    replay = Replay(spark, "first-order")
    rows = _order_rows(spark, d)
    replay.land(rows, "create_time", "ODS_ORDER_INFO", 3)
    writer = jobs.order_facts(
        replay.stream("ODS_ORDER_INFO", rows.schema),
        lambda: dims.with_user_labels(records.users(spark, d), batch.AS_OF),
        lambda: records.provinces(spark, d),
        replay.path("user-state"), "DWD_ORDER_INFO", replay.root,
    )
    replay.drain(writer)
    return replay.stored("DWD_ORDER_INFO", T.StructType.fromDDL(
        "order_id BIGINT, user_id BIGINT, if_first_order STRING"))


@query
def stream_order_enrich(spark: SparkSession, d: str) -> DataFrame:
    replay = Replay(spark, "order-enrich")
    rows = _order_rows(spark, d)
    replay.land(rows, "create_time", "ODS_ORDER_INFO", 2)
    writer = jobs.enrich_orders(
        replay.stream("ODS_ORDER_INFO", rows.schema),
        lambda: dims.with_user_labels(records.users(spark, d), batch.AS_OF),
        lambda: records.provinces(spark, d),
        replay.path("dwd"),
    )
    replay.drain(writer)
    return spark.read.parquet(replay.path("dwd")).select(
        "order_id", "province_name", "province_area_code", "user_age_group", "user_gender"
    )


@query
def stream_detail_enrich(spark: SparkSession, d: str) -> DataFrame:
    """Order lines with sku names, every second line sent twice."""
    replay = Replay(spark, "detail-enrich")
    lines = records.order_lines(spark, d).select("order_detail_id", "order_id", "sku_id", "sku_num")
    sent = lines.unionByName(lines.filter("order_detail_id % 2 = 0"))
    message = sent.select(F.lit(None).alias("key"), json_of(*sent.columns).alias("value"))
    replay.append(message, "ODS_ORDER_DETAIL")
    stream = replay.stream("ODS_ORDER_DETAIL", lines.schema)
    replay.drain(jobs.enrich_lines(stream, lambda: batch.enriched_skus(spark, d), replay.path("dwd")))
    stored = dws.dedup_lines(spark.read.parquet(replay.path("dwd")), "batch_id")
    return stored.select(
        "order_detail_id", "order_id", "sku_id", "sku_name", "spu_id", "tm_id", "category3_id",
        "spu_name", "tm_name", "category3_name",
    )


@query
def stream_order_wide(spark: SparkSession, d: str) -> DataFrame:
    """Orders in three slices and their lines in four, so many pairs meet across batches."""
    replay = Replay(spark, "order-wide")
    rows = _order_rows(spark, d)
    lines = _lines_with_time(spark, d, rows)

    def go() -> None:
        joined = jobs.join_orders(
            replay.stream("DWD_ORDER_INFO", rows.schema, only_reader=True),
            replay.stream("DWD_ORDER_DETAIL", lines.schema, only_reader=True),
        )
        replay.drain(jobs.store_wide(joined, replay.path("wide")))

    for _ in _landed(replay, d, rows, lines, 3, 4):
        go()
    replay.drop("checkpoint-job", "DWD_ORDER_INFO", "DWD_ORDER_DETAIL")
    return jobs.wide_view(spark, replay.path("wide")).select(
        "order_detail_id", "order_id", "sku_id", "line_cents"
    )


def _rounds(spark: SparkSession, d: str, slices: int) -> int:
    """How many times `slices` slices there have to be for none to be too large; the count is in the file's
    footer."""
    return max(1, -(-records.table(spark, d, "lineitem").count() // (slices * SLICE_LINES)))


def _span(orders: DataFrame, lag_seconds: int = 0) -> tuple[int, int]:
    """The first and the last moment of orders, and of their lines that come up to so much later."""
    at = F.unix_micros("create_time")
    low, high = orders.agg(F.min(at), F.max(at)).first()
    return low, high + lag_seconds * 1_000_000


def _landed(
    replay: Replay, d: str, orders: DataFrame, lines: DataFrame, order_slices: int, line_slices: int,
    all_orders: DataFrame | None = None,
) -> Iterator[bool]:
    """Land orders and lines in so many slices each, which a query then reads slice by slice. Large tables
    go round by round, each of them a part of the time in so many slices; there every slice has to be read
    before the next one lands. Tells whether all has landed. Lines may belong to more orders than come:
    `all_orders`."""
    rounds = _rounds(replay.spark, d, line_slices)
    if rounds == 1:
        replay.land(orders, "create_time", "DWD_ORDER_INFO", order_slices)
        replay.land(lines, "line_time", "DWD_ORDER_DETAIL", line_slices)
        yield True
        return
    span = _span(orders if all_orders is None else all_orders)
    parts = {
        "DWD_ORDER_INFO": (order_slices, replay.stage(
            orders, "create_time", "DWD_ORDER_INFO", order_slices * rounds, span)),
        "DWD_ORDER_DETAIL": (line_slices, replay.stage(
            lines, "line_time", "DWD_ORDER_DETAIL", line_slices * rounds, (span[0], span[1] + LINE_LAG * 1_000_000))),
    }
    steps = max(order_slices, line_slices)
    for step in range(rounds * steps):
        for topic, (slices, staged) in parts.items():
            if step % steps < slices:
                number = step // steps * slices + step % steps
                replay.append(staged[number], topic, deal=True)
                replay.drop(f"staged-{topic}/slice={number}")
        release_shuffles(replay.spark)
        yield step == rounds * steps - 1
    for topic in parts:
        replay.unstage(topic)


def _lines_with_time(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    lines = records.order_lines(spark, d)
    timed = _line_times(lines.join(rows.select("order_id", "create_time"), "order_id"), LINE_LAG)
    return timed.drop("create_time")


@query
def stream_order_full_outer(spark: SparkSession, d: str) -> DataFrame:
    """Orders without lines and lines without order, found by the full outer stream join.

    Every seventh order is held back, so its lines stay alone. A closing order and line a day later
    move the watermark past everything else.
    """
    replay = Replay(spark, "full-outer")
    rows = _order_rows(spark, d)
    lines = _lines_with_time(spark, d, rows)
    kept = rows.filter("order_id % 7 <> 0")

    def go() -> None:
        joined = jobs.join_orders(
            replay.stream("DWD_ORDER_INFO", rows.schema, only_reader=True),
            replay.stream("DWD_ORDER_DETAIL", lines.schema, only_reader=True),
            how="full_outer",
        )
        stored = joined.select("order_id", F.col("_order_id"), F.col("_salt"), "order_detail_id")
        replay.drain(jobs.append_files(stored, replay.path("pairs")))

    for last_slice in _landed(replay, d, kept, lines, 2, 2, rows):
        if last_slice:
            for topic, data, time in (("DWD_ORDER_INFO", kept, "create_time"), ("DWD_ORDER_DETAIL", lines, "line_time")):
                last = data.agg(F.max(time).alias(time)).withColumn(time, F.col(time) + F.expr("INTERVAL 1 DAY"))
                for column in ("order_id", "order_detail_id"):
                    if column in data.columns:
                        last = last.withColumn(column, F.lit(-1).cast("bigint"))
                replay.append(last.select(F.lit(None).alias("key"), json_of(*last.columns).alias("value")), topic)
        go()
    replay.drop("checkpoint-job", "DWD_ORDER_INFO", "DWD_ORDER_DETAIL")
    return jobs.unmatched(spark.read.parquet(replay.path("pairs")))


def _allocation(spark: SparkSession, d: str, label: str) -> tuple[Replay, T.StructType]:
    """Lines arriving up to three days after their order, in four slices, and the topic of changes that
    the two allocating queries make of them slice by slice."""
    replay = Replay(spark, label)
    lines = records.order_lines(spark, d)
    named = dims.add_sku(
        dws.join_wide(records.orders_with_amounts(records.orders(spark, d), lines), lines),
        batch.enriched_skus(spark, d),
    )
    lag = 3 * 86400
    pairs = _line_times(named, lag).select(
        "order_id", "create_time", "order_detail_id", "line_time", "line_cents", "tm_id", "tm_name",
        "original_total_cents", "final_total_cents",
    )
    rounds = _rounds(spark, d, 4)
    span = _span(records.orders(spark, d), lag) if rounds > 1 else None
    for number, part in enumerate(replay.stage(pairs, "line_time", "DWS_ORDER_PAIR", 4 * rounds, span)):
        replay.append(part, "DWS_ORDER_PAIR", deal=rounds > 1)
        if rounds > 1:
            replay.drop(f"staged-DWS_ORDER_PAIR/slice={number}")
        release_shuffles(spark)
        stream = replay.stream("DWS_ORDER_PAIR", pairs.schema)
        done = changes.order_done(stream, "DWS_ORDER_DONE", replay.root, late="4 days")
        replay.drain(done, "done", empty_batches=False)
        both = changes.wide_changes(
            stream, replay.stream("DWS_ORDER_DONE", ORDER_DONE, only_reader=True), late="4 days"
        )
        sent = changes.send_changes(both, "DWS_ORDER_WIDE", root=replay.root)
        replay.drain(sent, "wide", empty_batches=False)
        # Both its readers are through with the slice.
        replay.drop("DWS_ORDER_PAIR")
    replay.unstage("DWS_ORDER_PAIR")
    replay.drop("DWS_ORDER_DONE", "checkpoint-done", "checkpoint-wide")
    return replay, changes.change_schema(pairs.schema)


@query
def stream_order_split(spark: SparkSession, d: str) -> DataFrame:
    """What each line paid, from the newest message of each line on the topic of wide rows."""
    replay, schema = _allocation(spark, d, "split")
    return changes.read_changes(spark, "DWS_ORDER_WIDE", replay.root, schema).select(
        "order_id", "order_detail_id", "line_cents", "final_detail_cents"
    )


@query
def stream_trademark_sink(spark: SparkSession, d: str) -> DataFrame:
    """Brand sums from the topic of wide rows, in a result table. The query starts a second time
    without its checkpoint, from the first message on: nothing is lost or repeated."""
    replay, schema = _allocation(spark, d, "trademark")
    schema = T.StructType([schema[name] for name in ("tm_id", "tm_name", "delta_cents")])
    for checkpoint in ("sums", "sums-anew"):
        messages = topics.read_topic(
            spark, "DWS_ORDER_WIDE", root=replay.root, per_trigger=replay.files, positions=True
        )
        rows = good_rows(parse_typed(messages, schema, keep=["timestamp", "part", "pos"]))
        replay.drain(jobs.trademark_sums(rows, replay.path("stat")), checkpoint)
    stat = read_results(spark, replay.path("stat"))
    return stat.groupBy("tm_id", "tm_name").agg(F.sum("amount_cents").alias("amount_cents"))


def _priced_orders(spark: SparkSession, d: str) -> DataFrame:
    """All orders with their amounts, also those that no line belongs to: they are of nothing."""
    rows, lines = records.orders(spark, d), records.order_lines(spark, d)
    priced = records.orders_with_amounts(rows, lines).drop(*[c for c in rows.columns if c != "order_id"])
    cents = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in priced.columns[1:]]
    return rows.join(priced, "order_id", "left").select(*rows.columns, *cents)


def run_layers(spark: SparkSession, d: str, label: str, slices: int = 3) -> layers.Layers:
    """All layers started together on a change topic that grows; the wide join ends in the middle and
    starts again alone. Raises if the watermark dropped anything."""
    replay = Replay(spark, label)
    rows = _priced_orders(spark, d)
    lines = _lines_with_time(spark, d, rows)

    def messages(table: str, data: DataFrame, time: str) -> DataFrame:
        body = json_of(F.lit(table).alias("table"), F.lit("insert").alias("type"), F.struct(*data.columns).alias("data"))
        return data.select(body.alias("value"), F.col(time).alias("at_time"))

    both = messages("order_info", rows, "create_time").unionByName(
        messages("order_detail", lines, "line_time"))
    rounds = _rounds(spark, d, slices)
    slices *= rounds
    span = _span(rows, LINE_LAG) if rounds > 1 else None
    parts = replay.stage(both, "at_time", "DB_CHANGES", slices, span)
    flow = layers.Layers(
        spark, replay.root, rows.schema, lines.schema,
        users=lambda: dims.with_user_labels(records.users(spark, d), batch.AS_OF),
        provinces=lambda: records.provinces(spark, d),
        skus=lambda: batch.enriched_skus(spark, d),
        state_partitions=max(1, replay.files // 2),
    )
    flow.prepare()
    replay.append(parts[0], "DB_CHANGES")
    queries = flow.start_all()
    ended: list = []

    def again(name: str) -> None:
        ended.append(queries[name])
        queries[name].stop()

    try:
        for number, part in enumerate(parts[1:], 1):
            # The reader of the change topic is away while a slice lands, so it sees it whole.
            queries["ods"].processAllAvailable()
            again("ods")
            if number == slices // 2:
                again("dws_pairs")
            replay.append(part, "DB_CHANGES")
            if rounds > 1:
                replay.drop(f"staged-DB_CHANGES/slice={number}")
            queries["ods"] = flow.start("ods")
            if number == slices // 2:
                queries["dws_pairs"] = flow.start("dws_pairs")
            if rounds > 1:
                # The slice before goes through all layers by now, so that none of them falls behind and has
                # to hold many slices.
                for name, running in queries.items():
                    if name != "ods":
                        running.processAllAvailable()
                release_shuffles(spark)
        replay.unstage("DB_CHANGES")
        layers.rest(queries)
    finally:
        layers.stop(queries)
    # What only the layers themselves read: both ends of the run stay.
    replay.drop(*(f"checkpoint-{name}" for name in queries), *(t for t in layers.TOPICS if t != "DWS_ORDER_WIDE"))
    release_shuffles(spark)
    seconds = [s for q in (*queries.values(), *ended) for s in run.batch_seconds(q)]
    BATCH_SECONDS.setdefault(label, []).extend(seconds)
    late = sum(run.late_rows(spark, q) for q in (*queries.values(), *ended))
    if late:
        raise RuntimeError(f"{late} rows came after the watermark")
    return flow


# The run of the layers in a session, which two queries look at from different ends.
_RUNS: dict[tuple[str, str], layers.Layers] = {}


def _layers(spark: SparkSession, d: str) -> layers.Layers:
    key = (spark.sparkContext.applicationId, d)
    if key not in _RUNS:
        _RUNS[key] = run_layers(spark, d, "layers")
    return _RUNS[key]


@query
def stream_layers(spark: SparkSession, d: str) -> DataFrame:
    """Brand sums at the end of all layers."""
    flow = _layers(spark, d)
    stat = read_results(spark, f"{flow.root}/ADS_TRADEMARK")
    return stat.groupBy("tm_id", "tm_name").agg(F.sum("amount_cents").alias("amount_cents"))


@query
def stream_layers_wide(spark: SparkSession, d: str) -> DataFrame:
    """The whole wide table as the layers leave it on the topic of wide rows."""
    wide = dws.order_wide(_layers(spark, d).wide())
    return wide.withColumn("create_time", time_text(F.col("create_time")))
