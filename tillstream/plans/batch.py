"""Batch queries over the given tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.jsontext import good_rows, json_of, keyed_json, parse_typed
from ..functions.times import event_time_parts, order_time_parts, previous_day, time_text
from ..operators import ads, dims, dwd, dws, ods, search, serving
from ..operators.keyed import latest_per_key
from ..operators.postings import PostingIndex
from ..schemas import APP_LOG
from ..session import workspace
from ..sinks import files
from ..sinks.days import DayStore
from ..sources import records
from .stored import first_seen, line_grain, once, shop_stores

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2020-12-01"
DAU_DAY = "2024-01-15"
ORDER_DAY = "1996-09-17"
STATE_DAY = "1998-01-01"
STAT_START, STAT_END, TOP_N = "1996-01-01", "1999-01-01", 10
KEYWORD = "red"
DOC_WORDS, DOC_LANGS, DOC_MIN_CHARS = "the orders for", "en de", 300

REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# ---- shared inputs -------------------------------------------------------------------------


def _orders(spark: SparkSession, d: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Orders that have lines, with amounts. A day's orders read only their own lines."""
    rows, lines = records.orders(spark, d, first, last), records.order_lines(spark, d)
    if first:
        lines = lines.join(rows.select("order_id"), "order_id", "left_semi")
    return records.orders_with_amounts(rows, lines)


def allocated_lines(
    spark: SparkSession, d: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Allocated lines of all orders, or of the orders of some days."""
    lines = dws.unique_lines(records.order_lines(spark, d))
    rows = records.orders_with_amounts(records.orders(spark, d, first, last), lines)
    return dws.allocate(rows, lines)


def _users(spark: SparkSession, d: str) -> DataFrame:
    return dims.with_user_labels(records.users(spark, d), AS_OF)


def enriched_skus(spark: SparkSession, d: str) -> DataFrame:
    return dims.enrich_skus(
        records.skus(spark, d), records.categories(spark, d), records.trademarks(spark, d),
        records.spus(spark, d),
    )


def _located_orders(spark: SparkSession, d: str) -> DataFrame:
    """Order rows with the province of the customer."""
    homes = records.users(spark, d).select("user_id", "province_id")
    return records.orders(spark, d).join(homes, "user_id", "left")


def _log_lines(spark: SparkSession, d: str) -> DataFrame:
    return records.app_log_lines(records.app_events(spark, d))


def cdc_messages(spark: SparkSession, d: str) -> DataFrame:
    """Single-row change envelopes as JSON text."""
    kind = F.coalesce(F.concat(F.lit('"type":"'), "type", F.lit('",')), F.lit(""))
    text = F.concat(
        F.lit('{"table":"'), "table", F.lit('",'), kind, F.lit('"data":'), "data", F.lit("}")
    )
    return records.cdc_rows(spark, d).select(text.alias("value"))


def _dau(spark: SparkSession, d: str, first: str | None = None, last: str | None = None) -> DataFrame:
    return dwd.dau_rows(dwd.daily_first_events(records.app_events(spark, d, first, last)))


# ---- ingest and ODS ------------------------------------------------------------------------


@query
def json_field_extract(spark: SparkSession, d: str) -> DataFrame:
    return _log_lines(spark, d).select(
        "event_id",
        F.get_json_object("value", "$.ts").cast("bigint").alias("ts"),
        F.get_json_object("value", "$.common.mid").alias("mid"),
        F.get_json_object("value", "$.common.ch").alias("ch"),
    )


@query
def json_typed_parse(spark: SparkSession, d: str) -> DataFrame:
    return good_rows(parse_typed(_log_lines(spark, d), APP_LOG)).select("ts", "start", "common.*")


@query
def app_log_route(spark: SparkSession, d: str) -> DataFrame:
    return ods.route_app_log(_log_lines(spark, d)).select("event_id", "topic")


@query
def raw_log_landing(spark: SparkSession, d: str) -> DataFrame:
    path = workspace(spark, "raw-log")
    lines = _log_lines(spark, d).withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    files.write_text_days(lines, path)
    landed = spark.read.schema("value STRING, dt STRING").text(path)
    return landed.groupBy("dt").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars")
    )


@query
def cdc_single_filter(spark: SparkSession, d: str) -> DataFrame:
    changes = ods.parse_cdc_rows(cdc_messages(spark, d))
    return ods.cdc_filter(changes).select("table", "type", "data")


@query
def cdc_route_topic(spark: SparkSession, d: str) -> DataFrame:
    changes = ods.cdc_filter(ods.parse_cdc_rows(cdc_messages(spark, d)))
    return ods.topic_messages(changes).groupBy("topic").agg(
        F.count(F.lit(1)).alias("n_messages"), F.sum(F.length("value")).alias("n_chars")
    )


@query
def cdc_array_explode(spark: SparkSession, d: str) -> DataFrame:
    envelopes = ods.parse_cdc_arrays(records.cdc_arrays(spark, d))
    return ods.with_topic(ods.cdc_explode(envelopes)).select("topic", "data")


@query
def ods_to_json(spark: SparkSession, d: str) -> DataFrame:
    rows = records.orders(spark, d).withColumn("create_time", time_text(F.col("create_time")))
    return rows.select(json_of("order_id", "user_id", "order_status", "create_time").alias("value"))


@query
def dwd_order_keyed_json(spark: SparkSession, d: str) -> DataFrame:
    rows = _orders(spark, d).select("order_id", "user_id", "final_total_cents", "dt")
    return keyed_json(rows, "order_id")


# ---- DIM -----------------------------------------------------------------------------------


@query
def dim_scan(spark: SparkSession, d: str) -> DataFrame:
    return records.provinces(spark, d)


@query
def dim_point_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Dimension rows of the keys seen in a batch: the users of one day's orders."""
    seen = records.orders(spark, d, ORDER_DAY).select("user_id").distinct()
    return records.users(spark, d).join(seen, "user_id", "left_semi").select(
        "user_id", "user_level", "gender"
    )


@query
def dim_query_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a SQL query over dimension tables, typed by the result itself."""
    return spark.sql(
        "SELECT tm_id, count(*) AS n_sku, max(price_cents) AS max_price_cents"
        " FROM {skus} GROUP BY tm_id",
        skus=records.skus(spark, d),
    )


@query
def dim_upsert_latest(spark: SparkSession, d: str) -> DataFrame:
    """Users after a second batch of changes: every third user gets a new level."""
    path = workspace(spark, "dim-user")
    first = records.users(spark, d).select("user_id", "user_level", "gender")
    changed = first.filter("user_id % 3 = 0").withColumn("user_level", F.lit("VIP"))
    write = files.upsert_writer(path)
    write(first, 0)
    write(changed, 1)
    write(changed, 1)
    return files.upserted(spark, path, ["user_id"])


@query
def user_age_group(spark: SparkSession, d: str) -> DataFrame:
    return _users(spark, d).select(
        "user_id", F.col("birthday").cast("string").alias("birthday"), "age_group"
    )


@query
def user_gender_name(spark: SparkSession, d: str) -> DataFrame:
    return _users(spark, d).select("user_id", "gender", "gender_name")


@query
def sku_enrich(spark: SparkSession, d: str) -> DataFrame:
    return enriched_skus(spark, d).select(
        "sku_id", "spu_id", "price_cents", "sku_name", "tm_id", "category3_id",
        "category3_name", "spu_name", "tm_name",
    )


# ---- DWD -----------------------------------------------------------------------------------


@query
def event_time_parts_query(spark: SparkSession, d: str) -> DataFrame:
    events = records.app_events(spark, d)
    return events.select("event_id", *event_time_parts(F.timestamp_millis("ts_ms")))


@query
def order_time_parts_query(spark: SparkSession, d: str) -> DataFrame:
    text = records.orders(spark, d).select("order_id", time_text(F.col("create_time")).alias("t"))
    return text.select("order_id", *order_time_parts(F.col("t")))


@query
def dau_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dwd.daily_first_events(records.app_events(spark, d)).select("mid", "dt", "ts_ms")


def late_events(spark: SparkSession, d: str) -> DataFrame:
    """Log events of which a third comes in at once, a third after 23 and a third after 48 hours."""
    hours = F.element_at(F.array(F.lit(0), F.lit(23), F.lit(48)), (F.col("event_id") % 3 + 1).cast("int"))
    return records.app_events(spark, d).select(
        "mid", "ts", "ts_ms", "event_id", (F.col("ts") + F.make_dt_interval(hours=hours)).alias("arrived")
    )


def shown_actives(rows: DataFrame) -> DataFrame:
    times = {c: time_text(F.col(c)) for c in ("arrived", "kept_until")}
    return rows.withColumns(times)


@query
def dau_kept_actives(spark: SparkSession, d: str) -> DataFrame:
    """Daily actives by a state that ends 24 hours after a device's last event came in."""
    return shown_actives(dwd.kept_actives(late_events(spark, d)))


@query
def dau_project(spark: SparkSession, d: str) -> DataFrame:
    return _dau(spark, d)


@query
def dau_index_write(spark: SparkSession, d: str) -> DataFrame:
    """Index of daily actives by day and device: two batches that overlap, and the second one again, as
    after a failed commit. A day's devices lie in the folder of the day."""
    rows = _dau(spark, d).withColumn("dt", F.to_date("dt"))
    index = DayStore(spark, workspace(spark, "dau-index"), rows.schema, ("mid",))
    index.merge(rows.filter("hr < '12'"), "morning")
    for _ in range(2):
        index.merge(rows.filter("hr >= '08'"), "day")
    return index.read().withColumn("dt", F.date_format("dt", "yyyy-MM-dd"))


@query
def order_province_join(spark: SparkSession, d: str) -> DataFrame:
    return dims.add_province(_located_orders(spark, d), records.provinces(spark, d)).select(
        "order_id", "province_name", "province_area_code", "province_iso_code",
        "province_iso_3166_2",
    )


@query
def order_user_join(spark: SparkSession, d: str) -> DataFrame:
    return dims.add_user(records.orders(spark, d), _users(spark, d)).select(
        "order_id", "user_id", "user_age_group", "user_gender"
    )


@query
def order_user_level(spark: SparkSession, d: str) -> DataFrame:
    """Orders with the level their user had at the time: every third user changed it once."""
    people = records.users(spark, d).select("user_id", "user_level")
    log = people.withColumn("valid_from", F.lit("1900-01-01").cast("timestamp")).unionByName(
        people.filter("user_id % 3 = 0").withColumns(
            {"user_level": F.lit("VIP"), "valid_from": F.lit(STATE_DAY).cast("timestamp")}
        )
    )
    valid = dims.versions(log, "user_id")
    return dims.as_of(records.orders(spark, d), valid, "user_id", "create_time").select(
        "order_id", "user_id", "user_level"
    )


@query
def detail_sku_join(spark: SparkSession, d: str) -> DataFrame:
    return dims.add_sku(records.order_lines(spark, d), enriched_skus(spark, d)).select(
        "order_detail_id", "order_id", "sku_id", "sku_name", "spu_id", "tm_id", "category3_id",
        "spu_name", "tm_name", "category3_name",
    )


@query
def order_first_flag(spark: SparkSession, d: str) -> DataFrame:
    return dwd.flag_first_orders(records.orders(spark, d)).select(
        "order_id", "user_id", "if_first_order"
    )


@query
def order_first_flag_with_state(spark: SparkSession, d: str) -> DataFrame:
    """Orders from a day on, flagged against the state left by all orders before it."""
    rows = records.orders(spark, d)
    state = dwd.user_state_rows(dwd.flag_first_orders(rows.filter(F.col("dt") < STATE_DAY)))
    batch = rows.filter(F.col("dt") >= STATE_DAY)
    return dwd.flag_first_orders(batch, state).select("order_id", "user_id", "if_first_order")


@query
def order_user_state(spark: SparkSession, d: str) -> DataFrame:
    return dwd.user_state_rows(dwd.flag_first_orders(records.orders(spark, d)))


@query
def new_customers_anti(spark: SparkSession, d: str) -> DataFrame:
    rows = records.orders(spark, d)
    state = dwd.user_state_rows(dwd.flag_first_orders(rows.filter(F.col("dt") < STATE_DAY)))
    return dwd.new_customers(rows.filter(F.col("dt") >= STATE_DAY), state)


# ---- DWS -----------------------------------------------------------------------------------


def full_wide(spark: SparkSession, d: str) -> DataFrame:
    """The whole wide table, in cents and with `create_time` as a timestamp."""
    lines = records.order_lines(spark, d)
    facts = dwd.flag_first_orders(records.orders(spark, d))
    # One lookup of the user gives both the province key and the labels.
    people = _users(spark, d).select(
        "user_id", "province_id", F.col("age_group").alias("user_age_group"),
        F.col("gender_name").alias("user_gender"),
    )
    facts = dims.add_province(facts.join(people, "user_id", "left"), records.provinces(spark, d))
    if dws.has_hot_order(lines):
        once = dws.unique_lines(lines)
        allocated = dws.allocate(records.orders_with_amounts(facts, once), once)
        return dws.order_wide(dims.add_sku(allocated, enriched_skus(spark, d)))
    # Skus join the narrow lines, so the wide rows stay where their order is.
    allocated = dws.allocate_by_order(facts, dims.with_skus(lines, records.skus(spark, d)))
    names = (read(spark, d) for read in (records.categories, records.trademarks, records.spus))
    return dws.order_wide(dims.add_listed_skus(allocated, *names))


@query
def order_wide_join(spark: SparkSession, d: str) -> DataFrame:
    return full_wide(spark, d).withColumn("create_time", time_text(F.col("create_time")))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return dws.join_wide(records.orders(spark, d), records.order_lines(spark, d))


@query
def order_wide_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Joined pairs as two overlapping windows give them, every second order twice."""
    times = F.when(F.col("order_id") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    seen_twice = _pairs(spark, d).withColumn("_copy", F.explode(times)).drop("_copy")
    return dws.dedup_lines(seen_twice).select("order_detail_id", "order_id", "sku_id", "line_cents")


def _resent_store(spark: SparkSession, d: str) -> DayStore:
    """Wide rows merged into their days, then every fifth order again, a minute later with a new status,
    and that change a second time, as after a failed commit."""
    rows = _pairs(spark, d).select(
        "order_detail_id", "order_id", "order_status", "create_time", "line_cents",
        F.to_date("dt").alias("dt"),
    )
    minute = F.make_dt_interval(mins=F.lit(1))
    again = rows.filter("order_id % 5 = 0").withColumns(
        {"order_status": F.lit("RESENT"), "create_time": F.col("create_time") + minute}
    )

    def build() -> DayStore:
        store = DayStore(
            spark, workspace(spark, "resent"), rows.schema, ("order_id", "order_detail_id"),
            "create_time", line_grain(spark, d),
        )
        store.merge(rows, "first")
        for _ in range(2):
            store.merge(again, "again")
        return store

    return once(spark, d, "resent", build)


@query
def order_wide_latest(spark: SparkSession, d: str) -> DataFrame:
    return _resent_store(spark, d).read().select(
        "order_detail_id", F.date_format("dt", "yyyy-MM-dd").alias("dt"), "order_status",
        time_text(F.col("create_time")).alias("create_time"),
    )


@query
def order_wide_latest_amount(spark: SparkSession, d: str) -> DataFrame:
    """Sums over the newest versions, so that a resent row counts once."""
    return _resent_store(spark, d).read().groupBy(F.date_format("dt", "yyyy-MM-dd").alias("dt")).agg(
        F.sum("line_cents").alias("amount_cents"), F.count(F.lit(1)).alias("n_lines")
    )


@query
def order_wide_shard_counts(spark: SparkSession, d: str) -> DataFrame:
    """Lines written to eight shards and counted from what was written."""
    path = workspace(spark, "shards")
    files.write_shards(records.order_lines(spark, d), path, "order_detail_id", 8)
    stored = spark.read.parquet(path)
    return stored.groupBy(F.col("shard").cast("long").alias("shard")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query
def order_wide_store(spark: SparkSession, d: str) -> DataFrame:
    """The whole wide table as it is stored, in cents and text again."""
    wide = shop_stores(spark, d).wide_rows()
    return wide.withColumn("create_time", time_text(F.col("create_time")))


@query
def order_split_amount(spark: SparkSession, d: str) -> DataFrame:
    return allocated_lines(spark, d).select(
        "order_id", "order_detail_id", "line_cents", "final_detail_cents"
    )


@query
def order_split_check(spark: SparkSession, d: str) -> DataFrame:
    return allocated_lines(spark, d).groupBy("order_id").agg(
        F.max("final_total_cents").alias("final_total_cents"),
        F.sum("final_detail_cents").alias("split_sum_cents"),
    )


@query
def order_detail_unmatched(spark: SparkSession, d: str) -> DataFrame:
    rows, lines = records.orders(spark, d), records.order_lines(spark, d)
    bare = dws.orders_without_lines(rows, lines).select(F.lit("order").alias("kind"), F.col("order_id").alias("id"))
    lost = dws.lines_without_order(rows, lines).select(F.lit("line").alias("kind"), F.col("order_detail_id").alias("id"))
    return bare.unionByName(lost)


# ---- ADS -----------------------------------------------------------------------------------


@query
def trademark_batch_amount(spark: SparkSession, d: str) -> DataFrame:
    return ads.stored_amounts(shop_stores(spark, d).trademarks.read())


@query
def trademark_topn(spark: SparkSession, d: str) -> DataFrame:
    """Top brands strictly between two times, from the stored sums of these days."""
    stat = ads.stored_amounts(shop_stores(spark, d).trademarks.read(STAT_START, STAT_END))
    return ads.trademark_topn(stat, STAT_START, STAT_END, TOP_N)


@query
def trademark_topn_xy(spark: SparkSession, d: str) -> DataFrame:
    return serving.chart_points(trademark_topn(spark, d), "trademark_name", "order_amount_cents")


@query
def spu_amount(spark: SparkSession, d: str) -> DataFrame:
    stat = ads.stored_amounts(shop_stores(spark, d).spus.read())
    sums = stat.groupBy("spu_id", "spu_name").agg(F.sum("amount_cents").alias("amount_cents"))
    return sums.withColumn("spu_id", F.col("spu_id").cast("bigint"))


@query
def category_amount(spark: SparkSession, d: str) -> DataFrame:
    wide = shop_stores(spark, d).wide_rows()
    return wide.groupBy("category3_id", "category3_name").agg(
        F.sum("final_detail_cents").alias("amount_cents"), F.count(F.lit(1)).alias("line_count")
    )


def _user_attribute_amounts(spark: SparkSession, d: str, attribute: str) -> DataFrame:
    return ads.amounts_by_user_attribute(
        ads.amounts_by_user(_orders(spark, d)), _users(spark, d), attribute
    )


@query
def province_amount(spark: SparkSession, d: str) -> DataFrame:
    sums = _user_attribute_amounts(spark, d, "province_id")
    return dims.add_province(sums, records.provinces(spark, d)).select(
        "province_id", "province_name", "amount_cents", "order_count"
    )


@query
def age_group_amount(spark: SparkSession, d: str) -> DataFrame:
    return _user_attribute_amounts(spark, d, "age_group")


@query
def gender_amount(spark: SparkSession, d: str) -> DataFrame:
    return _user_attribute_amounts(spark, d, "gender_name")


@query
def dim_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    people = _users(spark, d).select("user_id", "province_id", "age_group", "gender_name")
    kinds = records.skus(spark, d).select("sku_id", "category3_id")
    # User and sku are the join keys, so sum to the pair before looking either up.
    sums = allocated_lines(spark, d).join(kinds, "sku_id", "left").groupBy("user_id", "category3_id").agg(
        F.sum("final_detail_cents").alias("amount_cents"), F.count(F.lit(1)).alias("line_count")
    )
    names = ["province_id", "age_group", "gender_name", "category3_id"]
    return ads.dimension_sets(sums.join(people, "user_id", "left"), names)


def _line_counts(spark: SparkSession, d: str, attribute: str) -> DataFrame:
    """Order lines per user attribute, counted by order and by user before the lookups."""
    per_order = records.order_lines(spark, d).groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    per_user = (
        records.orders(spark, d).join(per_order, "order_id")
        .groupBy("user_id").agg(F.sum("n").alias("n"))
    )
    people = _users(spark, d).select("user_id", attribute)
    return per_user.join(people, "user_id").groupBy(attribute).agg(F.sum("n").alias("n"))


@query
def gender_share(spark: SparkSession, d: str) -> DataFrame:
    return ads.shares(_line_counts(spark, d, "gender_name"), "gender_name", "n")


@query
def age_share(spark: SparkSession, d: str) -> DataFrame:
    return ads.shares(_line_counts(spark, d, "age_group"), "age_group", "n")


@query
def province_map_bands(spark: SparkSession, d: str) -> DataFrame:
    return ads.value_bands(province_amount(spark, d), "order_count").select(
        "province_name", "order_count", "band"
    )


# ---- serving -------------------------------------------------------------------------------


@query
def dau_total(spark: SparkSession, d: str) -> DataFrame:
    return serving.dau_total(_dau(spark, d, DAU_DAY))


@query
def dau_hour(spark: SparkSession, d: str) -> DataFrame:
    return serving.dau_by_hour(_dau(spark, d, DAU_DAY))


@query
def dau_hour_compare(spark: SparkSession, d: str) -> DataFrame:
    hourly = _dau(spark, d, previous_day(DAU_DAY), DAU_DAY).groupBy("dt", "hr").agg(
        F.count(F.lit(1)).alias("dau")
    )
    return serving.compare_hours(spark, hourly, "dau", DAU_DAY)


@query
def dau_hour_map(spark: SparkSession, d: str) -> DataFrame:
    return serving.hour_map(dau_hour(spark, d), "dau")


@query
def new_device_day(spark: SparkSession, d: str) -> DataFrame:
    return first_seen(spark, d, DAU_DAY).new_by_day()


PAID = "final_detail_cents"


@query
def order_amount_day(spark: SparkSession, d: str) -> DataFrame:
    return serving.order_amount_total(shop_stores(spark, d).wide_rows(ORDER_DAY), PAID)


@query
def order_amount_hour(spark: SparkSession, d: str) -> DataFrame:
    return serving.order_amount_by_hour(shop_stores(spark, d).wide_rows(ORDER_DAY), PAID)


@query
def order_amount_hour_compare(spark: SparkSession, d: str) -> DataFrame:
    hour = F.date_format("create_time", "HH").alias("hr")
    rows = shop_stores(spark, d).wide_rows(previous_day(ORDER_DAY), ORDER_DAY)
    hourly = rows.groupBy("dt", hour).agg(F.sum(PAID).alias("amount"))
    return serving.compare_hours(spark, hourly, "amount", ORDER_DAY)


@query
def kpi_total(spark: SparkSession, d: str) -> DataFrame:
    new_devices = first_seen(spark, d, DAU_DAY).new_by_day(DAU_DAY)
    return serving.kpi_total(
        _dau(spark, d, DAU_DAY), new_devices, shop_stores(spark, d).wide_rows(ORDER_DAY), PAID
    )


@query
def event_sliding_counts(spark: SparkSession, d: str) -> DataFrame:
    windows = records.app_events(spark, d).groupBy(F.window("ts", "10 seconds", "5 seconds").alias("w"))
    return windows.agg(F.count(F.lit(1)).alias("n")).select(
        time_text(F.col("w.start")).alias("window_start"), "n"
    )


# ---- search --------------------------------------------------------------------------------


def document_index(spark: SparkSession, d: str) -> PostingIndex:
    """Index of the documents' texts, languages and sources."""

    def build() -> PostingIndex:
        index = PostingIndex(spark, workspace(spark, "postings"))
        index.add(records.table(spark, d, "documents"), "doc_id", ["text", "lang", "source"], 0)
        return index

    return once(spark, d, "postings", build, ["documents"])


def _hits(spark: SparkSession, d: str) -> DataFrame:
    return search.must_match(
        records.table(spark, d, "documents"),
        document_index(spark, d),
        "doc_id",
        {"text": DOC_WORDS, "lang": DOC_LANGS},
        {"n_chars": DOC_MIN_CHARS},
    )


@query
def keyword_match(spark: SparkSession, d: str) -> DataFrame:
    return _hits(spark, d).select("doc_id", "lang", "n_chars")


@query
def keyword_should(spark: SparkSession, d: str) -> DataFrame:
    return search.should_match(
        records.table(spark, d, "documents"),
        document_index(spark, d),
        "doc_id",
        [("text", "que der"), ("source", "src1")],
        {"n_chars": DOC_MIN_CHARS},
    ).select("doc_id", "lang", "source", "n_chars")


@query
def keyword_highlight(spark: SparkSession, d: str) -> DataFrame:
    return search.with_highlight(_hits(spark, d), "text", DOC_WORDS).select("doc_id", "highlight")


@query
def keyword_page(spark: SparkSession, d: str) -> DataFrame:
    hits = _hits(spark, d).select("doc_id", "lang", "n_chars")
    return search.page(hits, [F.col("n_chars"), F.col("doc_id")], 1, 20)


@query
def keyword_page_after(spark: SparkSession, d: str) -> DataFrame:
    """The second page by the key of the last row of the first."""
    hits, keys = _hits(spark, d).select("doc_id", "lang", "n_chars"), ["n_chars", "doc_id"]
    seen = search.page_after(hits, keys, None, 20).select(*keys).collect()
    return search.page_after(hits, keys, tuple(seen[-1]) if seen else None, 20)


def _detail_hits(spark: SparkSession, d: str) -> DataFrame:
    return search.detail_hits(records.order_lines(spark, d), records.skus(spark, d), KEYWORD)


@query
def detail_search_total(spark: SparkSession, d: str) -> DataFrame:
    return search.total_hits(_detail_hits(spark, d))


@query
def detail_search_page(spark: SparkSession, d: str) -> DataFrame:
    """Second page of the order lines with the keyword, every page column, over all days."""
    hits = _detail_hits(spark, d)
    first = search.page(hits, [F.col("order_detail_id")], 1, 20)
    rows = first.join(records.orders(spark, d), "order_id").join(_users(spark, d), "user_id", "left")
    rows = rows.join(records.categories(spark, d), "category3_id", "left")
    age = F.call_function("div", F.datediff(F.lit(AS_OF).cast("date"), F.col("birthday")), F.lit(365))
    return rows.select(
        "order_detail_id", "user_id", "sku_id", F.col("gender").alias("user_gender"),
        age.cast("bigint").alias("user_age"), "user_level", F.col("price_cents").alias("order_price_cents"),
        "sku_name", "tm_id", "category3_id", "category3_name", "spu_id", "sku_num",
        F.lit(1).cast("bigint").alias("order_count"), F.col("line_cents").alias("order_amount_cents"), "dt",
    )


@query
def detail_search_day(spark: SparkSession, d: str) -> DataFrame:
    """First page of one day's wide rows with the keyword, from the day's files."""
    hits = search.wide_hits(shop_stores(spark, d).wide_rows(ORDER_DAY), ORDER_DAY, KEYWORD)
    first = search.page(hits, [F.col("order_detail_id")], 0, 10)
    # The stored row has the unit price, rounded; the line's own amount is that of the line.
    lines = records.order_lines(spark, d).select("order_id", "order_detail_id", "line_cents")
    return first.join(lines.dropDuplicates(dws.LINE_KEY), dws.LINE_KEY).select(
        "order_detail_id", "order_id", "user_id", "sku_name", "tm_name", "line_cents", "dt"
    )


def _detail_form(spark: SparkSession, d: str) -> search.DetailSearch:
    return search.DetailSearch(
        shop_stores(spark, d).wide_rows(ORDER_DAY), ORDER_DAY, KEYWORD, ("order_detail_id", "order_id"), 3
    )


@query
def detail_form_total(spark: SparkSession, d: str) -> DataFrame:
    return _detail_form(spark, d).total()


@query
def detail_form_gender_share(spark: SparkSession, d: str) -> DataFrame:
    return _detail_form(spark, d).shares("user_gender")


@query
def detail_form_age_share(spark: SparkSession, d: str) -> DataFrame:
    return _detail_form(spark, d).shares("user_age_group")


@query
def detail_form_page(spark: SparkSession, d: str) -> DataFrame:
    """The second page, by the key of the last row of the first."""
    form = _detail_form(spark, d)
    seen = form.page().select(*form.keys).collect()
    return form.page(form.key_of(seen[-1]) if seen else None).select(
        "order_detail_id", "order_id", "user_id", "sku_name", "tm_name", "final_detail_cents", "user_age_group",
        "user_gender", "dt",
    )


def _detail_share(spark: SparkSession, d: str, attribute: str) -> DataFrame:
    """Share of a user attribute among the lines a keyword search finds."""
    per_order = _detail_hits(spark, d).groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    per_user = (
        records.orders(spark, d).join(per_order, "order_id")
        .groupBy("user_id").agg(F.sum("n").alias("n"))
    )
    people = _users(spark, d).select("user_id", attribute)
    counts = per_user.join(people, "user_id").groupBy(attribute).agg(F.sum("n").alias("n"))
    return ads.shares(counts, attribute, "n")


@query
def detail_search_gender_share(spark: SparkSession, d: str) -> DataFrame:
    return _detail_share(spark, d, "gender_name")


@query
def detail_search_age_share(spark: SparkSession, d: str) -> DataFrame:
    return _detail_share(spark, d, "age_group")


@query
def doc_with_array(spark: SparkSession, d: str) -> DataFrame:
    """Documents indexed with an array field, the latest write of an id winning."""
    path = workspace(spark, "doc-index")
    docs = records.table(spark, d, "documents").select(
        "doc_id", F.array("lang", "source").alias("tags"), F.lit(1).alias("version")
    )
    files.batch_writer(path)(docs, 0)
    again = docs.withColumns({"tags": F.array_append("tags", "again"), "version": F.lit(2)})
    files.batch_writer(path)(again.filter("doc_id % 4 = 0"), 1)
    stored = latest_per_key(spark.read.parquet(path), ["doc_id"], [F.col("batch_id").desc()])
    return stored.select(
        "doc_id", F.size("tags").cast("bigint").alias("n_tags"), F.array_join("tags", ",").alias("tags")
    )


for _plain, _long in (("event_time_parts", "event_time_parts_query"), ("order_time_parts", "order_time_parts_query")):
    REGISTRY[_plain] = REGISTRY.pop(_long)
