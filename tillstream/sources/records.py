"""Shop records derived from the given tables (mapping in FIXTURES.md).

Each function is a lazy projection; only the order line id and the cents need arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.money import discounted, to_cents
from ..functions.times import in_days, time_text


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def app_events(
    spark: SparkSession, folder: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Application log rows, optionally of the whole days `first`..`last` only."""
    events = table(spark, folder, "events")
    if first:
        events = events.filter(in_days(F.col("ts"), first, last or first))
    when = F.col("ts").cast("timestamp")
    user = F.col("user_id").cast("string")
    return events.select(
        "event_id",
        when.alias("ts"),
        F.unix_millis(when).alias("ts_ms"),
        user.alias("mid"),
        user.alias("uid"),
        (F.col("user_id") % 25).cast("string").alias("ar"),
        F.col("event_type").alias("ch"),
        F.get_json_object("props", "$.k").alias("vc"),
    )


def app_log_lines(events: DataFrame) -> DataFrame:
    """Log lines as the collector receives them; a signup carries a `start` field."""
    line = F.to_json(
        F.struct(
            F.col("ts_ms").alias("ts"),
            F.when(F.col("ch") == "signup", F.lit("1")).alias("start"),
            F.struct("mid", "uid", "ar", "ch", "vc").alias("common"),
        )
    )
    return events.select("event_id", "ts", line.alias("value"))


def users(spark: SparkSession, folder: str) -> DataFrame:
    birthday = F.date_add(
        F.lit("1960-01-01").cast("date"), (F.col("c_custkey") * 37 % 18000).cast("int")
    )
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("user_level"),
        birthday.alias("birthday"),
        F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"),
        F.col("c_nationkey").cast("bigint").alias("province_id"),
    )


def provinces(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, folder, "nation").select(
        key.cast("bigint").alias("province_id"),
        F.col("n_name").alias("province_name"),
        F.col("n_regionkey").cast("string").alias("region_id"),
        (key * 10000 + 110000).cast("string").alias("province_area_code"),
        F.concat(F.lit("N-"), F.lpad(key.cast("string"), 2, "0")).alias("province_iso_code"),
        F.concat(F.lit("R"), F.col("n_regionkey"), F.lit("-N"), key).alias("province_iso_3166_2"),
    )


def skus(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("sku_id"),
        F.col("p_size").cast("bigint").alias("spu_id"),
        to_cents(F.col("p_retailprice")).alias("price_cents"),
        F.col("p_name").alias("sku_name"),
        F.regexp_extract("p_brand", r"(\d+)", 1).cast("bigint").alias("tm_id"),
        F.upper("p_type").alias("category3_id"),
    )


def spus(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size")
    return (
        table(spark, folder, "part")
        .select(size.cast("bigint").alias("spu_id"), F.concat(F.lit("spu "), size).alias("spu_name"))
        .distinct()
    )


def trademarks(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "part")
        .select(
            F.regexp_extract("p_brand", r"(\d+)", 1).cast("bigint").alias("tm_id"),
            F.col("p_brand").alias("tm_name"),
        )
        .distinct()
    )


def categories(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "part")
        .select(
            F.upper("p_type").alias("category3_id"),
            F.col("p_type").alias("category3_name"),
        )
        .distinct()
    )


def orders(
    spark: SparkSession, folder: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Order rows without amounts, optionally of the whole days `first`..`last` only."""
    raw = table(spark, folder, "orders")
    if first:
        raw = raw.filter(in_days(F.col("o_orderdate"), first, last or first))
    seconds = (F.col("o_orderkey") * 7919 % 86400).cast("int")
    rows = raw.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=seconds)).alias(
            "create_time"
        ),
    )
    return rows.withColumn("dt", F.date_format("create_time", "yyyy-MM-dd"))


# Prime modulus and multipliers of the line digest.
_PRIME, _MULTIPLIERS = 2147483647, (16807, 48271)
_MISSING = -1_000_003


def _digest(fields: list[Column]) -> Column:
    """62 bits from two polynomial hashes, in BIGINT arithmetic that every SQL engine shares."""
    halves = []
    for multiplier in _MULTIPLIERS:
        h = F.lit(0).cast("bigint")
        for field in fields:
            # A missing field has a value of its own, which no real one has.
            h = (h * multiplier + F.coalesce(field, F.lit(_MISSING))) % _PRIME
        halves.append(h)
    return halves[0] * (_PRIME + 1) + halves[1]


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines. The id is a digest of the line itself, so giving it needs no shuffle or sort."""
    amount = to_cents(F.col("l_extendedprice"))
    discount = to_cents(F.col("l_discount"))
    number = F.col("l_quantity").cast("bigint")
    identity = [
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), number,
        amount, discount, to_cents(F.col("l_tax")), F.ascii("l_returnflag"),
        F.ascii("l_linestatus"), F.unix_date(F.col("l_shipdate").cast("date")),
    ]
    return table(spark, folder, "lineitem").select(
        _digest(identity).alias("order_detail_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        number.alias("sku_num"),
        amount.alias("line_cents"),
        discounted(amount, discount).alias("paid_cents"),
    )


def order_totals(lines: DataFrame) -> DataFrame:
    """Amounts of each order, summed before the shuffle."""
    return lines.groupBy("order_id").agg(
        F.sum("line_cents").alias("original_total_cents"),
        F.sum("paid_cents").alias("final_total_cents"),
    )


def orders_with_amounts(orders_df: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders that have lines, with their amounts."""
    return orders_df.join(order_totals(lines), "order_id").select(
        *orders_df.columns,
        (F.col("original_total_cents") - F.col("final_total_cents")).alias("benefit_reduce_cents"),
        "original_total_cents",
        F.lit(0).cast("bigint").alias("freight_cents"),
        "final_total_cents",
    )


def _envelope(name: str, df: DataFrame, key: str) -> DataFrame:
    last = F.col(key) % 10
    # Some envelopes have no type.
    kind = F.when(last == 0, "delete").when(last == 1, "update").when(last != 2, "insert")
    data = F.when(F.col(key) % 20 == 3, F.lit("{}")).otherwise(F.to_json(F.struct(*df.columns)))
    return df.select(
        F.lit(name).alias("table"), kind.alias("type"), F.col(key).cast("bigint").alias("row_key"),
        data.alias("data"),
    )


def cdc_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Single-row change envelopes of every shop table and of one table nobody listens to.

    The change type and some empty `data` come from the key.
    """
    order_cols = ["order_id", "user_id", "order_status"]
    pieces = [
        _envelope("order_info", orders(spark, folder).select(*order_cols), "order_id"),
        _envelope("order_detail", order_lines(spark, folder).select("order_detail_id", "order_id", "sku_id", "sku_num"), "order_detail_id"),
        _envelope("base_province", provinces(spark, folder).select("province_id", "province_name"), "province_id"),
        _envelope("user_info", users(spark, folder).select("user_id", "user_level", "gender"), "user_id"),
        _envelope("sku_info", skus(spark, folder).select("sku_id", "spu_id", "sku_name", "tm_id"), "sku_id"),
        _envelope("spu_info", spus(spark, folder).select("spu_id", "spu_name"), "spu_id"),
        _envelope("base_trademark", trademarks(spark, folder).select("tm_id", "tm_name"), "tm_id"),
        _envelope("base_category3", categories(spark, folder).withColumn("n", F.length("category3_name")), "n"),
        _envelope(
            "comment_info",
            table(spark, folder, "events").select("event_id", "event_type"),
            "event_id",
        ),
    ]
    out = pieces[0]
    for piece in pieces[1:]:
        out = out.unionByName(piece)
    return out


def cdc_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Array change envelopes as JSON text: none to three status rows per order in one message."""
    step = F.sequence(F.lit(0), (F.col("o_orderkey") % 4).cast("int"))
    rows = F.transform(
        F.slice(step, 2, 3),
        lambda i: F.struct(
            (F.col("o_orderkey") * 10 + i).alias("id"),
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderstatus").alias("order_status"),
        ),
    )
    message = F.to_json(F.struct(F.lit("order_status_log").alias("table"), rows.alias("data")))
    return table(spark, folder, "orders").select(message.alias("value"))
