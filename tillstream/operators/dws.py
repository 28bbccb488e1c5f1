"""DWS: the wide order-line table and the allocation of what was paid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.money import prorate, to_decimal
from ..schemas import ORDER_WIDE_COLUMNS, ORDER_WIDE_MONEY
from .keyed import first_per_key, latest_per_key

LINE_KEY = ["order_id", "order_detail_id"]

# Lines from which on an order is too much for one task.
HOT_LINES = 100_000


def join_wide(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Each order line with its order. A skewed order is split at run time."""
    return lines.join(orders, "order_id")


def dedup_lines(wide: DataFrame, order: str = "create_time") -> DataFrame:
    """One row per order line, for pairs that an overlapping window or a resend gave twice."""
    return first_per_key(wide, LINE_KEY, [F.col(order)], spread=True)


def latest_lines(wide: DataFrame, version: str = "create_time") -> DataFrame:
    """Newest version of each order line within its day, as a replacing table shows it."""
    return latest_per_key(wide, ["dt", *LINE_KEY], [F.col(version).desc()], spread=True)


def allocated_share() -> Column:
    """A line's rounded share of what the order paid, before the last line takes the rest."""
    return prorate(
        F.col("line_cents"), F.col("final_total_cents"), F.col("original_total_cents")
    )


def last_paid_line() -> Column:
    """Aggregate: the line that takes the remainder, the last by id of those that cost anything."""
    return F.coalesce(
        F.max(F.when(F.col("line_cents") > 0, F.col("order_detail_id"))), F.max("order_detail_id")
    )


def unique_lines(lines: DataFrame) -> DataFrame:
    """Order lines once each: a resent line has the id and the fields of the first."""
    return first_per_key(lines, LINE_KEY, [F.col("order_detail_id")], spread=True)


def allocate(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Wide rows with `final_detail_cents`: what each line paid, exact to the cent per order.

    The last line by id takes the remainder (see `last_paid_line`). Lines must be unique by id (see `unique_lines`), and the
    totals of `orders` must be sums over them. One way for all orders: shares are summed per order
    before the shuffle, and the sums are joined back by order id, so no order is gathered in one
    task and a skewed one is split at run time.
    """
    shares = join_wide(orders, lines).withColumn("_share", allocated_share())
    ends = shares.groupBy("order_id").agg(
        last_paid_line().alias("_last_id"), F.sum("_share").alias("_share_sum")
    )
    rest = F.col("final_total_cents") - F.col("_share_sum")
    extra = F.when(F.col("order_detail_id") == F.col("_last_id"), rest).otherwise(F.lit(0))
    return (
        shares.join(ends, "order_id")
        .withColumn("final_detail_cents", F.col("_share") + extra)
        .drop("_share", "_share_sum", "_last_id")
    )


def has_hot_order(lines: DataFrame, most: int = HOT_LINES) -> bool:
    """Whether an order has more than `most` lines; counted in the map tasks first."""
    counts = lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    return not counts.filter(F.col("n") > most).isEmpty()


def allocate_by_order(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """`allocate` of `unique_lines`, with the totals of the orders, where no order is hot.

    Lines move once, by order: they are made unique, summed and allocated where they then lie.
    """
    by_order = Window.partitionBy("order_id")
    once = first_per_key(lines.repartition("order_id"), LINE_KEY, [F.col("order_detail_id")])
    totals = once.withColumns({
        "original_total_cents": F.sum("line_cents").over(by_order),
        "final_total_cents": F.sum("paid_cents").over(by_order),
    }).drop("paid_cents")
    shares = totals.join(orders, "order_id").withColumns({
        "benefit_reduce_cents": F.col("original_total_cents") - F.col("final_total_cents"),
        "freight_cents": F.lit(0).cast("bigint"),
        "_share": allocated_share(),
    })
    paid = F.when(F.col("line_cents") > 0, F.col("order_detail_id"))
    last = F.coalesce(F.max(paid).over(by_order), F.max("order_detail_id").over(by_order))
    rest = F.col("final_total_cents") - F.sum("_share").over(by_order)
    extra = F.when(F.col("order_detail_id") == last, rest).otherwise(F.lit(0))
    return shares.withColumn("final_detail_cents", F.col("_share") + extra).drop("_share")


def unit_price(wide: DataFrame) -> DataFrame:
    return wide.withColumn(
        "sku_price_cents", prorate(F.col("line_cents"), F.lit(1).cast("bigint"), F.col("sku_num"))
    )


def order_wide(allocated: DataFrame) -> DataFrame:
    """Wide rows in the table's column order."""
    return unit_price(allocated).select(*ORDER_WIDE_COLUMNS)


def store_types(wide: DataFrame) -> DataFrame:
    """Wide rows as the store keeps them: DECIMAL(16,2) money, a DATE partition column."""
    columns = [
        to_decimal(F.col(c)).alias(ORDER_WIDE_MONEY[c]) if c in ORDER_WIDE_MONEY else F.col(c)
        for c in wide.columns
    ]
    return wide.select(*columns).withColumn("dt", F.col("dt").cast("date"))


def from_store(stored: DataFrame) -> DataFrame:
    """Stored rows with cents and a text day again."""
    names = {kept: inside for inside, kept in ORDER_WIDE_MONEY.items()}
    columns = [
        (F.col(c) * 100).cast("bigint").alias(names[c]) if c in names else F.col(c)
        for c in stored.columns
    ]
    return stored.select(*columns).withColumn("dt", F.date_format("dt", "yyyy-MM-dd"))


def orders_without_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    # Distinct first: the probed side of an anti join is never split, and a hot order repeats there.
    return orders.join(lines.select("order_id").distinct(), "order_id", "left_anti")


def lines_without_order(orders: DataFrame, lines: DataFrame) -> DataFrame:
    return lines.join(orders.select("order_id"), "order_id", "left_anti")
