"""ADS: sums by brand, SPU, category, province, age group and gender.

Amounts are summed by sku or by user before the join with the dimension, so a best-selling sku or
a very busy user reaches the join as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.money import int_div

AMOUNT = "amount_cents"


def _measures(amount: str) -> list[Column]:
    return [F.sum(amount).alias(AMOUNT), F.count(F.lit(1)).alias("line_count")]


def _add_measures() -> list[Column]:
    return [F.sum(AMOUNT).alias(AMOUNT), F.sum("line_count").alias("line_count")]


def amounts_by_sku(allocated: DataFrame) -> DataFrame:
    return allocated.groupBy("sku_id").agg(*_measures("final_detail_cents"))


def amounts_by_sku_attribute(sku_amounts: DataFrame, skus: DataFrame, attribute: str) -> DataFrame:
    """Sums by a sku attribute; skus missing from the dimension keep a null attribute."""
    return (
        sku_amounts.join(skus.select("sku_id", attribute), "sku_id", "left")
        .groupBy(attribute)
        .agg(*_add_measures())
    )


def amounts_by_user(orders: DataFrame) -> DataFrame:
    """Paid amount per user, from order rows.

    The allocation of an order sums to its total, so reports by order attributes need no lines.
    """
    return orders.groupBy("user_id").agg(
        F.sum("final_total_cents").alias(AMOUNT), F.count(F.lit(1)).alias("order_count")
    )


def amounts_by_user_attribute(user_amounts: DataFrame, users: DataFrame, attribute: str) -> DataFrame:
    return (
        user_amounts.join(users.select("user_id", attribute), "user_id", "left")
        .groupBy(attribute)
        .agg(F.sum(AMOUNT).alias(AMOUNT), F.sum("order_count").alias("order_count"))
    )


def daily_amounts(wide: DataFrame, key: str, id_name: str, name: str) -> DataFrame:
    """Rows of a result table from stored wide rows: per day and brand (`tm`) or SPU (`spu`) what was
    paid, with the day standing for the time of the batch."""
    return (
        wide.groupBy("dt", F.col(f"{key}_id").cast("string").alias(id_name), F.col(f"{key}_name").alias(name))
        .agg(F.sum("final_detail_amount").cast("decimal(16,2)").alias("amount"))
        .withColumn("stat_time", F.col("dt").cast("timestamp"))
    )


def stored_amounts(stored: DataFrame) -> DataFrame:
    """Rows of a result table in cents, with the day of `stat_time` as text."""
    return stored.withColumns({
        "stat_time": F.date_format("stat_time", "yyyy-MM-dd"),
        AMOUNT: (F.col("amount") * 100).cast("bigint"),
    }).drop("amount", "dt")


def trademark_topn(stat: DataFrame, start: str, end: str, n: int) -> DataFrame:
    """Top brands of the result table between two times, both exclusive."""
    return (
        stat.filter((F.col("stat_time") > start) & (F.col("stat_time") < end))
        .groupBy("trademark_id", "trademark_name")
        .agg(F.sum(AMOUNT).alias("order_amount_cents"))
        .orderBy(F.col("order_amount_cents").desc(), F.col("trademark_id"))
        .limit(n)
    )


def dimension_sets(rows: DataFrame, dims: list[str]) -> DataFrame:
    """Sums by each single dimension and in total, in one pass over partial sums.

    They are summed to the finest combination first, so only that handful of rows is expanded.
    """
    finest = rows.groupBy(*dims).agg(*_add_measures())
    sets = [[d] for d in dims] + [[]]
    return finest.groupingSets(sets, *dims).agg(
        F.grouping_id(*dims).cast("bigint").alias("grouping_id"), *_add_measures()
    )


def shares(counts: DataFrame, name: str, count: str) -> DataFrame:
    """Counts with their share of all in basis points, rounded half up.

    `counts` is already one row per age group or gender, so the window sees a handful of rows.
    """
    total = F.sum(count).over(Window.partitionBy())
    share = int_div(F.col(count) * 20000 + total, total * 2)
    return counts.select(name, count, share.alias("share_bp"))


def value_bands(df: DataFrame, value: str, bands: int = 6) -> DataFrame:
    """Band number of a value: `bands` equal bands from 0 to the greatest value.

    `df` is a report of a few rows, as many as there are provinces, so the window sees no more.
    """
    end = F.max(value).over(Window.partitionBy()) + 1
    return df.withColumn("band", int_div(F.col(value) * bands, end))
