"""DWD: cleaned facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.times import event_time_parts
from .keyed import first_per_key

DAU_COLUMNS = ["mid", "uid", "ar", "ch", "vc", "dt", "hr", "mi", "ts_ms"]


def daily_first_events(events: DataFrame) -> DataFrame:
    """One row per device and day: its first event."""
    parted = events.select("*", *event_time_parts(F.col("ts")))
    return first_per_key(parted, ["mid", "dt"], [F.col("ts"), F.col("event_id")])


def kept_actives(events: DataFrame, kept: str = "24 hours") -> DataFrame:
    """Daily actives as a state gives them that forgets a device's day once nothing came for `kept`.

    Each event that comes in (`arrived`) moves the end, so a device is active once per day as long as no gap
    is greater; after one it counts again, also for a day long past. One row per device, day and stretch:
    its first event by arrival, when that came, when the state ends, and the number of events. On a stream
    with a watermark on `arrived` this is the state itself.
    """
    by_day = events.select("mid", "ts_ms", "event_id", "arrived", F.date_format("ts", "yyyy-MM-dd").alias("dt"))
    stretches = by_day.groupBy("mid", "dt", F.session_window("arrived", kept).alias("_kept")).agg(
        F.min(F.struct("arrived", "ts_ms", "event_id")).alias("_first"), F.count(F.lit(1)).alias("n_events")
    )
    return stretches.select(
        "mid", "dt", F.col("_first.ts_ms").alias("ts_ms"), F.col("_first.arrived").alias("arrived"),
        F.col("_kept.end").alias("kept_until"), "n_events",
    )


def dau_rows(first_events: DataFrame) -> DataFrame:
    return first_events.select(*DAU_COLUMNS)


def flag_first_orders(orders: DataFrame, user_state: DataFrame | None = None) -> DataFrame:
    """`if_first_order`: '1' on a user's earliest order unless the user ordered before.

    The earliest orders are found with one row per user and map task, then matched by order id, so
    no join is keyed by a user with many orders except the lookup of the state itself.
    """
    candidates = orders.select("user_id", "order_id", "create_time")
    firsts = first_per_key(candidates, ["user_id"], [F.col("create_time"), F.col("order_id")])
    if user_state is not None:
        known = user_state.filter(F.col("if_consumed") == "1").select(
            F.col("user_id").cast("bigint").alias("user_id")
        )
        firsts = firsts.join(known, "user_id", "left_anti")
    marks = firsts.select("order_id", F.lit("1").alias("_first"))
    return (
        orders.join(marks, "order_id", "left")
        .withColumn("if_first_order", F.coalesce("_first", F.lit("0")))
        .drop("_first")
    )


def user_state_rows(flagged_orders: DataFrame) -> DataFrame:
    """State to keep after a batch: users whose first order was seen."""
    return flagged_orders.filter(F.col("if_first_order") == "1").select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("if_first_order").alias("if_consumed"),
    )


def new_customers(orders: DataFrame, user_state: DataFrame) -> DataFrame:
    """Users of these orders that never ordered before."""
    known = user_state.select(F.col("user_id").cast("bigint").alias("user_id"))
    return orders.select("user_id").distinct().join(known, "user_id", "left_anti")
