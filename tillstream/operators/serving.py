"""Serving: totals, hourly curves and the key figures of a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Names of the key figures.
KPI_DAU = ("dau", "新增日活")
KPI_NEW_DEVICE = ("new_mid", "新增设备")
KPI_ORDER_AMOUNT = ("order_amount", "新增交易额")


def dau_total(dau: DataFrame) -> DataFrame:
    return dau.agg(F.count(F.lit(1)).alias("dau"))


def dau_by_hour(dau: DataFrame) -> DataFrame:
    return dau.groupBy("hr").agg(F.count(F.lit(1)).alias("dau"))


def order_amount_total(rows: DataFrame, amount: str = "final_total_cents") -> DataFrame:
    """Paid amount; null when there are no rows.

    Order rows carry it in `final_total_cents`, rows of the wide table in `final_detail_cents`;
    read from a wide table stored by day, a day's figure opens that day's files only.
    """
    return rows.agg(F.sum(amount).alias("order_amount_cents"))


def order_amount_by_hour(rows: DataFrame, amount: str = "final_total_cents") -> DataFrame:
    hour = F.date_format("create_time", "HH").alias("hr")
    return rows.groupBy(hour).agg(F.sum(amount).alias("order_amount_cents"))


def compare_hours(spark: SparkSession, hourly: DataFrame, value: str, today: str) -> DataFrame:
    """Today against yesterday over the 24 hours, 0 where nothing happened.

    `hourly` has `dt, hr` and the value for the two days; one pass over it fills both columns.
    """
    is_today = F.col("dt") == today
    sides = hourly.groupBy("hr").agg(
        F.sum(F.when(is_today, F.col(value))).alias("today"),
        F.sum(F.when(~is_today, F.col(value))).alias("yesterday"),
    )
    hours = spark.range(24).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hr"))
    return hours.join(sides, "hr", "left").select(
        "hr",
        F.coalesce("today", F.lit(0)).cast("bigint").alias("today"),
        F.coalesce("yesterday", F.lit(0)).cast("bigint").alias("yesterday"),
    )


def hour_map(hourly: DataFrame, value: str) -> DataFrame:
    """The JSON object hour → value that a dashboard reads, from at most 24 rows."""
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct("hr", value))))
    return hourly.agg(F.to_json(entries).alias("value"))


def new_devices_by_day(events: DataFrame) -> DataFrame:
    """Devices seen for the first time ever, per day, from all events; `sinks.first_seen` keeps them."""
    first = events.groupBy("mid").agg(F.min("ts").alias("ts"))
    return first.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("dt")).agg(
        F.count(F.lit(1)).alias("new_devices")
    )


def _kpi(df: DataFrame, kpi: tuple[str, str], value: str) -> DataFrame:
    return df.select(
        F.lit(kpi[0]).alias("id"),
        F.lit(kpi[1]).alias("name"),
        F.coalesce(F.col(value), F.lit(0)).cast("bigint").alias("value"),
    )


def kpi_total(
    dau: DataFrame, new_devices: DataFrame, day_orders: DataFrame, amount: str = "final_total_cents"
) -> DataFrame:
    """Three key figures of a day: active devices, new devices, order amount in cents."""
    return (
        _kpi(dau_total(dau), KPI_DAU, "dau")
        .unionByName(
            _kpi(new_devices.agg(F.sum("new_devices").alias("n")), KPI_NEW_DEVICE, "n")
        )
        .unionByName(_kpi(order_amount_total(day_orders, amount), KPI_ORDER_AMOUNT, "order_amount_cents"))
    )


def chart_points(topn: DataFrame, x: str, y: str) -> DataFrame:
    return topn.select(F.col(x).alias("x"), F.col(y).alias("y"), F.lit("1").alias("s"))
