"""Date and time parts."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, functions as F


def event_time_parts(ts: Column) -> list[Column]:
    """`dt`, `hr`, `mi` of an event time, each zero padded."""
    return [
        F.date_format(ts, "yyyy-MM-dd").alias("dt"),
        F.date_format(ts, "HH").alias("hr"),
        F.date_format(ts, "mm").alias("mi"),
    ]


def order_time_parts(create_time: Column) -> list[Column]:
    """`create_date`, `create_hour` of a `yyyy-MM-dd HH:mm:ss` text."""
    words = F.split(create_time, " ")
    return [
        words.getItem(0).alias("create_date"),
        F.split(words.getItem(1), ":").getItem(0).alias("create_hour"),
    ]


def time_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def in_days(column: Column, first: str, last: str) -> Column:
    """Whole days `first`..`last` on a zone-free time column, in a form the file scan can prune by."""
    end = (date.fromisoformat(last) + timedelta(days=1)).isoformat()
    return (column >= F.lit(first).cast("timestamp_ntz")) & (column < F.lit(end).cast("timestamp_ntz"))


def date_range(column: Column, first: str, last: str) -> Column:
    """Whole days `first`..`last` on a date column."""
    return column.between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def previous_day(day: str) -> str:
    return (date.fromisoformat(day) - timedelta(days=1)).isoformat()
