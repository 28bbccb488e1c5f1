"""Stored results that reports read: the wide table by day, and the brand and SPU sums kept from it.

Each is built once per session and set of input files, from the tables of a folder, and read from then
on. A change of the wide table sums the touched days again and no others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import ads, dws
from ..session import file_state, workspace
from ..sinks.days import DayStore, grain_for
from ..sinks.first_seen import FirstSeen
from ..sources import records

_MONEY = T.DecimalType(16, 2)
Built = TypeVar("Built")
SOURCES = "lineitem orders part customer nation".split()


def _result_schema(name: str) -> T.StructType:
    """Columns of a result table of the source system, and the day its rows are kept under."""
    fields = [
        ("stat_time", T.TimestampType()), (f"{name}_id", T.StringType()), (f"{name}_name", T.StringType()),
        ("amount", _MONEY), ("dt", T.DateType()),
    ]
    return T.StructType([T.StructField(*f) for f in fields])


@dataclass(frozen=True)
class ShopStores:
    """The wide table and the result tables made of it."""

    wide: DayStore
    trademarks: DayStore
    spus: DayStore

    @classmethod
    def at(cls, spark: SparkSession, root: str, schema: T.StructType, grain: str) -> ShopStores:
        return cls(
            DayStore(spark, f"{root}/order_wide", schema, ("order_id", "order_detail_id"), "create_time", grain),
            DayStore(spark, f"{root}/trademark_amount", _result_schema("trademark"), ("trademark_id",), None, grain),
            DayStore(spark, f"{root}/spu_amount", _result_schema("spu"), ("spu_id",), None, grain),
        )

    def merge(self, wide_rows: DataFrame, commit: str) -> list[str]:
        """Upsert wide rows (in store types) and sum the touched days again."""
        touched = self.wide.merge(wide_rows, commit)
        if touched:
            changed = self.wide.read_parts(touched)
            for table, key in ((self.trademarks, "tm"), (self.spus, "spu")):
                table.replace(ads.daily_amounts(changed, key, *table.schema.names[1:3]), touched, commit)
        return touched

    def wide_rows(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Wide rows in cents, with the day as text."""
        return dws.from_store(self.wide.read(first, last))


_BUILT: dict[tuple, object] = {}


def once(
    spark: SparkSession, d: str, name: str, build: Callable[[], Built], sources: list[str] = SOURCES
) -> Built:
    """What `build` makes of a folder's tables, made once as long as the files stay as they are."""
    state = tuple(file_state(spark, f"{d}/{source}.parquet") for source in sources)
    key = (spark.sparkContext.applicationId, d, name, state)
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]


def line_grain(spark: SparkSession, d: str) -> str:
    """Grain of a store of order lines by the day of their order: orders give the number of days, and the
    files' row counts that of the lines."""
    size = spark.read.parquet(f"{d}/lineitem.parquet").count()
    days = spark.read.parquet(f"{d}/orders.parquet").agg(F.count_distinct(F.to_date("o_orderdate"))).first()[0]
    return grain_for(size, days)


def shop_stores(spark: SparkSession, d: str) -> ShopStores:
    """The stores of a folder's tables."""
    from .batch import full_wide

    def build() -> ShopStores:
        rows = dws.store_types(full_wide(spark, d))
        stores = ShopStores.at(spark, workspace(spark, "stores"), rows.schema, line_grain(spark, d))
        stores.merge(rows, "load")
        return stores

    return once(spark, d, "shop", build)


def first_seen(spark: SparkSession, d: str, today: str) -> FirstSeen:
    """First days of the devices in the event log: what came before `today` in one go, then the day itself,
    and what came after it."""

    def build() -> FirstSeen:
        events, day = records.app_events(spark, d).select("mid", "ts"), F.to_date("ts")
        store, at = FirstSeen(spark, workspace(spark, "first-seen")), F.lit(today).cast("date")
        store.merge(events.filter(day < at), "before")
        store.merge(records.app_events(spark, d, today).select("mid", "ts"), today)
        store.merge(events.filter(day > at), "after")
        return store

    return once(spark, d, f"first-seen-{today}", build, ["events"])
