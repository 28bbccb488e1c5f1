"""Stores by day: what a merge touches, replays, maintained sums, and the plans of reports."""

from __future__ import annotations

import os
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstream.plans import batch, stored
from tillstream.session import workspace
from tillstream.sinks.days import DayStore, grain_for

from .conftest import rows_of

KIND = "dt DATE, k BIGINT, v STRING, at TIMESTAMP"
DAY = date(2024, 1, 30)


def _row(day, k, v, minute=0):
    return (day and DAY + timedelta(days=day - 1), k, v, datetime(2024, 1, 1) + timedelta(minutes=minute))


def _store(spark, grain="day", **options):
    schema = spark.createDataFrame([], KIND).schema
    return DayStore(spark, workspace(spark, "days"), schema, ("k",), "at", grain, **options)


def _files(store) -> dict:
    return {
        f"{os.path.basename(folder)}/{name}": os.stat(f"{folder}/{name}").st_mtime_ns
        for folder, _, names in os.walk(store.path) for name in names if name.endswith(".parquet")
    }


@pytest.mark.parametrize("grain", ["day", "month"])
def test_merge_touches_only_its_days(spark, grain):
    store = _store(spark, grain)
    frame = lambda rows: spark.createDataFrame(rows, KIND)
    store.merge(frame([_row(1, 1, "a"), _row(1, 2, "b"), _row(3, 1, "c"), _row(40, 9, "z")]), "one")
    before = _files(store)
    touched = store.merge(frame([_row(3, 1, "new", 5), _row(3, 2, "d"), _row(4, 1, "e")]), "two")
    after = _files(store)
    assert sorted(touched) == (["2024-02-01", "2024-02-02"] if grain == "day" else ["2024-02"])
    # Day one lies in January and day forty in March: the files of both are the same as before.
    kept = {n: t for n, t in before.items() if "01-30" in n or "2024-01/" in n or "2024-03" in n}
    assert kept and all(after.get(n) == t for n, t in kept.items())
    # An older version of a row changes nothing, an equal one replaces, nulls in keys and days are kept.
    store.merge(frame([_row(3, 1, "old", 1), _row(3, 2, "d2"), _row(None, None, "n")]), "three")
    got = rows_of(store.read().select("k", "v"))
    assert got == sorted([(1, "a"), (2, "b"), (1, "new"), (2, "d2"), (1, "e"), (9, "z"), (None, "n")], key=repr)
    assert rows_of(store.read("2024-02-01", "2024-02-02").select("v")) == [("d2",), ("e",), ("new",)]
    assert rows_of(store.read("2024-01-30").select("v")) == [("a",), ("b",)]
    assert store.read("2025-01-01").count() == 0


def test_merge_given_again_after_it_stopped(spark, monkeypatch):
    """The change is staged, then the job dies with one of two days in place."""
    store = _store(spark)
    store.merge(spark.createDataFrame([_row(1, 1, "a"), _row(2, 1, "b")], KIND), "one")
    change = spark.createDataFrame([_row(1, 1, "A", 9), _row(2, 1, "B", 9), _row(2, 2, "x")], KIND)
    from tillstream.sinks import days

    real, calls = days.replace_folder, []

    def dies(*args):
        if calls:
            raise OSError("lost")
        calls.append(args)
        real(*args)

    monkeypatch.setattr(days, "replace_folder", dies)
    with pytest.raises(OSError):
        store.merge(change, "two")
    monkeypatch.setattr(days, "replace_folder", real)
    for _ in range(2):
        store.merge(change, "two")
        assert rows_of(store.read().select("k", "v")) == [(1, "A"), (1, "B"), (2, "x")]


def test_merge_into_hot_day_and_empty_change(spark):
    """A third of all rows lie on one day, which is written in several files of the target size."""
    store = _store(spark, file_bytes=20_000)
    rows = spark.range(30_000).select(
        F.expr("date_add(date'2024-01-30', if(id % 3 = 0, 0, cast(id % 7 as int)))").alias("dt"),
        F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.lit(datetime(2024, 1, 1)).alias("at"),
    )
    store.merge(rows, "one")
    hot = [n for n in _files(store) if n.startswith("part=2024-01-30")]
    assert len(hot) > 1 and store.read().count() == 30_000
    assert store.merge(rows.limit(0), "two") == [] and store.read().count() == 30_000


def test_grain():
    assert grain_for(10_000, 30) == "month" and grain_for(10_000_000, 30) == "day" and grain_for(0, 0) == "month"


def _wide(spark, rows):
    columns = "order_id BIGINT, order_detail_id BIGINT, create_time TIMESTAMP, dt DATE, tm_id BIGINT, tm_name STRING, spu_id BIGINT, spu_name STRING, final_detail_amount DECIMAL(16,2)"
    return spark.createDataFrame(
        [(o, i, datetime(2024, 1, 1), DAY + timedelta(days=day), tm, tm and f"t{tm}", spu, f"s{spu}", Decimal(cents) / 100) for o, i, day, tm, spu, cents in rows],
        columns,
    )


def test_sums_of_touched_days_only(spark):
    first = [(1, 1, 0, 1, 5, 100), (1, 2, 0, 1, 6, 50), (2, 3, 1, 2, 5, 70), (3, 4, 1, None, 5, 1)]
    stores = stored.ShopStores.at(spark, workspace(spark, "sums"), _wide(spark, first).schema, "day")
    stores.merge(_wide(spark, first), "one")
    before = _files(stores.trademarks)
    # Line 3 moves to another brand and price; its day is summed again, the other is left.
    stores.merge(_wide(spark, [(2, 3, 1, 1, 5, 71), (4, 5, 1, 2, 5, 9)]), "two")
    after = _files(stores.trademarks)
    assert {n: t for n, t in after.items() if "2024-01-30" in n} == {n: t for n, t in before.items() if "2024-01-30" in n}
    got = stores.trademarks.read()
    assert got.schema["amount"].dataType.simpleString() == "decimal(16,2)"
    assert rows_of(got.select("dt", "stat_time", "trademark_id", "trademark_name", "amount")) == sorted([
        (DAY, datetime(2024, 1, 30), "1", "t1", Decimal("1.50")),
        (DAY + timedelta(days=1), datetime(2024, 1, 31), "1", "t1", Decimal("0.71")),
        (DAY + timedelta(days=1), datetime(2024, 1, 31), "2", "t2", Decimal("0.09")),
        (DAY + timedelta(days=1), datetime(2024, 1, 31), None, None, Decimal("0.01")),
    ], key=repr)
    assert rows_of(stores.spus.read("2024-01-31").select("spu_id", "amount")) == [("5", Decimal("0.81"))]
    # A brand that is gone from a day is gone from its sums.
    stores.merge(_wide(spark, [(4, 5, 1, 1, 5, 9)]), "three")
    assert rows_of(stores.trademarks.read("2024-01-31").select("trademark_id", "amount")) == sorted(
        [("1", Decimal("0.80")), (None, Decimal("0.01"))], key=repr)


@pytest.mark.parametrize(
    "name", ["trademark_topn", "order_amount_day", "order_amount_hour", "order_amount_hour_compare", "spu_amount"]
)
def test_reports_read_stores(spark, folder, name):
    """No line of the source is read; day reports open the day's folders only."""
    query = batch.REGISTRY[name](spark, folder)
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "orders.parquet" not in plan
    assert all("testdata" not in path for path in query.inputFiles())
    if name != "spu_amount":
        assert "PartitionFilters: [isnotnull(part" in plan
