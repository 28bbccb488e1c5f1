"""First days of devices: late events, false positives, growth of the filter, replays, plans."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tillstream.plans import batch
from tillstream.session import folder_names, workspace
from tillstream.sinks import first_seen
from tillstream.sinks.first_seen import FirstSeen

from .conftest import rows_of

KIND = "mid STRING, ts TIMESTAMP"
START = datetime(2024, 1, 1)


def _events(spark, rows):
    return spark.createDataFrame([(m, d and START + timedelta(days=d - 1, hours=h)) for m, d, h in rows], KIND)


def _expected(*commits):
    first = {}
    for mid, day, _ in (r for c in commits for r in c):
        if mid is not None and day is not None:
            first[mid] = min(first.get(mid, day), day)
    days = [(START + timedelta(days=d - 1)).strftime("%Y-%m-%d") for d in first.values()]
    return sorted((d, days.count(d)) for d in set(days))


def test_days_in_any_order(spark):
    """Known devices, repeated rows, nulls, and events that make a device older than it was."""
    rng = random.Random(5)
    store, commits = FirstSeen(spark, workspace(spark, "seen")), []
    for number, days in enumerate(([4, 5], [6], [2, 3], [1, 6, 7])):
        rows = [(f"d{rng.randrange(60)}", rng.choice(days), rng.randrange(24)) for _ in range(40)]
        rows += rows[:5] + [(None, days[0], 1), ("d1", None, 0)]
        commits.append(rows)
        store.merge(_events(spark, rows), f"c{number}")
        assert rows_of(store.new_by_day()) == _expected(*commits)
    # The last commit given again changes nothing, nor does an empty one.
    store.merge(_events(spark, commits[-1]), "c3")
    store.merge(_events(spark, []), "c4")
    assert rows_of(store.new_by_day()) == _expected(*commits)
    day = "2024-01-02"
    assert rows_of(store.new_by_day(day)) == [r for r in _expected(*commits) if r[0] == day]
    assert store.new_by_day("2025-01-01").count() == 0


def test_empty_store(spark):
    store = FirstSeen(spark, workspace(spark, "seen"))
    store.merge(_events(spark, []), "c0")
    assert store.new_by_day().count() == 0
    store.merge(_events(spark, [("a", 2, 0)]), "c1")
    assert rows_of(store.new_by_day()) == [("2024-01-02", 1)]


def test_filter_misses_no_device_and_few_pass_wrongly(spark):
    store = FirstSeen(spark, workspace(spark, "seen"))
    store.merge(_events(spark, [(f"a{k}", 1, 0) for k in range(3000)]), "one")
    asked = spark.range(6000).select(F.concat(F.lit("a"), "id").alias("mid"), (F.col("id") < 3000).alias("old"))
    passed = store.maybe_known(asked).groupBy("old").agg(F.count_if("maybe").alias("n"))
    found = dict(rows_of(passed))
    assert found[True] == 3000
    assert found[False] < 300


def test_a_filter_that_lets_all_pass(spark, monkeypatch):
    """With all devices in one word nearly every device looks known; the days are the same."""
    monkeypatch.setattr(first_seen, "DEVICES_PER_WORD", 10**9)
    store = FirstSeen(spark, workspace(spark, "seen"))
    one = [(f"a{k}", 2, 0) for k in range(200)]
    two = [(f"b{k}", 3, 0) for k in range(200)] + [(f"a{k}", 1, 0) for k in range(20)]
    store.merge(_events(spark, one), "one")
    wrong = store.maybe_known(_events(spark, two).select("mid").distinct().filter("mid like 'b%'"))
    assert wrong.filter("maybe").count() > 190
    store.merge(_events(spark, two), "two")
    assert rows_of(store.new_by_day()) == _expected(one, two)


def test_filter_grows(spark):
    store = FirstSeen(spark, workspace(spark, "seen"))
    store.merge(_events(spark, [("a", 1, 0)]), "one")
    small = store._filter_state()[1]
    store.merge(_events(spark, [(f"b{k}", 2, 0) for k in range(500)]), "two")
    assert store._filter_state()[1] > small
    assert len(folder_names(spark, f"{store.path}/filter")) == 1
    assert store.maybe_known(spark.createDataFrame([("a",), ("b7",)], "mid STRING")).filter("maybe").count() == 2


def test_key_figures_read_one_day(spark, folder):
    """New devices of a day come from the day's folders, and the log of events is read for that day only."""
    plan = batch.kpi_total(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "dt#" in plan and "PartitionFilters: [isnotnull(dt#" in plan
    scans = [line for line in plan.splitlines() if "FileScan" in line and "events.parquet" in line]
    assert scans and all("ts" in line.partition("PushedFilters")[2] for line in scans)
