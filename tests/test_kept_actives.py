"""State of daily actives that lives until a day after the last touch."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tillstream.operators import dwd
from tillstream.plans.streams import Replay
from tillstream.streaming import jobs, run

from .conftest import rows_of

KIND = "mid STRING, ts TIMESTAMP, ts_ms BIGINT, event_id BIGINT, arrived TIMESTAMP"
DAY = datetime(2024, 1, 1)


def _event(mid, number, hours):
    return (mid, DAY + timedelta(hours=1), number * 1000, number, DAY + timedelta(hours=hours))


def _seen(rows):
    return rows_of(rows.select("mid", "ts_ms", F.date_format("kept_until", "dd HH").alias("until"), "n_events"))


def test_gaps_of_23_24_and_25_hours(spark):
    events = [
        # Touched every 23 hours, the state goes on and on: one active.
        *(_event("a", k, 1 + 23 * k) for k in range(4)),
        # A gap of 25 hours ends it: the device counts again for the same day.
        _event("b", 1, 1), _event("b", 2, 26), _event("b", 3, 30),
        # A touch at the very end still finds the state.
        _event("c", 1, 1), _event("c", 2, 25),
        # Repeated rows, and one event that came in before another of earlier number.
        _event("d", 2, 1), _event("d", 1, 2), _event("d", 2, 1),
        _event(None, 9, 5),
    ]
    got = _seen(dwd.kept_actives(spark.createDataFrame(events, KIND)))
    assert got == sorted([
        ("a", 0, "04 22", 4), ("b", 1000, "02 01", 1), ("b", 2000, "03 06", 2), ("c", 1000, "03 01", 2),
        ("d", 2000, "02 02", 3), (None, 9000, "02 05", 1),
    ], key=repr)
    assert dwd.kept_actives(spark.createDataFrame([], KIND)).count() == 0


def test_state_is_moved_by_later_batches(spark):
    """A touch in a later micro-batch, after a restart, moves the end; a gap starts a new stretch."""
    replay, path = Replay(spark, "kept"), None
    path = replay.path("actives")
    schema = spark.createDataFrame([], KIND).schema
    for events in (
        [_event("a", 1, 1), _event("b", 1, 1)], [_event("a", 2, 24)], [_event("a", 3, 47), _event("b", 2, 47)],
        [_event("z", 9, 500)], [_event("z", 10, 501)],
    ):
        rows = spark.createDataFrame(events, KIND)
        replay.append(rows.select(F.lit(None).cast("string").alias("key"), F.to_json(F.struct(*rows.columns)).alias("value")), "E")
        ended = replay.drain(jobs.kept_actives(replay.stream("E", schema), path))
        assert run.late_rows(spark, ended) == 0
    got = [r for r in _seen(spark.read.parquet(path)) if r[0] != "z"]
    assert got == [("a", 1000, "03 23", 3), ("b", 1000, "02 01", 1), ("b", 2000, "03 23", 1)]
