"""Dimensions with versions: late names, lost checkpoints, point-in-time lookups."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tillstream.functions.jsontext import json_of
from tillstream.operators import dims
from tillstream.plans.streams import Replay
from tillstream.sources import topics
from tillstream.streaming import dimensions

from .conftest import rows_of

NOON = datetime(2024, 1, 1, 12)


def _send(spark, replay, topic, rows, columns, checkpoint="one"):
    if rows:
        frame = spark.createDataFrame(rows, columns)
        replay.append(frame.select(F.lit(None).alias("key"), json_of(*frame.columns).alias("value")), topic)
    stream = topics.read_topic(spark, topic, root=replay.root, positions=True)
    replay.drain(dimensions.load(stream, topic, replay.path("dims")), f"{topic}-{checkpoint}")


SKU = "sku_id LONG, spu_id LONG, price_cents LONG, sku_name STRING, tm_id LONG, category3_id STRING"
BRAND = "tm_id LONG, tm_name STRING"


def test_brand_that_arrives_after_its_sku(spark):
    replay = Replay(spark, "late-brand")
    root = replay.path("dims")
    named = lambda: rows_of(dimensions.named_skus(spark, root).select("sku_id", "sku_name", "tm_name"))
    _send(spark, replay, "ODS_SKU_INFO", [(1, 1, 5, "a", 7, "C"), (2, 1, 5, "b", 8, "C"), (3, 1, 5, "c", None, None)], SKU)
    assert named() == [(1, "a", None), (2, "b", None), (3, "c", None)]
    _send(spark, replay, "ODS_BASE_TRADEMARK", [(7, "seven"), (9, "nine")], BRAND)
    assert named() == [(1, "a", "seven"), (2, "b", None), (3, "c", None)]
    # A sku that changes its brand, a brand that is renamed, a sku that comes again with the same.
    _send(spark, replay, "ODS_SKU_INFO", [(2, 1, 5, "b", 9, "C"), (1, 1, 6, "a", 7, "C")], SKU)
    _send(spark, replay, "ODS_BASE_TRADEMARK", [(7, "Seven")], BRAND)
    assert named() == [(1, "a", "Seven"), (2, "b", "nine"), (3, "c", None)]
    # A loader that starts with a new checkpoint loses and repeats nothing.
    before = dimensions.changes(spark, root, "sku").count()
    _send(spark, replay, "ODS_SKU_INFO", [(4, 1, 5, "d", 7, "C")], SKU, "two")
    assert dimensions.changes(spark, root, "sku").count() == before + 1
    assert named() == [(1, "a", "Seven"), (2, "b", "nine"), (3, "c", None), (4, "d", "Seven")]


def test_changes_without_a_key_and_broken_messages(spark):
    replay = Replay(spark, "odd-dims")
    _send(spark, replay, "ODS_BASE_TRADEMARK", [(None, "x"), (1, None), (1, "one"), (1, "one")], BRAND)
    broken = spark.createDataFrame([(None, "{not json")], "key STRING, value STRING")
    replay.append(broken, "ODS_BASE_TRADEMARK")
    _send(spark, replay, "ODS_BASE_TRADEMARK", [], BRAND)
    assert dimensions.current(spark, replay.path("dims"), "trademark").select("tm_id").collect() == [(1,)]
    assert dimensions.current(spark, replay.path("dims"), "spu").count() == 0


def test_point_in_time(spark):
    hour = lambda n: NOON + timedelta(hours=n)
    log = spark.createDataFrame(
        [(1, "a", hour(0)), (1, "b", hour(2)), (1, "b", hour(2)), (2, "x", hour(1)), (1, "c", hour(5))],
        "k LONG, v STRING, valid_from TIMESTAMP",
    )
    times = [(1, -1, None), (1, 0, "a"), (1, 1, "a"), (1, 2, "b"), (1, 4, "b"), (1, 9, "c"), (2, 0, None), (2, 1, "x"), (3, 1, None), (None, 1, None)]
    # A third of all rows have one key.
    rows = [(k, hour(n), n, v) for k, n, v in times] + [(1, hour(3), 3, "b")] * 5
    frame = spark.createDataFrame(rows, "k LONG, at TIMESTAMP, n INT, want STRING")
    got = dims.as_of(frame, dims.versions(log, "k"), "k", "at")
    assert got.count() == len(rows) and got.filter(~F.col("v").eqNullSafe(F.col("want"))).count() == 0
