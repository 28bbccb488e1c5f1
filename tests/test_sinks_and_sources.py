from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillstream.session import workspace
from tillstream.sinks import files
from tillstream.sources import jdbc, topics

from .conftest import rows_of


def _kv(spark, *rows):
    return spark.createDataFrame(list(rows), "id BIGINT, v STRING")


def test_day_write_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "days")
    old = spark.createDataFrame([(1, "d1"), (2, "d2")], "id INT, dt STRING")
    new = spark.createDataFrame([(3, "d2")], "id INT, dt STRING")
    files.write_days(old, path)
    files.write_days(new, path)
    files.write_days(new, path)
    assert rows_of(spark.read.parquet(path).select("id", "dt")) == [(1, "d1"), (3, "d2")]


def test_replayed_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "batches")
    write = files.batch_writer(path)
    write(_kv(spark, (1, "half")), 0)
    write(_kv(spark, (1, "a"), (2, "b")), 0)
    write(_kv(spark, (3, "c")), 1)
    assert rows_of(spark.read.parquet(path).select("id", "v")) == [(1, "a"), (2, "b"), (3, "c")]


def test_upsert_log_shows_newest_rows_and_compacts(spark, tmp_path):
    path, packed = str(tmp_path / "log"), str(tmp_path / "packed")
    write = files.upsert_writer(path)
    write(_kv(spark, (1, "a"), (2, "b")), 0)
    write(_kv(spark, (2, "c")), 1)
    write(spark.createDataFrame([], "id BIGINT, v STRING"), 2)
    want = [(1, "a"), (2, "c")]
    assert rows_of(files.upserted(spark, path, ["id"]).select("id", "v")) == want
    assert not (tmp_path / "log" / "batch_id=2").exists()
    files.compact(spark, path, packed, ["id"])
    assert rows_of(files.upserted(spark, packed, ["id"]).select("id", "v")) == want
    files.upsert_writer(packed)(_kv(spark, (1, "z")), 1)
    assert rows_of(files.upserted(spark, packed, ["id"]).select("id", "v")) == [(1, "z"), (2, "c")]


def test_shards_hold_a_key_once(spark, tmp_path):
    path = str(tmp_path / "shards")
    files.write_shards(spark.range(1000).withColumn("k", F.col("id") % 50), path, "k", 4)
    homes = spark.read.parquet(path).select("k", F.input_file_name().alias("f")).distinct()
    assert homes.count() == 50 and homes.select("f").distinct().count() == 4


class _Session:
    """As much of a session as the folder lookup reads."""

    def __init__(self, conf: dict[str, str], master: str):
        self.conf = conf
        self.sparkContext = type("Context", (), {"master": master})()


def test_workspace_follows_the_cluster_setting(spark):
    shared = _Session({"spark.checkpoint.dir": "hdfs://data/tmp/"}, "yarn")
    assert workspace(shared, "x").startswith("hdfs://data/tmp/x-")
    with pytest.raises(RuntimeError):
        workspace(_Session({}, "yarn"), "x")
    assert workspace(spark, "x") != workspace(spark, "x")


def test_topic_needs_a_place(spark, tmp_path):
    with pytest.raises(ValueError):
        topics.read_topic(spark, "T")
    topics.append_messages(
        spark.createDataFrame([("k", "v")], "key STRING, value STRING"), "T", str(tmp_path), 2, keyed=True)
    stream = topics.read_topic(spark, "T", root=str(tmp_path), per_trigger=1)
    assert stream.isStreaming and stream.columns == ["key", "value", "timestamp"]
    assert topics.read_topic(spark, ["T", "T"], root=str(tmp_path)).isStreaming
    assert topics.kafka_sink(stream, "host:9092", "T") is not None


def test_jdbc_options():
    whole = jdbc.read_options("jdbc:x", "select 1", driver="d", fetchsize="10")
    assert whole == {"url": "jdbc:x", "query": "select 1", "driver": "d", "fetchsize": "10"}
    split = jdbc.read_options("jdbc:x", "select 1", partition_column="id", bounds=(0, 9), partitions=3)
    assert split["dbtable"] == "(select 1) q" and split["numPartitions"] == "3" and "query" not in split
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x", "select 1", partition_column="id")
    sink = jdbc.append_options("jdbc:x", "t")
    assert (sink["batchsize"], sink["isolationLevel"], sink["numPartitions"]) == ("100", "NONE", "4")
