"""Streaming behaviour that the table-wide queries do not show: lateness, duplicates, restarts."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from tillstream.functions.jsontext import good_rows, parse_typed
from tillstream.functions.times import time_text
from tillstream.operators import dws
from tillstream.plans import streams
from tillstream.plans.streams import Replay
from tillstream.schemas import ORDER_DONE
from tillstream.session import folder_names, workspace
from tillstream.sinks import files, results
from tillstream.sources import records, topics
from tillstream.streaming import changes, jobs, run

from .compare import difference, duck, duck_rows, spark_rows
from .conftest import rows_of

DAY = datetime(2024, 1, 1, 12, 0, 0)


def _log(mid: str, when: datetime) -> tuple[None, str]:
    ms = int((when - datetime(1970, 1, 1)).total_seconds() * 1000)
    return (None, f'{{"ts":{ms},"common":{{"mid":"{mid}","uid":"{mid}","ar":"1","ch":"c","vc":"1"}}}}')


def _append(spark, replay, topic, *messages):
    replay.append(spark.createDataFrame(list(messages), "key STRING, value STRING"), topic)


def test_late_event_is_dropped_and_counted(spark):
    replay = Replay(spark, "late")
    path = replay.path("dau")

    def go():
        return replay.drain(jobs.first_events(replay.stream("LOG"), path))

    _append(spark, replay, "LOG", _log("a", DAY), _log("a", DAY + timedelta(hours=1)))
    go()
    _append(spark, replay, "LOG", _log("a", DAY + timedelta(days=5)))
    go()
    # Day one is past the watermark now, the fifth day is not.
    _append(spark, replay, "LOG", _log("b", DAY), _log("b", DAY + timedelta(days=5)))
    late = run.late_rows(spark, go())
    got = rows_of(jobs.daily_first(spark, path).select("mid", "dt"))
    assert got == [("a", "2024-01-01"), ("a", "2024-01-06"), ("b", "2024-01-06")]
    assert late == 1


def test_earlier_event_of_a_later_batch_wins(spark):
    replay = Replay(spark, "order")
    for when in (DAY, DAY - timedelta(hours=2), DAY + timedelta(hours=2)):
        _append(spark, replay, "LOG", _log("a", when))
        replay.drain(jobs.first_events(replay.stream("LOG"), replay.path("dau")))
    assert rows_of(jobs.daily_first(spark, replay.path("dau")).select("mid", "hr")) == [("a", "10")]


ORDERS = "order_id BIGINT, create_time TIMESTAMP"
LINES = "order_id BIGINT, order_detail_id BIGINT, line_time TIMESTAMP"


def _land(spark, replay, topic, schema, rows):
    df = spark.createDataFrame(rows, schema)
    value = F.to_json(F.struct(*df.columns)).alias("value")
    replay.append(df.select(F.lit(None).alias("key"), value), topic)
    return df.schema


def test_line_sent_twice_and_partners_in_different_batches(spark):
    replay = Replay(spark, "join")
    near, far = DAY + timedelta(minutes=5), DAY + timedelta(minutes=30)

    def go():
        joined = jobs.join_orders(replay.stream("O", o), replay.stream("L", n), salts=3)
        return replay.drain(jobs.store_wide(joined, replay.path("wide")))

    o = _land(spark, replay, "O", ORDERS, [(1, DAY)])
    n = _land(spark, replay, "L", LINES, [(1, 11, near), (2, 21, near), (1, 12, far)])
    go()
    _land(spark, replay, "O", ORDERS, [(2, DAY)])
    _land(spark, replay, "L", LINES, [(1, 11, near), (1, 13, near)])
    go()
    pairs = rows_of(jobs.wide_view(spark, replay.path("wide")).select("order_id", "order_detail_id"))
    assert pairs == [(1, 11), (1, 13), (2, 21)]


PAIRS = (
    "order_id BIGINT, create_time TIMESTAMP, order_detail_id BIGINT, line_cents BIGINT,"
    " original_total_cents BIGINT, final_total_cents BIGINT, tm_id BIGINT, tm_name STRING"
)


def _pair(order, i, cents, original, final, when=DAY):
    return (order, when, i, cents, original, final, i % 2, f"b{i % 2}")


def _allocate(spark, replay, rows, late="4 days"):
    """Land pairs, run both allocating queries, give the newest rows of the topic and the late rows."""
    kind = _land(spark, replay, "P", PAIRS, rows)
    stream = replay.stream("P", kind)
    first = replay.drain(changes.order_done(stream, "D", replay.root, late), "done")
    both = changes.wide_changes(stream, replay.stream("D", ORDER_DONE), late)
    second = replay.drain(changes.send_changes(both, "W", root=replay.root), "wide")
    schema = changes.change_schema(kind)
    now = changes.read_changes(spark, "W", replay.root, schema).select(
        "order_id", "order_detail_id", "final_detail_cents", "status"
    )
    return rows_of(now), schema, run.late_rows(spark, first) + run.late_rows(spark, second)


def test_allocation_is_given_at_once_and_again_when_the_order_is_complete(spark):
    replay = Replay(spark, "split")
    got = [
        _allocate(spark, replay, rows)[0]
        for rows in (
            [_pair(1, 1, 4000, 12000, 10000), _pair(2, 9, 500, 500, 450)],
            [_pair(1, 2, 4000, 12000, 10000)],
            [_pair(1, 3, 4000, 12000, 10000)],
            # A line of nothing that comes after all others takes nothing.
            [_pair(1, 4, 0, 12000, 10000)],
        )
    ]
    whole = (2, 9, 450, "complete")
    assert got[0] == [(1, 1, 3333, "open"), whole]
    assert got[1] == [(1, 1, 3333, "open"), (1, 2, 3333, "open"), whole]
    three = [(1, 1, 3333, "complete"), (1, 2, 3333, "complete"), (1, 3, 3334, "complete")]
    assert got[2] == [*three, whole]
    assert got[3] == [*three, (1, 4, 0, "complete"), whole]


def test_changes_add_up_and_a_hot_order_is_split(spark):
    """A third of all lines are of one order, which comes in two parts."""
    replay = Replay(spark, "hot")
    hot = [_pair(7, i, 100 + i, sum(100 + k for k in range(90)), 5003) for i in range(90)]
    rest = [_pair(100 + k // 3, 1000 + k, 10, 30, 29) for k in range(180)]
    _allocate(spark, replay, hot[::2] + rest[:90])
    now, schema, late = _allocate(spark, replay, hot[1::2] + rest[90:])
    paid: dict = {}
    for order, _, cents, status in now:
        assert status == "complete"
        paid[order] = paid.get(order, 0) + cents
    assert paid == {7: 5003, **{100 + k: 29 for k in range(60)}} and late == 0 and len(now) == 270
    # Without looking back: the deltas of all messages give the same.
    rows = good_rows(parse_typed(spark.read.parquet(replay.path("W")), schema))
    sums = rows.groupBy("order_id").agg(F.sum("delta_cents")).collect()
    assert {tuple(r) for r in sums} == set(paid.items())
    # The join deals lines of the hot order by salt as well.
    salted = rows.filter("order_id = 7").select(F.pmod("order_detail_id", F.lit(jobs.JOIN_SALTS)))
    assert salted.distinct().count() == jobs.JOIN_SALTS


def test_lines_after_the_watermark_are_counted(spark):
    replay = Replay(spark, "late-lines")
    _allocate(spark, replay, [_pair(1, 1, 50, 100, 90)], late="1 hour")
    _allocate(spark, replay, [_pair(2, 2, 70, 70, 70, DAY + timedelta(days=2))], late="1 hour")
    _allocate(spark, replay, [_pair(4, 5, 70, 70, 70, DAY + timedelta(days=2))], late="1 hour")
    now, _, late = _allocate(spark, replay, [_pair(1, 3, 50, 100, 90)], late="1 hour")
    # The order stays open, its late line has its share, and both queries counted it.
    assert [r for r in now if r[0] == 1] == [(1, 1, 45, "open"), (1, 3, 45, "open")] and late >= 1


def _sums(spark, replay, checkpoint, schema):
    messages = topics.read_topic(spark, "W", root=replay.root, positions=True)
    rows = good_rows(parse_typed(messages, schema, keep=["timestamp", "part", "pos"]))
    replay.drain(jobs.trademark_sums(rows, replay.path("stat")), checkpoint)
    return rows_of(results.read_results(spark, replay.path("stat")).select("tm_name", "amount_cents", "stat_time"))


def test_results_outlive_the_checkpoint(spark):
    """150 messages are summed up, the checkpoint is lost, 10 more come: nothing is lost or repeated."""
    replay = Replay(spark, "manifest")
    first, schema, _ = _allocate(spark, replay, [_pair(k, k, 10, 10, 9) for k in range(75)])
    before = _sums(spark, replay, "one", schema)
    assert sum(r[1] for r in before) == 75 * 9
    _allocate(spark, replay, [_pair(k, k, 10, 10, 9) for k in range(100, 105)])
    after = _sums(spark, replay, "two", schema)
    assert sum(r[1] for r in after) == 80 * 9
    # What was there before is untouched, times and all.
    assert set(before) <= set(after)
    assert _sums(spark, replay, "three", schema) == after
    covered = results.manifest(spark, replay.path("stat")).agg(F.sum("n")).first()[0]
    assert covered == spark.read.parquet(replay.path("W")).count()


def test_batch_that_failed_before_its_manifest_is_written_again(spark):
    replay = Replay(spark, "torn")
    _, schema, _ = _allocate(spark, replay, [_pair(k, k, 10, 10, 9) for k in range(20)])
    # A commit that left rows but no manifest does not count, and makes room for the next.
    torn = spark.createDataFrame([(1, "b1", 999)], "tm_id BIGINT, tm_name STRING, amount_cents BIGINT")
    torn.withColumn("stat_time", F.current_timestamp()).write.parquet(replay.path("stat/rows/commit=1"))
    assert results.manifest(spark, replay.path("stat")).count() == 0
    once = _sums(spark, replay, "sums", schema)
    assert sum(r[1] for r in once) == 20 * 9
    # The batch committed, but the query died before it knew: the same messages come again.
    assert _sums(spark, replay, "sums-again", schema) == once


def test_layers_restart_alone(spark, folder):
    """In the registered run the wide join ends in the middle; its rows equal the batch's afterwards."""
    flow = streams._layers(spark, folder)
    wide = flow.wide()
    assert wide.filter("status <> 'complete'").count() == 0
    lines = records.order_lines(spark, folder).dropDuplicates(["order_id", "order_detail_id"])
    orders = records.orders(spark, folder)
    assert wide.count() == lines.join(orders, "order_id").count()


def test_rocksdb_state_gives_the_same(spark):
    replay = Replay(spark, "rocksdb")
    for when in (DAY, DAY + timedelta(hours=1)):
        _append(spark, replay, "LOG", _log("a", when), _log("b", when))
        writer = jobs.first_events(replay.stream("LOG"), replay.path("dau"))
        run.drain(spark, writer, replay.path("checkpoint"), rocksdb=True, state_partitions=2)
    assert rows_of(jobs.daily_first(spark, replay.path("dau")).select("mid", "hr")) == [("a", "12"), ("b", "12")]


def test_first_order_survives_a_restart_and_a_lost_checkpoint(spark):
    replay = Replay(spark, "first")
    schema = "order_id BIGINT, user_id BIGINT, create_time TIMESTAMP"
    got: list = []

    def go(checkpoint):
        stream = replay.stream("O", kind)
        flags = lambda b, i: got.extend(jobs.flag_batch(b, replay.path("state")).select("order_id", "if_first_order").collect())
        replay.drain(jobs.per_batch(stream, flags, "append"), checkpoint)

    for rows in ([(1, 5, DAY), (2, 5, DAY - timedelta(hours=1))], [(3, 5, DAY + timedelta(days=9)), (4, 6, DAY)]):
        kind = _land(spark, replay, "O", schema, rows)
        go("one")
    want = [(1, "0"), (2, "1"), (3, "0"), (4, "1")]
    assert sorted(tuple(r) for r in got) == want
    got.clear()
    go("two")  # all orders in one batch of a new query: the log knows them
    assert sorted(tuple(r) for r in got) == want


def test_batch_that_failed_after_its_write_is_not_counted_twice(spark):
    """The sink wrote the batch, then the query died before its commit; the restart replays it."""
    replay = Replay(spark, "crash")
    schema = "tm_id BIGINT, tm_name STRING, final_detail_cents BIGINT"
    path, crash = replay.path("stat"), {"at": 1}
    sums = lambda b: b.groupBy("tm_id", "tm_name").agg(F.sum("final_detail_cents").alias("amount_cents"))
    write = files.batch_writer(path, sums)

    def flaky(batch, batch_id):
        write(batch, batch_id)
        if batch_id == crash["at"]:
            crash["at"] = None
            raise RuntimeError("lost after the write")

    for rows in ([(1, "a:b", 5), (2, "c", 1)], [(1, "a:b", 7)]):
        kind = _land(spark, replay, "W", schema, rows)
        with_writer = jobs.per_batch(replay.stream("W", kind), flaky, "append")
        try:
            replay.drain(with_writer)
        except StreamingQueryException:
            replay.drain(jobs.per_batch(replay.stream("W", kind), flaky, "append"))
    assert crash["at"] is None
    stat = spark.read.parquet(path).groupBy("tm_name").agg(F.sum("amount_cents"))
    assert rows_of(stat) == [("a:b", 12), ("c", 1)]


def test_newest_copy_within_a_batch_is_enriched(spark):
    replay = Replay(spark, "copies")
    rows = [(1, 11, 5, 1, DAY), (1, 11, 5, 2, DAY + timedelta(seconds=1)), (1, 12, 9, 3, DAY)]
    schema = "order_id BIGINT, order_detail_id BIGINT, sku_id BIGINT, sku_num BIGINT, timestamp TIMESTAMP"
    kind = _land(spark, replay, "L", schema, rows)
    columns = "sku_id BIGINT, sku_name STRING, spu_id BIGINT, tm_id BIGINT, category3_id STRING, spu_name STRING, tm_name STRING, category3_name STRING"
    skus = spark.createDataFrame([(5, "five", 1, 1, "C", "s", "t", "c")], columns)
    stream = replay.stream("L", kind)
    replay.drain(jobs.enrich_lines(stream, lambda: skus, replay.path("dwd")))
    got = spark.read.parquet(replay.path("dwd")).select("order_detail_id", "sku_num", "sku_name")
    assert rows_of(got) == [(11, 2, "five"), (12, 3, None)]


def test_interval_trigger(spark):
    replay = Replay(spark, "interval")
    _append(spark, replay, "LOG", _log("a", DAY))
    writer = jobs.store_events(replay.stream("LOG"), replay.path("events"))
    query = run.start(spark, writer, replay.path("checkpoint"), interval="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(replay.path("events")).count() == 1


def test_staged_messages_go_once_they_have_landed_and_topics_lie_in_the_small_codec(spark):
    replay = Replay(spark, "staged")
    rows = spark.range(1000).select("id", F.timestamp_seconds(F.col("id")).alias("at_time")).repartition(
        2 * replay.files, "id")
    replay.land(rows, "at_time", "T", 3)
    assert folder_names(spark, replay.path("staged-T")) == []
    assert spark.read.parquet(replay.path("T")).count() == 1000
    files = [name for name in folder_names(spark, replay.path("T")) if name.endswith(".parquet")]
    assert len(files) <= 3 * replay.files and all(".zstd." in name for name in files)


@pytest.mark.parametrize("name, slices", [("stream_order_full_outer", 2), ("stream_order_split", 4)])
def test_large_tables_are_cut_into_more_slices_and_read_topics_go(spark, folder, monkeypatch, name, slices):
    made = []
    monkeypatch.setattr(streams, "SLICE_LINES", 1400)
    monkeypatch.setattr(streams, "workspace", lambda spark, label: made.append(workspace(spark, label)) or made[-1])
    streams.BATCH_SECONDS.clear()
    rows = spark_rows(queries()[name](spark, folder))
    assert difference(rows, duck_rows(duck(folder), oracle_sql()[name])) == ""
    batches = [len(seconds) for seconds in streams.BATCH_SECONDS.values()]
    assert len(batches) == 1 and batches[0] >= 2 * slices
    left = set(folder_names(spark, made[0]))
    assert not left & {"DWD_ORDER_INFO", "DWD_ORDER_DETAIL", "DWS_ORDER_PAIR", "DWS_ORDER_DONE", "checkpoint-job", "checkpoint-wide"}


def test_layers_over_more_slices(spark, folder, monkeypatch):
    monkeypatch.setattr(streams, "SLICE_LINES", 1900)
    flow = streams.run_layers(spark, folder, "many-layers")
    wide = dws.order_wide(flow.wide()).withColumn("create_time", time_text(F.col("create_time")))
    assert difference(spark_rows(wide), duck_rows(duck(folder), oracle_sql()["stream_layers_wide"])) == ""
    kept = {name for name in folder_names(spark, flow.root) if not name.startswith(".")}
    assert kept == {"ADS_TRADEMARK", "DWS_ORDER_WIDE", "user-state"}


def test_the_only_reader_of_a_topic_deletes_what_it_has_read(spark):
    replay = Replay(spark, "only")
    for number in range(3):
        _append(spark, replay, "T", (None, str(number)))
        messages = topics.read_topic(spark, "T", root=replay.root, only_reader=True)
        replay.drain(jobs.append_files(messages, replay.path("out")))
    assert sorted(r.value for r in spark.read.parquet(replay.path("out")).collect()) == ["0", "1", "2"]
    assert spark.read.schema(topics.MESSAGE).parquet(replay.path("T")).count() < 3
