"""Operators on small hand-written rows."""

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tillstream.operators import ads, dims, dwd, dws, ods, search, serving
from tillstream.plans import batch, stored
from tillstream.sinks import files
from tillstream.sources import records

from .conftest import rows_of

DETAIL_TABLES = [t for t in ods.ANY_CHANGE_TABLES]


@pytest.mark.parametrize("kind", ["insert", "update", "delete"])
@pytest.mark.parametrize("data", ['{"id":1}', "{}", None])
def test_change_filter_truth_table(spark, kind, data):
    tables = DETAIL_TABLES + ["order_info", "comment_info"]
    df = spark.createDataFrame([(t, kind, data) for t in tables], "table STRING, type STRING, data STRING")
    kept = {r.table for r in ods.cdc_filter(df).collect()}
    if kind == "delete" or data != '{"id":1}':
        assert kept == set()
    else:
        assert kept == set(DETAIL_TABLES) | ({"order_info"} if kind == "insert" else set())


def test_array_envelope_explodes_and_keeps_deletes_unless_told(spark):
    values = [
        '{"table":"user_info","type":"INSERT","data":[{"id":1,"n":{"a":[1,2]}},{"id":2}]}',
        '{"table":"user_info","type":"delete","data":[{"id":3}]}',
        '{"table":"user_info","data":[]}',
    ]
    df = ods.parse_cdc_arrays(spark.createDataFrame([(v,) for v in values], "value STRING"))
    assert rows_of(ods.cdc_explode(df)) == [
        ("user_info", '{"id":1,"n":{"a":[1,2]}}'), ("user_info", '{"id":2}'), ("user_info", '{"id":3}'),
    ]
    assert len(rows_of(ods.cdc_explode(df, skip_deletes=True))) == 2


def test_log_routing(spark):
    df = spark.createDataFrame(
        [('{"start":"1","ts":1}',), ('{"start":{"a":1}}',), ('{"start":null}',), ('{"ts":2}',)], "value STRING"
    )
    topics = [r.topic for r in ods.route_app_log(df).collect()]
    assert topics == [ods.STARTUP_TOPIC, ods.STARTUP_TOPIC, ods.EVENT_TOPIC, ods.EVENT_TOPIC]


def _orders(spark, rows):
    df = spark.createDataFrame(rows, "order_id BIGINT, user_id BIGINT, create_time STRING")
    return df.withColumn("create_time", F.to_timestamp("create_time"))


def test_first_order_within_a_batch_and_across_batches(spark):
    orders = _orders(spark, [
        (1, 10, "2020-01-02 00:00:00"), (2, 10, "2020-01-01 00:00:00"), (3, 10, "2020-01-01 00:00:00"),
        (4, 11, "2020-01-05 00:00:00"), (5, 12, "2020-01-05 00:00:00"),
    ])
    state = spark.createDataFrame([("11", "1"), ("12", "0")], "user_id STRING, if_consumed STRING")
    flagged = dwd.flag_first_orders(orders, state)
    assert {r.order_id: r.if_first_order for r in flagged.collect()} == {1: "0", 2: "1", 3: "0", 4: "0", 5: "1"}
    assert rows_of(dwd.user_state_rows(flagged)) == [("10", "1"), ("12", "1")]
    assert rows_of(dwd.new_customers(orders, state.filter("if_consumed = '1'"))) == [(10,), (12,)]


def test_unknown_dimension_keys_stay_null(spark):
    lines = spark.createDataFrame([(1, 100), (2, 999)], "order_detail_id BIGINT, sku_id BIGINT")
    sku = spark.createDataFrame(
        [(100, "s", 1, 7, "C")], "sku_id BIGINT, sku_name STRING, spu_id BIGINT, tm_id BIGINT, category3_id STRING")
    tm = spark.createDataFrame([(7, "a:b")], "tm_id BIGINT, tm_name STRING")
    spu = spark.createDataFrame([(2, "other")], "spu_id BIGINT, spu_name STRING")
    cat = spark.createDataFrame([("C", "cat")], "category3_id STRING, category3_name STRING")
    got = dims.add_sku(lines, dims.enrich_skus(sku, cat, tm, spu)).select(
        "order_detail_id", "tm_name", "spu_name", "category3_name")
    assert rows_of(got) == [(1, "a:b", None, "cat"), (2, None, None, None)]


LINES = "order_id BIGINT, order_detail_id BIGINT, line_cents BIGINT"
ORDERS = "order_id BIGINT, original_total_cents BIGINT, final_total_cents BIGINT"


def _split(spark, orders, lines):
    df = dws.allocate(spark.createDataFrame(orders, ORDERS), spark.createDataFrame(lines, LINES))
    return {(r.order_id, r.order_detail_id): r.final_detail_cents for r in df.collect()}


def test_allocation_rules(spark):
    orders = [(1, 12000, 10000), (2, 500, 450), (3, 0, 0), (4, 0, 70)]
    lines = [(1, 1, 4000), (1, 2, 4000), (1, 3, 4000), (2, 4, 500), (3, 5, 0), (3, 6, 0), (4, 7, 0), (4, 8, 0)]
    assert _split(spark, orders, lines) == {
        (1, 1): 3333, (1, 2): 3333, (1, 3): 3334, (2, 4): 450, (3, 5): 0, (3, 6): 0, (4, 7): 0, (4, 8): 70,
    }


def test_a_skewed_order_and_repeated_lines_add_up(spark, folder):
    """One order holds a third of all lines and a tenth of the lines come twice."""
    raw = records.order_lines(spark, folder)
    hot = raw.filter("order_id % 3 = 0").withColumns(
        {"order_id": F.lit(7).cast("bigint"), "order_detail_id": F.col("order_detail_id") + 1})
    rest = raw.filter("order_id % 3 <> 0").unionByName(hot)
    twice = rest.unionByName(rest.filter("order_detail_id % 10 = 0"))
    lines = dws.unique_lines(twice)
    orders = records.orders_with_amounts(records.orders(spark, folder), lines)
    allocated = dws.allocate(orders, lines)
    plan = allocated._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower()
    got = allocated.select("order_id", "order_detail_id", "final_detail_cents").collect()
    assert len(got) == rest.count()
    sums = defaultdict(int)
    for order_id, _, cents in got:
        sums[order_id] += cents
    assert dict(sums) == {r.order_id: r.final_total_cents for r in orders.collect()}


def test_line_ids_are_unique(spark, folder):
    lines = records.order_lines(spark, folder)
    assert lines.select("order_detail_id").distinct().count() == lines.count()


def test_at_most_one_first_order_per_user(spark, folder):
    flagged = batch.REGISTRY["order_first_flag"](spark, folder).filter("if_first_order = '1'")
    assert flagged.groupBy("user_id").count().filter("count > 1").isEmpty()


def test_top_brands_exclude_both_ends(spark):
    stat = spark.createDataFrame(
        [("2020-01-01", "1", "a:b", 5), ("2020-01-02", "1", "a:b", 7), ("2020-01-02", "2", "c", 7),
         ("2020-01-03", "2", "c", 100)],
        "stat_time STRING, trademark_id STRING, trademark_name STRING, amount_cents BIGINT")
    top = ads.trademark_topn(stat, "2020-01-01", "2020-01-03", 5)
    assert [tuple(r) for r in top.collect()] == [("1", "a:b", 7), ("2", "c", 7)]
    points = serving.chart_points(top, "trademark_name", "order_amount_cents").first()
    assert points.asDict() == {"x": "a:b", "y": 7, "s": "1"}


def test_shares_and_bands(spark):
    counts = spark.createDataFrame([("a", 300), ("b", 200), ("c", 100)], "g STRING, n BIGINT")
    assert rows_of(ads.shares(counts, "g", "n")) == [("a", 300, 5000), ("b", 200, 3333), ("c", 100, 1667)]
    values = spark.createDataFrame([(v,) for v in (0, 99, 100, 499, 500, 599)], "v BIGINT")
    assert [r.band for r in ads.value_bands(values, "v").collect()] == [0, 0, 1, 4, 5, 5]


def test_hours_are_filled_with_zero(spark):
    hourly = spark.createDataFrame(
        [("d2", "00", 5), ("d1", "00", 3), ("d1", "07", 9)], "dt STRING, hr STRING, n BIGINT")
    rows = {r.hr: (r.today, r.yesterday) for r in serving.compare_hours(spark, hourly, "n", "d2").collect()}
    assert len(rows) == 24 and rows["00"] == (5, 3) and rows["07"] == (0, 9) and rows["23"] == (0, 0)


def test_key_figures_of_an_empty_day(spark, folder):
    events = records.app_events(spark, folder, "1990-01-01")
    dau = dwd.dau_rows(dwd.daily_first_events(events))
    orders = records.orders_with_amounts(
        records.orders(spark, folder, "1990-01-01"), records.order_lines(spark, folder))
    rows = serving.kpi_total(dau, serving.new_devices_by_day(events), orders).collect()
    assert [(r.id, r.value) for r in rows] == [("dau", 0), ("new_mid", 0), ("order_amount", 0)]
    assert serving.order_amount_total(orders).first()[0] is None


def test_search_clauses_and_pages(spark):
    docs = spark.createDataFrame(
        [(1, "red sea", "hai", 5), (2, "red", "x", 9), (3, "sea", "hai", 2), (4, "blue", "hai", 8)],
        "id INT, name STRING, actor STRING, score INT")
    must = search.must_match(docs, {"name": "red sea", "actor": "hai"}, {"score": 3})
    assert rows_of(must.select("id")) == [(1,)]
    should = search.should_match(docs, [("name", "red"), ("actor", "hai")], {"score": 3})
    assert rows_of(should.select("id")) == [(1,), (2,), (4,)]
    page = search.page(docs, [F.col("score")], 1, 2)
    assert [r.id for r in page.collect()] == [4, 2]
    assert search.total_hits(docs).first()[0] == 4


def test_store_types(spark, folder):
    wide = dws.store_types(batch.full_wide(spark, folder))
    kinds = dict(wide.dtypes)
    assert kinds["final_detail_amount"] == "decimal(16,2)" and kinds["dt"] == "date"
    assert len(kinds) == 26


def test_day_of_the_stored_wide_table_opens_its_folder_only(spark, folder, tmp_path):
    path = str(tmp_path / "wide")
    files.write_days(batch.full_wide(spark, folder).filter("dt < '1995-03-01'"), path)
    stored = spark.read.parquet(path)
    day = stored.filter(F.col("dt") == "1995-02-03")
    total = serving.order_amount_total(day, "final_detail_cents")
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    orders = records.orders_with_amounts(
        records.orders(spark, folder, "1995-02-03"), records.order_lines(spark, folder))
    assert total.first()[0] == serving.order_amount_total(orders).first()[0]
    by_hour = serving.order_amount_by_hour(day, "final_detail_cents")
    assert rows_of(by_hour) == rows_of(serving.order_amount_by_hour(orders))


def test_lookup_of_seen_keys(spark):
    dim = spark.range(100).withColumnRenamed("id", "k")
    rows = spark.createDataFrame([(3,), (3,), (7,), (500,)], "k BIGINT")
    assert rows_of(dims.seen_only(dim, rows, "k")) == [(3,), (7,)]


def test_changes_without_a_type_pass(spark):
    rows = [("order_detail", None, '{"a":1}'), ("order_detail", "delete", '{"a":1}'), ("order_info", None, '{"a":1}')]
    df = spark.createDataFrame(rows, "table STRING, type STRING, data STRING")
    assert rows_of(ods.cdc_filter(df).select("table", "type")) == [("order_detail", None)]


def test_bands_follow_the_greatest_value(spark):
    df = spark.createDataFrame([(0,), (599,), (6000,)], "v BIGINT")
    assert rows_of(ads.value_bands(df, "v")) == [(0, 0), (599, 0), (6000, 5)]


def test_lines_move_once_where_no_order_is_hot(spark):
    """Orders, lines and skus that come twice, lines of nothing and lines without order or sku."""
    orders = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c")], "order_id BIGINT, order_status STRING")
    rows = [(10, 1, 7, 1, 100, 33), (11, 1, 8, 2, 50, 17), (11, 1, 8, 2, 50, 17), (12, 1, None, 1, 0, 0),
            (20, 2, 7, 1, 10, 5), (21, 2, 9, 1, 20, 9), (30, None, 7, 1, 5, 5), (40, 9, 7, 1, 5, 5)]
    lines = spark.createDataFrame(rows, "order_detail_id BIGINT, order_id BIGINT, sku_id BIGINT, sku_num BIGINT, line_cents BIGINT, paid_cents BIGINT")
    skus = spark.createDataFrame(
        [(7, 1, "x", 4, "K"), (8, 1, "y", 4, None), (8, 2, "z", 5, "K")],
        "sku_id BIGINT, spu_id BIGINT, sku_name STRING, tm_id BIGINT, category3_id STRING")
    names = [spark.createDataFrame(r, k) for r, k in (
        ([("K", "k")], "category3_id STRING, category3_name STRING"), ([(4, "four")], "tm_id BIGINT, tm_name STRING"),
        ([(1, "one")], "spu_id BIGINT, spu_name STRING"))]
    once = dws.unique_lines(lines)
    before = dims.add_sku(
        dws.allocate(records.orders_with_amounts(orders, once), once), dims.enrich_skus(skus, *names))
    moved = dws.allocate_by_order(orders, dims.with_skus(lines, skus))
    now = dims.add_listed_skus(moved, *names)
    columns = sorted(set(before.columns) & set(now.columns))
    assert {"final_detail_cents", "benefit_reduce_cents", "freight_cents", "sku_name", "spu_name", "tm_name", "category3_name"} <= set(columns)
    assert rows_of(now.select(columns)) == rows_of(before.select(columns)) and now.count() == 8
    assert not dws.has_hot_order(lines, 4) and dws.has_hot_order(lines, 3)


def test_resent_store_builds_no_other_store(spark, folder, monkeypatch):
    monkeypatch.setattr(stored, "_BUILT", {})

    def built(*_):
        raise AssertionError("the wide table is not needed")

    monkeypatch.setattr(batch, "shop_stores", built)
    got = batch.order_wide_latest_amount(spark, folder)
    assert got.agg(F.sum("n_lines")).first()[0] == records.order_lines(spark, folder).count()
