"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tillstream.operators import dws
from tillstream.plans import batch
from tillstream.session import conf_override
from tillstream.sources import records

WRITERS = {"order_wide_shard_counts", "raw_log_landing", "dim_upsert_latest", "dau_index_write", "order_wide_store", "doc_with_array"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in batch.REGISTRY if n not in WRITERS])
def test_no_cross_join_and_no_python(spark, folder, name):
    plan = _plan(queries()[name](spark, folder))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "MapInArrow"):
        assert word not in plan


def test_dedupe_keeps_one_row_per_key_before_the_shuffle(spark, folder):
    plan = _plan(queries()["dau_dedup"](spark, folder))
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_day_reaches_the_scan(spark, folder):
    dau, orders = (_plan(queries()[n](spark, folder)) for n in ("dau_total", "order_amount_day"))
    assert "GreaterThanOrEqual(ts,2024-01-15" in dau
    assert "GreaterThanOrEqual(dt,1996-09-17" in orders and "PartitionFilters: [isnotnull(part" in orders


def test_scan_reads_needed_columns_only(spark, folder):
    plan = _plan(queries()["dau_total"](spark, folder))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan


def test_allocation_gathers_no_order(spark, folder):
    """Shares are summed per order by an aggregate; no window holds an order's lines."""
    with conf_override(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        lines = records.order_lines(spark, folder)
        orders = records.orders_with_amounts(records.orders(spark, folder), lines)
        plan = _plan(dws.allocate(orders, lines))
    assert "Window" not in plan and "Broadcast" not in plan
    assert "sum(_share" in plan


def test_sums_by_dimension_are_partial_before_the_join(spark, folder):
    plan = _plan(queries()["province_amount"](spark, folder))
    assert "partial_sum(final_total_cents" in plan


def test_dedupe_after_a_join_spreads_by_line(spark, folder):
    """Copies of one line collapse before the exchange although the join left rows by order."""
    with conf_override(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        pairs = dws.join_wide(records.orders(spark, folder), records.order_lines(spark, folder))
        for rows in (dws.dedup_lines(pairs), dws.latest_lines(pairs)):
            plan = _plan(rows)
            last, first = plan.index("WindowGroupLimit"), plan.rindex("WindowGroupLimit")
            assert "Exchange hashpartitioning" in plan[last:first]


def test_hot_order_is_split_in_the_join(spark):
    """A third of all lines in one order: the adaptive plan splits that join partition."""
    folder = "/root/testdata/sf0.01"
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    with conf_override(spark, conf):
        lines = records.order_lines(spark, folder)
        hot = lines.filter("order_id % 3 = 0").withColumn("order_id", F.lit(7).cast("bigint"))
        lines = lines.filter("order_id % 3 <> 0").unionByName(hot).repartition(8)
        wide = dws.join_wide(records.orders(spark, folder), lines).groupBy("order_id").agg(
            F.max("order_detail_id").alias("last"))
        wide._jdf.collectToPython()
        assert "skew=true" in _plan(wide)
