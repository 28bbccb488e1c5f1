"""One form of detail search: date, keyword, total, shares and pages by key."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tillstream.operators import search

from .conftest import rows_of

KIND = ("order_detail_id BIGINT, order_id BIGINT, sku_name STRING, user_age_group STRING, user_gender STRING,"
        " line_cents BIGINT, dt STRING")
DAY = "2024-01-02"


@pytest.fixture
def wide(spark):
    rows = [
        (k, k // 3, ("red lamp", "blue Lamp", None, "redder")[k % 4], ("a", "b", None)[k % 3], "男" if k % 2 else "女",
         k * 10, DAY if k % 5 else "2024-01-03")
        for k in range(400)
    ]
    # Rows that tie in the first key, a null key, and a column of a name that the form uses itself.
    rows += [(7, 900 + k, "red", "a", "男", 1, DAY) for k in range(5)] + [(None, 1, "red", "a", "男", 1, DAY)]
    return spark.createDataFrame(rows, KIND).withColumn("n", F.lit("other"))


def _chosen(wide, keyword):
    rows = [r for r in wide.collect() if r.dt == DAY]
    return [r for r in rows if not keyword or (r.sku_name and keyword in r.sku_name.lower().split())]


@pytest.mark.parametrize("keyword", ["red", "lamp", "", "nothing"])
def test_total_shares_and_pages_are_of_the_same_rows(wide, keyword):
    form = search.DetailSearch(wide, DAY, keyword, ("order_detail_id", "order_id"), 30)
    expected = _chosen(wide, keyword)
    assert form.total().first()[0] == len(expected)
    for attribute in ("user_age_group", "user_gender"):
        counts = {}
        for r in expected:
            counts[r[attribute]] = counts.get(r[attribute], 0) + 1
        got = {r[0]: (r[1], r[2]) for r in form.shares(attribute).collect()}
        assert got == {
            k: (n, (n * 20000 + len(expected)) // (2 * len(expected))) for k, n in counts.items()
        }
    # All pages one after the other are the rows in order; what has no key is on none.
    seen, last = [], None
    while rows := form.page(last).collect():
        assert len(rows) <= 30
        seen += rows
        last = form.key_of(rows[-1])
    ordered = sorted((r.order_detail_id, r.order_id) for r in expected if r.order_detail_id is not None)
    assert [(r.order_detail_id, r.order_id) for r in seen] == ordered


def test_a_far_page_equals_the_offset_page_and_keeps_one_page(spark):
    """Page 10,000 by key: equal rows, and no task keeps more than a page."""
    rows = spark.range(210_000).select(
        F.col("id").alias("order_detail_id"), F.col("id").alias("order_id"), F.lit("red").alias("sku_name"),
        F.lit("a").alias("user_age_group"), F.lit("男").alias("user_gender"), F.lit(DAY).alias("dt"),
    )
    form = search.DetailSearch(rows, DAY, "red", ("order_detail_id", "order_id"), 20)
    number = 10_000
    far = form.page((number * 20 - 1, number * 20 - 1))
    by_offset = search.page(search.wide_hits(rows, DAY, "red"), [F.col("order_detail_id")], number, 20)
    assert rows_of(far) == rows_of(by_offset)
    plan = far._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=20" in plan and "offset" not in plan.lower()


def test_day_reaches_the_store(spark, folder):
    from tillstream.plans import batch
    from tillstream.plans.stored import shop_stores

    form = search.DetailSearch(
        shop_stores(spark, folder).wide_rows(batch.ORDER_DAY), batch.ORDER_DAY, "red", ("order_detail_id",), 10)
    for part in (form.total(), form.shares("user_gender"), form.page(None)):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert date.fromisoformat(batch.ORDER_DAY).strftime("%Y-%m") in plan.partition("PartitionFilters")[2]
