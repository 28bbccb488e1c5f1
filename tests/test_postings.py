"""The inverted index against a scan of the texts, with scripts without blanks and replaced documents."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillstream.functions.text import highlight, matches_any_word, query_terms
from tillstream.operators.postings import PostingIndex, postings
from tillstream.operators.search import must_match, page, page_after, should_match
from tillstream.plans import batch
from tillstream.session import workspace

from .conftest import rows_of

TEXTS = [
    (1, "Der rote Hahn, the RED hen"), (2, "redder than red_hen"), (3, None), (4, ""), (5, "新品手机上市，手机壳"),
    (6, "机手 手 机"), (7, "iPhone手机壳 red"), (8, "red " * 3000 + "Ünder"), (9, "ünder iphone 手机"), (10, "手"),
    (11, "カタカナとひらがな"), (12, "red"), (13, "!!! ???"), (None, "red without a key"),
]


def _index(spark, rows=TEXTS):
    docs = spark.createDataFrame(rows, "id LONG, text STRING").withColumn("extra", F.lit("red"))
    index = PostingIndex(spark, workspace(spark, "index"), buckets=4)
    index.add(docs, "id", ["text"], 0)
    return docs, index


@pytest.mark.parametrize(
    "words",
    ["red", "RED hen", "手机", "手", "机", "手机壳 hen", "壳", "手机上市", "上手", "カタ", "がな", "nothing", "ünder", "ÜNDER red_hen", "新品手机上市"],
)
def test_index_equals_scan(spark, words):
    docs, index = _index(spark)
    found = must_match(docs, index, "id", {"text": words}).select("id")
    scan = docs.filter("id IS NOT NULL").filter(matches_any_word(F.col("text"), words)).select("id")
    assert rows_of(found) == rows_of(scan)


def test_word_of_two_scripts(spark):
    docs, index = _index(spark)
    assert query_terms(spark, "iPhone手机壳") == [["iphone"], ["手机", "机壳"]]
    assert rows_of(must_match(docs, index, "id", {"text": "iPhone手机"}).select("id")) == [(7,), (9,)]


def test_clauses_and_bounds(spark):
    docs, index = _index(spark)
    rows = docs.withColumn("n", F.length("text"))
    assert rows_of(should_match(rows, index, "id", [("text", "手机"), ("text", "hahn")], {"n": 10}).select("id")) == [(1,), (5,), (7,), (9,)]
    assert must_match(rows, index, "id", {"text": ""}).count() == 0


def test_later_batch_replaces(spark):
    docs, index = _index(spark)
    again = spark.createDataFrame([(1, "a blue cock"), (20, "red")], "id LONG, text STRING")
    for _ in range(2):
        index.add(again, "id", ["text"], 1)
    both = docs.select("id").union(again.select("id")).distinct()
    found = lambda w: rows_of(must_match(both, index, "id", {"text": w}).select("id"))
    assert found("red") == sorted([(7,), (8,), (12,), (20,)], key=repr) and found("blue") == [(1,)] and found("hahn") == []


def test_positions(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "手机手机")], "id LONG, text STRING")
    got: dict = {}
    for row in postings(docs, "id", ["text"]).orderBy("at").collect():
        got.setdefault((row.key, row.term), []).append(row.at)
    step = 1 << 32
    assert got == {(1, "a"): [0, 2 * step], (1, "b"): [step], (2, "手机"): [0, 2], (2, "机手"): [1], (2, "机"): [3]}


def test_highlight_agrees(spark):
    docs, _ = _index(spark)
    marked = lambda i, w: docs.filter(F.col("id") == i).select(highlight(F.col("text"), w)).first()[0]
    assert marked(5, "手机") == "新品<em>手机</em>上市，<em>手机</em>壳"
    assert marked(7, "iphone") == "<em>iPhone</em>手机壳 red"
    assert marked(2, "red") == "redder than red_hen"


def test_empty_table(spark):
    docs, index = _index(spark, [])
    assert must_match(docs, index, "id", {"text": "red 手机"}).count() == 0


def test_search_reads_postings_only(spark, folder):
    query = batch.REGISTRY["keyword_match"](spark, folder)
    plan = query._jdf.queryExecution().executedPlan().toString()
    documents = [line for line in plan.split("\n") if "documents.parquet" in line]
    # Of the documents neither texts nor languages are filtered; the postings' folders are chosen by term.
    assert documents and all("text:string" not in line for line in documents)
    assert "PartitionFilters: [bucket" in plan and "In(term" in plan


def test_pages_by_key_equal_pages_by_offset(spark):
    rows = spark.range(997).select(
        F.col("id").alias("k"), F.when(F.col("id") % 50 != 7, F.col("id") * 31 % 13).alias("n")
    )
    last, number, seen = None, 0, []
    while got := page_after(rows, ["n", "k"], last, 100).collect():
        assert got == page(rows.dropna(), [F.col("n"), F.col("k")], number, 100).collect()
        last, number, seen = (got[-1].n, got[-1].k), number + 1, seen + got
    assert len(seen) == rows.dropna().count()
    # A page far behind keeps as many rows as the first.
    plan = page_after(rows, ["n", "k"], (12, 900), 100)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=100" in plan
