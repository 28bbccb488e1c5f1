from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.functions import jsontext, money, people, text, times

AS_OF = date(2020, 12, 1)


@pytest.mark.parametrize(
    "age, group",
    [(19, people.AGE_UP_TO_20), (20, people.AGE_21_TO_30), (21, people.AGE_21_TO_30),
     (30, people.AGE_21_TO_30), (31, people.AGE_OVER_30)],
)
@pytest.mark.parametrize("extra_days", [0, 364])
def test_age_group_edges(spark, age, group, extra_days):
    born = AS_OF - timedelta(days=age * 365 + extra_days)
    df = spark.createDataFrame([(born,)], "birthday DATE")
    assert df.select(people.age_group(F.col("birthday"), AS_OF.isoformat())).first()[0] == group


def test_gender_name(spark):
    df = spark.createDataFrame([("M",), ("F",), (None,)], "gender STRING")
    names = [r[0] for r in df.select(people.gender_name(F.col("gender"))).collect()]
    assert names == [people.MALE, people.FEMALE, people.FEMALE]


def test_prorate_rounds_half_up_in_both_widths(spark):
    big = 10**16
    rows = [(4000, 10000, 12000), (1, 1, 2), (0, 5, 0), (3, big, 7), (12345678, big + 1, big)]
    df = spark.createDataFrame(rows, "p BIGINT, t BIGINT, b BIGINT")
    got = [r[0] for r in df.select(money.prorate(F.col("p"), F.col("t"), F.col("b"))).collect()]
    assert got == [(2 * p * t + b) // (2 * b) if b else 0 for p, t, b in rows]


def test_cents_and_decimals(spark):
    df = spark.createDataFrame([(0.1,), (68423.46,), (1.005,), (0.29,)], "x DOUBLE")
    cents = df.select(money.to_cents(F.col("x")).alias("c"))
    assert [r[0] for r in cents.collect()] == [10, 6842346, 100, 29]
    back = [r[0] for r in cents.select(money.to_decimal(F.col("c"))).collect()]
    assert back == [Decimal("0.10"), Decimal("68423.46"), Decimal("1.00"), Decimal("0.29")]
    exact = spark.sql("SELECT CAST(12.34 AS DECIMAL(16,2)) AS x")
    assert exact.select(money.to_cents(F.col("x"))).first()[0] == 1234


def test_time_parts(spark):
    df = spark.createDataFrame([(1604224103939, "2020-11-01 07:05:09")], "ts BIGINT, t STRING")
    row = df.select(
        *times.event_time_parts(F.timestamp_millis("ts")), *times.order_time_parts(F.col("t"))
    ).first()
    assert tuple(row) == ("2020-11-01", "09", "48", "2020-11-01", "07")
    assert times.previous_day("2024-03-01") == "2024-02-29"


def test_numbers_coerce_into_text_fields(spark):
    value = '{"area_code":"340000","name":"安徽","region_id":"2","iso_3166_2":"CN-AH","id":9,"iso_code":"CN-34"}'
    df = spark.createDataFrame([(value,)], "value STRING")
    row = jsontext.good_rows(jsontext.parse_typed(df, schemas.PROVINCE)).first()
    assert tuple(row) == ("9", "安徽", "2", "340000", "CN-34", "CN-AH")


def test_text_that_does_not_parse_is_set_aside(spark):
    df = spark.createDataFrame([('{"id": 1, "name": "a"}',), ("{oops",)], "value STRING")
    parsed = jsontext.parse_typed(df, schemas.CATEGORY3)
    assert jsontext.good_rows(parsed).count() == 1
    assert jsontext.corrupt_rows(parsed).first()[0] == "{oops"


def test_order_json_round_trip(spark):
    value = '{"id":5,"user_id":7,"final_total_amount":12.5,"create_time":"2020-11-01 07:05:09"}'
    df = spark.createDataFrame([(value,)], "value STRING")
    row = jsontext.good_rows(jsontext.parse_typed(df, schemas.ORDER_INFO)).first()
    assert (row.id, row.user_id, row.final_total_amount) == (5, 7, Decimal("12.50"))
    again = jsontext.keyed_json(spark.createDataFrame([(5, "x")], "id BIGINT, s STRING"), "id").first()
    assert tuple(again) == ("5", '{"id":5,"s":"x"}')


def test_words_match_whole_and_in_any_language(spark):
    data = ["Red Sea, red", "reddish sea", "mer ROUGE", "leSea", "der Ärger", "ärgern"]
    df = spark.createDataFrame([(t,) for t in data], "t STRING")
    hit = [r[0] for r in df.select(text.matches_any_word(F.col("t"), "red ärger sea")).collect()]
    assert hit == [True, True, False, False, True, False]
    marked = [r[0] for r in df.select(text.highlight(F.col("t"), "red sea")).collect()]
    assert marked[0] == "<em>Red</em> <em>Sea</em>, <em>red</em>"
    assert marked[1] == "reddish <em>sea</em>" and marked[3] == "leSea"


def test_runs_are_told_apart_as_by_the_plain_classes_and_scripts_looked_up_last(spark):
    """Every character of the first planes beside a letter, a digit, a blank and a Han character."""
    plain = rf"[{text.SCRIPTS}]+|[\p{{L}}\p{{N}}_&&[^{text.SCRIPTS}]]+"
    chars = spark.range(0x20, 0x30000).filter("id not between 55296 and 57343").select(
        F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    texts = chars.select(F.concat(F.lit("Ab"), "c", F.lit("9 "), "c", F.lit("中_"), "c", "c").alias("t"))
    old = F.regexp_extract_all(F.lower("t"), F.lit(plain), F.lit(0))
    assert texts.count() > 190_000 and texts.filter(text.runs(F.col("t")) != old).isEmpty()
    plan = texts.select(text.run_terms(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "ascii(" in plan
