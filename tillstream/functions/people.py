"""User attributes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Group labels shown in reports.
AGE_UP_TO_20 = "20岁及以下"
AGE_21_TO_30 = "21岁到30岁"
AGE_OVER_30 = "30岁以上"
MALE = "男"
FEMALE = "女"


def age_group(birthday: Column, as_of: str) -> Column:
    """Age in 365-day years at `as_of`; 20 itself belongs to the middle group."""
    years = F.call_function("div", F.datediff(F.lit(as_of).cast("date"), birthday), F.lit(365))
    return (
        F.when(years < 20, F.lit(AGE_UP_TO_20))
        .when(years > 30, F.lit(AGE_OVER_30))
        .otherwise(F.lit(AGE_21_TO_30))
    )


def gender_name(gender: Column) -> Column:
    return F.when(gender == "M", F.lit(MALE)).otherwise(F.lit(FEMALE))
