"""Money as integer cents."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


def to_cents(amount: Column) -> Column:
    """Nearest cent, halves up; cheaper than `round`, which goes through arbitrary precision."""
    return F.floor(amount * 100 + F.lit(Decimal("0.5"))).cast("bigint")


def to_decimal(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(16,2)")


def int_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def prorate(part: Column, total: Column, base: Column) -> Column:
    """`part * total / base` rounded half up, for non-negative integers; 0 when `base` is 0.

    The product is taken in BIGINT while it fits and in DECIMAL(38) beyond that.
    """
    fits = part.cast("double") * total.cast("double") < F.lit(4e18)
    narrow = int_div(part * total * 2 + base, base * 2)
    dec = [c.cast("decimal(18,0)") for c in (part, total, base)]
    wide = int_div(dec[0] * dec[1] * 2 + dec[2], dec[2] * 2)
    return F.when(base == 0, F.lit(0).cast("bigint")).when(fits, narrow).otherwise(wide)


def discounted(cents: Column, discount_percent: Column) -> Column:
    """Price after a whole-percent discount, rounded half up to the cent."""
    return int_div(cents * (F.lit(100) - discount_percent) + 50, F.lit(100))
