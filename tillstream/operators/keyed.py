"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], spread: bool = False
) -> DataFrame:
    """The first row of each key.

    Spark keeps one candidate per key and map task before the shuffle (window group limit), so a
    key that holds much of the data still reaches its reducer as a few rows. Rows that are already
    distributed by a part of the key, as after a join, would be windowed where they are, hot keys
    and all; `spread` distributes them anew by the whole key.
    """
    partition = [F.struct(*keys)] if spread else list(keys)
    window = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], spread: bool = False
) -> DataFrame:
    """The winning row of each key by a newest-first order."""
    return first_per_key(df, keys, order, spread)
