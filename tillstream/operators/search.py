"""Search: keyword queries over documents and over order lines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F

from ..functions.text import highlight, matches_any_word
from .ads import shares
from .postings import PostingIndex


def _at_least(df: DataFrame, bounds: dict[str, int] | None) -> DataFrame:
    for column, low in (bounds or {}).items():
        df = df.filter(F.col(column) >= low)
    return df


def must_match(
    df: DataFrame, index: PostingIndex | dict[str, str], key: str | dict[str, int] | None = None,
    clauses: dict[str, str] | None = None, at_least: dict[str, int] | None = None,
) -> DataFrame:
    """Rows matching every clause (any word of it) and every unscored lower bound: the postings of the
    clauses are intersected, the searched columns are not read. Without an index, as `must_match(df, clauses,
    at_least)`, they are."""
    if not isinstance(index, PostingIndex):
        rows = _at_least(df, key)
        for column, words in index.items():
            rows = rows.filter(matches_any_word(F.col(column), words))
        return rows
    rows = _at_least(df, at_least)
    for column, words in clauses.items():
        rows = rows.join(index.any_word(column, words).withColumnRenamed("key", key), key, "left_semi")
    return rows


def should_match(
    df: DataFrame, index: PostingIndex | Sequence[tuple[str, str]], key: str | dict[str, int] | None = None,
    clauses: Sequence[tuple[str, str]] | None = None, at_least: dict[str, int] | None = None,
) -> DataFrame:
    """Rows matching at least one clause and every lower bound; without an index as `must_match`."""
    if not isinstance(index, PostingIndex):
        return _at_least(df, key).filter(reduce(Column.__or__, (matches_any_word(F.col(c), w) for c, w in index)))
    hits = [index.any_word(column, words) for column, words in clauses]
    keys = reduce(DataFrame.unionByName, hits).distinct().withColumnRenamed("key", key)
    return _at_least(df, at_least).join(keys, key, "left_semi")


def with_highlight(df: DataFrame, column: str, words: str) -> DataFrame:
    return df.withColumn("highlight", highlight(F.col(column), words))


def page(df: DataFrame, order: Sequence[Column], number: int, size: int) -> DataFrame:
    """Page `number` (from 0) of the ordered rows. No task keeps more than the pages up to it."""
    return df.orderBy(*order).offset(number * size).limit(size)


def page_after(df: DataFrame, keys: Sequence[str], last: Sequence | None, size: int) -> DataFrame:
    """The `size` rows that follow the key `last` (None: the first ones) by ascending `keys`.

    Whatever page it is, each task keeps `size` rows. Keys must be unique together; rows with a null in
    one are on no page.
    """
    rows = df.dropna(subset=list(keys))
    if last is not None:
        after, equal = F.lit(False), F.lit(True)
        for key, value in zip(keys, last):
            after = after | (equal & (F.col(key) > F.lit(value)))
            equal = equal & (F.col(key) == F.lit(value))
        # The first key's bound alone can be pushed to the scan.
        rows = rows.filter(F.col(keys[0]) >= F.lit(last[0])).filter(after)
    return rows.orderBy(*keys).limit(size)


def total_hits(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


def detail_hits(lines: DataFrame, skus: DataFrame, keyword: str) -> DataFrame:
    """Order lines whose sku name has the keyword; an empty keyword keeps all."""
    names = skus.select("sku_id", "sku_name", "tm_id", "category3_id", "spu_id", "price_cents")
    if keyword:
        names = names.filter(matches_any_word(F.col("sku_name"), keyword))
    return lines.join(names, "sku_id")


def wide_hits(wide: DataFrame, day: str, keyword: str) -> DataFrame:
    """Wide rows of a day, and with the keyword in the sku name unless it is empty."""
    hits = wide.filter(F.col("dt") == day)
    return hits.filter(matches_any_word(F.col("sku_name"), keyword)) if keyword else hits


@dataclass(frozen=True)
class DetailSearch:
    """Wide rows of a day with a keyword in the sku name (all if it is empty): how many there are, how they
    divide, and pages of `size` rows by ascending `keys`, each taken from the key the last one ended with."""

    wide: DataFrame
    day: str
    keyword: str
    keys: tuple[str, ...]
    size: int

    def hits(self) -> DataFrame:
        return wide_hits(self.wide, self.day, self.keyword)

    def total(self) -> DataFrame:
        return total_hits(self.hits())

    def shares(self, attribute: str) -> DataFrame:
        """Rows per value of a user attribute, and their share."""
        counts = self.hits().groupBy(attribute).agg(F.count(F.lit(1)).alias("n"))
        return shares(counts, attribute, "n")

    def page(self, last: Sequence | None = None) -> DataFrame:
        """The rows after the key `last`, the first ones without it."""
        return page_after(self.hits(), self.keys, last, self.size)

    def key_of(self, row: Row) -> tuple:
        return tuple(row[key] for key in self.keys)
