"""JSON in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

CORRUPT = "_corrupt_record"


def parse_typed(
    df: DataFrame, schema: T.StructType, column: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Parse a JSON text column into top-level columns plus the text of rows that do not parse.

    The struct is unnested by a generator: a later filter then stays above it and each text is
    parsed once, where a plain projection would be parsed again for every column a filter names.
    `keep` names columns of the message itself to carry along.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return df.select(*keep, F.inline(F.array(F.from_json(column, with_corrupt, options))))


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_rows(parsed: DataFrame) -> DataFrame:
    """Texts that did not parse, for a side output."""
    return parsed.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))


def json_of(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns))


def keyed_json(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as topic messages: `value` is the row's JSON, `key` keeps equal keys together."""
    value = json_of(*df.columns).alias("value")
    key_col = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(key_col.alias("key"), value)
