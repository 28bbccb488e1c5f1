"""Dimension loaders: a change topic each, kept with every version, and names that arrive late.

A dimension is a result table (`sinks.results`) of changes, each valid from its message's time. A sku's
names come from three other dimensions. The batch that brings a change of any of the four first stores it
and then enriches the skus it concerns, so of two that cross at least the later one sees the other: a brand
that comes after its sku gives its name to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.jsontext import good_rows, parse_typed
from ..operators import dims
from ..operators.keyed import latest_per_key
from ..schemas import DIMENSIONS
from ..session import folder_exists
from ..sinks.results import read_results, result_writer
from .jobs import per_batch

PLACE = ["timestamp", "part", "pos"]
# The dimensions whose names a sku carries, by the sku's column.
SKU_NAMES = {"trademark": "tm_id", "spu": "spu_id", "category3": "category3_id"}
_KEYS = {name: (key, schema) for name, key, schema in DIMENSIONS.values()}


def changes(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All changes of a dimension, `valid_from` when each came."""
    path = f"{root}/{name}"
    if not folder_exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], _KEYS[name][1]).withColumn("valid_from", F.lit(None).cast("timestamp"))
    return read_results(spark, path).drop("commit")


def current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest row of each key."""
    key = _KEYS[name][0]
    return latest_per_key(changes(spark, root, name), [key], [F.col("valid_from").desc()]).drop("valid_from")


def valid(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Versions with validity ranges, for `dims.as_of`."""
    return dims.versions(changes(spark, root, name), _KEYS[name][0])


def _newest(rows: DataFrame, key: str) -> DataFrame:
    """Of each key of a batch the change that counts, with its time."""
    newest = latest_per_key(rows, [key], [F.col(c).desc() for c in PLACE])
    return newest.withColumnRenamed("timestamp", "valid_from").drop("part", "pos")


def load(messages: DataFrame, topic: str, root: str) -> DataStreamWriter:
    """Keep a dimension from its topic (read with positions), and the names of skus with it."""
    spark = messages.sparkSession
    name, key, schema = DIMENSIONS[topic]
    rows = good_rows(parse_typed(messages, schema, keep=PLACE)).filter(F.col(key).isNotNull())
    store = result_writer(f"{root}/{name}", lambda batch: _newest(batch, key))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            store(batch, batch_id)
            if name == "sku" or name in SKU_NAMES:
                _name_skus(spark, batch, batch_id, root, name, key)
        finally:
            batch.unpersist()

    return per_batch(rows, write, "append")


def _name_skus(spark: SparkSession, batch: DataFrame, batch_id: int, root: str, name: str, key: str) -> None:
    """Enrich the skus a batch concerns anew."""
    column = SKU_NAMES.get(name, "sku_id")

    def named(rows: DataFrame) -> DataFrame:
        changed = rows.select(F.col(key).alias(column)).distinct()
        skus = current(spark, root, "sku").join(changed, column, "left_semi")
        others = [current(spark, root, other) for other in ("category3", "trademark", "spu")]
        # When it was read decides between enrichments of one sku: all of them saw what was stored before.
        return dims.enrich_skus(skus, *others).withColumn("named_at", F.current_timestamp())

    result_writer(f"{root}/sku-names/{name}", named)(batch, batch_id)


def named_skus(spark: SparkSession, root: str) -> DataFrame:
    """Each sku as it was enriched last."""
    sources = [f"{root}/sku-names/{name}" for name in ("sku", *SKU_NAMES)]
    parts = [read_results(spark, path).drop("commit") for path in sources if folder_exists(spark, f"{path}/manifest")]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return latest_per_key(rows, ["sku_id"], [F.col("named_at").desc()]).drop("named_at")
