"""DIM: dimension attributes and lookups.

No join here forces a broadcast. Spark broadcasts a side by itself when its measured size is below
`spark.sql.autoBroadcastJoinThreshold`, and splits skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.people import age_group, gender_name


def with_user_labels(users: DataFrame, as_of: str) -> DataFrame:
    return users.withColumns({
        "age_group": age_group(F.col("birthday"), as_of),
        "gender_name": gender_name(F.col("gender")),
    })


def enrich_skus(
    skus: DataFrame, categories: DataFrame, trademarks: DataFrame, spus: DataFrame
) -> DataFrame:
    """Skus with the names of their category, trademark and SPU; unknown ones stay null."""
    return (
        skus.join(categories.select("category3_id", "category3_name"), "category3_id", "left")
        .join(trademarks.select("tm_id", "tm_name"), "tm_id", "left")
        .join(spus.select("spu_id", "spu_name"), "spu_id", "left")
    )


def seen_only(dim: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The rows of a dimension that `rows` needs, as a semi join that the optimizer plans."""
    return dim.join(rows.select(key).distinct(), key, "left_semi")


def versions(log: DataFrame, key: str, at: str = "valid_from") -> DataFrame:
    """Rows of a change log with the time up to which each was valid, null for the current one.

    Of several changes of a key at one time any is taken.
    """
    order = Window.partitionBy(key).orderBy(at)
    return log.dropDuplicates([key, at]).withColumn("valid_to", F.lead(at).over(order))


def as_of(rows: DataFrame, valid: DataFrame, key: str, time: str) -> DataFrame:
    """Rows with the version of their dimension row that was valid at their time, if there was one."""
    right = valid.withColumnRenamed(key, "_key")
    on = (
        (rows[key] == F.col("_key"))
        & (rows[time] >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (rows[time] < F.col("valid_to")))
    )
    return rows.join(right, on, "left").drop("_key", "valid_from", "valid_to")


def add_province(orders: DataFrame, provinces: DataFrame) -> DataFrame:
    columns = ["province_id", "province_name", "province_area_code", "province_iso_code", "province_iso_3166_2"]
    return orders.join(provinces.select(*columns), "province_id", "left")


def add_user(orders: DataFrame, labelled_users: DataFrame) -> DataFrame:
    names = labelled_users.select(
        "user_id",
        F.col("age_group").alias("user_age_group"),
        F.col("gender_name").alias("user_gender"),
    )
    return orders.join(names, "user_id", "left")


def add_sku(lines: DataFrame, enriched_skus: DataFrame) -> DataFrame:
    columns = ["sku_id", "sku_name", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name"]
    return lines.join(enriched_skus.select(*columns), "sku_id", "left")


def with_skus(lines: DataFrame, skus: DataFrame) -> DataFrame:
    """Lines with the sku rows of their sku as an array, so that there are as many lines as before; see
    `add_listed_skus`."""
    columns = ["spu_id", "sku_name", "tm_id", "category3_id"]
    listed = skus.groupBy("sku_id").agg(F.collect_list(F.struct(*columns)).alias("_skus"))
    return lines.join(listed, "sku_id", "left")


def add_listed_skus(
    rows: DataFrame, categories: DataFrame, trademarks: DataFrame, spus: DataFrame
) -> DataFrame:
    """What `add_sku` gives, from the arrays of `with_skus`: the names are looked up last, from tables of a
    few rows."""
    named = rows.select("*", F.explode_outer("_skus").alias("_sku")).select("*", "_sku.*").drop("_sku", "_skus")
    return enrich_skus(named, categories, trademarks, spus)
