"""Record schemas. Keys are BIGINT inside; only JSON and the report tables use strings."""

from __future__ import annotations

from pyspark.sql import types as T


_LONG, _TEXT, _MONEY = T.LongType(), T.StringType(), T.DecimalType(16, 2)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _texts(names: str) -> T.StructType:
    return _struct(**{name: _TEXT for name in names.split()})


APP_LOG = _struct(ts=_LONG, start=_TEXT, common=_texts("mid uid ar ch vc"))
CDC_ROW = _texts("table type data")
CDC_ARRAY = _struct(table=_TEXT, type=_TEXT, data=T.ArrayType(_TEXT))

ORDER_INFO = _struct(
    id=_LONG, province_id=_LONG, order_status=_TEXT, user_id=_LONG,
    final_total_amount=_MONEY, benefit_reduce_amount=_MONEY, original_total_amount=_MONEY,
    feight_fee=_MONEY, expire_time=_TEXT, create_time=_TEXT, operate_time=_TEXT,
)
ORDER_DETAIL = _struct(
    id=_LONG, order_id=_LONG, sku_id=_LONG, order_price=_MONEY, sku_num=_LONG, sku_name=_TEXT,
    create_time=_TEXT,
)
PROVINCE = _texts("id name region_id area_code iso_code iso_3166_2")
USER = _texts("id user_level birthday gender")
SKU = _texts("id spu_id price sku_name tm_id category3_id create_time")
SPU = _texts("id spu_name")
TRADEMARK = _texts("tm_id tm_name")
CATEGORY3 = _texts("id name category2_id")
USER_STATE = _texts("user_id if_consumed")
# Orders of which all lines have come.
ORDER_DONE = _struct(order_id=_LONG, create_time=T.TimestampType(), share_sum=_LONG, last_id=_LONG)

# Dimension topics: name of the table, its key, and its messages.
DIMENSIONS = {
    "ODS_BASE_PROVINCE": ("province", "province_id", _struct(
        province_id=_LONG, province_name=_TEXT, region_id=_TEXT, province_area_code=_TEXT,
        province_iso_code=_TEXT, province_iso_3166_2=_TEXT)),
    "ODS_USER_INFO": ("user", "user_id", _struct(
        user_id=_LONG, user_level=_TEXT, birthday=T.DateType(), gender=_TEXT, province_id=_LONG)),
    "ODS_SKU_INFO": ("sku", "sku_id", _struct(
        sku_id=_LONG, spu_id=_LONG, price_cents=_LONG, sku_name=_TEXT, tm_id=_LONG, category3_id=_TEXT)),
    "ODS_SPU_INFO": ("spu", "spu_id", _struct(spu_id=_LONG, spu_name=_TEXT)),
    "ODS_BASE_TRADEMARK": ("trademark", "tm_id", _struct(tm_id=_LONG, tm_name=_TEXT)),
    "ODS_BASE_CATEGORY3": ("category3", "category3_id", _struct(category3_id=_TEXT, category3_name=_TEXT)),
}

# Column order of the wide table.
ORDER_WIDE_COLUMNS = [
    "order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
    "sku_price_cents", "sku_num", "sku_name", "benefit_reduce_cents", "original_total_cents",
    "freight_cents", "final_total_cents", "final_detail_cents", "if_first_order",
    "province_name", "province_area_code", "user_age_group", "user_gender", "dt",
    "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name",
]

# Wide-table columns that hold cents inside and DECIMAL(16,2) in stores and JSON.
ORDER_WIDE_MONEY = {
    "sku_price_cents": "sku_price",
    "benefit_reduce_cents": "benefit_reduce_amount",
    "original_total_cents": "original_total_amount",
    "freight_cents": "feight_fee",
    "final_total_cents": "final_total_amount",
    "final_detail_cents": "final_detail_amount",
}
