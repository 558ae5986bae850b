"""Column names and table schemas of the behaviour-log data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the log, metadata and feature tables (must
# equal the names produced by the upstream exports).
TIMESTAMP = "timestamp"
ACTION_TYPE = "action_type"
SEARCH_KEYWORD = "search_keyword"
MEMBER_ID = "m_id"
COMP_MEMBER_ID = "comp_mid"
AGE = "age"
SEX = "sex"
PRODUCT_NO = "prod_no"
PRICE = "sale_price"
SALE_START_DATE = "sale_start_dt"
SALE_END_DATE = "sale_end_dt"
PRODUCT_NAME = "prod_nm"
DEAL_CONSTRUCTION = "deal_construction"
DEPTH0_NAME = "gnb_depth0_nm"
DEPTH1_NO = "gnb_depth1_cate_id"
DEPTH1_NAME = "gnb_depth1_nm"
DEPTH2_NO = "gnb_depth2_cate_id"
DEPTH2_NAME = "gnb_depth2_nm"
DEPTH0_DISPLAY_ORDER = "display_order_depth0"
DEPTH1_DISPLAY_ORDER = "display_order_depth1"
DEPTH2_DISPLAY_ORDER = "display_order_depth2"
CATEGORY_NO = "gnb_category_id"
DEAL_NO = "deal_no"
ITEM_NO = "item_no"
VALID_PRODUCT_NO = "deal_prod_no"

# Derived columns of the instance-building stage.
USER_IDX = "user_idx"
PROD_IDX = "prod_idx"
CATEGORY_IDX = "gnb_category_idx"

USERACTION_COLUMNS = [TIMESTAMP, ACTION_TYPE, PRODUCT_NO, SEARCH_KEYWORD, MEMBER_ID]

# The 19 columns of a feature row, in output order.
FEATURE_COLUMNS = [
    COMP_MEMBER_ID, TIMESTAMP, PRODUCT_NO, SEX, AGE, PRICE, SALE_START_DATE,
    SALE_END_DATE, PRODUCT_NAME, DEAL_CONSTRUCTION, CATEGORY_NO, DEPTH0_NAME,
    DEPTH1_NO, DEPTH1_NAME, DEPTH2_NO, DEPTH2_NAME, DEPTH0_DISPLAY_ORDER,
    DEPTH1_DISPLAY_ORDER, DEPTH2_DISPLAY_ORDER,
]

PRODUCT_COLUMNS = [PRODUCT_NO, PRICE, SALE_START_DATE, SALE_END_DATE, PRODUCT_NAME, DEAL_CONSTRUCTION]

USERACTION = T.StructType([
    T.StructField(TIMESTAMP, T.LongType()),
    T.StructField(ACTION_TYPE, T.StringType()),
    T.StructField(PRODUCT_NO, T.IntegerType()),
    T.StructField(SEARCH_KEYWORD, T.StringType()),
    T.StructField(MEMBER_ID, T.StringType()),
])

USER = T.StructType([
    T.StructField(COMP_MEMBER_ID, T.StringType()),
    T.StructField(SEX, T.IntegerType()),
    T.StructField(AGE, T.IntegerType()),
    T.StructField(MEMBER_ID, T.StringType()),
])

USER_RAW = T.StructType([f for f in USER.fields if f.name != COMP_MEMBER_ID])

COMP_MID_MAP = T.StructType([
    T.StructField(MEMBER_ID, T.StringType()),
    T.StructField(COMP_MEMBER_ID, T.StringType()),
])

PRODUCT = T.StructType([
    T.StructField(PRODUCT_NO, T.IntegerType()),
    T.StructField(PRICE, T.IntegerType()),
    T.StructField(SALE_START_DATE, T.DateType()),
    T.StructField(SALE_END_DATE, T.DateType()),
    T.StructField(PRODUCT_NAME, T.StringType()),
    T.StructField(DEAL_CONSTRUCTION, T.StringType()),
])

CATEGORY_RAW = T.StructType([
    T.StructField(DEPTH0_NAME, T.StringType()),
    T.StructField(DEPTH1_NO, T.IntegerType()),
    T.StructField(DEPTH1_NAME, T.StringType()),
    T.StructField(DEPTH2_NO, T.IntegerType()),
    T.StructField(DEPTH2_NAME, T.StringType()),
    T.StructField(DEPTH0_DISPLAY_ORDER, T.IntegerType()),
    T.StructField(DEPTH1_DISPLAY_ORDER, T.IntegerType()),
    T.StructField(DEPTH2_DISPLAY_ORDER, T.IntegerType()),
])

CATEGORY = T.StructType([T.StructField(CATEGORY_NO, T.IntegerType())] + CATEGORY_RAW.fields)

DEAL_ITEM = T.StructType([
    T.StructField(DEAL_NO, T.IntegerType()),
    T.StructField(ITEM_NO, T.IntegerType()),
])

DEAL_ITEM_RAW = T.StructType([
    T.StructField(DEAL_NO, T.IntegerType()),
    T.StructField(PRODUCT_NO, T.IntegerType()),
])

PROD_CATEGORY = T.StructType([
    T.StructField(PRODUCT_NO, T.IntegerType()),
    T.StructField(CATEGORY_NO, T.IntegerType()),
])

VALID_PRODUCTS = T.StructType([T.StructField(VALID_PRODUCT_NO, T.IntegerType())])

BEHAVIOUR = T.StructType([
    T.StructField(COMP_MEMBER_ID, T.StringType()),
    T.StructField(TIMESTAMP, T.LongType()),
    T.StructField(PRODUCT_NO, T.IntegerType()),
    T.StructField(PRODUCT_NAME, T.StringType()),
])

# Metadata schemas by entity name, used instead of schema inference.
METADATA = {
    "user": USER,
    "comp_mid": COMP_MID_MAP,
    "product": PRODUCT,
    "category": CATEGORY,
    "deal_item": DEAL_ITEM,
    "prod_category": PROD_CATEGORY,
    "valid_products": VALID_PRODUCTS,
}

# The feature table (P1 output, P3 input) with its column types.
def _field(name: str) -> T.StructField:
    for schema in (USERACTION, USER, PRODUCT, CATEGORY):
        if name in schema.names:
            return schema[name]
    raise KeyError(name)


FEATURE = T.StructType([_field(c) for c in FEATURE_COLUMNS])
