"""Behaviour-log inputs derived from the generic test tables (see FIXTURES.md).

Each function reads the Parquet tables under ``sf_dir`` and returns the input
a pipeline expects, so every query's work grows with the tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas as S
from ..functions.time import epoch_seconds

# Keywords given to sign-up events (by item number mod 8), the
# blacklist globs and filter words used by the test pipelines.
SIGNUP_KEYWORDS = ["red", "blue", "hot", "old", "small", "large", "widget", "PROMO"]
TEST_BLACKLIST = ["red *", "*g?zmo", "[!ho]l[a-z]* r*"]
TEST_FILTER_WORDS = ["old", "PROMO"]
# P1 test parameters and the split bounds of the large order log.
P1_ACTION, P1_START, P1_END, P1_THRESHOLD = "C", "2024-01-01", "2024-01-30", 3
ORDER_LOG_SPLITS = (852076800, 915148800)
EVENT_SPLITS = (1705104000, 1705968000)  # 2024-01-13 and 2024-01-23, 00:00 UTC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _item_number(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("int")


def useraction(spark: SparkSession, sf_dir: str, with_event_id: bool = True,
               with_file_size: bool = False) -> DataFrame:
    """The user-action log: purchases are orders 'O', clicks and views are clicks 'C'."""
    ev = table(spark, sf_dir, "events")
    if with_file_size:
        ev = ev.withColumn("file_size", F.col("_metadata.file_size"))
    k = _item_number()
    et = F.col("event_type")
    action = (F.when(et == "purchase", F.lit("O")).when(et.isin("click", "view"), F.lit("C"))
              .otherwise(F.lit("S")))
    keyword = (F.when(et == "signup", F.element_at(F.array(*[F.lit(w) for w in SIGNUP_KEYWORDS]), F.pmod(k, F.lit(8)) + 1))
               .when(et == "error", F.lit("")))
    member = F.when(F.pmod(F.col("user_id"), F.lit(50)) == 0, F.lit(None).cast("string")) \
        .otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string")))
    cols = [epoch_seconds("ts", ev.schema["ts"].dataType).alias(S.TIMESTAMP), action.alias(S.ACTION_TYPE),
            F.when(et.isin("purchase", "click", "view"), k).alias(S.PRODUCT_NO),
            keyword.alias(S.SEARCH_KEYWORD), member.alias(S.MEMBER_ID)]
    if with_event_id:
        cols.append(F.col("event_id"))
    if with_file_size:
        cols.append(F.col("file_size"))
    return ev.select(*cols)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer; the member id of each seventh is one that the log does not use."""
    c = table(spark, sf_dir, "customer")
    prefix = F.when(F.pmod(F.col("c_custkey"), F.lit(7)) == 3, F.lit("X")).otherwise(F.lit("U"))
    return c.select(F.lpad(F.col("c_custkey").cast("string"), 5, "0").alias(S.COMP_MEMBER_ID),
                    F.pmod(F.col("c_custkey"), F.lit(2)).cast("int").alias(S.SEX),
                    (F.lit(1950) + F.col("c_nationkey")).cast("int").alias(S.AGE),
                    F.concat(prefix, F.col("c_custkey").cast("string")).alias(S.MEMBER_ID))


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member table before codes are attached (every customer)."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.pmod(F.col("c_custkey"), F.lit(2)).cast("int").alias(S.SEX),
                    (F.lit(1950) + F.col("c_nationkey")).cast("int").alias(S.AGE),
                    F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias(S.MEMBER_ID))


def comp_mid_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users(spark, sf_dir).select(S.MEMBER_ID, S.COMP_MEMBER_ID)


def product_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    tags = F.when(F.pmod(F.col("p_partkey"), F.lit(11)) == 0, F.lit(None).cast("string")) \
        .otherwise(F.concat(F.regexp_replace(F.col("p_name"), " ", ","), F.lit(","), F.col("p_type")))
    return p.select(F.col("p_partkey").cast("int").alias(S.PRODUCT_NO),
                    F.floor(F.col("p_retailprice")).cast("int").alias(S.PRICE),
                    F.date_add(F.lit(_dt.date(2024, 1, 1)), F.col("p_size")).alias(S.SALE_START_DATE),
                    F.date_add(F.lit(_dt.date(2024, 6, 1)), F.col("p_size")).alias(S.SALE_END_DATE),
                    F.col("p_name").alias(S.PRODUCT_NAME), tags.alias(S.DEAL_CONSTRUCTION),
                    F.col("p_brand").alias("extra"))


def valid_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.where(F.pmod(F.col("p_size"), F.lit(5)) != 0).select(F.col("p_partkey").cast("int").alias(S.VALID_PRODUCT_NO))


def category_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category rows before the leaf id is derived; nation 0 has no depth-2 level."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    root = F.col("n_nationkey") == 0
    return j.select(F.lit("ROOT").alias(S.DEPTH0_NAME),
                    (F.lit(100) + F.col("r_regionkey")).cast("int").alias(S.DEPTH1_NO),
                    F.col("r_name").alias(S.DEPTH1_NAME),
                    F.when(root, F.lit(None).cast("int")).otherwise(F.col("n_nationkey")).cast("int").alias(S.DEPTH2_NO),
                    F.col("n_name").alias(S.DEPTH2_NAME), F.lit(1).alias(S.DEPTH0_DISPLAY_ORDER),
                    F.col("r_regionkey").cast("int").alias(S.DEPTH1_DISPLAY_ORDER),
                    F.col("n_nationkey").cast("int").alias(S.DEPTH2_DISPLAY_ORDER))


def category(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = category_raw(spark, sf_dir)
    leaf = F.coalesce(F.col(S.DEPTH2_NO), F.col(S.DEPTH1_NO)).alias(S.CATEGORY_NO)
    return raw.select(leaf, *raw.columns)


def prod_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct (product, category) pair of the line items."""
    li = table(spark, sf_dir, "lineitem")
    su = table(spark, sf_dir, "supplier")
    j = li.join(su, li["l_suppkey"] == su["s_suppkey"])
    cat = F.when(F.col("s_nationkey") == 0, F.lit(100)).otherwise(F.col("s_nationkey")).cast("int")
    return j.select(F.col("l_partkey").cast("int").alias(S.PRODUCT_NO), cat.alias(S.CATEGORY_NO)).distinct()


def deal_item_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select((F.col("l_suppkey") * 37).cast("int").alias(S.DEAL_NO),
                     F.col("l_partkey").cast("int").alias(S.PRODUCT_NO)).distinct()


def search_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct non-empty search keywords of the log (one column ``word``)."""
    ua = useraction(spark, sf_dir, with_event_id=False)
    return ua.where(F.col(S.SEARCH_KEYWORD).isNotNull() & (F.col(S.SEARCH_KEYWORD) != "")) \
        .select(F.col(S.SEARCH_KEYWORD).alias("word")).distinct()


def behaviours(spark: SparkSession, sf_dir: str, action: str) -> DataFrame:
    """Orders ('O') or clicks ('C') as (comp_mid, timestamp, prod_no, prod_nm, event_id)."""
    ua = useraction(spark, sf_dir).where((F.col(S.ACTION_TYPE) == action) & F.col(S.MEMBER_ID).isNotNull())
    u = users(spark, sf_dir).select(S.MEMBER_ID, S.COMP_MEMBER_ID)
    p = product_raw(spark, sf_dir).select(S.PRODUCT_NO, S.PRODUCT_NAME)
    j = ua.withColumn(S.MEMBER_ID, F.upper(F.col(S.MEMBER_ID))).join(u, S.MEMBER_ID).join(p, S.PRODUCT_NO)
    return j.select(S.COMP_MEMBER_ID, S.TIMESTAMP, S.PRODUCT_NO, S.PRODUCT_NAME, "event_id")


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The larger order log: one row per line item, user = customer, item = part."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    ts = epoch_seconds("o_orderdate", o.schema["o_orderdate"].dataType) \
        + F.pmod(F.col("o_orderkey") * 7919, F.lit(86400))
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(p, "l_partkey")
    return j.select(F.lpad(F.col("o_custkey").cast("string"), 5, "0").alias(S.COMP_MEMBER_ID),
                    ts.cast("long").alias(S.TIMESTAMP), F.col("l_partkey").cast("int").alias(S.PRODUCT_NO),
                    F.col("p_name").alias(S.PRODUCT_NAME))


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(prod_no, vector array<double>) from the embeddings table."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("int").alias(S.PRODUCT_NO),
                    F.transform("embedding", lambda x: x.cast("double")).alias("vector"))


def name_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A glob from every part: every 50th its name with a gap (these match), the others names or brands with their number."""
    p, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    name = F.concat(F.lit("*"), F.substring("p_name", 2, 3), F.lit("?"), F.expr("substring(p_name, 6)"))
    other = F.concat(F.lit("*"), F.substring("p_name", 1, 4), F.lit("*"), key.cast("string"))
    glob = F.when(key % 50 == 0, name).when(key % 3 == 1, other).otherwise(F.concat("p_brand", F.lit("[0-9]*"), key.cast("string"), F.lit("?")))
    return p.select(glob.alias("pattern"))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias(S.PRODUCT_NO),
                                               F.col("p_name").alias(S.PRODUCT_NAME))
