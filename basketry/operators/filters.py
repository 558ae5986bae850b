"""Row filters and column transforms (F1-F14, U2, X*)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas as S
from ..functions.glob import matches_any_glob
from .blacklist import filter_blacklist_table
from ..functions.time import KST_OFFSET, date_range_bounds

# Action-type aliases accepted on the command line and their codes.
ACTION_ALIASES = {"order": "O", "o": "O", "click": "C", "c": "C", "all": "A", "a": "A"}

# Words never kept in cleaned deal-construction tags (regions,
# then shop names), in their original order; duplicates are harmless in a set.
REGION_NAMES = (
    "마포,홍대,신촌,강남,논현,청담,역삼,노원,삼성,서초,중구,상계,목동,명동,일산,장항동,고양,광명,철산,"
    "구리,김포,남양주,부천,중동,상동,중동,평촌,안양,오산,용인,처인구,동백,의정부,화성,수원,영통,신림역,"
    "신도림역,영등포역,강남역,양재역,교대,남부터미널,인천,부평,구월동,경남,창원,마산,대전,둔산동,대구,"
    "동천동,부산,사하구,대연동,동아대,잠실,성수,왕십리,건대입구,서울,경기,인천,경남,대구,부산,노원구,"
    "동대문구,이태원,시흥시,성동구,화성시,강동,장안구,강북구,서대문구,강서,충주,종로,판교,강서구,경기도,"
    "구리시,포천시,송파구,마포구,은평구,충북,금 천구,중랑구,충남,청주,분당,세종,광진구,하남시,고양시,이대,"
    "평택,순천,광주"
)
GARBAGE_WORDS = "AK플라자,AK백화점,AKMALL,AKPLAZA,AK몰,lch91,bigdeal"
FILTER_WORDS = tuple(REGION_NAMES.split(",")) + tuple(GARBAGE_WORDS.split(","))


def action_type_code(raw: str) -> str:
    """'order'/'o' -> 'O', 'click'/'c' -> 'C', 'all'/'a' -> 'A' (case-insensitive) (F2)."""
    code = ACTION_ALIASES.get(raw.lower())
    if code is None:
        raise ValueError(f"unknown action type {raw!r}; use order, click or all")
    return code


def filter_null_member_id(df: DataFrame, column: str = S.MEMBER_ID) -> DataFrame:
    """drop rows without a member id."""
    return df.where(F.col(column).isNotNull())


def filter_by_action_type(df: DataFrame, action: str, column: str = S.ACTION_TYPE) -> DataFrame:
    """keep one action type; 'A' keeps everything. Accepts aliases like 'click'."""
    code = action_type_code(action)
    return df if code == "A" else df.where(F.col(column) == F.lit(code))


def filter_by_timestamp(df: DataFrame, start: int, end: int, column: str = S.TIMESTAMP) -> DataFrame:
    """keep ``start <= ts <= end`` (both ends inclusive)."""
    return df.where(F.col(column).between(start, end))


def filter_by_dates(df: DataFrame, start_date: str, end_date: str, offset: int = KST_OFFSET,
                    column: str = S.TIMESTAMP) -> DataFrame:
    """F3 from ISO dates: local days ``start_date``..``end_date`` at UTC+offset."""
    lo, hi = date_range_bounds(start_date, end_date, offset)
    return filter_by_timestamp(df, lo, hi, column)


def upper_member_id(df: DataFrame, column: str = S.MEMBER_ID) -> DataFrame:
    """F4."""
    return df.withColumn(column, F.upper(F.col(column)))


def select_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """project to a fixed column list, in that order."""
    return df.select(*columns)


def filter_blacklist(df: DataFrame, patterns: list[str] | DataFrame, column: str = S.PRODUCT_NAME,
                     drop_column: bool = True) -> DataFrame:
    """drop rows whose ``column`` matches any shell-glob pattern, then drop ``column``.

    Null names never match. Patterns are stripped like lines of a pattern file.
    A list becomes one regex; a table (its first column) is indexed and joined.
    """
    if isinstance(patterns, DataFrame):
        kept = filter_blacklist_table(df, patterns, column)
        return kept.drop(column) if drop_column else kept
    pats = [p.strip() for p in patterns]
    kept = df.where(~matches_any_glob(column, pats))
    return kept.drop(column) if drop_column else kept


def filter_by_prod_threshold(df: DataFrame, threshold: int, column: str = S.PRODUCT_NO) -> DataFrame:
    """keep rows whose ``column`` value occurs strictly more than ``threshold`` times.

    Counted with a partial (map-side) aggregation, so a hot product is
    pre-aggregated before the shuffle; the qualifying keys (one row per key)
    are applied with a semi join that Spark broadcasts when its estimated size
    is under the broadcast threshold, and otherwise sort-merges with AQE skew
    splitting of the large side.
    """
    qualifying = (df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
                  .where(F.col("_n") > threshold).select(column))
    return df.join(qualifying, on=[column], how="left_semi")


def products_above_threshold(log: DataFrame, user: DataFrame, products: DataFrame, threshold: int,
                             user_key: str = S.MEMBER_ID, column: str = S.PRODUCT_NO) -> DataFrame:
    """F7 counted before the fan-out: the products whose joined rows would number more than ``threshold``.

    A log row joins every user row of its ``user_key`` and every dimension row of
    its product, so a product's joined rows are its log rows, weighted by the
    number of their users, times its dimension rows. Only the two key columns
    of the log are read, and each side is a partial aggregate; null keys join nothing.
    """
    per_user = user.groupBy(user_key).agg(F.count(F.lit(1)).alias("_u"))
    per_product = products.groupBy(column).agg(F.count(F.lit(1)).alias("_p"))
    # equal (user, product) rows are merged before the join, the rest after it
    pairs = log.groupBy(user_key, column).agg(F.count(F.lit(1)).alias("_l")).join(per_user, user_key)
    logged = pairs.groupBy(column).agg(F.sum(F.col("_l") * F.col("_u")).alias("_n"))
    return logged.join(per_product, column).where(F.col("_n") * F.col("_p") > threshold).select(column)


def ids_with_min_count(df: DataFrame, column: str, cut: int) -> DataFrame:
    """F8: the distinct values of ``column`` occurring at least ``cut`` times (one column)."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") >= cut).select(column))


def keep_keys_in(df: DataFrame, keys: DataFrame, column: str, key_column: str | None = None) -> DataFrame:
    """Keep rows whose ``column`` occurs in ``keys[key_column]`` (nulls never match)."""
    key_column = key_column or column
    k = keys.select(F.col(key_column).alias(column)).where(F.col(column).isNotNull())
    return df.join(k, on=[column], how="left_semi")


def leaf_category(df: DataFrame) -> DataFrame:
    """nullable depth-2 id; leaf id = depth-2 id if present else depth-1 id."""
    return (df.withColumn(S.DEPTH2_NO, F.col(S.DEPTH2_NO).cast("int"))
            .withColumn(S.CATEGORY_NO, F.coalesce(F.col(S.DEPTH2_NO), F.col(S.DEPTH1_NO)).cast("int")))


def clean_tags(df: DataFrame, search_words: DataFrame, filter_words: Iterable[str] = FILTER_WORDS,
               key: str = S.PRODUCT_NO, column: str = S.DEAL_CONSTRUCTION, word_column: str | None = None,
               sep: str = ",") -> DataFrame:
    """replace a comma-separated tag list by (tags & search words) - filter words.

    Null stays null; a list without survivors becomes ''. Survivors are joined
    in sorted order. The search-word list can be as large as the log's distinct
    keywords, so it is applied as a semi join on exploded tags (broadcast or
    skew-split by Spark) instead of a literal list; the fixed filter-word list
    is a literal ``isin``.
    """
    word_column = word_column or search_words.columns[0]
    words = search_words.select(F.col(word_column).alias("_tag")).where(F.col("_tag").isNotNull()).distinct()
    stop = list(dict.fromkeys(filter_words))
    # rows are cleaned one by one: equal (key, tag list) rows have equal results, so these two identify a result
    tags = (df.select(key, column, F.explode(F.split(F.col(column), sep, -1)).alias("_tag")).distinct()
            .join(words, on="_tag", how="left_semi"))
    if stop:
        tags = tags.where(~F.col("_tag").isin(stop))
    kept = tags.groupBy(F.col(key).alias("_key"), F.col(column).alias("_list")) \
        .agg(F.array_join(F.array_sort(F.collect_set("_tag")), sep).alias("_kept"))
    out = df.join(kept, df[key].eqNullSafe(F.col("_key")) & (df[column] == F.col("_list")), how="left").drop("_key", "_list")
    cleaned = F.when(F.col(column).isNull(), F.lit(None).cast("string")).otherwise(F.coalesce(F.col("_kept"), F.lit("")))
    return out.withColumn(column, cleaned).drop("_kept").select(*df.columns)


def tag_set_ops(a: str | Column, b: str | Column) -> dict[str, Column]:
    """Intersection / difference / union of two tag arrays."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return {"intersect": F.array_intersect(ca, cb), "except": F.array_except(ca, cb), "union": F.array_union(ca, cb)}
