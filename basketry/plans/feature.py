"""P1 feature generation and P2 sort job."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..operators import filters as flt
from ..operators.joins import join_using, product_dimension
from ..operators.ordering import sort_by


def generate_features(useraction: DataFrame, user: DataFrame, product: DataFrame, prod_category: DataFrame,
                      category: DataFrame, action: str, start_date: str, end_date: str,
                      prod_threshold: int) -> DataFrame:
    """Filtered log joined with user, product and category, sorted by time.

    F1 -> F2 -> F3 -> F4 -> F7 (product count > threshold) -> J1(user)
    -> J1(product ⋈ prod_category ⋈ category) -> F5 (19 columns) -> O1.

    F7 counts joined rows, but as products of the counts of both sides, so the
    log is cut to the qualifying products before it fans out over users and
    categories. Columns come out as ``prod_no`` then the other 18, like the
    original job's output.
    Filters sit on the log before any join so they reach the Parquet scan; the
    sort key extends the timestamp with the row's identity so equal
    timestamps still spread over range partitions and the order is total.
    """
    code = flt.action_type_code(action)
    products = product_dimension(product, prod_category, category)
    log = (useraction
           .transform(flt.filter_null_member_id)
           .transform(flt.filter_by_action_type, code)
           .transform(flt.filter_by_dates, start_date, end_date)
           .transform(flt.upper_member_id))
    if prod_threshold > 0:  # every joined product has one row at least
        log = flt.keep_keys_in(log, flt.products_above_threshold(log, user, products, prod_threshold), S.PRODUCT_NO)
    joined = join_using(join_using(log, user, S.MEMBER_ID), products, S.PRODUCT_NO)
    feature = joined.select(S.PRODUCT_NO, *[c for c in S.FEATURE_COLUMNS if c != S.PRODUCT_NO])
    return sort_by(feature, S.TIMESTAMP, [S.COMP_MEMBER_ID, S.PRODUCT_NO, S.CATEGORY_NO])


def sort_log(useraction: DataFrame, column: str) -> DataFrame:
    """The whole log sorted by one named column (rest of the row breaks ties)."""
    if column not in useraction.columns:
        raise ValueError(f"unknown column {column}")
    return sort_by(useraction, column, [c for c in useraction.columns if c != column])
