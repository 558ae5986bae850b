"""Equi-joins with dimension and index tables.

No broadcast hints are placed on tables whose size grows with the data:
Spark broadcasts a side only when its estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` (the size check), AQE re-plans at
run time from real shuffle sizes, and skewed keys of a sort-merge join are
split by AQE's skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S


def join_using(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """``left JOIN right USING (on)``."""
    return left.join(right, on=[on] if isinstance(on, str) else list(on), how=how)


def product_dimension(product: DataFrame, prod_category: DataFrame, category: DataFrame) -> DataFrame:
    """product ⋈ prod_category ⋈ category (a product appears once per category)."""
    return join_using(join_using(product, prod_category, S.PRODUCT_NO), category, S.CATEGORY_NO)


def join_mapping(users: DataFrame, mapping: DataFrame, on: str = S.MEMBER_ID) -> DataFrame:
    """Attach the existing member-id mapping; users absent from it are dropped."""
    return join_using(users, mapping, on)


def to_index(df: DataFrame, user_index: DataFrame, item_index: DataFrame,
             user: str = S.COMP_MEMBER_ID, item: str = S.PRODUCT_NO,
             user_idx: str = S.USER_IDX, item_idx: str = S.PROD_IDX, drop_ids: bool = True) -> DataFrame:
    """Replace user and item ids by dense indices; rows with an unknown id are dropped."""
    out = df.join(user_index, on=user, how="inner").join(item_index, on=item, how="inner")
    return out.drop(user, item) if drop_ids else out
