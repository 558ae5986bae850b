"""Item categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions.arrays import multi_hot, row_normalise
from .indexing import dense_index


def item_categories(items: DataFrame, prod_category: DataFrame, item: str = S.PRODUCT_NO,
                    item_idx: str = S.PROD_IDX) -> tuple[DataFrame, DataFrame]:
    """A4: per indexed item the sorted category indices (empty when it has none).

    Categories are indexed 0..m-1 over the sorted distinct categories of the
    given items only. Returns ``(item_categories, category_index)`` where
    ``item_categories`` is ``(item_idx, categories array<int>)``.
    """
    links = prod_category.select(item, S.CATEGORY_NO).join(items.select(item, item_idx), on=item, how="inner")
    cat_index = dense_index(links, S.CATEGORY_NO, S.CATEGORY_IDX)
    per_item = (links.join(cat_index, on=S.CATEGORY_NO, how="inner")
                .groupBy(item_idx).agg(F.array_sort(F.collect_set(S.CATEGORY_IDX)).alias("categories")))
    out = items.select(item_idx).join(per_item, on=item_idx, how="left") \
        .withColumn("categories", F.coalesce(F.col("categories"), F.array().cast("array<int>")))
    return out, cat_index


def dense_categories(item_cats: DataFrame, n_categories: int, normalise: bool = False) -> DataFrame:
    """A4 dense multi-hot form (``n_categories`` wide); A5 row-normalised when asked."""
    hot = multi_hot("categories", n_categories)
    return item_cats.withColumn("category_vector", row_normalise(hot) if normalise else hot)


def with_category_features(vectors: DataFrame, item_cats: DataFrame, n_categories: int,
                           item_idx: str = S.PROD_IDX) -> DataFrame:
    """Item vector concatenated with its (dense) category vector."""
    dense = dense_categories(item_cats, n_categories).select(item_idx, "category_vector")
    return vectors.join(dense, on=item_idx, how="inner").withColumn(
        "vector", F.concat(F.col("vector"), F.transform("category_vector", lambda x: x.cast("double")))
    ).drop("category_vector")
