"""P5: metadata preparation (user, product, category, deal_item, prod_category)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..operators import filters as flt
from ..operators.indexing import member_codes

ENTITIES = ("user", "product", "category", "deal_item", "prod_category")


def prepare_user(users: DataFrame, seed: int = 0, mapping: DataFrame | None = None,
                 extend: bool = False) -> DataFrame:
    """Attach compressed member codes (reuse ``mapping`` when given)."""
    return member_codes(users, seed, mapping, extend)


def prepare_product(product: DataFrame, valid_products: DataFrame, search_words: DataFrame,
                    filter_words: Iterable[str] = flt.FILTER_WORDS) -> DataFrame:
    """F5 -> F9 (valid products) -> F13 (clean tags)."""
    df = product.transform(flt.select_columns, S.PRODUCT_COLUMNS)
    df = flt.keep_keys_in(df, valid_products, S.PRODUCT_NO, S.VALID_PRODUCT_NO)
    return flt.clean_tags(df, search_words, filter_words)


def prepare_category(category: DataFrame) -> DataFrame:
    """F11 + F12: nullable depth-2 id and the leaf category id."""
    return flt.leaf_category(category)


def prepare_deal_item(deal_item: DataFrame, product: DataFrame) -> DataFrame:
    """F10 + F9: ``prod_no`` becomes ``item_no``; deal and item must both be products."""
    df = deal_item.withColumnRenamed(S.PRODUCT_NO, S.ITEM_NO)
    df = flt.keep_keys_in(df, product, S.ITEM_NO, S.PRODUCT_NO)
    return flt.keep_keys_in(df, product, S.DEAL_NO, S.PRODUCT_NO)


def prepare_prod_category(prod_category: DataFrame, product: DataFrame) -> DataFrame:
    """F11 + F9: integer product number, products of the prepared product table only."""
    df = prod_category.withColumn(S.PRODUCT_NO, F.col(S.PRODUCT_NO).cast("int"))
    return flt.keep_keys_in(df, product, S.PRODUCT_NO)


def prepare_metadata(which: Iterable[str] = (), *, users: DataFrame | None = None,
                     mapping: DataFrame | None = None, product: DataFrame | None = None,
                     valid_products: DataFrame | None = None, search_words: DataFrame | None = None,
                     category: DataFrame | None = None, deal_item: DataFrame | None = None,
                     prod_category: DataFrame | None = None, prepared_product: DataFrame | None = None,
                     seed: int = 0, filter_words: Iterable[str] = flt.FILTER_WORDS, extend: bool = False) -> dict[str, DataFrame]:
    """The selected entities (all when none named), each as a prepared DataFrame.

    deal_item and prod_category need the prepared product table: the one made
    in this call, else ``prepared_product`` (e.g. read back from its sink).
    """
    chosen = tuple(w.lower() for w in which) or ENTITIES
    unknown = set(chosen) - set(ENTITIES)
    if unknown:
        raise ValueError(f"unknown entities: {sorted(unknown)}")
    out: dict[str, DataFrame] = {}
    if "user" in chosen:
        out["user"] = prepare_user(users, seed, mapping, extend)
    if "product" in chosen:
        out["product"] = prepare_product(product, valid_products, search_words, filter_words)
    if "category" in chosen:
        out["category"] = prepare_category(category)
    base = out.get("product", prepared_product)
    if ("deal_item" in chosen or "prod_category" in chosen) and base is None:
        raise ValueError("deal_item / prod_category need the prepared product table")
    if "deal_item" in chosen:
        out["deal_item"] = prepare_deal_item(deal_item, base)
    if "prod_category" in chosen:
        out["prod_category"] = prepare_prod_category(prod_category, base)
    return out
