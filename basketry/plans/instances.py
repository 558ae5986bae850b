"""P4 instance building: indexed users/items, order histories, yesterday's clicks, splits."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions.time import DAY_SPLIT_OFFSET, KST_OFFSET, LATE_HOUR
from ..operators import filters as flt
from ..operators.categories import item_categories
from ..operators.indexing import dense_index
from ..operators.joins import to_index
from ..session import stored
from ..operators.sequences import (attach_yesterday_clicks, daily_last_clicks,
                                   order_instances)

# Default instance parameters.
DEFAULT_ITEM_CUT, DEFAULT_MIN_ORDERS, DEFAULT_MAX_ORDERS, DEFAULT_MAX_CLICKS = 1, 4, 8, 16


@dataclass
class InstanceTables:
    instances: DataFrame  # user_idx, timestamp, position, orders, clicks?, label, split
    users: DataFrame      # comp_mid, user_idx
    items: DataFrame      # prod_no, prod_idx


def build_instances(orders: DataFrame, clicks: DataFrame | None, blacklist: list[str] | DataFrame, ts_val: int, ts_test: int,
                    item_cut: int = DEFAULT_ITEM_CUT, min_orders: int = DEFAULT_MIN_ORDERS,
                    max_orders: int = DEFAULT_MAX_ORDERS, max_clicks: int = DEFAULT_MAX_CLICKS,
                    tiebreak: tuple[str, ...] = (), bounds_offset: int = KST_OFFSET,
                    split_offset: int = DAY_SPLIT_OFFSET, late_hour: int = LATE_HOUR,
                    partitions: int | None = None) -> InstanceTables:
    """S4 -> F6 -> F8 -> I1 -> J5 -> W3/W4/W8 (-> W5/J6 with clicks).

    ``orders``/``clicks`` are behaviour tables (comp_mid, timestamp, prod_no,
    prod_nm, optional tiebreak columns). Items need ``item_cut`` orders, users
    ``min_orders + 1`` orders, both counted on the orders left after the
    blacklist; clicks are converted with the same indices.
    """
    # counted twice and indexed once: whatever made the orders (joins, P3) runs once, and each reader takes its own columns
    kept = flt.filter_blacklist(orders, blacklist).select(*dict.fromkeys([S.COMP_MEMBER_ID, S.TIMESTAMP, S.PRODUCT_NO, *tiebreak]))
    kept = stored(kept, "kept-orders")
    items = dense_index(flt.ids_with_min_count(kept, S.PRODUCT_NO, item_cut), S.PRODUCT_NO, S.PROD_IDX)
    users = dense_index(flt.ids_with_min_count(kept, S.COMP_MEMBER_ID, min_orders + 1), S.COMP_MEMBER_ID, S.USER_IDX)
    indexed = to_index(kept, users, items)
    inst = order_instances(indexed, ts_val, ts_test, min_orders, max_orders, tiebreak=tiebreak,
                           partitions=partitions)
    if clicks is not None:
        cidx = to_index(flt.filter_blacklist(clicks, blacklist), users, items)
        daily = daily_last_clicks(cidx, max_clicks, tiebreak=tiebreak, bounds_offset=bounds_offset)
        inst = attach_yesterday_clicks(inst, daily, max_clicks, split_offset=split_offset, late_hour=late_hour)
    cols = [S.USER_IDX, S.TIMESTAMP, "position", "orders"] + (["clicks"] if clicks is not None else []) \
        + ["label", "split"]
    return InstanceTables(inst.select(*cols), users, items)


def item_table(items: DataFrame, titles: DataFrame | None = None, vectors: DataFrame | None = None,
               prod_category: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """K5 items: (prod_idx, prod_no, title?, vector?, categories?).

    Items without a vector keep a null vector unless ``strict`` (then the job
    fails on the first missing vector).
    """
    out = items
    if titles is not None:
        out = out.join(titles.select(S.PRODUCT_NO, F.col(S.PRODUCT_NAME).alias("title")), on=S.PRODUCT_NO, how="left")
    if vectors is not None:
        out = out.join(vectors.select(S.PRODUCT_NO, "vector"), on=S.PRODUCT_NO, how="left")
        if strict:
            out = out.withColumn("vector", F.when(F.col("vector").isNull(),
                                                  F.raise_error(F.concat(F.lit("no vector for item "),
                                                                         F.col(S.PRODUCT_NO).cast("string"))))
                                 .otherwise(F.col("vector")))
    if prod_category is not None:
        cats, _ = item_categories(items, prod_category)
        out = out.join(cats, on=S.PROD_IDX, how="left")
    return out


def instance_stats(tables: InstanceTables) -> DataFrame:
    """K6: instances per split, number of valid users and target items, as (name, value) rows."""
    per_split = tables.instances.groupBy("split").agg(F.count(F.lit(1)).alias("value"))
    parts = [
        per_split.select(F.concat(F.lit("instances "), F.col("split")).alias("name"), F.col("value").cast("long")),
        tables.users.agg(F.count(F.lit(1)).cast("long").alias("value")).select(F.lit("users").alias("name"), "value"),
        tables.items.agg(F.count(F.lit(1)).cast("long").alias("value")).select(F.lit("items").alias("name"), "value"),
    ]
    return reduce(DataFrame.unionByName, parts)

