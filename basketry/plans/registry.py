"""Registered queries: one per operator family of the survey, on the test tables.

Every query takes ``(spark, sf_dir)``, reads the tables under ``sf_dir`` whole
and returns a DataFrame; :func:`oracle_sql` holds the DuckDB equivalents.
Array columns are rendered as comma-joined strings and doubles rounded so both
engines produce comparable values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas as S
from ..functions.arrays import drop_pads, join_ints, right_pad, valid_length
from ..functions.codes import CODE_ALPHABET, CODE_SPACE, affine_key
from ..functions.time import date_range_bounds
from ..operators import filters as flt
from ..operators import quality as Q
from ..operators.categories import dense_categories, item_categories, with_category_features
from ..operators.indexing import dense_index, member_codes
from ..operators.neighbours import fit_cells, nearest_by_cells, recall
from ..operators.ordering import shuffle_rows
from ..operators.scoring import top_k_scores
from ..operators.sequences import attach_yesterday_clicks, daily_last_clicks
from ..operators.text import tokenize
from ..operators.vectors import sequence_vectors
from ..session import materialize
from ..sources.readers import csv_lines, extract_orders, extract_search_words, parse_csv_lines, union_by_name
from . import fixtures as fx
from . import oracles as O
from .behaviour import aggregate_log
from .feature import generate_features, sort_log
from .instances import build_instances, instance_stats, item_table
from .metadata import (prepare_category, prepare_deal_item, prepare_prod_category,
                       prepare_product, prepare_user)
from .recommend import evaluate, prediction_report, recommend, similar_items, with_instance_id
from .titles import item_title_vectors, title_neighbours

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


# ---------------------------------------------------------------- P1 / P2


def _features(spark: SparkSession, d: str, action: str, start: str, end: str, threshold: int) -> DataFrame:
    return generate_features(fx.useraction(spark, d, with_event_id=False), fx.users(spark, d),
                             fx.product_raw(spark, d), fx.prod_category(spark, d), fx.category(spark, d),
                             action, start, end, threshold)


def _feature_oracle(action: str, start: str, end: str, threshold: int) -> str:
    lo, hi = date_range_bounds(start, end)
    return O.feature_sql(action, lo, hi, threshold)


@register("p1_feature_clicks", _feature_oracle("C", fx.P1_START, fx.P1_END, fx.P1_THRESHOLD))
def p1_feature_clicks(spark: SparkSession, d: str) -> DataFrame:
    """P1 flagship: clicks of January 2024, products seen more than 3 times."""
    return _features(spark, d, fx.P1_ACTION, fx.P1_START, fx.P1_END, fx.P1_THRESHOLD)


@register("p1_feature_orders", _feature_oracle("O", "2024-01-05", "2024-01-25", 1))
def p1_feature_orders(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, "order", "2024-01-05", "2024-01-25", 1)


@register("p1_feature_all", _feature_oracle("A", "2024-01-01", "2024-01-15", 5))
def p1_feature_all(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, "all", "2024-01-01", "2024-01-15", 5)


@register("p2_sort_log", O.sql("select timestamp, action_type, prod_no, search_keyword, m_id from useraction"))
def p2_sort_log(spark: SparkSession, d: str) -> DataFrame:
    return sort_log(fx.useraction(spark, d, with_event_id=False), S.TIMESTAMP)


# ---------------------------------------------------------------- P5 metadata, quality, F6/F8/I1/I2


CODE_SEED = 7

_PRODUCT_ORACLE_CTES = """
prod AS (select prod_no, sale_price, sale_start_dt, sale_end_dt, prod_nm, deal_construction from product_raw
         where prod_no in (select deal_prod_no from valid_prods)),
tags AS (select prod_no, unnest(string_split(deal_construction, ',')) as tag from prod),
kept AS (select prod_no, string_agg(distinct tag, ',' order by tag) as k from tags
         where tag in (select word from search_words) and tag not in ('old', 'PROMO') group by prod_no),
prepared_product AS (
  select p.prod_no, p.sale_price, p.sale_start_dt, p.sale_end_dt, p.prod_nm,
    case when p.deal_construction is null then null else coalesce(k.k, '') end as deal_construction
  from prod p left join kept k on p.prod_no = k.prod_no)"""


def _prepared_product(spark: SparkSession, d: str) -> DataFrame:
    return prepare_product(fx.product_raw(spark, d), fx.valid_products(spark, d), fx.search_words(spark, d),
                           fx.TEST_FILTER_WORDS)


@register("p5_product", O.sql("select * from prepared_product", _PRODUCT_ORACLE_CTES))
def p5_product(spark: SparkSession, d: str) -> DataFrame:
    """F5 -> F9 -> F13 on the product table."""
    return _prepared_product(spark, d)


@register("p5_category", O.sql("select * from category"))
def p5_category(spark: SparkSession, d: str) -> DataFrame:
    """F11 + F12: leaf category ids."""
    return prepare_category(fx.category_raw(spark, d))


@register("p5_deal_item", O.sql("""select deal_no, prod_no as item_no from deal_item_raw
  where prod_no in (select prod_no from prepared_product) and deal_no in (select prod_no from prepared_product)""",
                                 _PRODUCT_ORACLE_CTES))
def p5_deal_item(spark: SparkSession, d: str) -> DataFrame:
    return prepare_deal_item(fx.deal_item_raw(spark, d), _prepared_product(spark, d))


@register("p5_prod_category", O.sql("select * from prod_category where prod_no in (select prod_no from prepared_product)",
                                     _PRODUCT_ORACLE_CTES))
def p5_prod_category(spark: SparkSession, d: str) -> DataFrame:
    return prepare_prod_category(fx.prod_category(spark, d), _prepared_product(spark, d))


@register("p5_user_mapping", O.sql("select r.sex, r.age, r.m_id, u.comp_mid from raw_users r join users u on r.m_id = u.m_id"))
def p5_user_mapping(spark: SparkSession, d: str) -> DataFrame:
    """Reuse an existing member-code mapping; unmapped members are dropped."""
    return prepare_user(fx.raw_users(spark, d), mapping=fx.comp_mid_mapping(spark, d))


def _code_oracle() -> str:
    a, b = affine_key(CODE_SEED)
    digits = ", ".join(
        f"substr('{CODE_ALPHABET}', cast((n // {36 ** k}) % 36 as int) + 1, 1)" for k in range(4, -1, -1))
    return O.sql(f"select r.sex, r.age, r.m_id, concat({digits}) as comp_mid from raw_users r join coded c on r.m_id = c.m_id",
                 f"""ranked AS (select m_id, row_number() over (order by m_id) - 1 as idx from (select distinct m_id from raw_users)),
coded AS (select m_id, ({a} * idx + {b}) % {CODE_SPACE} as n from ranked)""")


@register("i2_member_codes", _code_oracle())
def i2_member_codes(spark: SparkSession, d: str) -> DataFrame:
    """New pseudo-random unique 5-character codes for every member."""
    return prepare_user(fx.raw_users(spark, d), seed=CODE_SEED)


_BLACKLIST_WHERE = " or ".join(f"prod_nm glob '{p}'" for p in fx.TEST_BLACKLIST)


def _orders_after_blacklist(spark: SparkSession, d: str) -> DataFrame:
    return flt.filter_blacklist(fx.behaviours(spark, d, "O"), fx.TEST_BLACKLIST)


@register("f6_blacklist", O.sql(f"""select comp_mid, timestamp, prod_no, event_id from behaviours
  where action_type = 'O' and not coalesce({_BLACKLIST_WHERE}, false)"""))
def f6_blacklist(spark: SparkSession, d: str) -> DataFrame:
    """orders whose product name matches none of the blacklist globs."""
    return _orders_after_blacklist(spark, d)


@register("f6_blacklist_order_log", O.sql(f"""select comp_mid, timestamp, prod_no from order_log
  where not coalesce({_BLACKLIST_WHERE}, false)"""))
def f6_blacklist_order_log(spark: SparkSession, d: str) -> DataFrame:
    return flt.filter_blacklist(fx.order_log(spark, d), fx.TEST_BLACKLIST)


@register("f6_blacklist_table", O.sql("""select comp_mid, timestamp, prod_no from order_log o where not exists (
  select 1 from hit where hit.prod_nm = o.prod_nm)""", """patterns AS (select distinct case when p_partkey % 50 = 0 then '*' || substr(p_name, 2, 3) || '?' || substr(p_name, 6)
    when p_partkey % 3 = 1 then '*' || substr(p_name, 1, 4) || '*' || p_partkey else p_brand || '[0-9]*' || p_partkey || '?' end as pattern from part),
hit AS (select prod_nm from (select distinct prod_nm from order_log) n where exists (select 1 from patterns where n.prod_nm glob pattern))"""))
def f6_blacklist_table(spark: SparkSession, d: str) -> DataFrame:
    """The order log without names that match any of a table of globs, one from every part."""
    return flt.filter_blacklist(fx.order_log(spark, d), fx.name_patterns(spark, d))


_F6_CTE = f"""kept_orders AS (select comp_mid, timestamp, prod_no from behaviours
  where action_type = 'O' and not coalesce({_BLACKLIST_WHERE}, false))"""


@register("f8_items", O.sql("select prod_no from kept_orders group by prod_no having count(*) >= 2", _F6_CTE))
def f8_items(spark: SparkSession, d: str) -> DataFrame:
    """F8: items ordered at least ``item_cut`` (2) times."""
    return flt.ids_with_min_count(_orders_after_blacklist(spark, d), S.PRODUCT_NO, 2)


@register("f8_users", O.sql("select comp_mid from kept_orders group by comp_mid having count(*) >= 5", _F6_CTE))
def f8_users(spark: SparkSession, d: str) -> DataFrame:
    """F8: users with at least ``min_orders + 1`` (5) orders."""
    return flt.ids_with_min_count(_orders_after_blacklist(spark, d), S.COMP_MEMBER_ID, 5)


@register("a2_value_counts", O.sql("select prod_no, count(*) as n from order_log group by prod_no"))
def a2_value_counts(spark: SparkSession, d: str) -> DataFrame:
    """A1/A2: occurrences per item in the order log."""
    return fx.order_log(spark, d).groupBy(S.PRODUCT_NO).agg(F.count(F.lit(1)).alias("n"))


@register("i1_user_index", O.sql("""select comp_mid, cast(row_number() over (order by comp_mid) - 1 as int) as user_idx
  from (select distinct comp_mid from order_log)"""))
def i1_user_index(spark: SparkSession, d: str) -> DataFrame:
    """A3 + I1: dense 0..n-1 index of the sorted distinct users of the order log."""
    return dense_index(fx.order_log(spark, d), S.COMP_MEMBER_ID, S.USER_IDX)


@register("i1_item_index", O.sql("""select prod_no, cast(row_number() over (order by prod_no) - 1 as int) as prod_idx
  from (select distinct prod_no from order_log)"""))
def i1_item_index(spark: SparkSession, d: str) -> DataFrame:
    return dense_index(fx.order_log(spark, d), S.PRODUCT_NO, S.PROD_IDX)


def _quality_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    product = _prepared_product(spark, d)
    return {"user": fx.users(spark, d), "product": product, "category": prepare_category(fx.category_raw(spark, d)),
            "deal_item": fx.deal_item_raw(spark, d).withColumnRenamed(S.PRODUCT_NO, S.ITEM_NO),
            "prod_category": fx.prod_category(spark, d)}


def _quality_oracle() -> str:
    src = {"user": "users", "product": "prepared_product", "category": "category",
           "deal_item": "(select deal_no, prod_no as item_no from deal_item_raw)", "prod_category": "prod_category"}
    parts = []
    for t, key in Q.PRIMARY_KEYS.items():
        parts.append(f"""select '{t}' as "table", '{key}' as "column", 'duplicate_key' as rule,
          cast(coalesce(sum(n), 0) as bigint) as violations
          from (select {key}, count(*) as n from {src[t]} group by {key}) where {key} is not null and n > 1""")
        parts.append(f"""select '{t}', '{key}', 'null_key', cast(count(*) filter (where {key} is null) as bigint) from {src[t]}""")
        for c in Q.NOT_NULL.get(t, []):
            parts.append(f"select '{t}', '{c}', 'not_null', cast(count(*) filter (where {c} is null) as bigint) from {src[t]}")
    for t in Q.RANGES.keys() | Q.MAX_LENGTHS.keys():
        for c, (lo, hi) in Q.RANGES.get(t, []):
            parts.append(f"""select '{t}', '{c}', 'range {lo}..{hi}',
              cast(count(*) filter (where {c} is not null and not ({c} between {lo} and {hi})) as bigint) from {src[t]}""")
        for c, n in Q.MAX_LENGTHS.get(t, []):
            parts.append(f"""select '{t}', '{c}', 'length <= {n}',
              cast(count(*) filter (where length({c}) > {n}) as bigint) from {src[t]}""")
    for child, col, parent, pcol in Q.FOREIGN_KEYS:
        parts.append(f"""select '{child}', '{col}', 'references {parent}.{pcol}', cast(count(*) as bigint)
          from {src[child]} x where x.{col} is not null and x.{col} not in (select {pcol} from {src[parent]} where {pcol} is not null)""")
    return O.sql("\nunion all\n".join(parts), _PRODUCT_ORACLE_CTES)


@register("q_constraints", _quality_oracle())
def q_constraints(spark: SparkSession, d: str) -> DataFrame:
    """Q1-Q3: key, not-null, foreign-key, range and length violations per table and rule."""
    return Q.all_violations(_quality_tables(spark, d))


# ---------------------------------------------------------------- P3 / P4 sequences


def _pad_sql(expr: str, width: int) -> str:
    return f"array_to_string(list_concat(list_transform(range({width} - len({expr})), lambda x: -1), {expr}), ',')"


def _yday_sql(ts: str) -> str:
    return (f"floor(({ts} + 18000) / 86400.0) - case when floor((({ts} + 18000) % 86400) / 3600.0) = 4 "
            f"then 2 else 1 end")


_SPLIT_SQL = "case when timestamp < {v} then 'training' when timestamp < {t} then 'validation' else 'test' end"


@register("p3_behaviour_order_log", O.sql("""select comp_mid, timestamp, prod_no, prod_nm from w2
  where prev is null or prev <> prod_no""", """w1 AS (select * from (select *, row_number() over
    (partition by comp_mid, timestamp order by prod_no, prod_nm nulls first) as r from order_log) where r = 1),
w2 AS (select *, lag(prod_no) over (partition by comp_mid order by timestamp) as prev from w1)"""))
def p3_behaviour_order_log(spark: SparkSession, d: str) -> DataFrame:
    """W1 + W2 + sort on the order log (many same-time rows per order)."""
    return aggregate_log(fx.order_log(spark, d))


_FEATURE_REST = [c for c in S.FEATURE_COLUMNS if c not in (S.COMP_MEMBER_ID, S.TIMESTAMP, S.PRODUCT_NO)]


def _p3_features_oracle() -> str:
    lo, hi = date_range_bounds("2024-01-01", "2024-01-30")
    feat = O.FEATURE_SELECT.format(action="", lo=lo, hi=hi)
    order = ", ".join(f"{c} nulls first" for c in [S.PRODUCT_NO, *_FEATURE_REST])
    return O.sql("select * exclude (r, prev) from w2 where prev is null or prev <> prod_no", f"""
feat AS ({feat}),
w1 AS (select * from (select *, row_number() over (partition by comp_mid, timestamp order by {order}) as r
  from feat) where r = 1),
w2 AS (select *, lag(prod_no) over (partition by comp_mid order by timestamp) as prev from w1)""")


@register("p3_behaviour_features", _p3_features_oracle())
def p3_behaviour_features(spark: SparkSession, d: str) -> DataFrame:
    """P3 on the P1 output (all actions, no threshold): category fan-out makes same-time rows."""
    feats = _features(spark, d, "all", "2024-01-01", "2024-01-30", 0)
    return aggregate_log(feats)


def _order_log_instances(spark: SparkSession, d: str):
    log = aggregate_log(fx.order_log(spark, d), sort=False)
    return build_instances(log, None, fx.TEST_BLACKLIST, *fx.ORDER_LOG_SPLITS)


def _w3_oracle() -> str:
    v, t = fx.ORDER_LOG_SPLITS
    return O.sql(f"""select cast(user_idx as int) as user_idx, timestamp, cast(pos as bigint) as position,
        {_pad_sql('coalesce(hist, [])', 8)} as orders, cast(prod_idx as int) as label, {_SPLIT_SQL.format(v=v, t=t)} as split
      from seq where pos >= 4""", f"""
w1 AS (select * from (select *, row_number() over
    (partition by comp_mid, timestamp order by prod_no, prod_nm nulls first) as r from order_log) where r = 1),
w2 AS (select * from (select *, lag(prod_no) over (partition by comp_mid order by timestamp) as prev from w1)
  where prev is null or prev <> prod_no),
kept AS (select * from w2 where not coalesce({_BLACKLIST_WHERE}, false)),
items AS (select prod_no, row_number() over (order by prod_no) - 1 as prod_idx
  from (select prod_no from kept group by prod_no having count(*) >= 1)),
usrs AS (select comp_mid, row_number() over (order by comp_mid) - 1 as user_idx
  from (select comp_mid from kept group by comp_mid having count(*) >= 5)),
oidx AS (select u.user_idx, i.prod_idx, k.timestamp from kept k join usrs u on k.comp_mid = u.comp_mid
  join items i on k.prod_no = i.prod_no),
seq AS (select *, row_number() over (partition by user_idx order by timestamp) - 1 as pos,
  list(prod_idx) over (partition by user_idx order by timestamp rows between 8 preceding and 1 preceding) as hist
  from oidx)""")


@register("w3_order_instances", _w3_oracle())
def w3_order_instances(spark: SparkSession, d: str) -> DataFrame:
    """W3/W4/W8 on the aggregated order log: position >= 4, 8 previous orders, 3 splits."""
    inst = _order_log_instances(spark, d).instances
    return inst.withColumn("orders", join_ints("orders"))


_EVENT_INSTANCE_CTES = f"""
kept_o AS (select comp_mid, timestamp, prod_no, event_id from behaviours
  where action_type = 'O' and not coalesce({_BLACKLIST_WHERE}, false)),
kept_c AS (select comp_mid, timestamp, prod_no, event_id from behaviours
  where action_type = 'C' and not coalesce({_BLACKLIST_WHERE}, false)),
items AS (select prod_no, cast(row_number() over (order by prod_no) - 1 as int) as prod_idx
  from (select prod_no from kept_o group by prod_no having count(*) >= 1)),
usrs AS (select comp_mid, cast(row_number() over (order by comp_mid) - 1 as int) as user_idx
  from (select comp_mid from kept_o group by comp_mid having count(*) >= 5)),
oidx AS (select u.user_idx, i.prod_idx, k.timestamp, k.event_id from kept_o k
  join usrs u on k.comp_mid = u.comp_mid join items i on k.prod_no = i.prod_no),
cidx AS (select u.user_idx, i.prod_idx, k.timestamp, k.event_id from kept_c k
  join usrs u on k.comp_mid = u.comp_mid join items i on k.prod_no = i.prod_no),
seq AS (select *, row_number() over (partition by user_idx order by timestamp, event_id) - 1 as pos,
  list(prod_idx) over (partition by user_idx order by timestamp, event_id rows between 8 preceding and 1 preceding) as hist
  from oidx),
inst AS (select user_idx, timestamp, pos, coalesce(hist, []) as hist, prod_idx as label,
  {_SPLIT_SQL.format(v=fx.EVENT_SPLITS[0], t=fx.EVENT_SPLITS[1])} as split from seq where pos >= 4),
ctop AS (select user_idx, prod_idx, floor((timestamp + 32400) / 86400.0) as d,
  row_number() over (partition by user_idx, floor((timestamp + 32400) / 86400.0) order by timestamp desc, event_id) as r
  from cidx),
carr AS (select user_idx, d, list(prod_idx order by r desc) as cl from ctop where r <= 16 group by user_idx, d),
full_inst AS (select i.user_idx, i.timestamp, cast(i.pos as bigint) as position, {_pad_sql('i.hist', 8)} as orders,
  {_pad_sql('coalesce(c.cl, [])', 16)} as clicks, i.label, i.split
  from inst i left join carr c on i.user_idx = c.user_idx and {_yday_sql('i.timestamp')} = c.d)"""


def _event_instances(spark: SparkSession, d: str):
    return build_instances(fx.behaviours(spark, d, "O"), fx.behaviours(spark, d, "C"), fx.TEST_BLACKLIST,
                           *fx.EVENT_SPLITS, tiebreak=("event_id",))


@register("p4_instances", O.sql("select * from full_inst", _EVENT_INSTANCE_CTES))
def p4_instances(spark: SparkSession, d: str) -> DataFrame:
    """Instances with order history and yesterday's last 16 clicks, split by time."""
    inst = _event_instances(spark, d).instances
    return inst.withColumn("orders", join_ints("orders")).withColumn("clicks", join_ints("clicks"))


@register("k6_instance_stats", O.sql("""select 'instances ' || split as name, cast(count(*) as bigint) as value
    from full_inst group by split
  union all select 'users', cast(count(*) as bigint) from usrs
  union all select 'items', cast(count(*) as bigint) from items""", _EVENT_INSTANCE_CTES))
def k6_instance_stats(spark: SparkSession, d: str) -> DataFrame:
    """K6: instance counts per split, valid users, target items."""
    return instance_stats(_event_instances(spark, d))


@register("j6_yesterday_clicks", O.sql(f"""select o.comp_mid, o.timestamp, o.prod_no, o.event_id,
    {_pad_sql('coalesce(c.cl, [])', 2)} as clicks
  from (select * from behaviours where action_type = 'O') o left join carr c
    on o.comp_mid = c.comp_mid and {_yday_sql('o.timestamp')} = c.d""", """
ctop AS (select comp_mid, prod_no, floor((timestamp + 32400) / 86400.0) as d,
  row_number() over (partition by comp_mid, floor((timestamp + 32400) / 86400.0) order by timestamp desc, event_id) as r
  from behaviours where action_type = 'C'),
carr AS (select comp_mid, d, list(prod_no order by r desc) as cl from ctop where r <= 2 group by comp_mid, d)"""))
def j6_yesterday_clicks(spark: SparkSession, d: str) -> DataFrame:
    """W5 + J6 on raw ids: every purchase with the last 2 clicks of its "yesterday"."""
    orders = fx.behaviours(spark, d, "O").drop(S.PRODUCT_NAME)
    clicks = fx.behaviours(spark, d, "C")
    daily = daily_last_clicks(clicks, 2, user=S.COMP_MEMBER_ID, item=S.PRODUCT_NO, tiebreak=["event_id"])
    out = attach_yesterday_clicks(orders, daily, 2, user=S.COMP_MEMBER_ID)
    return out.withColumn("clicks", join_ints("clicks"))


@register("a4_item_categories", O.sql("""select i.prod_idx, coalesce(array_to_string(c.cats, ','), '') as categories
  from items i left join (select l.prod_idx, list(distinct ci.cidx order by ci.cidx) as cats from links l
    join cindex ci on l.gnb_category_id = ci.gnb_category_id group by l.prod_idx) c on i.prod_idx = c.prod_idx""",
                                       _EVENT_INSTANCE_CTES + """,
links AS (select i.prod_idx, pc.gnb_category_id from prod_category pc join items i on pc.prod_no = i.prod_no),
cindex AS (select gnb_category_id, row_number() over (order by gnb_category_id) - 1 as cidx
  from (select distinct gnb_category_id from links))"""))
def a4_item_categories(spark: SparkSession, d: str) -> DataFrame:
    """A4: sorted category indices per target item (categories of used items only)."""
    items = _event_instances(spark, d).items
    cats, _ = item_categories(items, fx.prod_category(spark, d))
    return cats.withColumn("categories", join_ints("categories"))


@register("k5_items", O.sql("""select i.prod_no, i.prod_idx, p.prod_nm as title,
    array_to_string(list_transform(v.vector, lambda x: printf('%.6f', x)), ',') as vector
  from items i left join product_raw p on i.prod_no = p.prod_no left join item_vectors v on i.prod_no = v.prod_no""",
                             _EVENT_INSTANCE_CTES))
def k5_items(spark: SparkSession, d: str) -> DataFrame:
    """K5: the item table (index, id, title, vector) of the target items."""
    t = _event_instances(spark, d)
    items = item_table(t.items, fx.titles(spark, d), fx.item_vectors(spark, d))
    return items.withColumn("vector", F.array_join(F.transform("vector", lambda x: F.format_string("%.6f", x)), ","))


# ---------------------------------------------------------------- P7 recommend + evaluate, T4


RANK_DECIMALS = 6
TOP_K = 10


def _rounded(col: str):
    """Scores as compared across engines: 6 decimals, and no negative zero."""
    return F.round(col, RANK_DECIMALS) + F.lit(0.0)


def _event_item_vectors(spark: SparkSession, d: str, t) -> DataFrame:
    return t.items.join(fx.item_vectors(spark, d), on=S.PRODUCT_NO).select(S.PROD_IDX, "vector")


def _saved_instances(t) -> DataFrame:
    """The instance table as a recommender reads it back (materialised once)."""
    return materialize(with_instance_id(t.instances))


def _topk_query(mode: str) -> Query:
    def q(spark: SparkSession, d: str) -> DataFrame:
        t = _event_instances(spark, d)
        rec = recommend(_saved_instances(t), _event_item_vectors(spark, d, t), mode, TOP_K, RANK_DECIMALS,
                        with_lse=False)
        return rec.scores.top.withColumn("score", _rounded("score"))
    q.__doc__ = f"T5-T8/J8/W6: top-{TOP_K} items per instance for the '{mode}' session vector."
    return q


_P7_CTES = _EVENT_INSTANCE_CTES + """,
inst_id AS (select (cast(user_idx as bigint) << 32) + pos as instance_id, * from inst),
ivec AS (select i.prod_idx, v.vector from items i join item_vectors v on i.prod_no = v.prod_no),
hp AS (select instance_id, unnest(hist) as prod_idx, unnest(range(len(hist))) as p from inst_id),
hv AS (select h.instance_id, h.p, v.vector from hp h join ivec v on h.prod_idx = v.prod_idx),
sess_last AS (select instance_id, arg_max(vector, p) as session from hv group by instance_id),
dims AS (select instance_id, unnest(range(len(vector))) as d, unnest(vector) as x from hv),
sums AS (select instance_id, list(s order by d) as total
  from (select instance_id, d, sum(x) as s from dims group by instance_id, d) group by instance_id),
cnt AS (select instance_id, count(*) filter (where list_max(list_transform(vector, lambda x: abs(x))) > 0) as n
  from hv group by instance_id),
sess_average AS (select s.instance_id, list_transform(s.total, lambda x: x / c.n) as session
  from sums s join cnt c on s.instance_id = c.instance_id where c.n > 0),
att_s AS (select h.instance_id, h.p, h.vector, list_dot_product(h.vector, l.session) as s
  from hv h join sess_last l on h.instance_id = l.instance_id),
att_e AS (select instance_id, p, vector, exp(s - max(s) over (partition by instance_id)) as e from att_s),
att_w AS (select instance_id, p, vector, e / sum(e) over (partition by instance_id) as w from att_e),
att_dims AS (select instance_id, w, unnest(range(len(vector))) as d, unnest(vector) as x from att_w),
sess_attention AS (select instance_id, list(s order by d) as session
  from (select instance_id, d, sum(w * x) as s from att_dims group by instance_id, d) group by instance_id),
inst_clicks AS (select (cast(i.user_idx as bigint) << 32) + i.pos as instance_id, coalesce(c.cl, []) as cl
  from inst i left join carr c on i.user_idx = c.user_idx and """ + _yday_sql("i.timestamp") + """ = c.d),
cv AS (select c.instance_id, v.vector from (select instance_id, unnest(cl) as prod_idx from inst_clicks) c
  join ivec v on c.prod_idx = v.prod_idx),
cdims AS (select instance_id, unnest(range(len(vector))) as d, unnest(vector) as x from cv),
csum AS (select instance_id, list(s order by d) as total
  from (select instance_id, d, sum(x) as s from cdims group by instance_id, d) group by instance_id),
ccnt AS (select instance_id, count(*) filter (where list_max(list_transform(vector, lambda x: abs(x))) > 0) as n
  from cv group by instance_id),
ckey AS (select s.instance_id, list_transform(s.total, lambda x: x / c.n) as k
  from csum s join ccnt c on s.instance_id = c.instance_id where c.n > 0),
akey AS (select l.instance_id, coalesce(k.k, l.session) as k from sess_last l left join ckey k on l.instance_id = k.instance_id),
catt_e AS (select h.instance_id, h.vector, exp(list_dot_product(h.vector, a.k)
    - max(list_dot_product(h.vector, a.k)) over (partition by h.instance_id)) as e
  from hv h join akey a on h.instance_id = a.instance_id),
catt_dims AS (select instance_id, e / sum(e) over (partition by instance_id) as w,
  unnest(range(len(vector))) as d, unnest(vector) as x from catt_e),
sess_click_attention AS (select instance_id, list(s order by d) as session
  from (select instance_id, d, sum(w * x) as s from catt_dims group by instance_id, d) group by instance_id)"""


def _scores_cte(mode: str) -> str:
    return f""",
sc AS (select s.instance_id, v.prod_idx, list_dot_product(s.session, v.vector) as score
  from sess_{mode} s cross join ivec v),
rk AS (select *, row_number() over (partition by instance_id order by round(score, 6) desc, prod_idx) as rank from sc),
lse AS (select instance_id, max(mx) + ln(sum(exp(score - mx))) as lse
  from (select *, max(score) over (partition by instance_id) as mx from sc) group by instance_id),
hit AS (select i.instance_id, i.split,
  cast(max(case when r.prod_idx = i.label then 1 else 0 end) as int) as hit
  from inst_id i join rk r on i.instance_id = r.instance_id where r.rank <= {TOP_K} group by i.instance_id, i.split),
loss AS (select i.instance_id, i.split, l.lse - list_dot_product(s.session, v.vector) as loss
  from inst_id i join lse l on i.instance_id = l.instance_id join sess_{mode} s on i.instance_id = s.instance_id
  join ivec v on i.label = v.prod_idx)"""


def _topk_oracle(mode: str) -> str:
    return O.sql(f"""select instance_id, cast(prod_idx as int) as prod_idx, round(score, 6) + 0.0 as score,
      cast(rank as int) as rank from rk where rank <= {TOP_K}""", _P7_CTES + _scores_cte(mode))


for _mode in ("last", "average", "attention"):
    register(f"t5_topk_{_mode}", _topk_oracle(_mode))(_topk_query(_mode))


@register("t7_topk_click_attention", _topk_oracle("click_attention"))
def t7_topk_click_attention(spark: SparkSession, d: str) -> DataFrame:
    """Attention keyed by the mean click vector (last order when no clicks) -> top-10."""
    return _topk_query("click_attention")(spark, d)


def _eval_oracle() -> str:
    parts = []
    for mode in ("last", "average"):
        parts.append(f"""{mode}_sum AS (select '{mode}' as scorer, h.split, cast(count(*) as bigint) as instances,
          round(avg(h.hit) * 100, 6) + 0.0 as hit_rate, round(max(lo.loss), 6) + 0.0 as loss
          from {mode}_hit h left join (select split, avg(loss) as loss from {mode}_loss group by split) lo
            on h.split = lo.split group by h.split)""")
    ctes = _P7_CTES
    for mode in ("last", "average"):
        block = _scores_cte(mode).replace("sc AS", f"{mode}_sc AS").replace("from sc", f"from {mode}_sc") \
            .replace("rk AS", f"{mode}_rk AS").replace("join rk r", f"join {mode}_rk r") \
            .replace("lse AS", f"{mode}_lse AS").replace("join lse l", f"join {mode}_lse l") \
            .replace("hit AS", f"{mode}_hit AS").replace("loss AS", f"{mode}_loss AS")
        ctes += block
    ctes += ",\n" + ",\n".join(parts)
    return O.sql("select * from last_sum union all select * from average_sum", ctes)


@register("t9_evaluation", _eval_oracle())
def t9_evaluation(spark: SparkSession, d: str) -> DataFrame:
    """Hit-rate@10 (A9) and mean cross-entropy (A10) per scorer and split."""
    t = _event_instances(spark, d)
    out = evaluate(_saved_instances(t), _event_item_vectors(spark, d, t), ("last", "average"),
                   TOP_K, RANK_DECIMALS)
    return out.select("scorer", "split", F.col("instances").cast("long").alias("instances"),
                      _rounded("hit_rate").alias("hit_rate"), _rounded("loss").alias("loss"))


def _report_oracle() -> str:
    return O.sql("""select outcome, cast(case_no as int) as case_no, instance_id,
      concat_ws(chr(10) || chr(10), coalesce(orders_text, ''), answer, preds) as text from numbered n
      left join (select instance_id, string_agg(printf('[ORDER %02d] %s', p + 1, coalesce(t.title, '')), chr(10) order by p) as orders_text
        from hp h left join titles t on h.prod_idx = t.prod_idx group by instance_id) o using (instance_id)
      join (select i.instance_id, printf('[ANSWER] %s', coalesce(t.title, '')) as answer
        from inst_id i left join titles t on i.label = t.prod_idx) a using (instance_id)
      join (select r.instance_id, string_agg(printf('[%6.3f] %s', r.score, coalesce(t.title, '')), chr(10) order by r.rank) as preds
        from rk r left join titles t on r.prod_idx = t.prod_idx where r.rank <= 10 group by r.instance_id) pr using (instance_id)""",
                 _P7_CTES + _scores_cte("last") + """,
titles AS (select i.prod_idx, p.prod_nm as title from items i join product_raw p on i.prod_no = p.prod_no),
numbered AS (select instance_id, case when hit = 1 then 'positives' else 'negatives' end as outcome,
  row_number() over (partition by hit order by instance_id) as case_no from hit)""")


@register("k7_case_report", _report_oracle())
def k7_case_report(spark: SparkSession, d: str) -> DataFrame:
    """Case texts of the 'last' scorer, all positives and negatives."""
    t = _event_instances(spark, d)
    titles = t.items.join(fx.titles(spark, d), on=S.PRODUCT_NO).select(S.PROD_IDX, F.col(S.PRODUCT_NAME).alias("title"))
    return prediction_report(_saved_instances(t), _event_item_vectors(spark, d, t), titles, "last", TOP_K,
                             RANK_DECIMALS)


@register("t4_similar_items", O.sql("""select cast(query_item as bigint) as query_item, cast(prod_idx as int) as prod_idx,
    round(sim, 6) + 0.0 as similarity, cast(rank as int) as rank from (select *, row_number() over
    (partition by query_item order by round(sim, 6) desc, prod_idx) as rank from
    (select a.prod_no as query_item, b.prod_no as prod_idx, list_cosine_similarity(a.vector, b.vector) as sim
     from item_vectors a cross join item_vectors b)) where rank <= 11"""))
def t4_similar_items(spark: SparkSession, d: str) -> DataFrame:
    """T4: the 11 most cosine-similar items of every item vector (itself included)."""
    vecs = fx.item_vectors(spark, d).withColumnRenamed(S.PRODUCT_NO, S.PROD_IDX)
    return similar_items(vecs, 11, rank_decimals=RANK_DECIMALS).withColumn(
        "similarity", _rounded("similarity"))


def _index_queries(vecs: DataFrame) -> DataFrame:
    """Every vector whose id is divisible by 100, to be compared with all."""
    return vecs.where(F.col(S.PROD_IDX) % 100 == 0).select(F.col(S.PROD_IDX).cast("long").alias("query_item"), "vector")


@register("t4_index_neighbours")
def t4_index_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """T4 by the cell index: the 11 nearest items of every id divisible by 100, with their similarities (approximate set)."""
    vecs = fx.item_vectors(spark, d).withColumnRenamed(S.PRODUCT_NO, S.PROD_IDX)
    found = nearest_by_cells(_index_queries(vecs), vecs, fit_cells(vecs, 11), 11, rank_decimals=RANK_DECIMALS)
    return found.withColumn("similarity", _rounded("similarity"))


@register("t4_index_recall", O.sql("""select cast(query_item as bigint) as query_item, cast(prod_idx as int) as prod_idx,
    cast(rank as int) as rank, true as recall_reached from (select *, row_number() over
    (partition by query_item order by round(sim, 6) desc, prod_idx) as rank from
    (select a.prod_no as query_item, b.prod_no as prod_idx, list_cosine_similarity(a.vector, b.vector) as sim
     from item_vectors a join item_vectors b on a.prod_no % 100 = 0)) where rank <= 11"""))
def t4_index_recall(spark: SparkSession, d: str) -> DataFrame:
    """The exact neighbours of the same queries, and whether the index found at least 0.9 of them all."""
    vecs = fx.item_vectors(spark, d).withColumnRenamed(S.PRODUCT_NO, S.PROD_IDX)
    queries, index = _index_queries(vecs), fit_cells(vecs, 11)
    exact = materialize(nearest_by_cells(queries, vecs, index, 11, rank_decimals=RANK_DECIMALS, probes=len(index.centroids)))
    reached = recall(nearest_by_cells(queries, vecs, index, 11, rank_decimals=RANK_DECIMALS), exact).first()["recall"]
    return exact.select("query_item", S.PROD_IDX, "rank", F.lit((reached or 0) >= 0.9).alias("recall_reached"))


@register("j8_dot_topk", O.sql("""select cast(query_item as bigint) as instance_id, cast(prod_idx as int) as prod_idx,
    round(score, 6) + 0.0 as score, cast(rank as int) as rank from (select *, row_number() over
    (partition by query_item order by round(score, 6) desc, prod_idx) as rank from
    (select a.prod_no as query_item, b.prod_no as prod_idx, list_dot_product(a.vector, b.vector) as score
     from item_vectors a cross join item_vectors b)) where rank <= 10"""))
def j8_dot_topk(spark: SparkSession, d: str) -> DataFrame:
    """Top-10 items by dot product for every item vector as a query."""
    vecs = fx.item_vectors(spark, d).withColumnRenamed(S.PRODUCT_NO, S.PROD_IDX)
    queries = vecs.select(F.col(S.PROD_IDX).cast("long").alias("instance_id"), F.col("vector").alias("session"))
    res = top_k_scores(queries, vecs, TOP_K, rank_decimals=RANK_DECIMALS, with_lse=False)
    return res.top.withColumn("score", _rounded("score"))


# ---------------------------------------------------------------- T1-T3/P6, T10, A5, J9, S5, S6, O5


@register("t1_title_tokens", O.sql(r"""select prod_no, array_to_string(regexp_extract_all(lower(prod_nm), '[\p{L}\p{N}]+'), ' ')
  as tokens from product_raw"""))
def t1_title_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Product titles as token lists (letters/digits runs, lower case)."""
    docs = tokenize(fx.product_raw(spark, d).select(S.PRODUCT_NO, S.PRODUCT_NAME))
    return docs.select(S.PRODUCT_NO, F.array_join("tokens", " ").alias("tokens"))


_TITLE_VECTOR_CTES = r"""title_tokens AS (select prod_no,
    regexp_extract_all(lower(coalesce(prod_nm, '')), '[\p{L}\p{N}]+') as tokens from product_raw),
title_bytes AS (select prod_no, len(tokens) as n, j, cast(coalesce(list_sum(list_transform(tokens, lambda t:
    cast('0x' || substr(md5(t || ':' || (j // 16)), 2 * (j % 16) + 1, 2) as int))), 0) as bigint) as total
  from title_tokens, (select unnest(range(64)) as j)),
title_components AS (select prod_no, j, case when n > 0 then cast(total * 2 - n * 255 as double) / (n * 255.0::double)
    else 0.0::double end as v from title_bytes),
title_vectors AS (select prod_no, list(v order by j) as vector from title_components group by prod_no)"""


@register("t2_title_vectors", O.sql("""select prod_no, cast(j as int) as position, round(v, 6) + 0.0 as value
  from title_components""", _TITLE_VECTOR_CTES))
def t2_title_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Title vectors of every product, one row per component."""
    vecs = item_title_vectors(fx.product_raw(spark, d))
    return vecs.select(S.PRODUCT_NO, F.posexplode("vector").alias("position", "value")) \
        .withColumn("value", _rounded("value"))


_LEARNED_CTES = r"""title_tokens AS (select prod_no,
    regexp_extract_all(lower(coalesce(prod_nm, '')), '[\p{L}\p{N}]+') as tokens from product_raw),
placed AS (select prod_no, unnest(tokens) as token, unnest(range(len(tokens))) as pos, len(tokens) as n from title_tokens),
co AS (select x.token as a, y.token as b, count(*) as c from placed x join placed y
  on x.prod_no = y.prod_no and abs(x.pos - y.pos) between 1 and 2 group by x.token, y.token),
occ AS (select a, sum(c) as n from co group by a),
ppmi AS (select co.a, co.b, ln(cast(c as double) * (select cast(sum(c) as double) from co) / (cast(x.n as double) * cast(y.n as double))) as w
  from co join occ x on x.a = co.a join occ y on y.a = co.b),
drawn AS (select b, cast('0x' || substr(h, 4 * j + 1, 4) as int) % 64 as slot,
    case when cast('0x' || substr(h, 17 + j, 1) as int) % 2 = 0 then 1 else -1 end as sign
  from (select b, md5('42:' || b) as h, unnest(range(4)) as j from (select distinct b from co))),
comp AS (select a, slot, sum(w * sign) as v from ppmi join drawn using (b) where w > 0 group by a, slot)"""


@register("t2_learned_title_vectors", O.sql("""select t.prod_no, cast(p.j as int) as position, round(coalesce(s.v, 0.0::double), 6) + 0.0 as value
  from title_tokens t cross join (select unnest(range(64)) as j) p
  left join (select prod_no, slot, sum(v) / any_value(n) as v from placed join comp on comp.a = placed.token group by prod_no, slot) s
    on s.prod_no = t.prod_no and s.slot = p.j""", _LEARNED_CTES))
def t2_learned_title_vectors(spark: SparkSession, d: str) -> DataFrame:
    """T2/T3 learned: title vectors from window-2 co-occurrences, one row per component."""
    vecs = item_title_vectors(fx.product_raw(spark, d), learned=True)
    return vecs.select(S.PRODUCT_NO, F.posexplode("vector").alias("position", "value")).withColumn("value", _rounded("value"))


@register("p6_title_neighbours", O.sql("""select cast(query_item as bigint) as query_item, cast(prod_idx as int) as prod_idx,
    round(sim, 6) + 0.0 as similarity, cast(rank as int) as rank from (select *, row_number() over
    (partition by query_item order by round(sim, 6) desc, prod_idx) as rank from
    (select a.prod_no as query_item, b.prod_no as prod_idx, list_cosine_similarity(a.vector, b.vector) as sim
     from title_vectors a cross join title_vectors b)) where rank <= 11""", _TITLE_VECTOR_CTES))
def p6_title_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """11 nearest titles of every product by title vector."""
    vecs = item_title_vectors(fx.product_raw(spark, d)).select(S.PRODUCT_NO, "vector")
    return title_neighbours(vecs, rank_decimals=RANK_DECIMALS).withColumn("similarity", _rounded("similarity"))


@register("s1_log_records", O.sql("""select event_id,
    case when bad is null then timestamp end as timestamp, case when bad is null then action_type end as action_type,
    case when bad is null then prod_no end as prod_no,
    case when bad is null then case when event_id % 5 = 0 then 'say "' || coalesce(search_keyword, '') || '", ok'
      when event_id % 5 = 1 then 'two' || chr(10) || 'lines, ' || event_id else nullif(search_keyword, '') end end as search_keyword,
    case when bad is null then m_id end as m_id, bad as _rejected
  from (select *, case when event_id % 97 = 0 then 'x' || event_id || ',O,1,,u' when event_id % 101 = 0 then event_id || ',O' end as bad from useraction)"""))
def s1_log_records(spark: SparkSession, d: str) -> DataFrame:
    """The log written as CSV records with quotes, commas and line breaks, some of them bad, and read back with its rejects."""
    log, key = fx.useraction(spark, d), F.col("event_id")
    keyword = (F.when(key % 5 == 0, F.concat(F.lit('say "'), F.coalesce(S.SEARCH_KEYWORD, F.lit("")), F.lit('", ok')))
               .when(key % 5 == 1, F.concat(F.lit("two\nlines, "), key.cast("string"))).otherwise(F.col(S.SEARCH_KEYWORD)))
    lines = csv_lines(log.withColumn(S.SEARCH_KEYWORD, keyword), S.USERACTION.names)
    bad = F.when(key % 97 == 0, F.concat(F.lit("x"), key.cast("string"), F.lit(",O,1,,u"))).when(key % 101 == 0, F.concat(key.cast("string"), F.lit(",O")))
    return parse_csv_lines(lines.withColumn("value", F.coalesce(bad, "value")))


@register("u1_union_by_name", O.sql("""select event_id, timestamp, action_type, m_id, prod_no from useraction where action_type = 'O'
  union all select event_id, timestamp, action_type, m_id, null from useraction where action_type <> 'O'"""))
def u1_union_by_name(spark: SparkSession, d: str) -> DataFrame:
    """Log parts whose columns come in another order, one part without ``prod_no``."""
    log = fx.useraction(spark, d)
    orders = log.where("action_type = 'O'").select("event_id", S.TIMESTAMP, S.ACTION_TYPE, S.MEMBER_ID, S.PRODUCT_NO)
    others = log.where("action_type <> 'O'").select(S.MEMBER_ID, S.ACTION_TYPE, S.TIMESTAMP, "event_id")
    return union_by_name([orders, others])


@register("t10_padded_histories", O.sql("""select instance_id,
    array_to_string(list_concat(hist, list_transform(range(mx - len(hist)), lambda x: 0)), ',') as sequence, label
  from inst_id, (select max(len(hist)) as mx from inst_id)""", _P7_CTES))
def t10_padded_histories(spark: SparkSession, d: str) -> DataFrame:
    """A8 + T10: order histories without pads, right-padded with 0 to the longest one."""
    inst = with_instance_id(_event_instances(spark, d).instances)
    seq = inst.select("instance_id", drop_pads("orders").alias("_s"), "label")
    longest = seq.agg(F.max(F.size("_s"))).first()[0] or 0  # A8: one number to the driver
    return seq.select("instance_id", join_ints(right_pad("_s", longest, 0)).alias("sequence"), "label")


def _item_cats(spark: SparkSession, d: str):
    t = _event_instances(spark, d)
    cats, index = item_categories(t.items, fx.prod_category(spark, d))
    return t, cats, index.count()


_CAT_CTES = _P7_CTES + """,
links AS (select i.prod_idx, pc.gnb_category_id from prod_category pc join items i on pc.prod_no = i.prod_no),
cindex AS (select gnb_category_id, row_number() over (order by gnb_category_id) - 1 as cidx
  from (select distinct gnb_category_id from links)),
icat AS (select i.prod_idx, coalesce(c.cats, []) as cats from items i left join
  (select l.prod_idx, list(distinct ci.cidx) as cats from links l join cindex ci using (gnb_category_id) group by l.prod_idx) c
  on i.prod_idx = c.prod_idx),
dense AS (select prod_idx, list_transform(range((select count(*) from cindex)),
  lambda j: case when list_contains(cats, j) then 1 else 0 end) as hot from icat)"""


@register("a5_normalised_categories", O.sql("""select prod_idx, array_to_string(list_transform(hot,
    lambda x: printf('%.6f', x / case when list_sum(hot) > 0 then list_sum(hot) else 1 end)), ',') as category_vector
  from dense""", _CAT_CTES))
def a5_normalised_categories(spark: SparkSession, d: str) -> DataFrame:
    """A4 dense + A5: multi-hot category vectors divided by their row sums."""
    _, cats, n = _item_cats(spark, d)
    out = dense_categories(cats, n, normalise=True)
    return out.select(S.PROD_IDX, F.array_join(F.transform("category_vector", lambda x: F.format_string("%.6f", x)),
                                               ",").alias("category_vector"))


@register("j9_item_category_vectors", O.sql("""select d.prod_idx, array_to_string(list_transform(
    list_concat(v.vector, list_transform(d.hot, lambda x: cast(x as double))), lambda x: printf('%.6f', x)), ',') as vector
  from dense d join ivec v on d.prod_idx = v.prod_idx""", _CAT_CTES))
def j9_item_category_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Item vectors concatenated with their multi-hot category vectors."""
    t, cats, n = _item_cats(spark, d)
    out = with_category_features(_event_item_vectors(spark, d, t), cats, n)
    return out.select(S.PROD_IDX, F.array_join(F.transform("vector", lambda x: F.format_string("%.6f", x)),
                                               ",").alias("vector"))


@register("s5_order_extract", O.sql("""select timestamp, action_type, prod_no, search_keyword, m_id, event_id
  from useraction where action_type like 'O%'"""))
def s5_order_extract(spark: SparkSession, d: str) -> DataFrame:
    """Order rows of all log files."""
    return extract_orders(fx.useraction(spark, d, with_file_size=True), size_col="file_size")


@register("s6_search_words", O.sql("select word from search_words"))
def s6_search_words(spark: SparkSession, d: str) -> DataFrame:
    """Distinct non-empty search keywords of the log."""
    return extract_search_words(fx.useraction(spark, d, with_event_id=False))


@register("o5_shuffled_instances", O.sql(f"""select instance_id, {_pad_sql('hist', 8)} as orders, label, split
  from inst_id""", _P7_CTES))
def o5_shuffled_instances(spark: SparkSession, d: str) -> DataFrame:
    """Instances in a repeatable random order (checked as the same rows)."""
    inst = with_instance_id(_event_instances(spark, d).instances)
    return shuffle_rows(inst.select("instance_id", join_ints("orders").alias("orders"), "label", "split"), 7,
                        ["instance_id"])


# ---------------------------------------------------------------- A6, I3


@register("a6_sequence_lengths", O.sql("""select i.instance_id,
    cast(count(h.instance_id) filter (where list_max(list_transform(h.vector, lambda x: abs(x))) > 0) as int) as length
  from inst_id i left join hv h on i.instance_id = h.instance_id group by i.instance_id""", _P7_CTES))
def a6_sequence_lengths(spark: SparkSession, d: str) -> DataFrame:
    """Valid length of every order history (positions with a non-zero item vector)."""
    t = _event_instances(spark, d)
    inst = with_instance_id(t.instances)
    seq = sequence_vectors(inst, _event_item_vectors(spark, d, t), "instance_id", "orders", "_ov")
    return inst.select("instance_id").join(seq, on="instance_id", how="left") \
        .select("instance_id", F.coalesce(valid_length("_ov"), F.lit(0)).cast("int").alias("length"))


def _extend_oracle() -> str:
    a, b = affine_key(CODE_SEED)
    digits = ", ".join(
        f"substr('{CODE_ALPHABET}', cast((n // {36 ** k}) % 36 as int) + 1, 1)" for k in range(4, -1, -1))
    return O.sql(f"""select r.sex, r.age, r.m_id, u.comp_mid from raw_users r join users u on r.m_id = u.m_id
      union all
      select r.sex, r.age, r.m_id, concat({digits}) as comp_mid from raw_users r join coded c on r.m_id = c.m_id""",
                 f"""fresh AS (select distinct m_id from raw_users where m_id not in (select m_id from users)),
ranked AS (select m_id, row_number() over (order by m_id) - 1 + (select count(distinct m_id) from users) as idx from fresh),
coded AS (select m_id, ({a} * idx + {b}) % {CODE_SPACE} as n from ranked)""")


@register("i3_member_codes_extend", _extend_oracle())
def i3_member_codes_extend(spark: SparkSession, d: str) -> DataFrame:
    """Keep the existing member codes and give members missing from the mapping new ones that it does not use."""
    return member_codes(fx.raw_users(spark, d), CODE_SEED, fx.comp_mid_mapping(spark, d), extend=True, pass_over_taken=True) \
        .select("sex", "age", "m_id", "comp_mid")
