"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The test-table adapters of :mod:`basketry.plans.fixtures` are repeated here as
CTEs over the pre-registered views; each oracle appends its own CTEs and
final SELECT. Arrays are compared as comma-joined strings, doubles rounded.
"""

from __future__ import annotations

E = "cast(epoch(date_trunc('second', ts)) as bigint)"
K = "cast(json_extract_string(props, '$.k') as int)"

FIXTURE_CTES = f"""
useraction AS (
  select {E} as timestamp,
    case when event_type='purchase' then 'O' when event_type in ('click','view') then 'C' else 'S' end as action_type,
    case when event_type in ('purchase','click','view') then {K} end as prod_no,
    case when event_type='signup' then
           case {K}%8 when 0 then 'red' when 1 then 'blue' when 2 then 'hot' when 3 then 'old'
             when 4 then 'small' when 5 then 'large' when 6 then 'widget' else 'PROMO' end
         when event_type='error' then '' end as search_keyword,
    case when user_id%50=0 then null else concat('u', cast(user_id as varchar)) end as m_id,
    event_id
  from events),
users AS (
  select lpad(cast(c_custkey as varchar),5,'0') as comp_mid, cast(c_custkey%2 as int) as sex,
    cast(1950+c_nationkey as int) as age, concat(case when c_custkey%7=3 then 'X' else 'U' end, cast(c_custkey as varchar)) as m_id
  from customer),
raw_users AS (
  select cast(c_custkey%2 as int) as sex, cast(1950+c_nationkey as int) as age,
    concat('U', cast(c_custkey as varchar)) as m_id
  from customer),
product_raw AS (
  select cast(p_partkey as int) as prod_no, cast(floor(p_retailprice) as int) as sale_price,
    cast(date '2024-01-01' + p_size as date) as sale_start_dt, cast(date '2024-06-01' + p_size as date) as sale_end_dt,
    p_name as prod_nm,
    case when p_partkey%11=0 then null else concat(replace(p_name,' ',','), ',', p_type) end as deal_construction,
    p_brand as extra
  from part),
valid_prods AS (select cast(p_partkey as int) as deal_prod_no from part where p_size%5<>0),
category_raw AS (
  select 'ROOT' as gnb_depth0_nm, cast(100+r_regionkey as int) as gnb_depth1_cate_id, r_name as gnb_depth1_nm,
    cast(case when n_nationkey=0 then null else n_nationkey end as int) as gnb_depth2_cate_id,
    n_name as gnb_depth2_nm, 1 as display_order_depth0,
    cast(r_regionkey as int) as display_order_depth1, cast(n_nationkey as int) as display_order_depth2
  from nation join region on n_regionkey=r_regionkey),
category AS (
  select cast(coalesce(gnb_depth2_cate_id, gnb_depth1_cate_id) as int) as gnb_category_id, * from category_raw),
prod_category AS (
  select distinct cast(l_partkey as int) as prod_no, cast(case when s_nationkey=0 then 100 else s_nationkey end as int) as gnb_category_id
  from lineitem join supplier on l_suppkey=s_suppkey),
deal_item_raw AS (
  select distinct cast(l_suppkey*37 as int) as deal_no, cast(l_partkey as int) as prod_no
  from lineitem),
search_words AS (
  select distinct search_keyword as word from useraction where search_keyword is not null and search_keyword<>''),
behaviours AS (
  select u.comp_mid, a.timestamp, a.prod_no, p.prod_nm, a.event_id, a.action_type
  from useraction a join users u on upper(a.m_id)=u.m_id join product_raw p on a.prod_no=p.prod_no
  where a.m_id is not null and a.action_type in ('O','C')),
order_log AS (
  select lpad(cast(o_custkey as varchar),5,'0') as comp_mid,
    cast(epoch(o_orderdate) as bigint) + ((o_orderkey*7919) % 86400) as timestamp,
    cast(l_partkey as int) as prod_no, p_name as prod_nm
  from lineitem join orders on l_orderkey=o_orderkey join part on l_partkey=p_partkey),
item_vectors AS (
  select cast(vec_id as int) as prod_no, list_transform(embedding, lambda x: cast(x as double)) as vector from embeddings)
"""


def sql(body: str, ctes: str = "") -> str:
    """Fixture CTEs + optional extra CTEs (``name AS (...)``, comma separated) + final SELECT."""
    extra = f",\n{ctes}" if ctes.strip() else ""
    return f"WITH {FIXTURE_CTES}{extra}\n{body}"


FEATURE_SELECT = """
select u.comp_mid, a.timestamp, a.prod_no, u.sex, u.age, p.sale_price, p.sale_start_dt, p.sale_end_dt,
  p.prod_nm, p.deal_construction, c.gnb_category_id, c.gnb_depth0_nm, c.gnb_depth1_cate_id, c.gnb_depth1_nm,
  c.gnb_depth2_cate_id, c.gnb_depth2_nm, c.display_order_depth0, c.display_order_depth1, c.display_order_depth2
from useraction a
  join users u on upper(a.m_id)=u.m_id
  join product_raw p on a.prod_no=p.prod_no
  join prod_category pc on p.prod_no=pc.prod_no
  join category c on pc.gnb_category_id=c.gnb_category_id
where a.m_id is not null {action} and a.timestamp between {lo} and {hi}
"""


def feature_sql(action: str, lo: int, hi: int, threshold: int) -> str:
    act = "" if action == "A" else f"and a.action_type='{action}'"
    ctes = f"feat AS ({FEATURE_SELECT.format(action=act, lo=lo, hi=hi)})"
    return sql(f"""select * from feat where prod_no in
      (select prod_no from feat group by prod_no having count(*) > {threshold})""", ctes)
