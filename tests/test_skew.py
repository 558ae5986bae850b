"""A user owning a third of all rows: P3 + W3/W4 stay exact (checked against DuckDB)."""

from pyspark.sql import functions as F

from basketry.operators.sequences import order_instances
from basketry.plans import fixtures as fx
from basketry.plans.behaviour import aggregate_log
from conftest import SF01
from oracle_check import digest, duck


def test_hot_user_histories_match_sql(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        log = fx.order_log(spark, SF01)
        # every third customer's orders are folded into one hot user
        hot = log.withColumn("comp_mid", F.when(F.col("comp_mid").cast("int") % 3 == 0, F.lit("00000"))
                             .otherwise(F.col("comp_mid")))
        share = hot.where(F.col("comp_mid") == "00000").count() / hot.count()
        assert 0.3 < share < 0.37
        inst = order_instances(aggregate_log(hot, sort=False), 0, 0, 4, 8, user="comp_mid", ts="timestamp",
                               item="prod_no", partitions=8)
        got = inst.select("comp_mid", "timestamp", "position", F.array_join("orders", ",").alias("orders"),
                          F.col("label").alias("prod_no"))
        rows = [tuple(r) for r in got.collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    sql = """
    with log as (
      select case when o_custkey % 3 = 0 then '00000' else lpad(cast(o_custkey as varchar), 5, '0') end as comp_mid,
        cast(epoch(o_orderdate) as bigint) + ((o_orderkey * 7919) % 86400) as timestamp,
        cast(l_partkey as int) as prod_no, p_name as prod_nm
      from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey),
    w1 as (select * from (select *, row_number() over (partition by comp_mid, timestamp order by prod_no, prod_nm) r
      from log) where r = 1),
    w2 as (select * from (select *, lag(prod_no) over (partition by comp_mid order by timestamp) prev from w1)
      where prev is null or prev <> prod_no),
    seq as (select *, row_number() over (partition by comp_mid order by timestamp, prod_no) - 1 as pos,
      list(prod_no) over (partition by comp_mid order by timestamp, prod_no rows between 8 preceding and 1 preceding) h
      from w2)
    select comp_mid, timestamp, cast(pos as bigint) as position,
      array_to_string(list_concat(list_transform(range(8 - len(h)), lambda x: -1), h), ',') as orders, prod_no
    from seq where pos >= 4"""
    res = duck(SF01).execute(sql)
    cols = [c[0] for c in res.description]
    expected = res.fetchall()
    assert len(rows) == len(expected) > 10000
    assert digest(got.columns, rows) == digest(cols, expected)
