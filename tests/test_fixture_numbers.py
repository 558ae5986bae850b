"""The independently verified results of FIXTURES.md §4, recomputed with our operators."""

from pyspark.sql import functions as F

from basketry.functions.time import click_day, yesterday_day
from basketry.operators.scoring import top_k_scores
from basketry.operators.sequences import (aggregate_behaviour, attach_yesterday_clicks, daily_last_clicks,
                                          order_instances)
from basketry.plans import fixtures as fx
from basketry.plans import registry
from basketry.plans.behaviour import aggregate_log
from conftest import SF001, SF01
from oracle_check import duck


def test_feature_rows(spark):
    for d in (SF001, SF01):
        sql = registry.oracle_sql()["p1_feature_clicks"]
        assert registry.p1_feature_clicks(spark, d).count() == len(duck(d).execute(sql).fetchall())


def test_order_histories(spark):
    ua = fx.useraction(spark, SF01).where((F.col("action_type") == "O") & F.col("m_id").isNotNull())
    agg = aggregate_behaviour(ua.select("m_id", "timestamp", "prod_no"), user="m_id", tiebreak=["prod_no"])
    assert order_instances(agg, 0, 0, 4, 8, user="m_id", ts="timestamp", item="prod_no").count() == 1344


def test_split_counts_on_order_log(spark):
    log = aggregate_log(fx.order_log(spark, SF01), sort=False)
    inst = order_instances(log, *fx.ORDER_LOG_SPLITS, 4, 8, user="comp_mid", ts="timestamp", item="prod_no")
    got = {r.split: r["count"] for r in inst.groupBy("split").count().collect()}
    assert got == {"training": 417, "validation": 2838, "test": 5509}


def test_yesterday_clicks_counts(spark):
    ev = fx.table(spark, SF01, "events").select("event_id", "user_id")
    ua = fx.useraction(spark, SF01).join(ev, "event_id")
    orders = ua.where(F.col("action_type") == "O")
    clicks = ua.where(F.col("action_type") == "C")
    pairs = orders.withColumn("d", yesterday_day("timestamp")).join(
        clicks.withColumn("d", click_day("timestamp")), ["user_id", "d"])
    assert pairs.count() == 1628
    daily = daily_last_clicks(clicks, 2, user="user_id", item="prod_no", tiebreak=["event_id"])
    assert attach_yesterday_clicks(orders, daily, 2, user="user_id").count() == 1981


def test_dot_product_topk_rows(spark):
    v = fx.item_vectors(spark, SF01).withColumnRenamed("prod_no", "prod_idx")
    q = v.where(F.col("prod_idx") < 100).select(F.col("prod_idx").cast("long").alias("instance_id"),
                                               F.col("vector").alias("session"))
    assert top_k_scores(q, v, 10, rank_decimals=6).top.count() == 1000
