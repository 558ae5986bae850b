"""Decided semantics of SURVEY §5.1 not covered elsewhere (#6, #7, #15, #17, #19)."""

import math

import pytest
from pyspark.sql import functions as F

from basketry.operators.filters import clean_tags
from basketry.operators.indexing import member_codes
from basketry.plans import fixtures as fx
from basketry.plans import registry
from basketry.plans.behaviour import aggregate_log
from basketry.plans.feature import sort_log
from basketry.plans.instances import build_instances, item_table
from basketry.plans.recommend import evaluate, similar_items
from conftest import SF001


def test_users_counted_before_item_cut(spark):
    # user A has 5 orders, two of them of an item ordered only once overall
    rows = [("A", t, 1 if t < 3 else 90 + t, "n") for t in range(5)] + [("B", 10 + t, 1, "n") for t in range(5)]
    df = spark.createDataFrame(rows, "comp_mid string, timestamp long, prod_no int, prod_nm string")
    t = build_instances(df, None, [], 100, 200, item_cut=2, min_orders=4, max_orders=8)
    assert {r.comp_mid for r in t.users.collect()} == {"A", "B"}        # A counted with its rare items
    assert {r.prod_no for r in t.items.collect()} == {1}
    # A's rare-item orders are dropped by the index join: 3 orders left, no instance for A
    assert {r.user_idx for r in t.instances.collect()} == {1}


def test_item_without_vector(spark):
    items = spark.createDataFrame([(1, 0), (2, 1)], "prod_no int, prod_idx int")
    vecs = spark.createDataFrame([(1, [1.0])], "prod_no int, vector array<double>")
    loose = {r.prod_no: r.vector for r in item_table(items, vectors=vecs).collect()}
    assert loose == {1: [1.0], 2: None}
    with pytest.raises(Exception, match="no vector for item 2"):
        item_table(items, vectors=vecs, strict=True).collect()


def test_hit_rate_and_loss_cover_the_same_instances(spark):
    inst = spark.createDataFrame([(1, [0], 0, "test"), (2, [0], 1, "test"), (3, [1], 0, "test"), (4, [1], 1, "late")],
                                 "instance_id long, orders array<int>, label int, split string")
    vecs = spark.createDataFrame([(0, [1.0, 0.0]), (2, [0.0, 1.0])], "prod_idx int, vector array<double>")
    got = {r.split: r for r in evaluate(inst, vecs, ("last",), 1).collect()}
    assert (got["test"].instances, got["test"].hit_rate, got["test"].left_out) == (1, 100.0, 2)
    assert got["test"].loss == pytest.approx(math.log(math.e + 1) - 1)
    assert (got["late"].instances, got["late"].hit_rate, got["late"].loss, got["late"].left_out) == (0, None, None, 1)


def test_sorted_outputs_are_sorted(spark):
    times = [r.timestamp for r in registry.p1_feature_clicks(spark, SF001).collect()]
    assert times == sorted(times) and len(times) > 0
    for column in ("timestamp", "action_type"):
        values = [r[column] for r in sort_log(fx.useraction(spark, SF001), column).collect()]
        assert values == sorted(values) and len(values) == 1000
    log = aggregate_log(fx.order_log(spark, SF001)).collect()
    keys = [(r.comp_mid, r.timestamp) for r in log]
    assert keys == sorted(keys) and len(keys) > 0


def test_filter_word_with_space_is_exact(spark):
    prods = spark.createDataFrame([(1, "금 천구,금천구,x")], "prod_no int, deal_construction string")
    words = spark.createDataFrame([("금 천구",), ("금천구",), ("x",)], "word string")
    out = clean_tags(prods, words).first().deal_construction     # default filter words
    assert out == "x,금천구"


def test_similar_items_exclude_self(spark):
    v = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [0.0, 1.0])], "prod_idx int, vector array<double>")
    with_self = {(r.query_item, r.rank): r.prod_idx for r in similar_items(v, 2).collect()}
    assert with_self[(0, 1)] == 0 and with_self[(0, 2)] == 1
    without = {(r.query_item, r.rank): r.prod_idx for r in similar_items(v, 2, exclude_self=True).collect()}
    assert without[(0, 1)] == 1 and without[(0, 2)] == 2 and all(q != p for (q, _), p in without.items())


def test_member_codes_mapping_and_extend(spark):
    users = spark.createDataFrame([("U1",), ("U2",), ("U3",)], "m_id string")
    first = member_codes(users.where(F.col("m_id") != "U3"), seed=4)
    mapping = first.select("m_id", "comp_mid")
    kept = member_codes(users, seed=4, mapping=mapping)
    assert sorted(r.m_id for r in kept.collect()) == ["U1", "U2"]         # unmapped member dropped
    ext = {r.m_id: r.comp_mid for r in member_codes(users, seed=4, mapping=mapping, extend=True).collect()}
    assert set(ext) == {"U1", "U2", "U3"} and len(set(ext.values())) == 3
    assert {r.m_id: r.comp_mid for r in mapping.collect()}.items() <= ext.items()


def test_member_codes_extend_refuses_taken_code(spark):
    users = spark.createDataFrame([("U1",), ("U2",)], "m_id string")
    # a foreign mapping whose single code equals the one U2 would get next (index 0 + offset 1)
    from basketry.functions.codes import code_of_index
    clash = spark.range(1).select(code_of_index(F.lit(1), 4).alias("c")).first().c
    mapping = spark.createDataFrame([("U1", clash)], "m_id string, comp_mid string")
    with pytest.raises(Exception, match="code already in use"):
        member_codes(users, seed=4, mapping=mapping, extend=True).collect()
