from pyspark.sql import functions as F

from basketry import schemas as S
from basketry.operators import filters as flt
from basketry.operators.quality import all_violations, foreign_key_violations


def test_action_type_aliases():
    assert [flt.action_type_code(x) for x in ("order", "O", "Click", "c", "ALL", "a")] == list("OOCCAA")
    try:
        flt.action_type_code("search")
        assert False
    except ValueError:
        pass


def test_timestamp_bounds_inclusive(spark):
    lo, hi = 100, 200
    df = spark.createDataFrame([(t,) for t in (lo - 1, lo, hi, hi + 1)], "timestamp long")
    assert [r.timestamp for r in flt.filter_by_timestamp(df, lo, hi).collect()] == [lo, hi]


def test_prod_threshold_strict_and_fanout(spark):
    rows = [(1,)] * 3 + [(2,)] * 4 + [(3,)] * 2
    df = spark.createDataFrame(rows, "prod_no int")
    kept = flt.filter_by_prod_threshold(df, 3)
    assert sorted(r.prod_no for r in kept.collect()) == [2] * 4
    # a product listed in two categories counts twice
    cats = spark.createDataFrame([(3, 10), (3, 11)], "prod_no int, gnb_category_id int")
    fanned = df.join(cats, "prod_no")
    assert fanned.transform(flt.filter_by_prod_threshold, 3).count() == 4


def test_ids_with_min_count(spark):
    df = spark.createDataFrame([("00001",), ("00001",), ("00002",)], "comp_mid string")
    assert [r.comp_mid for r in flt.ids_with_min_count(df, "comp_mid", 2).collect()] == ["00001"]


def test_blacklist_null_and_drop(spark):
    df = spark.createDataFrame([("red ring", 1), ("blue", 2), (None, 3)], "prod_nm string, prod_no int")
    out = flt.filter_blacklist(df, ["red *  "])
    assert out.columns == ["prod_no"]
    assert sorted(r.prod_no for r in out.collect()) == [2, 3]


def test_clean_tags(spark):
    prods = spark.createDataFrame([(1, "a,b,b,old"), (2, None), (3, "zzz"), (4, "")],
                                  "prod_no int, deal_construction string")
    words = spark.createDataFrame([("b",), ("a",), ("old",)], "word string")
    out = {r.prod_no: r.deal_construction for r in flt.clean_tags(prods, words, ["old"]).collect()}
    assert out == {1: "a,b", 2: None, 3: "", 4: ""}


def test_leaf_category(spark):
    df = spark.createDataFrame([(101, None), (101, 7)], "gnb_depth1_cate_id int, gnb_depth2_cate_id int")
    assert [r.gnb_category_id for r in flt.leaf_category(df).collect()] == [101, 7]


def test_constraints_one_violation_each(spark):
    user = spark.createDataFrame([("00001", 1, 30, "U1"), ("00001", 300, 30, None), ("123456", 0, 1, "U3")],
                                 "comp_mid string, sex int, age int, m_id string")
    product = spark.createDataFrame([(1, 10, "x" * 201, None), (2, -1, "ok", "t")],
                                    "prod_no int, sale_price int, prod_nm string, deal_construction string")
    category = spark.createDataFrame([(5, 100, None)], "gnb_category_id int, gnb_depth1_cate_id int, gnb_depth2_cate_id int")
    deal_item = spark.createDataFrame([(1, 9)], "deal_no int, item_no int")
    pc = spark.createDataFrame([(1, 6)], "prod_no int, gnb_category_id int")
    v = {(r.table, r.column, r.rule): r.violations for r in
         all_violations({"user": user, "product": product, "category": category, "deal_item": deal_item,
                         "prod_category": pc}).collect()}
    assert v[("user", "comp_mid", "duplicate_key")] == 2
    assert v[("user", "m_id", "not_null")] == 1
    assert v[("user", "sex", "range 0..255")] == 1
    assert v[("user", "comp_mid", "length <= 5")] == 1
    assert v[("product", "prod_nm", "length <= 200")] == 1
    assert v[("product", "sale_price", "range 0..4294967295")] == 1
    assert v[("deal_item", "item_no", "references product.prod_no")] == 1
    assert v[("deal_item", "deal_no", "references product.prod_no")] == 0
    assert v[("prod_category", "gnb_category_id", "references category.gnb_category_id")] == 1


def test_tag_set_ops(spark):
    df = spark.createDataFrame([(["a", "b", "c"], ["b", "d"])], "x array<string>, y array<string>")
    ops = flt.tag_set_ops("x", "y")
    r = df.select(*[F.array_sort(c).alias(k) for k, c in ops.items()]).first()
    assert (r.intersect, r["except"], r.union) == (["b"], ["a", "c"], ["a", "b", "c", "d"])


def test_foreign_keys_in_one_shuffle_each(spark):
    product = spark.createDataFrame([(1,), (2,), (2,), (None,)], "prod_no long")
    category = spark.createDataFrame([(7,)], "catg_no long")
    deal_item = spark.createDataFrame([(1, 9), (9, 2), (9, 9), (None, 1), (3, None)], "deal_no long, item_no long")
    prod_category = spark.createDataFrame([(1, 7), (9, 8), (None, 8), (2, None)], "prod_no long, catg_no long")
    tables = {"product": product.toDF(S.PRODUCT_NO), "category": category.toDF(S.CATEGORY_NO),
              "deal_item": deal_item.toDF(S.DEAL_NO, S.ITEM_NO), "prod_category": prod_category.toDF(S.PRODUCT_NO, S.CATEGORY_NO)}
    got = foreign_key_violations(tables)
    assert [(r.table, r.column, r.violations) for r in got.collect()] == [
        ("deal_item", S.DEAL_NO, 3), ("deal_item", S.ITEM_NO, 2), ("prod_category", S.PRODUCT_NO, 1), ("prod_category", S.CATEGORY_NO, 2)]
    assert got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("hashpartitioning(key") == 2
    empty = {name: df.limit(0) for name, df in tables.items()}
    assert {r.violations for r in foreign_key_violations(empty).collect()} == {0}
