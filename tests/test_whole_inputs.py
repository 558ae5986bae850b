"""Nothing is dropped or misread by default: parts, tags, cases, empty widths."""

import os

from pyspark.sql import functions as F

from basketry.functions.arrays import multi_hot
from basketry.operators.evaluation import case_report
from basketry.operators.filters import clean_tags
from basketry.sources.readers import extract_orders, read_csv_parts


def test_parts_align_by_column_name(spark, tmpdir_path):
    for name, text in (("a.csv", "comp_mid,timestamp,prod_no\nA,1,10\n"), ("b.csv", "prod_no,comp_mid,timestamp\n20,B,2\n"), ("c.csv", "timestamp,comp_mid\n3,C\n")):
        with open(os.path.join(tmpdir_path, name), "w") as f:
            f.write(text)
    got = {(r.comp_mid, r.timestamp, r.prod_no) for r in read_csv_parts(spark, tmpdir_path).collect()}
    assert got == {("A", "1", "10"), ("B", "2", "20"), ("C", "3", None)}


def test_tags_are_cleaned_per_row(spark):
    rows = spark.createDataFrame([(1, "a,b"), (1, "c"), (1, "c"), (2, None), (2, "x"), (None, "a")], "prod_no int, deal_construction string")
    words = spark.createDataFrame([("a",), ("b",), ("c",)], "word string")
    got = sorted(((r.prod_no, r.deal_construction) for r in clean_tags(rows, words, filter_words=()).collect()), key=repr)
    assert got == sorted([(1, "a,b"), (1, "c"), (1, "c"), (2, None), (2, ""), (None, "a")], key=repr)


def test_width_zero_is_empty(spark):
    row = spark.range(1).select(multi_hot(F.array().cast("array<int>"), 0).alias("a"), multi_hot(F.array(F.lit(1)), 3).alias("b")).first()
    assert row.a == [] and row.b == [0, 1, 0]


def test_orders_of_every_size_count_without_a_band(spark):
    log = spark.createDataFrame([("O", 1), ("O", 1 << 40), ("C", 5)], "action_type string, file_size long")
    assert extract_orders(log, size_col="file_size").count() == 2
    assert extract_orders(log, 0, 1 << 30, size_col="file_size").count() == 1


def test_every_case_is_reported_unless_capped(spark):
    n = 250
    inst = spark.range(n).select(F.col("id").alias("instance_id"), F.array(F.lit(0)).alias("orders"), F.lit(0).alias("label"))
    top = inst.select("instance_id", F.lit(0).alias("prod_idx"), F.lit(1.0).alias("score"), F.lit(1).alias("rank"))
    hit = inst.select("instance_id", (F.col("instance_id") % 5 == 0).cast("int").alias("hit"))
    titles = spark.createDataFrame([(0, "t")], "prod_idx int, title string")
    report = case_report(inst, top, hit, titles)
    assert report.count() == n
    numbers = sorted(r.case_no for r in report.where("outcome = 'negatives'").collect())
    assert numbers == list(range(1, 201))
    assert case_report(inst, top, hit, titles, positive_cases=3, negative_cases=7).count() == 10
