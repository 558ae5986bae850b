"""File-to-file jobs end to end: CSV inputs written from the fixtures, outputs
compared with the in-memory pipelines."""

import os

import pytest
from pyspark.sql import functions as F

from basketry import schemas as S
from basketry.plans import fixtures as fx
from basketry.plans import jobs
from basketry.plans import registry
from basketry.plans.behaviour import aggregate_log
from basketry.plans.metadata import prepare_product
from basketry.sources import readers as R
from basketry.sources import sinks as K
from conftest import SF001


def _same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def files(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="basketry-jobs-")
    d = SF001
    K.write_csv(fx.useraction(spark, d, with_event_id=False), os.path.join(root, "log"), header=False)
    meta = os.path.join(root, "meta")
    K.write_csv(fx.users(spark, d), os.path.join(meta, "user.csv"))
    K.write_csv(fx.product_raw(spark, d).drop("extra"), os.path.join(meta, "product.csv"))
    K.write_csv(fx.prod_category(spark, d), os.path.join(meta, "prod_category.csv"))
    K.write_csv(fx.category(spark, d), os.path.join(meta, "category.csv"))
    for action, name in (("O", "orders"), ("C", "clicks")):
        K.write_csv(fx.behaviours(spark, d, action).drop("event_id"), os.path.join(root, name))
    with open(os.path.join(root, "blacklist.txt"), "w") as f:
        f.write("\n".join(fx.TEST_BLACKLIST) + "\n")
    emb = os.path.join(root, "emb")
    os.makedirs(emb)
    vecs = fx.item_vectors(spark, d).join(fx.titles(spark, d), S.PRODUCT_NO).orderBy(S.PRODUCT_NO).collect()
    with open(os.path.join(emb, "ids.tsv"), "w") as a, open(os.path.join(emb, "titles.tsv"), "w") as b, \
            open(os.path.join(emb, "vectors.tsv"), "w") as c:
        for r in vecs:
            a.write(f"{r.prod_no}\n")
            b.write(f"{r.prod_nm}\n")
            c.write("\t".join(repr(x) for x in r.vector) + "\n")
    return root


def test_feature_sort_aggregate_jobs(spark, files):
    out = os.path.join(files, "features")
    jobs.feature_job(spark, os.path.join(files, "log"), os.path.join(files, "meta"), "click", 3,
                     fx.P1_START, fx.P1_END, out)
    back = spark.read.option("header", True).csv(out)
    expected = registry.p1_feature_clicks(spark, SF001)
    assert back.count() == expected.count() > 0
    # the F7 semi join (USING prod_no) puts the key first, as the original job's output does
    assert back.columns == [S.PRODUCT_NO] + [c for c in S.FEATURE_COLUMNS if c != S.PRODUCT_NO]
    agg = jobs.aggregate_job(spark, out, os.path.join(files, "aggregated"), single_file=True)
    assert _same(agg, aggregate_log(expected))
    sorted_log = jobs.sort_job(spark, os.path.join(files, "log"), "timestamp", os.path.join(files, "sorted"))
    assert sorted_log.count() == spark.read.csv(os.path.join(files, "sorted")).count()


def test_instances_and_evaluate_jobs(spark, files):
    out = os.path.join(files, "instances_out")
    jobs.instances_job(spark, os.path.join(files, "orders"), out, os.path.join(files, "blacklist.txt"),
                       os.path.join(files, "clicks"), os.path.join(files, "meta", "prod_category.csv"),
                       os.path.join(files, "emb"), version="6w")
    inst = spark.read.parquet(os.path.join(out, "instances"))
    t = registry._event_instances(spark, SF001)
    # same instances as the in-memory pipeline apart from the split bounds (6w preset here)
    assert inst.count() == t.instances.count()
    assert _same(inst.drop("split"), t.instances.drop("split"))
    items = spark.read.parquet(os.path.join(out, "items"))
    assert {"prod_no", "prod_idx", "title", "vector", "categories"} <= set(items.columns)
    stats = {r[0]: int(r[1]) for r in spark.read.option("header", True).csv(os.path.join(out, "stats")).collect()}
    assert stats["items"] == items.count()
    metrics = jobs.evaluate_job(spark, out, os.path.join(files, "eval"), "average", split="test")
    assert metrics.count() >= 1
    assert os.path.isdir(os.path.join(files, "eval", "predictions"))


def test_metadata_and_titles_jobs(spark, files):
    d = SF001
    raw = os.path.join(files, "raw")
    K.write_csv(fx.raw_users(spark, d), os.path.join(raw, "user"))
    K.write_csv(fx.comp_mid_mapping(spark, d), os.path.join(raw, "comp_mid"))
    K.write_csv(fx.product_raw(spark, d), os.path.join(raw, "product"))
    K.write_csv(fx.category_raw(spark, d), os.path.join(raw, "category"))
    K.write_csv(fx.deal_item_raw(spark, d), os.path.join(raw, "deal_item"))
    K.write_csv(fx.prod_category(spark, d), os.path.join(raw, "prod_category"))
    K.write_csv(fx.valid_products(spark, d), os.path.join(raw, "valid"))
    fx.search_words(spark, d).coalesce(1).write.text(os.path.join(raw, "words"))
    sources = {e: os.path.join(raw, e) for e in ("user", "comp_mid", "product", "category", "deal_item", "prod_category")}
    out = jobs.metadata_job(spark, sources, os.path.join(files, "prepared"),
                            search_words_path=os.path.join(raw, "words"),
                            valid_products_path=os.path.join(raw, "valid"))
    expected = prepare_product(fx.product_raw(spark, d), fx.valid_products(spark, d), fx.search_words(spark, d))
    assert _same(out["product"], expected)
    assert out["user"].count() == fx.users(spark, d).where("m_id like 'U%'").count()
    assert spark.read.option("header", True).csv(os.path.join(files, "prepared", "deal_item")).count() \
        == out["deal_item"].count()
    vecs = jobs.titles_job(spark, os.path.join(files, "prepared", "product"), os.path.join(files, "titles"),
                           vector_size=8)
    assert vecs.count() == out["product"].count()
    back = R.read_vectors_tsv(spark, os.path.join(files, "titles", "tsv"))
    assert _same(back, vecs) and {len(r.vector) for r in back.collect()} == {8}


def test_titles_to_instances_to_evaluation(spark, files):
    titles, out = os.path.join(files, "titles_all"), os.path.join(files, "instances_titles")
    jobs.titles_job(spark, os.path.join(files, "meta", "product.csv"), titles)
    jobs.instances_job(spark, os.path.join(files, "orders"), out, clicks_path=os.path.join(files, "clicks"),
                       titles_dir=titles, strict=True)
    items = spark.read.parquet(os.path.join(out, "items"))
    assert items.count() == items.where("title is not null and size(vector) = 64").count() > 0
    assert jobs.evaluate_job(spark, out, os.path.join(files, "eval_titles"), "average").count() >= 1


def test_member_mapping_is_stored_and_extended(spark, files):
    def users(name, ids):
        path = os.path.join(files, name)
        K.write_csv(spark.createDataFrame([("F", 30, i) for i in ids], "sex string, age int, m_id string").select(
            F.lit(1).alias(S.SEX), F.col("age").alias(S.AGE), F.col("m_id").alias(S.MEMBER_ID)), path)
        return path

    def run(source, name, **more):
        out = os.path.join(files, name)
        jobs.metadata_job(spark, source, out, ("user",), **more)
        rows = spark.read.option("header", True).csv(os.path.join(out, "comp_mid")).collect()
        bad = {(r["column"], r.rule): int(r.violations) for r in spark.read.option("header", True).csv(os.path.join(out, "constraints")).collect()}
        return os.path.join(out, "comp_mid"), {r[S.MEMBER_ID]: r[S.COMP_MEMBER_ID] for r in rows}, bad

    path, first, bad = run({"user": users("u1", ["B", "D", None])}, "codes1")
    assert set(first) == {"B", "D"} and bad[S.MEMBER_ID, "left out, no id"] == 1
    path, second, bad = run({"user": users("u2", ["A", "C", "D"]), "comp_mid": path}, "codes2", extend=True)
    assert set(second) == {"A", "B", "C", "D"} and len(set(second.values())) == 4
    assert all(second[k] == v for k, v in first.items()) and bad[S.COMP_MEMBER_ID, "duplicate_key"] == 0


def test_command_line(spark, files):
    from basketry.__main__ import main
    log = os.path.join(files, "log")
    main(["search_words", log, os.path.join(files, "words_out")])
    words = {r.value for r in spark.read.text(os.path.join(files, "words_out")).collect()}
    assert words == {r.word for r in fx.search_words(spark, SF001).collect()}
    main(["orders", log, os.path.join(files, "orders_out")])        # no band: every part counts
    whole = spark.read.csv(os.path.join(files, "orders_out")).count()
    assert whole == spark.read.csv(log).where("_c1 like 'O%'").count() > 0
    main(["orders", log, os.path.join(files, "orders_band"), "--min-bytes", str(13 << 20)])
    assert spark.read.csv(os.path.join(files, "orders_band")).count() == 0
    main(["sort", log, "prod_no", os.path.join(files, "sorted_cli")])
    assert spark.read.csv(os.path.join(files, "sorted_cli")).count() == 1000
