"""File-to-file jobs: readers -> pipeline -> writers, one function per job.

These are the batch entry points a user runs (see ``python -m basketry -h``);
each one only wires sources, a pipeline from this package and sinks.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas as S
from ..operators.quality import all_violations
from ..operators.sequences import split_bounds
from ..sources import readers as R
from ..sources import sinks as K
from .behaviour import aggregate_log
from .feature import generate_features, sort_log
from .instances import (DEFAULT_ITEM_CUT, DEFAULT_MAX_CLICKS, DEFAULT_MAX_ORDERS, DEFAULT_MIN_ORDERS,
                        InstanceTables, build_instances, instance_stats, item_table)
from .metadata import ENTITIES, prepare_metadata
from .recommend import DEFAULT_TOP_K, evaluate, prediction_report, with_instance_id
from .titles import item_title_vectors

# Metadata file names inside a metadata directory.
METADATA_FILES = {"user": "user.csv", "product": "product.csv", "category": "category.csv",
                  "prod_category": "prod_category.csv", "deal_item": "deal_item.csv", "comp_mid": "comp_mid.csv"}


def feature_job(spark: SparkSession, useraction_dir: str, metadata_dir: str, action: str, prod_threshold: int,
                start_date: str, end_date: str, output_dir: str) -> DataFrame:
    """Log CSV parts + metadata CSVs -> feature CSV directory with header."""
    meta = {e: R.read_metadata(spark, os.path.join(metadata_dir, METADATA_FILES[e]), e)
            for e in ("user", "product", "prod_category", "category")}
    out = generate_features(R.read_useraction(spark, useraction_dir), meta["user"], meta["product"],
                            meta["prod_category"], meta["category"], action, start_date, end_date, prod_threshold)
    K.write_csv(out, output_dir, header=True)
    return out


def sort_job(spark: SparkSession, useraction_dir: str, column: str, output_dir: str) -> DataFrame:
    """Log CSV parts sorted by one column -> CSV directory without header."""
    out = sort_log(R.read_useraction(spark, useraction_dir), column)
    K.write_csv(out, output_dir, header=False)
    return out


def aggregate_job(spark: SparkSession, feature_dir: str, output: str, single_file: bool = False) -> DataFrame:
    """Feature CSV parts -> deduplicated, sorted behaviour CSV."""
    out = aggregate_log(R.read_csv_parts(spark, feature_dir, S.FEATURE))
    (K.write_single_csv if single_file else K.write_csv)(out, output)
    return out


def instances_job(spark: SparkSession, orders_path: str, output_dir: str, blacklist_path: str | None = None,
                  clicks_path: str | None = None, categories_path: str | None = None,
                  embedding_dir: str | None = None, version: str = "6w", item_cut: int = DEFAULT_ITEM_CUT,
                  min_orders: int = DEFAULT_MIN_ORDERS, max_orders: int = DEFAULT_MAX_ORDERS,
                  max_clicks: int = DEFAULT_MAX_CLICKS, titles_dir: str | None = None, strict: bool = False) -> DataFrame:
    """Behaviour CSVs -> instances by split (K4), user/item tables (K5), stats (K6).

    Titles and vectors of items come from ``titles_dir``, the output of
    :func:`titles_job`, or from the three line-aligned files in
    ``embedding_dir``. With ``strict`` an item without a vector stops the job.
    """
    cols = [S.COMP_MEMBER_ID, S.TIMESTAMP, S.PRODUCT_NO, S.PRODUCT_NAME]
    orders = R.read_behaviours(spark, orders_path, cols)
    clicks = R.read_behaviours(spark, clicks_path, cols) if clicks_path else None
    blacklist = R.read_lines(spark, blacklist_path) if blacklist_path else []
    ts_val, ts_test = split_bounds(version)
    t = build_instances(orders, clicks, blacklist, ts_val, ts_test, item_cut, min_orders, max_orders, max_clicks)
    K.save_instances(t.instances, os.path.join(output_dir, "instances"))
    K.save_index(t.users, os.path.join(output_dir, "users"))
    lookup = None
    if titles_dir:  # a product id that repeats keeps one row
        vectors = R.read_index(spark, os.path.join(titles_dir, "vectors"))
        lookup = vectors.groupBy(S.PRODUCT_NO).agg(F.max(F.struct("title", "vector")).alias("_r")).select(S.PRODUCT_NO, "_r.*")
    elif embedding_dir:
        lookup = R.read_lookup(spark, *(os.path.join(embedding_dir, f) for f in ("ids.tsv", "titles.tsv", "vectors.tsv")))
    cats = R.read_metadata(spark, categories_path, "prod_category") if categories_path else None
    items = item_table(t.items, lookup.select(S.PRODUCT_NO, F.col("title").alias(S.PRODUCT_NAME)) if lookup else None,
                       lookup.select(S.PRODUCT_NO, "vector") if lookup else None, cats, strict)
    K.save_index(items, os.path.join(output_dir, "items"))
    # the stats count what was written instead of building it again
    read = lambda name: R.read_index(spark, os.path.join(output_dir, name))
    written = InstanceTables(read("instances"), read("users"), read("items"))
    K.save_stats(instance_stats(written), os.path.join(output_dir, "stats"))
    return t.instances


def metadata_job(spark: SparkSession, sources: dict[str, str], output_dir: str, which: tuple[str, ...] = (),
                 search_words_path: str | None = None, valid_products_path: str | None = None,
                 prepared_product_path: str | None = None, seed: int = 0, jdbc_url: str | None = None,
                 jdbc_properties: dict[str, str] | None = None, single_file: bool = False,
                 extend: bool = False) -> dict[str, DataFrame]:
    """P5: raw metadata CSVs (``sources``: entity -> path) -> prepared CSV directories (K1;
    one file each with ``single_file``, K2), optionally appended to SQL tables (K3).

    With users, the member mapping is stored as ``comp_mid``: the given one and
    the codes made in this run. Give it back as source ``comp_mid`` (from
    another ``output_dir``) to keep every code; ``extend`` then also gives codes
    to members that it lacks. The violations of Q1-Q3 in the written tables, and
    the raw users left out for want of a member id, go to ``constraints``.
    """
    chosen = tuple(w.lower() for w in which) or ENTITIES

    def read(entity: str, schema) -> DataFrame | None:
        # raw exports may carry extra columns: cast the known ones, keep the rest
        if entity not in sources:
            return None
        return R.cast_known(R.read_csv_with_header(spark, sources[entity]), schema)

    mapping = R.read_metadata(spark, sources["comp_mid"], "comp_mid") if "comp_mid" in sources else None
    users = read("user", S.USER_RAW) if "user" in chosen else None
    words = R.read_lines(spark, search_words_path, strip=False).withColumnRenamed("value", "word") \
        if search_words_path else None
    valid = R.read_valid_products(spark, valid_products_path) if valid_products_path else None
    prepared = R.read_metadata(spark, prepared_product_path, "product") if prepared_product_path else None
    out = prepare_metadata(chosen, users=users, mapping=mapping, product=read("product", S.PRODUCT),
                           valid_products=valid, search_words=words, category=read("category", S.CATEGORY_RAW),
                           deal_item=read("deal_item", S.DEAL_ITEM_RAW),
                           prod_category=read("prod_category", S.PROD_CATEGORY),
                           prepared_product=prepared, seed=seed, extend=extend)
    write = K.write_single_csv if single_file else K.write_csv
    written = {}
    for entity, df in out.items():
        write(df, os.path.join(output_dir, entity))
        written[entity] = R.cast_known(R.read_csv_with_header(spark, os.path.join(output_dir, entity)), S.METADATA[entity])
        if jdbc_url:
            K.write_sql(written[entity], jdbc_url, K.SQL_TABLES[entity], jdbc_properties)
    violations = all_violations(written)
    if "user" in out:
        codes = written["user"].select(S.MEMBER_ID, S.COMP_MEMBER_ID)
        known = codes if mapping is None else codes.unionByName(mapping.select(*codes.columns))
        write(known.where(F.col(S.MEMBER_ID).isNotNull()).distinct(), os.path.join(output_dir, "comp_mid"))
        violations = violations.unionByName(users.agg(F.count_if(F.col(S.MEMBER_ID).isNull()).alias("violations")).select(
            F.lit("user").alias("table"), F.lit(S.MEMBER_ID).alias("column"), F.lit("left out, no id").alias("rule"), "violations"))
    K.write_single_csv(violations, os.path.join(output_dir, "constraints"))
    return out


def titles_job(spark: SparkSession, product_path: str, output_dir: str, vector_size: int = 64,
               window: int = 2, learned: bool = False) -> DataFrame:
    """Product titles -> title vectors (Parquet, read by ``instances_job``) and a TSV export (K8)."""
    products = R.read_metadata(spark, product_path, "product")
    vecs = item_title_vectors(products, vector_size=vector_size, learned=learned, **({"window": window} if learned else {}))
    vecs.write.mode("overwrite").parquet(os.path.join(output_dir, "vectors"))
    vecs = R.read_index(spark, os.path.join(output_dir, "vectors"))
    K.export_vectors_tsv(vecs, os.path.join(output_dir, "tsv"))
    return vecs


def evaluate_job(spark: SparkSession, data_dir: str, output_dir: str, algorithm: str = "last",
                 top_k: int = DEFAULT_TOP_K, pos_cases: int | None = None, neg_cases: int | None = None,
                 split: str = "test") -> DataFrame:
    """Saved instances + items -> metrics per split and the case report of one split."""
    inst = with_instance_id(R.read_instances(spark, os.path.join(data_dir, "instances"), with_clicks=True))
    items = R.read_index(spark, os.path.join(data_dir, "items"))
    vectors = items.select(S.PROD_IDX, "vector").where(F.col("vector").isNotNull())
    metrics = evaluate(inst, vectors, (algorithm,), top_k)
    metrics.coalesce(1).write.mode("overwrite").option("header", True).csv(os.path.join(output_dir, "metrics"))
    if "title" in items.columns:
        titles = items.select(S.PROD_IDX, "title")
        report = prediction_report(inst.where(F.col("split") == split), vectors, titles, algorithm, top_k,
                                   positive_cases=pos_cases, negative_cases=neg_cases)
        K.save_case_report(report, os.path.join(output_dir, "predictions"))
    return metrics


def orders_job(spark: SparkSession, useraction_dir: str, output: str,
               min_bytes: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Order rows of the log (of the parts within a size band, if given) -> CSV without header."""
    out = R.extract_orders(R.read_useraction(spark, useraction_dir), min_bytes, max_bytes)
    K.write_csv(out, output, header=False)
    return out


def search_words_job(spark: SparkSession, useraction_dir: str, output: str) -> DataFrame:
    """Distinct non-empty search keywords of the log -> one word per line."""
    out = R.extract_search_words(R.read_useraction(spark, useraction_dir))
    out.write.mode("overwrite").text(output)
    return out
