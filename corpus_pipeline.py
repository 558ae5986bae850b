"""The training-data pipeline: five stages over ``documents``, each stored and read again.

1. quality: the pairwise ranking scores every document; rejected ones go.
2. near duplicates: of each component of similar rows one stays, that with the
   smallest id (a null one is the last, ties go to the first row). Rows are
   told apart by their own key, so ids may repeat or be null.
3. decontamination: documents that count as contaminated go.
4. personal data: every span found is replaced by its kind in brackets.
5. packing: every document gets its bucket, batch and place.

The labels for stage 1 are the table beside the documents. Every stage keeps
the columns of ``documents`` but the last, which returns the packing plan.

Defined cases: a null or empty text is scored as an empty one and, if kept,
similar to nothing, uncontaminated and packed with no words; rows with a null or
repeated id are documents like any other; an empty table passes through every stage; other
columns may have any name, also that of an operator's own columns, since the
operators see them under neutral names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import decontamination, jaccard_join, packing, pii, quality_ranking
from basketry.llm.common import remainder, stored, table


def neutral(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns but ``doc_id`` and ``text`` under names that no operator uses, by position."""
    return docs.toDF(*[c if c in ("doc_id", "text") else f"_extra{i}" for i, c in enumerate(docs.columns)])


def restored(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, in its order and under its names, from rows of ``neutral(docs)``."""
    return kept.select(*neutral(docs).columns).toDF(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    sample = quality_ranking.labelled_sample(table(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 4) != 2, "quality", quality_ranking.MAX_LABELLED)
    rows = neutral(docs)
    ranker = quality_ranking.fit(rows, sample, "doc_id", "text")
    return restored(quality_ranking.score(rows, ranker).where(F.col("score") >= quality_ranking.ACCEPT), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = neutral(docs)
    integral = isinstance(rows.schema["doc_id"].dataType, T.IntegralType)
    if integral and rows.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():  # the id is the row's key
        gone = jaccard_join.similar_documents(rows).where("component_id <> doc_id").select("doc_id")
        return restored(rows.join(gone, "doc_id", "left_anti"), docs)
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = jaccard_join.similar_documents(rows.select(F.col("_row").alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row")
    first = rows.select("_row", "doc_id").join(found, "_row").groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first._row").alias("_row"))
    return restored(rows.join(first, "_row", "left_semi"), docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontamination.hits(neutral(docs), table(spark, sf_dir, "benchmark"))
    n_hit = F.expr("aggregate(spans, 0L, (a, x) -> x - a)")
    return restored(found.where(~((n_hit > 0) & (decontamination.ONE_IN * n_hit >= F.col("n_words")))), docs)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return restored(pii.masked(neutral(docs)), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(neutral(docs))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("PII", without_pii),
    ("packing", packed),
]

#: The ranking is fitted and the personal-data classifier estimated, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{k + 1}")
    return docs
