"""P7 recommend + evaluate, and T4 similar items."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from .. import schemas as S
from ..functions.arrays import unit
from ..operators import evaluation as ev
from ..operators.scoring import ScoreResult, top_k_scores
from ..operators.vectors import session_vectors, session_vectors_by_mode
from ..session import materialize

DEFAULT_TOP_K = 10


def with_instance_id(instances: DataFrame, id_col: str = "instance_id") -> DataFrame:
    """A unique id per instance from (user index, position)."""
    return instances.withColumn(id_col, F.shiftleft(F.col(S.USER_IDX).cast("long"), 32) + F.col("position"))


@dataclass
class Recommendation:
    sessions: DataFrame
    scores: ScoreResult


def recommend(instances: DataFrame, item_vectors: DataFrame, mode: str, k: int = DEFAULT_TOP_K,
              rank_decimals: int | None = None, id_col: str = "instance_id", with_lse: bool = True) -> Recommendation:
    """Session vector (T5-T7) -> score all items (J8) -> top k (W6) (+ log-sum-exp for A10)."""
    sess = session_vectors(instances, item_vectors, mode, id_col)
    return Recommendation(sess, top_k_scores(sess, item_vectors, k, id_col, rank_decimals=rank_decimals,
                                             with_lse=with_lse))


def evaluate(instances: DataFrame, item_vectors: DataFrame, modes: tuple[str, ...] = ("last", "average"),
             k: int = DEFAULT_TOP_K, rank_decimals: int | None = None, id_col: str = "instance_id") -> DataFrame:
    """Per scorer and split the scored instances, hit-rate@k (A9) and mean loss (A10).

    Both metrics cover the same instances: those with a session vector and a
    label that has an item vector. ``left_out`` counts the split's others. All
    scorers share one vector lookup and one blocked scoring pass, keyed by
    (scorer, instance).
    """
    every = instances.select(id_col, "label", "split")
    labels = every.join(item_vectors.select(F.col(S.PROD_IDX).alias("label")), on="label", how="left_semi")
    sess = session_vectors_by_mode(instances, item_vectors, tuple(modes), id_col)
    res = top_k_scores(sess, item_vectors, k, id_col, rank_decimals=rank_decimals, group_col="scorer")
    h = ev.hits(res.top, labels, id_col, group_cols=("scorer",)).join(labels.select(id_col, "split"), on=id_col)
    rate = ev.hit_rate(h, ["scorer", "split"])
    loss = (ev.cross_entropy(res.lse, res.queries, labels, item_vectors, id_col, session_col="_vec",
                             group_cols=("scorer",))
            .join(labels.select(id_col, "split"), on=id_col)
            .groupBy("scorer", "split").agg(F.avg("loss").alias("loss")))
    total = every.groupBy("split").agg(F.count(F.lit(1)).alias("_all")) \
        .withColumn("scorer", F.explode(F.array(*[F.lit(m) for m in modes])))
    scored = F.coalesce("instances", F.lit(0))
    return (total.join(rate, on=["scorer", "split"], how="left").join(loss, on=["scorer", "split"], how="left")
            .select("scorer", "split", scored.alias("instances"), "hit_rate", "loss", (F.col("_all") - scored).alias("left_out")))


def prediction_report(instances: DataFrame, item_vectors: DataFrame, titles: DataFrame, mode: str = "last",
                      k: int = DEFAULT_TOP_K, rank_decimals: int | None = None, id_col: str = "instance_id",
                      positive_cases: int | None = None, negative_cases: int | None = None) -> DataFrame:
    """K7: positive / negative case texts for one scorer, all of them unless capped."""
    rec = recommend(instances, item_vectors, mode, k, rank_decimals, id_col, with_lse=False)
    top = materialize(rec.scores.top)    # read for the hits and for the texts
    h = ev.hits(top, instances.select(id_col, "label"), id_col)
    return ev.case_report(instances, top, h, titles, id_col, positive_cases=positive_cases,
                          negative_cases=negative_cases)


def similar_items(item_vectors: DataFrame, k: int = 11, exclude_self: bool = False,
                  rank_decimals: int | None = None, item_col: str = S.PROD_IDX) -> DataFrame:
    """T4: the ``k`` most cosine-similar items of every item (itself included unless excluded)."""
    # queries and items are the same rows, read for their count and for both sides: made once
    units = materialize(item_vectors.select(item_col, unit("vector").alias("vector")).where(F.col("vector").isNotNull()))
    queries = units.select(F.col(item_col).cast("long").alias("query_item"), F.col("vector").alias("session"))
    extra = 1 if exclude_self else 0
    res = top_k_scores(queries, units, k + extra, "query_item", item_col=item_col, rank_decimals=rank_decimals,
                       with_lse=False)
    top = res.top
    if exclude_self:
        # k + 1 were kept, so k remain whether or not the item itself was among them
        top = top.where(F.col(item_col) != F.col("query_item"))
        top = top.withColumn("rank", F.row_number().over(Window.partitionBy("query_item").orderBy("rank"))) \
            .where(F.col("rank") <= k)
    return top.withColumnRenamed("score", "similarity")
