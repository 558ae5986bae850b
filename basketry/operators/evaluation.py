"""Recommendation evaluation: hit-rate, cross-entropy, case reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions.arrays import PAD, dot
from .sequences import sequence_context

#: instance ids are (user << 32) + position: a chunk numbers the cases of 4,096 users
IDS_A_CHUNK = 4096 << 32

# Report line formats.
ORDER_LINE, ANSWER_LINE, SCORE_LINE = "[ORDER %02d] %s", "[ANSWER] %s", "[%6.3f] %s"


def hits(top: DataFrame, labels: DataFrame, id_col: str = "instance_id", item_col: str = S.PROD_IDX,
         label_col: str = "label", group_cols: tuple[str, ...] = ()) -> DataFrame:
    """Per scored instance (and scorer): 1 when its label is among its top-k items, else 0."""
    lab = labels.select(id_col, label_col)
    return top.join(lab, on=id_col).groupBy(*group_cols, id_col).agg(
        F.max((F.col(item_col) == F.col(label_col)).cast("int")).alias("hit"))


def hit_rate(hit_rows: DataFrame, group_cols: list[str]) -> DataFrame:
    """Share of instances with a hit, in percent, per group."""
    return hit_rows.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("instances"),
                                             (F.avg("hit") * 100).alias("hit_rate"))


def cross_entropy(lse: DataFrame, sessions: DataFrame, labels: DataFrame, item_vectors: DataFrame,
                  id_col: str = "instance_id", label_col: str = "label", item_col: str = S.PROD_IDX,
                  session_col: str = "session", group_cols: tuple[str, ...] = ()) -> DataFrame:
    """A10 per instance (and scorer): log-sum-exp of all scores minus the label's score."""
    keys = [id_col, *group_cols]
    lab = labels.select(id_col, F.col(label_col).alias(item_col)) \
        .join(item_vectors.select(item_col, F.col("vector").alias("_lv")), on=item_col)
    return (lse.join(sessions.select(*keys, F.col(session_col).alias("_sv")), on=keys).join(lab, on=id_col)
            .select(*keys, (F.col("lse") - dot("_sv", "_lv")).alias("loss")))


def case_report(instances: DataFrame, top: DataFrame, hit_rows: DataFrame, titles: DataFrame,
                id_col: str = "instance_id", item_col: str = S.PROD_IDX, title_col: str = "title",
                positive_cases: int | None = None, negative_cases: int | None = None) -> DataFrame:
    """K7 + W7: a text report per instance (history titles, answer, k scored titles),
    numbered per outcome in instance order; all of them unless a cap is given.

    The numbers come from :func:`sequence_context`, which splits the two
    outcomes into chunks of ids instead of sorting each in one task.
    """
    t = titles.select(item_col, title_col)
    numbered = hit_rows.withColumn("outcome", F.when(F.col("hit") == 1, F.lit("positives")).otherwise(F.lit("negatives")))
    numbered = sequence_context(numbered, "outcome", [id_col], pos_col="_n", chunk=IDS_A_CHUNK) \
        .withColumn("case_no", (F.col("_n") + 1).cast("int"))
    for outcome, cap in (("positives", positive_cases), ("negatives", negative_cases)):
        if cap is not None:
            numbered = numbered.where((F.col("outcome") != outcome) | (F.col("case_no") <= cap))
    hist = (instances.select(id_col, F.posexplode("orders").alias("_p", item_col)).where(F.col(item_col) != PAD)
            .join(numbered.select(id_col), on=id_col, how="left_semi")
            .join(t, on=item_col, how="left"))
    hist_text = hist.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("_p", title_col))).alias("_h")) \
        .select(id_col, F.array_join(F.transform(
            F.zip_with(F.col("_h"), F.sequence(F.lit(1), F.size("_h")),
                       lambda s, i: F.format_string(ORDER_LINE, i, F.coalesce(s[title_col], F.lit("")))),
            lambda x: x), "\n").alias("_orders"))
    answer = instances.select(id_col, F.col("label").alias(item_col)).join(
        numbered.select(id_col), on=id_col, how="left_semi").join(t, on=item_col, how="left") \
        .select(id_col, F.format_string(ANSWER_LINE, F.coalesce(F.col(title_col), F.lit(""))).alias("_answer"))
    preds = (top.join(numbered.select(id_col), on=id_col, how="left_semi").join(t, on=item_col, how="left")
             .groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("rank", "score", title_col))).alias("_r"))
             .select(id_col, F.array_join(F.transform("_r", lambda s: F.format_string(
                 SCORE_LINE, s["score"], F.coalesce(s[title_col], F.lit("")))), "\n").alias("_preds")))
    body = F.concat_ws("\n\n", F.coalesce(F.col("_orders"), F.lit("")), F.col("_answer"), F.col("_preds"))
    return (numbered.join(hist_text, on=id_col, how="left").join(answer, on=id_col).join(preds, on=id_col)
            .select("outcome", "case_no", id_col, body.alias("text")))
