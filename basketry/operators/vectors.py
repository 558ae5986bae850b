"""Item-vector lookups and session vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas as S
from ..functions.arrays import PAD, dot, let, softmax, valid_length, vec_scale, vec_sum

SESSION_MODES = ("last", "average", "attention", "click_attention")


def sequence_vectors(df: DataFrame, vectors: DataFrame, id_col: str, seq_col: str, out_col: str,
                     item_col: str = S.PROD_IDX, vector_col: str = "vector") -> DataFrame:
    """The vectors of a sequence's items in sequence order (pads and items
    without a vector left out). Returns ``(id_col, out_col)``; rows whose
    sequence yields no vector are absent.

    The per-position join is an ordinary equi-join on the item (broadcast by
    Spark when the vector table is small, sort-merge with skew splitting
    otherwise); each regrouped row holds at most the sequence width.
    """
    pos = df.select(id_col, F.posexplode(seq_col).alias("_pos", item_col)).where(F.col(item_col) != PAD)
    looked = pos.join(vectors.select(item_col, vector_col), on=item_col, how="inner")
    ordered = F.array_sort(F.collect_list(F.struct("_pos", F.col(vector_col).alias("_v"))))
    return looked.groupBy(id_col).agg(F.transform(ordered, lambda s: s["_v"]).alias(out_col))


def _weighted_sum(vecs: Column, weights: Column) -> Column:
    return vec_sum(F.zip_with(vecs, weights, lambda v, w: vec_scale(v, w)))


def _mean(vecs: Column) -> Column:
    """Element-wise sum over A6's valid length (null when no vector is non-zero)."""
    return let(vecs, lambda vs: let(valid_length(vs), lambda n: F.when(n > 0, F.transform(vec_sum(vs), lambda x: x / n))))


def attention_pool(vecs: Column, key: Column) -> Column:
    """softmax(dot(v_i, key)) weighted sum of the position vectors."""
    return let(vecs, lambda vs: let(key, lambda k: _weighted_sum(vs, softmax(F.transform(vs, lambda v: dot(v, k))))))


def _session_exprs(modes: tuple[str, ...]) -> dict[str, tuple]:
    """Per mode: (session vector, optional [context, last] concatenation) over ``_ov``/``_cv``."""
    last = F.element_at("_ov", -1)
    out = {}
    for mode in modes:
        if mode == "last":
            out[mode] = (last, None)
        elif mode == "average":
            out[mode] = (_mean(F.col("_ov")), None)
        elif mode == "attention":
            ctx = attention_pool(F.col("_ov"), last)
            out[mode] = (ctx, F.concat(ctx, last))
        elif mode == "click_attention":
            ctx = attention_pool(F.col("_ov"), F.coalesce(_mean(F.col("_cv")), last))
            out[mode] = (ctx, F.concat(ctx, last))
        else:
            raise ValueError(f"unknown session mode {mode}")
    return out


def _sequences(instances: DataFrame, vectors: DataFrame, modes: tuple[str, ...], id_col: str,
               orders_col: str, clicks_col: str, item_col: str) -> DataFrame:
    seq = sequence_vectors(instances, vectors, id_col, orders_col, "_ov", item_col)
    if "click_attention" in modes:
        clicks = sequence_vectors(instances, vectors, id_col, clicks_col, "_cv", item_col)
        seq = seq.join(clicks, on=id_col, how="left")
    return seq


def session_vectors(instances: DataFrame, vectors: DataFrame, mode: str, id_col: str = "instance_id",
                    orders_col: str = "orders", clicks_col: str = "clicks",
                    item_col: str = S.PROD_IDX) -> DataFrame:
    """One query vector per instance, ``(id_col, session[, session_concat])``.

    * ``last``: vector of the most recent ordered item;
    * ``average``: mean of the ordered items' vectors (A6/A7);
    * ``attention``: attention pooling of the order vectors keyed by the last one
      (parameter-free form); the [context, last] concatenation is ``session_concat``;
    * ``click_attention``: the same keyed by the mean click vector (the last
      order vector when there are no clicks).

    Instances without any order vector get no row (they are not scored).
    """
    vec, concat = _session_exprs((mode,))[mode]
    seq = _sequences(instances, vectors, (mode,), id_col, orders_col, clicks_col, item_col)
    cols = [F.col(id_col), vec.alias("session")] + ([concat.alias("session_concat")] if concat is not None else [])
    return seq.select(*cols).where(F.col("session").isNotNull())


def session_vectors_by_mode(instances: DataFrame, vectors: DataFrame, modes: tuple[str, ...],
                            id_col: str = "instance_id", orders_col: str = "orders", clicks_col: str = "clicks",
                            item_col: str = S.PROD_IDX) -> DataFrame:
    """Several scorers at once, ``(id_col, scorer, session)``: the vector lookups
    (J7) run once and each instance yields one row per scorer."""
    exprs = _session_exprs(tuple(modes))
    seq = _sequences(instances, vectors, tuple(modes), id_col, orders_col, clicks_col, item_col)
    per_mode = F.array(*[F.struct(F.lit(m).alias("scorer"), exprs[m][0].alias("session")) for m in modes])
    return (seq.select(id_col, F.explode(per_mode).alias("_s"))
            .select(id_col, "_s.scorer", "_s.session").where(F.col("session").isNotNull()))
