"""Quality classifier: Bradley-Terry ranking from preference pairs.

A good labelled document is preferred to a bad one; the chance that i beats j
is logistic(w . (x_i - x_j)). The weights minimise the logistic loss over such
pairs, found by Newton steps. A document's raw score is w . x; the threshold
is the quantile of the labelled scores that separates the labels best, and the
reported score is logistic(raw - threshold) shifted so that the threshold is
``accept``.

Features come from each whole text in one pass (byte histogram, words, repeated
words and lines). The fit uses a bounded sample of labelled rows
(``max_labelled``); scoring covers every document without a shuffle. Labels,
language, source and id are never features.

Defined cases: a null or empty text has the features of an empty text and is
scored; null ids or labels are never learned from; repeated rows are scored
each; without both labels every score is ``accept``, so nothing is rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import chunks, utf8
from .common import bounded_share, hash32, remainder, ship, shipped, small

MAX_LABELLED, MAX_PAIRS, ACCEPT, RIDGE = 20_000, 200_000, 0.7, 1e-3
SYMBOL_BYTES = [*b"#*$%&|<>"]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def features(batch: pa.RecordBatch, text_col: str) -> np.ndarray:
    """One row of features per document of the batch."""
    data, offsets = utf8(batch.column(text_col))
    rows = np.zeros((len(offsets) - 1, 16))
    for i in range(len(rows)):
        raw = data[offsets[i]:offsets[i + 1]]
        n = len(raw)
        c = np.bincount(raw, minlength=256) if n else np.zeros(256, dtype=np.int64)
        text = raw.tobytes()
        words = text.split()
        lines = [x for x in text.split(b"\n") if x.strip()]
        w, m = max(1, len(words)), max(1, n)
        upper, lower, digit = c[65:91].sum(), c[97:123].sum(), c[48:58].sum()
        letters = upper + lower + c[128:].sum()
        rows[i] = (
            c[SYMBOL_BYTES].sum() / w, c[33] / w, c[124] / w, upper / max(1, upper + lower), digit / m, letters / m,
            (c[44] + c[46]) / w, c[10] / w, n / w / 10, math.log1p(len(words)) / 10, math.log1p(math.log1p(len(words))),
            len(set(words)) / w, 1 - len(set(lines)) / max(1, len(lines)), (c[123] + c[125] + c[91] + c[93] + c[61]) / w,
            min(1.0, 10 / w), (c[63] + c[34] + c[39]) / w)
    return np.minimum(rows, 4.0)


def featured(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` without its text, with a column ``x`` of features."""
    kept = [f for f in docs.schema.fields if f.name != text_col]
    schema = T.StructType([*kept, T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text_col):
            x = features(batch, text_col)
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))],
                                             names=[*(f.name for f in kept), "x"])

    return docs.mapInArrow(run, schema)


class Ranker:
    """Weights, centre, scale and threshold of a fitted ranking."""

    def __init__(self, x: np.ndarray, y: np.ndarray, max_pairs: int = MAX_PAIRS, accept: float = ACCEPT):
        self.accept = accept
        self.centre, self.scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
        z = (x - self.centre) / self.scale
        good, bad = z[y == 1], z[y == 0]
        self.w, self.threshold = np.zeros(x.shape[1]), 0.0
        if not len(good) or not len(bad):
            return
        rng = np.random.default_rng(5)
        n = min(max_pairs, len(good) * len(bad))
        d = good[rng.integers(0, len(good), n)] - bad[rng.integers(0, len(bad), n)]
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(d @ self.w, -30, 30)))
            grad = d.T @ (1 - p) / n - RIDGE * self.w
            hess = (d * (p * (1 - p))[:, None]).T @ d / n + RIDGE * np.eye(len(self.w))
            step = np.linalg.solve(hess, grad)
            self.w += step
            if np.abs(step).max() < 1e-6:
                break
        raw = z @ self.w
        order = np.argsort(raw, kind="stable")
        s, yes = raw[order], y[order] == 1
        # share of bad below plus share of good at or above each cut, at every quantile
        quality = np.concatenate([[0], np.cumsum(~yes)]) / max(1, (~yes).sum()) + np.concatenate([yes[::-1].cumsum()[::-1], [0]]) / max(1, yes.sum())
        quality[1:-1][s[1:] == s[:-1]] = -1
        best = np.flatnonzero(quality >= quality.max() - 1e-12)
        cut = int(best[len(best) // 2])
        self.quantile = cut / len(s)
        self.threshold = float(s[0] - 1 if cut == 0 else s[-1] + 1 if cut == len(s) else (s[cut - 1] + s[cut]) / 2)

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = ((x - self.centre) / self.scale) @ self.w - self.threshold
        return 1 / (1 + np.exp(-np.clip(raw + math.log(self.accept / (1 - self.accept)), -30, 30)))


def labelled_sample(labels: DataFrame, learn: Column, label_col: str, max_labelled: int) -> DataFrame:
    """(doc_id, y) for learning: one row per id, a hash sample of about ``max_labelled`` where there are more."""
    usable = labels.where(learn & F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1)).groupBy("doc_id").agg(F.min(label_col).alias("y"))
    share = bounded_share(usable.count(), max_labelled)
    return usable.where(hash32(F.col("doc_id")) < share)


def fit(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str, **options) -> Ranker:
    """Rank the documents of a bounded labelled sample."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(small(sample)), "doc_id")
    got = featured(rows, "text").select("doc_id", "x", "y").orderBy("doc_id", "x").toPandas()  # pairs are drawn by place, so the files' order must not matter
    x = np.array(got.x.tolist(), dtype=float).reshape(len(got), -1) if len(got) else np.zeros((0, 16))
    return Ranker(x, got.y.to_numpy(dtype=float) if len(got) else np.zeros(0), **options)


def score(docs: DataFrame, ranker: Ranker, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``score``; every other column stays."""
    if "score" in docs.columns:
        raise ValueError("docs must not have a column score")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    shared = ship(docs.sparkSession, ranker)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shipped(shared)
        for batch in chunks(batches, text_col):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fitted.score(features(batch, text_col)))], names=[*batch.schema.names, "score"])

    return docs.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score and predicted for every document; folds by crc32 of the id modulo 4."""
    sample = labelled_sample(labels, remainder(F.col("doc_id"), 4) != 2, "quality", max_labelled)
    ranker = fit(docs, sample, id_col, text_col)
    scored = score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), ranker)
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score",
                         F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"))


__all__ = ["Ranker", "features", "fit", "labelled_sample", "quality_scores", "score"]
