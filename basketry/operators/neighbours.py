"""Approximate nearest items by an inverted cell index (T4 for large sets).

Cells are the centroids of a spherical k-means over a bounded sample of the
items; every item is then listed under its nearest cell. A query is compared
only with the items of its nearest cells, in blocks of bounded size on both
sides: a cell that holds a third of all items is as many blocks as it needs.
The number of cells probed is calibrated on the sample: the least that finds
``target`` of the sample's true neighbours. Neighbours within a sample are
farther apart than within all items, so the estimate is on the safe side.

What is broadcast are the centroids (at most ``max_cells``) and one row of
block counts per cell; items and queries never leave the executors.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .. import schemas as S
from ..functions.arrays import unit
from ..session import materialize
from .scoring import _block_scorer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_CELLS, SAMPLE_ROWS, SAMPLE_BYTES, CALIBRATION_QUERIES, ROUNDS = 4096, 20_000, 64 << 20, 256, 10
TARGET_RECALL = 0.97
PIECE = 1 << 21


@dataclass
class CellIndex:
    """Unit centroids, and how many of them to probe for the recall asked for."""

    centroids: np.ndarray
    probes: int


def unit_vectors(vectors: DataFrame, item_col: str, vector_col: str = "vector") -> DataFrame:
    """(item, unit vector); null and zero vectors have no direction and go."""
    return vectors.select(item_col, unit(vector_col).alias("_vec")).where(F.col("_vec").isNotNull())


def spherical_kmeans(x: np.ndarray, n_cells: int, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """``n_cells`` unit centroids of the unit rows of ``x``; an empty cell takes the row worst served."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), n_cells, replace=False)].copy()
    for _ in range(rounds):
        sims = x @ centres.T
        cell, best = sims.argmax(1), sims.max(1)
        order = np.argsort(cell, kind="stable")
        at = np.searchsorted(cell[order], np.arange(n_cells))
        size = np.bincount(cell, minlength=n_cells)
        sums = np.zeros_like(centres)
        sums[size > 0] = np.add.reduceat(x[order], at[size > 0])
        empty = np.flatnonzero(size == 0)
        sums[empty] = x[np.argsort(best, kind="stable")[:len(empty)]]
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centres)
    return centres


def fit_cells(vectors: DataFrame, k: int, item_col: str = S.PROD_IDX, vector_col: str = "vector", target: float = TARGET_RECALL,
              n_cells: int | None = None, max_cells: int = MAX_CELLS, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES,
              seed: int = 17) -> CellIndex:
    """Centroids and probes from a hash sample of at most about ``sample_rows`` items and ``sample_bytes`` of vectors."""
    units = unit_vectors(vectors, item_col, vector_col)
    n, width = units.agg(F.count(F.lit(1)), F.max(F.size("_vec"))).first()
    if not n:
        return CellIndex(np.zeros((0, 0)), 0)
    bound = max(2, min(sample_rows, sample_bytes // (8 * width)))
    share = 2**32 if n <= bound else int(2**32 * bound / n)
    sample = units.where(F.pmod(F.xxhash64(item_col), F.lit(2**32)) < share).orderBy(item_col).select("_vec").toPandas()
    if sample.empty:
        sample = units.orderBy(item_col).limit(1).select("_vec").toPandas()
    x = np.vstack(sample["_vec"].to_numpy())
    cells = max(1, min(n_cells or math.isqrt(n), max_cells, len(x)))
    centres = spherical_kmeans(x, cells, seed)
    rng = np.random.default_rng(seed)
    queries = x[np.sort(rng.choice(len(x), min(CALIBRATION_QUERIES, len(x)), replace=False))]
    near = np.argsort(-(queries @ x.T), axis=1, kind="stable")[:, :k + 1]
    order = np.argsort(-(queries @ centres.T), axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(cells)[None, :], 1)
    needed = np.sort(np.take_along_axis(rank, (x @ centres.T).argmax(1)[near], 1).ravel())
    return CellIndex(centres, int(needed[math.ceil(target * len(needed)) - 1]) + 1)


def _celled(frames: Iterator[pd.DataFrame], centres: np.ndarray, n: int) -> Iterator[pd.DataFrame]:
    """Task of ``with_cells``; PIECE bounds the similarities at a time and the numbers in a frame that is sent."""
    step = max(1, PIECE // max(len(centres), n * centres.shape[1]))
    for frame in frames:
        for lo in range(0, len(frame), step):
            part = frame.iloc[lo:lo + step]
            sims = np.vstack(part["_vec"].to_numpy()) @ centres.T
            cells = sims.argmax(1)[:, None] if n == 1 else np.argsort(-sims, axis=1, kind="stable")[:, :n]
            out = part.loc[part.index.repeat(cells.shape[1])].reset_index(drop=True)
            out["_cell"] = cells.ravel().astype(np.int32)
            yield out


def with_cells(units: DataFrame, index: CellIndex, n: int) -> DataFrame:
    """Each row once for each of its ``n`` nearest cells (column ``_cell``)."""
    shared = units.sparkSession.sparkContext.broadcast(index.centroids)
    schema = T.StructType([*units.schema.fields, T.StructField("_cell", T.IntegerType())])
    return units.mapInPandas(lambda frames: _celled(frames, shared.value, n), schema)


def nearest_by_cells(queries: DataFrame, items: DataFrame, index: CellIndex, k: int, query_col: str = "query_item", item_col: str = S.PROD_IDX,
                     vector_col: str = "vector", rank_decimals: int | None = None, probes: int | None = None,
                     block_rows: int = 32_768, chunk: int = 256) -> DataFrame:
    """The ``k`` most cosine-similar items of each query among those of its nearest cells: query, item, similarity, rank.

    Ties (on rounded similarities if ``rank_decimals`` is given) go to the lower
    item. Every item is in exactly one cell; probing all cells gives the exact
    result. Queries and items without a direction have no rows.
    """
    spark = queries.sparkSession
    if not len(index.centroids):
        return spark.createDataFrame([], f"{query_col} long, {item_col} int, similarity double, rank int")
    it = unit_vectors(items.select(F.col(item_col).cast("int").alias(item_col), vector_col), item_col, vector_col)
    q = unit_vectors(queries.select(F.col(query_col).cast("long").alias(query_col), vector_col), query_col, vector_col)
    n_probes = probes or index.probes
    if n_probes < len(index.centroids):
        it, q = with_cells(it, index, 1), with_cells(q, index, n_probes)
    else:  # all cells together are one: a query meets every block of items once, not every cell
        it, q = (rows.withColumn("_cell", F.lit(0)) for rows in (it, q))
    # the items under their cells are the index: stored once, read for its sizes and for its vectors
    it = materialize(it)
    sizes = {}  # one row a cell
    for side, rows in (("i", it), ("q", q)):
        for r in rows.groupBy("_cell").count().collect():
            sizes.setdefault(r["_cell"], {})[side] = max(1, math.ceil(r["count"] / block_rows))
    blocks = spark.createDataFrame([(c, n.get("i", 1), n.get("q", 1)) for c, n in sorted(sizes.items())], "_cell int, _ni int, _nq int")

    def dealt(rows: DataFrame, key: str, mine: str, other: str, mine_n: str, other_n: str) -> DataFrame:
        own = F.pmod(F.xxhash64(key), F.col(mine_n)).cast("int")
        return (rows.join(F.broadcast(blocks), "_cell").withColumn(mine, own)
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1))).drop("_ni", "_nq"))

    keys = ["_cell", "_ib", "_qb"]
    schema = f"{query_col} long, {item_col} int, score double, blk_max double, blk_sumexp double"
    score = _block_scorer(query_col, item_col, k, rank_decimals, chunk, None, with_lse=False)
    found = (dealt(q, query_col, "_qb", "_ib", "_nq", "_ni").groupBy(*keys)
             .cogroup(dealt(it, item_col, "_ib", "_qb", "_ni", "_nq").groupBy(*keys)).applyInArrow(score, schema))
    key = F.round("score", rank_decimals) if rank_decimals is not None else F.col("score")
    best = Window.partitionBy(query_col).orderBy(key.desc(), item_col)
    return found.where(F.col("blk_max").isNull()).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select(query_col, item_col, F.col("score").alias("similarity"), "rank")


def recall(found: DataFrame, exact: DataFrame, query_col: str = "query_item", item_col: str = S.PROD_IDX) -> DataFrame:
    """One row: ``wanted`` exact neighbours, ``found`` of them, and ``recall`` (null if none are wanted)."""
    hits = exact.select(query_col, item_col).join(found.select(query_col, item_col, F.lit(1).alias("_hit")), [query_col, item_col], "left")
    return hits.agg(F.count(F.lit(1)).alias("wanted"), F.count("_hit").alias("found"), F.avg(F.coalesce("_hit", F.lit(0))).alias("recall"))
