"""Score every query vector against every item vector and keep the top k (J8, W6, A10 parts).

The full product is |queries| x |items| x dim. Queries are cut into bounded
blocks by a hash of their id, one partition each, and the items stream past
every block in order of their index; few queries meet the items in several
parts, so that all tasks have work. A task holds one block of queries and one
Arrow batch of items. Inside it numpy multiplies a chunk of queries with piece
after piece of the items (in single precision first, exactly where a score may
be among the best) and emits only

* the k best items per query (ties: lower item index first), and
* if the log-sum-exp is asked for, per query the maximum and sum of exp(score - max),

so no (query, item) pair is materialised as a row. The winners of several parts
are merged with ``row_number() <= k`` per query (bounded: k per part), and
the log-sum-exp parts merge associatively.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize

# The block scorer runs in Python workers that need not have this package
# installed: ship this module's functions by value with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Items that a chunk of queries meets at first, and at a time later on.
FIRST_PIECE, PIECE = 256, 1024
#: Lengths up to which single precision is used, and what it may lose where numbers are very small.
LONGEST, LEAST_SLACK = 1e15, 1e-28


@dataclass
class ScoreResult:
    top: DataFrame      # id, [group], item, score, rank (1 = best)
    lse: DataFrame      # id, [group], lse: log(sum(exp(score))) over all items
    queries: DataFrame  # id, [group], _vec: the scored query vectors (materialised)


def _top_positions(key: np.ndarray, k: int) -> np.ndarray:
    """Column positions of the ``k`` largest values per row, best first; among
    equal values the lower position (= lower item index) comes first."""
    rows, m = key.shape
    if k >= m:
        return np.argsort(-key, axis=1, kind="stable")
    cand = np.argpartition(-key, k - 1, axis=1)[:, :k]
    cand_key = np.take_along_axis(key, cand, 1)
    thr = cand_key.min(axis=1)
    # argpartition picks arbitrarily among values equal to the k-th: redo those rows exactly
    tied = (key >= thr[:, None]).sum(axis=1) > k
    order = np.lexsort((cand, -cand_key), axis=1)
    best = np.take_along_axis(cand, order, 1)
    if tied.any():
        best[tied] = np.argsort(-key[tied], axis=1, kind="stable")[:, :k]
    return best


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """A column of equal-length arrays as a matrix; no copy where the numbers lie side by side."""
    flat = pa.concat_arrays([c.flatten() for c in vectors.chunks]).to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1).astype(np.float64, copy=False)


def _dots(q: np.ndarray, items: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", q, items)


def _longest(vectors: np.ndarray) -> float:
    """The length of the longest row; not finite if a number isn't."""
    return float(np.sqrt(_dots(vectors, vectors).max(initial=0.0)))


class Piece:
    """Some items in ascending order of their numbers, as every chunk of queries meets them."""

    def __init__(self, numbers: np.ndarray, items: np.ndarray):
        self.numbers, self.items, self.longest = numbers, items, _longest(items)

    @cached_property
    def single(self) -> np.ndarray:
        return self.items.astype(np.float32).T

    @cached_property
    def leader(self) -> np.ndarray:
        """For each item the place of the first one with the same vector."""
        rows = np.ascontiguousarray(self.items).view(f"V{self.items.itemsize * self.items.shape[1]}").ravel()
        _, first, of = np.unique(rows, return_index=True, return_inverse=True)
        return first[of.ravel()]


class Best:
    """The ``k`` best items so far of every row of ``q``, which meets the items piece by piece.

    After the first piece only scores that beat the k-th best so far are looked
    at again. Numbers ascend from piece to piece and a later one loses a tie, so
    nothing equal to the k-th best is kept twice, however many items share a
    score. Scores are taken in single precision first: one is off by less than
    ``slack`` (rounding of both vectors, of the products and of their sum), so
    the exact score of whatever may be above the bound decides. With the
    log-sum-exp every score is exact, as where numbers are not finite or very large.
    """

    def __init__(self, q: np.ndarray, k: int, decimals: int | None, with_lse: bool):
        self.q, self.k, self.decimals, self.with_lse, self.seen = q, k, decimals, with_lse, 0
        self.margin = 10.0 ** -decimals if decimals is not None else 0.0   # rounding moves a score by half of this at most
        self.longest, self.lengths = _longest(q), np.sqrt(_dots(q, q))
        self.single = None
        self.at, self.score, self.key = np.zeros((len(q), k), dtype=np.int64), np.full((len(q), k), -np.inf), np.full((len(q), k), -np.inf)
        self.worst = np.full(len(q), -np.inf)
        self.top, self.total = (np.full(len(q), -np.inf), np.zeros(len(q))) if with_lse else (None, None)
        self.finds, self.waiting = [], 0

    def _rank(self, scores: np.ndarray) -> np.ndarray:
        return np.round(scores, self.decimals) if self.decimals is not None else scores

    def add(self, piece: Piece) -> None:
        single = not self.with_lse and max(self.longest, piece.longest) <= LONGEST   # False for NaN
        first, s = not self.seen, None
        self.seen += len(piece.numbers)
        if first or not single:
            s = self.q @ piece.items.T
        if self.with_lse:
            new = np.maximum(self.top, s.max(axis=1))
            with np.errstate(invalid="ignore"):
                before = np.where(self.total > 0, self.total * np.exp(self.top - new), 0.0)
            self.top, self.total = new, before + np.exp(s - new[:, None]).sum(axis=1)
        if first:
            self._start(piece, s, single)
            return
        if single:
            row, col = self._above(piece)
            found = _dots(self.q[row], piece.items[col])
        else:
            row, col = np.nonzero(s > (self.worst - self.margin)[:, None])
            found = s[row, col]
        key = self._rank(found)
        keep = key > self.worst[row]
        if keep.any():
            self.finds.append((row[keep], piece.numbers[col[keep]], found[keep], key[keep]))
            self.waiting += int(keep.sum())
        if self.waiting >= len(self.q):
            self.merge()

    def _start(self, piece: Piece, s: np.ndarray, single: bool) -> None:
        kk = min(self.k, len(piece.numbers))
        at = _top_positions(self._rank(s), kk)
        score = np.take_along_axis(s, at, 1)
        if single:   # summed as the later finds are, so that equal vectors score alike
            score = _dots(np.repeat(self.q, kk, axis=0), piece.items[at.ravel()]).reshape(at.shape)
            order = np.lexsort((at, -self._rank(score)), axis=1)
            at, score = np.take_along_axis(at, order, 1), np.take_along_axis(score, order, 1)
        self.at[:, :kk], self.score[:, :kk], self.key[:, :kk] = piece.numbers[at], score, self._rank(score)
        self._bound()

    def _bound(self) -> None:
        self.worst = np.nan_to_num(self.key[:, -1], nan=-np.inf, posinf=np.inf, neginf=-np.inf)

    def _above(self, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
        """(row, place in the piece) of the pairs that may score above the row's k-th best."""
        if self.single is None:
            self.single = self.q.astype(np.float32)
        slack = self.margin + (self.q.shape[1] + 4) * 2.0 ** -23 * piece.longest * self.lengths + LEAST_SLACK
        bound = np.nextafter(np.maximum(self.worst - slack, -1e38).astype(np.float32), np.float32(-np.inf))
        bound[self.worst >= self._rank(piece.longest * self.lengths * (1 + 1e-12))] = np.inf   # no score is above the product of the lengths
        s = self.single @ piece.single
        rows = np.flatnonzero(s.max(axis=1) > bound)
        part, limit = (s, bound) if 2 * len(rows) > len(s) else (s[rows], bound[rows])
        row, col = np.divmod(np.flatnonzero(part > limit[:, None]), s.shape[1])
        row = row if part is s else rows[row]
        if len(row) > len(s):   # many at once are mostly equal vectors, of which a row scores one
            lead = piece.leader[col]
            own = lead == col
            r, c = row[own], col[own]
            beats = np.zeros(s.shape, dtype=bool)
            beats[r, c] = self._rank(_dots(self.q[r], piece.items[c])) > self.worst[r]
            keep = beats[row, lead]
            row, col = row[keep], col[keep]
        return row, col

    def merge(self) -> None:
        if not self.waiting:
            return
        row, number, found, key = (np.concatenate(f) for f in zip(*self.finds))
        by, k = np.argsort(row, kind="stable"), self.k
        row, number, found, key = row[by], number[by], found[by], key[by]
        # the finds of a row side by side after its best so far: numbers ascend among equal keys
        rows, start, n = np.unique(row, return_index=True, return_counts=True)
        line, place = np.repeat(np.arange(len(rows)), n), k + np.arange(len(row)) - np.repeat(start, n)
        both = np.full((3, len(rows), k + n.max()), -np.inf)
        both[0, :, :k], both[1, :, :k], both[2, :, :k] = self.key[rows], self.score[rows], self.at[rows]
        both[0, line, place], both[1, line, place], both[2, line, place] = key, found, number
        order = np.argsort(-both[0], axis=1, kind="stable")[:, :k]
        self.key[rows], self.score[rows], self.at[rows] = (np.take_along_axis(b, order, 1) for b in both)
        self.finds, self.waiting = [], 0
        self._bound()


def _best_of(q: np.ndarray, items: np.ndarray, k: int, decimals: int | None, with_lse: bool) -> tuple[np.ndarray, ...]:
    """(positions, scores, maximum, sum of exp(score - maximum)) of the ``k`` best ``items`` of every row of ``q``."""
    best = Best(q, k, decimals, with_lse)
    for piece in _pieces([(np.arange(len(items)), items)], k):
        best.add(piece)
    best.merge()
    return best.at, best.score, best.top, best.total


def _pieces(parts, k: int) -> Iterator[Piece]:
    """(numbers, vectors) one after the other, cut into a first piece of at least ``k`` items and longer ones."""
    size, held, n = max(FIRST_PIECE, k), [], 0
    for numbers, vectors in parts:
        lo = 0
        while n + len(numbers) - lo >= size:
            held.append((numbers[lo:lo + size - n], vectors[lo:lo + size - n]))
            lo += size - n
            yield Piece(*(np.concatenate(h) if len(held) > 1 else h[0] for h in zip(*held)))
            size, held, n = min(PIECE, size * 4), [], 0
        if lo < len(numbers):
            held.append((numbers[lo:], vectors[lo:]))
            n += len(numbers) - lo
    if held:
        yield Piece(*(np.concatenate(h) for h in zip(*held)))


def _scored(keys: pa.Table, qmat: np.ndarray, parts, item_col: str, k: int, decimals: int | None, chunk: int, with_lse: bool) -> Iterator[pa.Table]:
    """The best items of the queries ``qmat``, whose ``keys`` go with them, and the parts of their log-sum-exp."""
    def made(of: pa.Table, columns: list[pa.Array]) -> pa.Table:
        return pa.table([*of.columns, *columns], names=[*keys.column_names, item_col, "score", "blk_max", "blk_sumexp"])

    chunks = [Best(qmat[lo:lo + chunk], k, decimals, with_lse) for lo in range(0, len(qmat), chunk)]
    for piece in _pieces(parts, k):
        for best in chunks:
            best.add(piece)
    for lo, best in zip(range(0, len(qmat), chunk), chunks):
        if not best.seen:
            return
        best.merge()
        mine, n, kk = keys.slice(lo, len(best.q)), len(best.q), min(k, best.seen)
        none = pa.nulls(n * kk, pa.float64())
        yield made(mine.take(pa.array(np.repeat(np.arange(n), kk))), [pa.array(best.at[:, :kk].ravel().astype(np.int32)),
                                                                      pa.array(best.score[:, :kk].ravel(), from_pandas=True), none, none])
        if with_lse:
            yield made(mine, [pa.array(np.full(n, -1, dtype=np.int32)), pa.nulls(n, pa.float64()), pa.array(best.top), pa.array(best.total)])


def _block_scorer(id_col: str, item_col: str, k: int, decimals: int | None, chunk: int,
                  group_col: str | None, with_lse: bool = True):
    """Of a block of queries and one of items, for a co-group."""
    keys = [id_col] + ([group_col] if group_col else [])

    def score(q: pa.Table, it: pa.Table) -> pa.Table:
        out = []
        if q.num_rows and it.num_rows:
            numbers = it.column(item_col).to_numpy()
            order = np.argsort(numbers, kind="stable")
            parts = [(numbers[order].astype(np.int32), _matrix(it.column("_vec"))[order])]
            out = list(_scored(q.select(keys), _matrix(q.column("_vec")), parts, item_col, k, decimals, chunk, with_lse))
        if not out:
            empty = q.select(keys).slice(0, 0)
            return pa.table([*empty.columns, pa.nulls(0, pa.int32()), *[pa.nulls(0, pa.float64())] * 3],
                            names=[*keys, item_col, "score", "blk_max", "blk_sumexp"])
        return pa.concat_tables(out)
    return score


def _stream_scorer(id_col: str, item_col: str, k: int, decimals: int | None, chunk: int, group_col: str | None, with_lse: bool):
    """Of a partition whose rows are, for each value of ``_block``, its queries (no ``_item``) and then items in ascending order."""
    keys = [id_col] + ([group_col] if group_col else [])

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Table]]:
        """The rows in pieces of one block and side."""
        for batch in batches:
            table = pa.Table.from_batches([batch])
            block, side = table.column("_block").to_numpy(), table.column("_side").to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(block) != 0) | (np.diff(side) != 0)) + 1), len(block)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi > lo:
                    yield (block[lo], side[lo]), table.slice(lo, hi - lo)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = slices(batches)
        ahead = next(queue, None)

        def of(block, side) -> Iterator[pa.Table]:
            nonlocal ahead
            while ahead is not None and ahead[0] == (block, side):
                part = ahead[1]
                ahead = next(queue, None)
                yield part

        while ahead is not None:
            block = ahead[0][0]
            names, vectors = [], []
            for q in of(block, 0):
                names.append(q.select(keys))
                vectors.append(_matrix(q.column("_vec")).copy())
            items = ((it.column(item_col).to_numpy().astype(np.int32), _matrix(it.column("_vec"))) for it in of(block, 1))
            if names:
                qmat = np.concatenate(vectors)
                vectors.clear()
                for table in _scored(pa.concat_tables(names), qmat, items, item_col, k, decimals, chunk, with_lse):
                    yield from table.combine_chunks().to_batches()
            for _ in items:   # without queries
                pass
    return run


def spark_parallelism(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def top_k_scores(queries: DataFrame, items: DataFrame, k: int, id_col: str = "instance_id",
                 query_vec: str = "session", item_col: str = "prod_idx", item_vec: str = "vector",
                 rank_decimals: int | None = None, block_bytes: int = 32 << 20, least_queries: int = 64,
                 chunk: int = 512, group_col: str | None = None, with_lse: bool = True) -> ScoreResult:
    """Top-``k`` items by dot product for every query, plus each query's log-sum-exp.

    ``rank_decimals`` ranks on scores rounded to that many decimals (ties then
    go to the lower item index), which makes rankings reproducible across
    engines; ``None`` ranks on exact scores.

    ``block_bytes`` bounds a block of queries at any vector width (32 MB is
    65k vectors of 64 doubles); query blocks are as many as the session's
    parallelism needs while each holds ``least_queries``. The shuffle volume is
    about |queries| x item parts + |items| x query blocks rows. With ``group_col``
    (e.g. the scorer name) a query is identified by (group, id), so several
    kinds of query vectors share one pass over the items. Without
    ``with_lse`` only the top-k is produced (``lse`` is None) and the block
    output is consumed once, without being materialised.
    """
    # the query side is sized and then blocked: materialise it so its lineage runs once
    gcols = [F.col(group_col)] if group_col else []
    keys = [id_col] + ([group_col] if group_col else [])
    q = materialize(queries.select(F.col(id_col).cast("long").alias(id_col), *gcols, F.col(query_vec).alias("_vec"))
                    .where(F.col("_vec").isNotNull()))
    it = items.select(F.col(item_col).cast("int").alias(item_col), F.col(item_vec).alias("_vec")) \
        .where(F.col("_vec").isNotNull())
    nq, (ni, width) = q.count(), it.agg(F.count(F.lit(1)), F.max(F.size("_vec"))).first()
    block = max(1, block_bytes // (8 * max(1, width or 1)))
    tasks = spark_parallelism(queries)
    qb = max(1, math.ceil(nq / block), min(tasks, math.ceil(nq / least_queries)))
    qb = math.ceil(qb / tasks) * tasks if qb > tasks else qb           # no task left over for a last round
    ib = max(1, min(math.ceil(ni / block), math.ceil(tasks / qb)))
    # a block's queries (side 0) and then its items (side 1) are one partition, or one part of the items each
    number = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<int>"))
    none = [F.lit(None).cast(q.schema[c].dataType).alias(c) for c in keys]
    of_queries = q.select(number(id_col, qb).alias("_qb"), every(ib).alias("_ib"), F.lit(0).alias("_side"),
                          *keys, F.lit(None).cast("int").alias(item_col), "_vec")
    of_items = it.select(every(qb).alias("_qb"), number(item_col, ib).alias("_ib"), F.lit(1).alias("_side"), *none, item_col, "_vec")
    gtype = f", {group_col} {q.schema[group_col].dataType.simpleString()}" if group_col else ""
    schema = f"{id_col} long{gtype}, {item_col} int, score double, blk_max double, blk_sumexp double"
    blocks = (of_queries.unionByName(of_items).withColumn("_block", F.col("_qb") * ib + F.col("_ib")).drop("_qb", "_ib")
              .repartitionById(qb * ib, "_block")
              .sortWithinPartitions("_block", "_side", F.col(item_col).asc_nulls_last())
              .mapInArrow(_stream_scorer(id_col, item_col, k, rank_decimals, chunk, group_col, with_lse), schema))
    if with_lse:
        # both results below read the block output: materialise it once
        blocks = materialize(blocks)
    cand = blocks.where(F.col("blk_max").isNull())
    rank_key = F.round("score", rank_decimals) if rank_decimals is not None else F.col("score")
    w = Window.partitionBy(*keys).orderBy(rank_key.desc(), F.col(item_col).asc())
    top = cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) \
        .select(*keys, item_col, "score", "rank")
    if not with_lse:
        return ScoreResult(top, None, q)
    parts = blocks.where(F.col("blk_max").isNotNull())
    mx = Window.partitionBy(*keys)
    lse = (parts.withColumn("_m", F.max("blk_max").over(mx))
           .groupBy(*keys).agg(F.first("_m").alias("_m"),
                               F.sum(F.col("blk_sumexp") * F.exp(F.col("blk_max") - F.col("_m"))).alias("_s"))
           .select(*keys, (F.col("_m") + F.log("_s")).alias("lse")))
    return ScoreResult(top, lse, q)
