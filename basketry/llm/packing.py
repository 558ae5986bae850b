"""Packing into optimal length buckets.

The global histogram of document lengths (tokens: white-space words) goes
through a dynamic programme that chooses the bucket boundaries with the least
padding; inside a bucket, whose rows are padded to its upper boundary, batches
of at most ``budget`` padded tokens form.

The histogram is counted by Spark over the exact distinct lengths, whatever the
longest one is and however many there are: D distinct lengths need about D * D / 2
tokens in all, so their number grows with the root of the corpus (some 100,000 at
5e9 tokens), and no size of the input changes the method. Only a caller who sets ``max_lengths``
lets lengths above 4095 that agree in their leading 12 bits share a bin (each within
1/2048) where there are more, which counts as the longest length that occurs in it. A bucket with most of the rows is
split into shards of ``SHARD_BATCHES`` batches by a hash of the id and a stored
row number, so no bucket is numbered in one task, whatever ids repeat; each
shard leaves at most one batch unfilled.

Defined cases: a null or empty text has length 0 and goes to the first bucket;
a document longer than the budget is a batch of its own, uncut; repeated rows
take a place each; ties in length share a bucket; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import chunks, utf8, words
from .common import small, stored

BUCKETS, BUDGET, SHARD_BATCHES = 12, 32_768, 16


def boundaries(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` ranges of lengths with the least total padding.

    ``histogram``: (length, rows), lengths distinct. cost[j] is the least
    padding of the first j lengths in the ranges so far; the last range i..j
    pads each of its rows to the j-th length. The best i never falls as j
    grows, so each j is tried only between the choices of its neighbours.
    """
    histogram = sorted(histogram)
    if not histogram:
        return []
    length = np.array([0] + [x for x, _ in histogram], dtype=np.int64)
    rows = np.concatenate([[0], np.cumsum([c for _, c in histogram])])
    mass = np.concatenate([[0], np.cumsum([x * c for x, c in histogram])])
    n = len(histogram)
    cost = np.full(n + 1, np.iinfo(np.int64).max // 4)
    cost[0] = 0
    back = []
    for _ in range(min(buckets, n)):
        choice, least = np.zeros(n + 1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
        step = 1 << n.bit_length()
        while step:
            js = np.arange(step, n + 1, 2 * step)
            if len(js):
                low = choice[js - step]
                high = np.minimum(np.where(js + step <= n, choice[np.minimum(js + step, n)], n), js - 1)
                size = high - low + 1
                at = np.cumsum(size) - size
                i = np.arange(size.sum()) + np.repeat(low - at, size)
                j = np.repeat(js, size)
                total = cost[i] + (rows[j] - rows[i]) * length[j] - (mass[j] - mass[i])
                least[js] = np.minimum.reduceat(total, at)
                hits = np.flatnonzero(total == np.repeat(least[js], size))
                choice[js] = i[hits[np.searchsorted(hits, at)]]
            step //= 2
        back.append(choice)
        cost = least
        if cost[n] == 0:
            break
    out, j = [], n
    for choice in reversed(back):
        out.append(int(length[j]))
        j = int(choice[j])
        if not j:
            break
    return out[::-1]


def measured(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` without its text, with ``n_tokens``."""
    kept = [f for f in docs.schema.fields if f.name != text_col]
    schema = T.StructType([*kept, T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text_col):
            first = words(*utf8(batch.column(text_col)))[3]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(np.diff(first).astype(np.int64))], names=[*(f.name for f in kept), "n_tokens"])

    return docs.mapInArrow(run, schema)


def choose(lengths: DataFrame, buckets: int, max_lengths: int | None = None) -> list[int]:
    """Bucket boundaries for a column ``n_tokens``; exact unless ``max_lengths`` is set and exceeded."""
    histogram = small(lengths.groupBy(F.col("n_tokens").alias("top")).agg(F.count(F.lit(1)).alias("rows")))
    if max_lengths is not None and histogram.count() > max_lengths:
        low_bits = F.expr("greatest(length(bin(top)) - 12, 0)")
        histogram = histogram.groupBy(low_bits, F.expr("shiftright(top, greatest(length(bin(top)) - 12, 0))")).agg(F.max("top").alias("top"), F.sum("rows").alias("rows"))
    found = histogram.select("top", "rows").toPandas()  # a row for each distinct length
    return boundaries(list(zip(found.top.tolist(), found.rows.tolist(), strict=True)), buckets)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, budget: int = BUDGET,
         max_lengths: int | None = None) -> DataFrame:
    """doc_id, n_tokens, bucket, padded (the bucket's length), batch and place of every document.

    ``batch`` is bucket:shard:number; ``place`` counts from 0 inside it.
    """
    read = measured(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text")
    lengths = stored(read.withColumn("row", F.monotonically_increasing_id()), "lengths")
    ends = choose(lengths, buckets, max_lengths)
    table = F.array(*[F.lit(e).cast("long") for e in ends]) if ends else F.array(F.lit(0).cast("long"))
    placed = lengths.withColumn("bucket", F.size(F.filter(table, lambda e: e < F.col("n_tokens")))).withColumn("padded", F.get(table, F.col("bucket")))
    sizes = {r.bucket: r["count"] for r in placed.groupBy("bucket").count().collect()}  # one row per bucket
    room = {b: max(1, budget // max(1, e)) for b, e in enumerate(ends)}
    shards = {b: max(1, -(-n // (room[b] * SHARD_BATCHES))) for b, n in sizes.items()}
    by = lambda d: F.get(F.array(*[F.lit(d.get(b, 1)).cast("long") for b in range(max(1, len(ends)))]), F.col("bucket"))
    spread = placed.withColumn("shard", F.pmod(F.xxhash64("doc_id", "n_tokens", "row"), by(shards)))
    number = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("n_tokens", "doc_id", "row")) - 1
    return (spread.withColumn("number", number).withColumn("room", by(room))
            .select("doc_id", "n_tokens", "bucket", "padded",
                    F.concat_ws(":", "bucket", "shard", F.expr("number div room")).alias("batch"), F.expr("number % room").cast("long").alias("place")))
