"""Benchmark decontamination with one FM-index per training shard.

Documents are read shard by shard (a bounded chunk of rows inside a task).
A shard's words become numbers of the benchmark's vocabulary; a word outside
it cannot be part of any match and ends a run, and runs too short for the
shortest window are left out of the index, which changes no result. Every
distinct benchmark window is searched backwards through wavelet-tree ranks,
its occurrences are located by sampled suffix positions, and the spans they
cover are merged per document.

The benchmark is the stated query set: its windows go to the tasks in blocks
of at most ``block_words`` words, so what is broadcast is bounded whatever its
size, and each block adds to the spans of the one before. No shuffle.

Defined cases: a null or empty text has no words, hits or items; a benchmark
item without words has no window; items with equal windows all count; a null
item id is skipped; repeated rows give a row each; empty tables give no hits
or no rows; other columns are carried through untouched in the pipeline only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import FOLD, chunks
from .fm_index import FMIndex

WINDOW = 13
BLOCK_WORDS = 2_000_000
#: contaminated: at least one hit word in so many words
ONE_IN = 20
_KEEP = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in FOLD.tobytes())


def bench_words(text: str | None) -> list[bytes]:
    """Letters, digits and everything beyond ASCII, A-Z lower-cased."""
    return (text or "").encode().translate(_KEEP).split()


class Phrases:
    """The distinct windows of some benchmark items and the items that have them."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple, set] = {}
        for item, text in items:
            w = [self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in bench_words(text)]
            for at in range(max(1, len(w) - window + 1) if w else 0):
                owners.setdefault(tuple(w[at:at + window]), set()).add(item)
        self.windows = [np.array(w, dtype=np.int64) for w in owners]
        self.owners = [sorted(o) for o in owners.values()]
        self.shortest = min(map(len, owners), default=0)

    def search(self, docs: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set]]:
        """Per document: merged [start, end) word spans covered by windows, and the items found."""
        out = [([], set()) for _ in docs]
        if not self.windows:
            return out
        get, none = self.vocabulary.get, 0
        lengths = np.array([len(d) for d in docs], dtype=np.int64)
        s = np.fromiter((get(w, none) for d in docs for w in d), dtype=np.int64, count=int(lengths.sum()))
        starts = np.cumsum(lengths) - lengths
        # maximal in-vocabulary runs within documents
        cut = np.zeros(len(s) + 1, dtype=bool)
        cut[starts], cut[-1] = True, True
        inside = np.concatenate([[False], s > 0, [False]])
        opens = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
        closes = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
        kept = closes - opens >= self.shortest
        opens, closes = opens[kept], closes[kept]
        if not len(opens):
            return out
        sizes = closes - opens + 1  # each run with a separator behind it
        begin = np.cumsum(sizes) - sizes
        place = np.repeat(opens - begin, sizes) + np.arange(int(sizes.sum()))
        separator = np.zeros(len(place), dtype=bool)
        separator[begin + sizes - 1] = True
        stop = len(self.vocabulary) + 1
        index = FMIndex(np.where(separator, stop, s[np.minimum(place, len(s) - 1)]), stop)
        low, high = index.search(self.windows)
        hits = np.flatnonzero(high > low)
        if not len(hits):
            return out
        counts = high[hits] - low[hits]
        rows = np.repeat(low[hits] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        which = np.repeat(hits, counts)
        at = place[index.locate(rows)]
        doc = np.searchsorted(starts, at, side="right") - 1
        for k in np.lexsort((at, doc)).tolist():
            spans, items = out[doc[k]]
            a = int(at[k] - starts[doc[k]])
            b = a + len(self.windows[which[k]])
            if spans and a <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
            else:
                spans.append((a, b))
            items.update(self.owners[which[k]])
        return out


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple]]:
    """The benchmark's rows in blocks of bounded text, each fetched on its own."""
    sized = benchmark.select(F.col(id_col).alias("item"), F.col(text_col).alias("text")).where("item is not null and text is not null")
    sized = sized.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(4096)))
    per = sized.groupBy("bucket").agg(F.sum(F.length("text")).alias("chars")).orderBy("bucket").collect()  # at most 4096 rows
    group, total = [], 0
    for r in per:
        if group and total + r.chars > 6 * block_words:
            yield [tuple(x) for x in sized.where(F.col("bucket").isin(group)).select("item", "text").collect()]
            group, total = [], 0
        group.append(r.bucket)
        total += r.chars
    if group:
        yield [tuple(x) for x in sized.where(F.col("bucket").isin(group)).select("item", "text").collect()]


def hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", bench_col: str = "text",
         window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (merged word spans, as flat starts and ends) and ``items`` (as sorted text)."""
    spark = docs.sparkSession
    names = {"n_words", "spans", "items"}
    if names & set(docs.columns):
        raise ValueError(f"docs must not have columns {sorted(names)}")
    out = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType())),
                        T.StructField("items", T.ArrayType(T.StringType()))])
    current, found = docs, False
    for rows in blocks(benchmark, item_col, bench_col, block_words):
        # built in the task from the rows: a block is small, its tables are not
        shared = spark.sparkContext.broadcast([(str(i), t) for i, t in rows])
        current, found = current.mapInArrow(_searcher(shared, text_col, window, found), out), True
    if not found:
        current = current.mapInArrow(_searcher(spark.sparkContext.broadcast([]), text_col, window, False), out)
    return current


def _searcher(shared, text_col: str, window: int, again: bool):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(shared.value, window)
        for batch in chunks(batches, text_col):
            docs = [bench_words(t) for t in batch.column(text_col).to_pylist()]
            got = phrases.search(docs)
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            if again:
                before = zip(columns["spans"].to_pylist(), columns["items"].to_pylist(), strict=True)
                got = [(_merged(s + list(zip(a[::2], a[1::2], strict=True))), i | set(b)) for (s, i), (a, b) in zip(got, before, strict=True)]
            columns["n_words"] = pa.array([len(d) for d in docs], pa.int64())
            columns["spans"] = pa.array([[x for span in s for x in span] for s, _ in got], pa.list_(pa.int64()))
            columns["items"] = pa.array([sorted(i) for _, i in got], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return search


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: words, hit words, items, their digest, and whether it is contaminated."""
    found = hits(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), benchmark, **options)
    return found.select(
        "doc_id", "n_words",
        F.expr("aggregate(spans, 0L, (a, x) -> x - a)").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "spans",
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words")))


__all__ = ["Phrases", "blocks", "contamination", "hits"]
