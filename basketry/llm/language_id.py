"""Language identification: words first, then shorter and shorter character n-grams.

A word known from training scores by its log frequency in each language. An
unseen word falls back to its longest character n-grams (with word edges) of
which any is known, from ``ORDERS`` downwards; a language without the word or
n-gram gets a floor, the same for all languages (a lower one for those with
more text would favour the rare ones). The language with the highest sum wins.

The tables are counted by Spark over every training row, so a language with
few rows among very many is learned from all of them, and cut to the most frequent ``max_words`` words and
``max_grams`` n-grams a language, so the broadcast model is bounded by these
parameters and the number of languages. Prediction covers every whole text
without a shuffle; each chunk scores each distinct word once.

Defined cases: null, empty or letterless text is ``und`` with score 0; a null
language or id is never learned from; ties go to the alphabetically first
language; with nothing learned every text is ``und``; repeated rows get a row
each. Language, source and id are never inputs.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import chunks
from .common import remainder, ship, shipped, stored

MAX_WORDS, MAX_GRAMS = 30_000, 20_000
#: Distinct words or n-grams that a task holds before it passes their counts on.
HELD_WORDS = 300_000
#: Text per scoring chunk; a larger one scores fewer distinct words again.
SCORE_BYTES = 12 << 20
ORDERS = (4, 3, 2, 1)
#: Weight of an unseen word's n-gram score against a known word's.
BACKOFF = 0.5
_WORD = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def grams(word: str, n: int) -> list[str]:
    edged = f" {word} "
    return [edged[i:i + n] for i in range(len(edged) - n + 1)] if n > 1 else list(word)


def rows_of(counts: Counter, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The keys and counts in batches."""
    rows = list(counts.items())
    for at in range(0, len(rows), 50_000):
        part = rows[at:at + 50_000]
        keys = [pa.array(column) for column in zip(*[k for k, _ in part], strict=True)]
        yield pa.RecordBatch.from_arrays([*keys, pa.array([c for _, c in part], pa.int64())], names=names)


def counted_words(train: DataFrame) -> DataFrame:
    """(lang, token, count) of every word of the training rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        passed = lambda: rows_of(Counter({(lang, w): c for lang, seen in words.items() for w, c in seen.items() if w.isalpha()}), ["lang", "token", "count"])
        for batch in chunks(batches):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(tokens(text))
            if sum(map(len, words.values())) > HELD_WORDS:
                yield from passed()
                words = {}
        yield from passed()

    return train.mapInArrow(count, "lang string, token string, count bigint").groupBy("lang", "token").agg(F.sum("count").alias("count"))


def counted(train: DataFrame) -> DataFrame:
    """(lang, n, token, count): words (n = 0) and n-grams, which are cut from every distinct word once."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held = ["lang", "n", "token", "count"], Counter()
        for batch in batches:
            for lang, word, c in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                for n in ORDERS:
                    for g in grams(word, n):
                        held[lang, n, g] += c
            if len(held) > HELD_WORDS:
                yield from rows_of(held, names)
                held = Counter()
        yield from rows_of(held, names)

    words = stored(counted_words(train), "language-words")
    pieces = words.mapInArrow(cut, "lang string, n long, token string, count bigint").groupBy("lang", "n", "token").agg(F.sum("count").alias("count"))
    return words.select("lang", F.lit(0).cast("long").alias("n"), "token", "count").unionAll(pieces)


class Model:
    """Per-language log frequencies of words and n-grams."""

    def __init__(self, rows: list[tuple]):
        self.langs = sorted({r[0] for r in rows})
        index = {lang: i for i, lang in enumerate(self.langs)}
        totals: dict[tuple, int] = {}
        for lang, n, _, c in rows:
            totals[lang, n] = totals.get((lang, n), 0) + c
        self.at: dict[int, dict[str, int]] = {n: {} for n in (0, *ORDERS)}
        for _, n, token, _ in rows:
            self.at[n].setdefault(token, len(self.at[n]))
        floor = {n: -math.log(max((totals.get((lang, n), 0) for lang in self.langs), default=0) + 2) - 1 for n in self.at}
        self.logs = {n: np.full((len(self.at[n]), len(self.langs)), floor[n], dtype=np.float32) for n in self.at}
        for lang, n, token, c in rows:
            self.logs[n][self.at[n][token], index[lang]] = math.log(c / (totals[lang, n] + 1))

    def scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(score per word and language, whether the word has a letter)."""
        known = np.array([self.at[0].get(w, -1) for w in words], dtype=np.int64)
        table = np.zeros((len(words), len(self.langs)), dtype=np.float32)
        real = np.ones(len(words), dtype=bool)
        table[known >= 0] = self.logs[0][known[known >= 0]]
        owners: dict[int, list[int]] = {n: [] for n in ORDERS}
        found: dict[int, list[int]] = {n: [] for n in ORDERS}
        for k in np.flatnonzero(known < 0).tolist():
            word = words[k]
            if not word.isalpha() and not any(c.isalpha() for c in word):
                real[k] = False
                continue
            for n in ORDERS:
                ids = [g for g in map(self.at[n].get, grams(word, n)) if g is not None]
                if ids:
                    found[n] += ids
                    owners[n] += [k] * len(ids)
                    break
        for n in ORDERS:
            if owners[n]:
                who, start, count = np.unique(owners[n], return_index=True, return_counts=True)
                table[who] = BACKOFF * np.add.reduceat(self.logs[n][found[n]], start, axis=0) / count[:, None]
        return table, real

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and its share of the posterior (from mean word scores) for each text."""
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        ids: dict[str, int] = {}
        docs = [[ids.setdefault(w, len(ids)) for w in tokens(t)] for t in texts]
        table, real = self.scores(list(ids))
        langs, share = [], np.zeros(len(texts))
        for k, doc in enumerate(docs):
            at = np.array(doc, dtype=np.int64)
            n = int(real[at].sum()) if len(at) else 0
            if not n:
                langs.append("und")
                continue
            mean = table[at].sum(axis=0, dtype=np.float64) / n
            best = int(mean.argmax())
            langs.append(self.langs[best])
            share[k] = 1 / np.exp(np.clip(mean - mean[best], -50, 0)).sum()
        return langs, share


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> Model:
    """Count the training fold (crc32 of the id modulo 5 not 0)."""
    train = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        (remainder(F.col("doc_id"), 5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    totals = stored(counted(train), "language-counts")
    return Model([tuple(r) for r in most_frequent(totals, max_words, max_grams).collect()])


def most_frequent(totals: DataFrame, max_words: int, max_grams: int) -> DataFrame:
    """The rows whose count reaches the limit's count in their language and length.

    The cut comes from a histogram of counts (few distinct counts), so no
    group is sorted in one task. Rows that tie at the cut stay out.
    """
    sizes = totals.groupBy("lang", "n", "count").agg(F.count(F.lit(1)).alias("rows")).groupBy("lang", "n").agg(
        F.sort_array(F.collect_list(F.struct("count", "rows")), asc=False).alias("sizes"))
    cut = sizes.select("lang", "n", F.expr(f"""aggregate(sizes, named_struct('left', cast(if(n = 0, {max_words}, {max_grams}) as bigint), 'cut', cast(9223372036854775807 as bigint)),
        (a, x) -> if(a.left >= x.rows, named_struct('left', a.left - x.rows, 'cut', x.count), named_struct('left', -1L, 'cut', a.cut)), a -> a.cut)""").alias("cut"))
    return totals.join(F.broadcast(cut), ["lang", "n"]).where("count >= cut").select("lang", "n", "token", "count")


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; every other column stays."""
    taken = {"lang_pred", "score"} & set(docs.columns)
    if taken:
        raise ValueError(f"docs must not have columns {sorted(taken)}")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = ship(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shipped(shared)
        for batch in chunks(batches, text_col, SCORE_BYTES):
            langs, share = fitted.predict(batch.column(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(share)], names=[*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every document."""
    model = learn(docs, id_col, text_col, lang_col, **options)
    got = predict(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model)
    return got.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
