"""Titles as tokens and title vectors.

Tokens are runs of Unicode letters and digits, lower-cased; an optional
stop-word list is removed in the same expression. A title's vector is the mean
of its token vectors. Token vectors are by default the bytes of the token's
hash: no model, no vocabulary on the driver, any title at any time. The learned
option takes them from the titles' own co-occurrences, as tables. MLlib's
Word2Vec remains as a third way (its vocabulary x vector size is held by the
driver); unseen titles get vectors from the same model.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

from .. import schemas as S
from ..session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN_PATTERN = r"[\p{L}\p{N}]+"

# Default title-model parameters.
VECTOR_SIZE, WINDOW, MIN_COUNT, EPOCHS, STEP_SIZE = 64, 2, 1, 5, 0.025
#: Tokens whose bytes are gathered at a time.
PIECE = 1 << 18


def tokenize(df: DataFrame, column: str = S.PRODUCT_NAME, out: str = "tokens",
             stop_words: Iterable[str] = (), min_length: int = 1) -> DataFrame:
    """Title -> array of tokens (whole text, no truncation)."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(F.col(column), F.lit(""))), F.lit(TOKEN_PATTERN), 0)
    stop = list(dict.fromkeys(stop_words))
    keep = lambda x: (F.length(x) >= min_length) & (~x.isin(stop) if stop else F.lit(True))
    return df.withColumn(out, F.filter(tokens, keep))


def _hashed(batch: pa.RecordBatch, vector_size: int) -> pa.Array:
    """The vectors of one batch of token lists: the bytes of each distinct token once, then sums over the lists."""
    lists, blocks = batch.column("_tokens"), (vector_size + 15) // 16
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
    flat = lists.flatten()
    tokens, lacks = pc.fill_null(flat, "").dictionary_encode(), np.array(flat.is_null())
    digests = b"".join(hashlib.md5(f"{t}:{b}".encode()).digest() for t in tokens.dictionary.to_pylist() for b in range(blocks))
    table = np.frombuffer(digests, dtype=np.uint8).reshape(-1, 16 * blocks)[:, :vector_size]
    of, n = tokens.indices.to_numpy(zero_copy_only=False), np.diff(ends)[:, None]
    total, some = np.zeros((len(n), vector_size), dtype=np.int64), np.flatnonzero(n[:, 0])
    unknown = np.zeros(n.shape, dtype=bool)  # a list with a null token has no vector
    unknown[some, 0] = np.add.reduceat(lacks, ends[some], dtype=np.int64) > 0 if len(some) else False
    step = max(1, PIECE * len(n) // max(1, len(of)))
    for lo in range(0, len(some), step):  # lists of about PIECE tokens at a time
        rows = some[lo:lo + step]
        first, last = ends[rows[0]], ends[rows[-1] + 1]
        total[rows] = np.add.reduceat(table[of[first:last]], ends[rows] - first, axis=0, dtype=np.int64)
    values = np.where(n > 0, (total * 2 - n * 255) / (np.maximum(n, 1) * 255.0), 0.0)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * vector_size), pa.array(values.ravel(), mask=np.repeat(unknown, vector_size)))


def hashed_title_vectors(docs: DataFrame, id_col: str = S.PRODUCT_NO, tokens: str = "tokens",
                         vector_size: int = VECTOR_SIZE) -> DataFrame:
    """T2/T3 without training: ``(id, vector array<double>)``.

    Component j of a token is byte j mod 16 of ``md5(token:j div 16)``, mapped
    to (byte - 127.5) / 127.5. The byte sums are whole numbers, so a vector does
    not depend on the order of the tokens. A title without tokens has zeros.
    The narrow rows are dealt over the session's partitions first: a product
    table of a few files would keep as few tasks busy.
    """
    spark = docs.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(id_col, F.col(tokens).alias("_tokens")).repartition(n)
    schema = T.StructType([rows.schema[0], T.StructField("vector", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _hashed(batch, vector_size)], names=[batch.schema.names[0], "vector"])

    return rows.mapInArrow(run, schema)


def cooccurrence_counts(docs: DataFrame, tokens: str = "tokens", window: int = WINDOW) -> DataFrame:
    """(a, b, c): how often token b stands within ``window`` places of token a, either side; pairs are merged before the shuffle."""
    near = F.expr(f"""explode(flatten(transform(sequence(1, {int(window)}), d ->
        transform(slice({tokens}, 1, greatest(size({tokens}) - d, 0)), (t, i) -> struct(t as a, {tokens}[i + d] as b)))))""")
    one_way = docs.select(near.alias("_p")).groupBy("_p.a", "_p.b").agg(F.count(F.lit(1)).alias("c"))
    other_way = one_way.select(F.col("b").alias("a"), F.col("a").alias("b"), "c")
    return one_way.unionByName(other_way).groupBy("a", "b").agg(F.sum("c").alias("c"))


def cooccurrence_vectors(docs: DataFrame, tokens: str = "tokens", window: int = WINDOW, vector_size: int = VECTOR_SIZE,
                         nonzero: int = 4, seed: int = 42) -> DataFrame:
    """T2, learned: ``(token, vector array<double>)`` from the titles' own co-occurrences.

    The positive mutual information of a token with every token near it, under
    a sparse random projection: each context token adds or subtracts itself in
    ``nonzero`` components drawn from ``md5(seed:token)``. Counts, weights and
    vectors are joins and aggregates over tables, so the vocabulary is never in
    one place, and the result depends only on the titles and the seed. A token
    that is never near another one has no row.
    """
    if not 0 < nonzero <= 6:
        raise ValueError("nonzero must be 1 to 6")
    counts = materialize(cooccurrence_counts(docs, tokens, window))
    total = counts.agg(F.sum("c")).first()[0] or 0
    sizes = counts.groupBy("a").agg(F.sum("c").alias("n"))
    weights = (counts.join(sizes.withColumnRenamed("n", "_na"), "a").join(sizes.select(F.col("a").alias("b"), F.col("n").alias("_nb")), "b")
               .withColumn("_w", F.log(F.col("c").cast("double") * F.lit(float(total)) / (F.col("_na").cast("double") * F.col("_nb").cast("double"))))
               .where(F.col("_w") > 0))
    hexes = F.md5(F.concat(F.lit(f"{int(seed)}:"), F.col("b")))
    drawn = F.expr(f"""transform(sequence(0, {nonzero - 1}), j -> struct(
        cast(conv(substring(_h, j * 4 + 1, 4), 16, 10) as int) % {int(vector_size)} as at,
        if(cast(conv(substring(_h, j + {4 * nonzero + 1}, 1), 16, 10) as int) % 2 = 0, 1, -1) as sign))""")
    parts = weights.withColumn("_h", hexes).select("a", "_w", F.explode(drawn).alias("_d")) \
        .groupBy("a", F.col("_d.at").alias("at")).agg(F.sum(F.col("_w") * F.col("_d.sign")).alias("_v"))
    spread = F.array(*[F.coalesce(F.max(F.when(F.col("at") == j, F.col("_v"))), F.lit(0.0)) for j in range(vector_size)])
    return parts.groupBy(F.col("a").alias("token")).agg(spread.alias("vector"))


def mean_title_vectors(docs: DataFrame, token_vectors: DataFrame, id_col: str = S.PRODUCT_NO, tokens: str = "tokens",
                       vector_size: int = VECTOR_SIZE) -> DataFrame:
    """``(id, vector)``, the mean of the token vectors over all of a title's tokens; tokens without one count as zeros.

    Equal token lists are computed once; rows are kept one for one.
    """
    lists = docs.select(F.col(tokens).alias("_list")).distinct()
    rows = lists.select("_list", F.explode("_list").alias("token")).groupBy("_list", "token").agg(F.count(F.lit(1)).alias("_m")).join(token_vectors, "token")
    sums = [(F.sum(F.col("vector")[j] * F.col("_m")) / F.size("_list")) for j in range(vector_size)]
    means = rows.groupBy("_list").agg(F.array(*sums).alias("vector"))
    zeros = F.array_repeat(F.lit(0.0), vector_size)
    return docs.join(means, docs[tokens] == means["_list"], "left").select(docs[id_col], F.coalesce("vector", zeros).alias("vector"))


def train_title_model(docs: DataFrame, tokens: str = "tokens", vector_size: int = VECTOR_SIZE,
                      window: int = WINDOW, min_count: int = MIN_COUNT, epochs: int = EPOCHS,
                      step_size: float = STEP_SIZE, seed: int = 42, partitions: int | None = None) -> Word2VecModel:
    """T2, learned: distributed Word2Vec over the token lists (training split over ``partitions``)."""
    n = partitions or docs.sparkSession.sparkContext.defaultParallelism
    w2v = Word2Vec(vectorSize=vector_size, windowSize=window, minCount=min_count, maxIter=epochs,
                   stepSize=step_size, seed=seed, numPartitions=n, inputCol=tokens, outputCol="_vec")
    return w2v.fit(docs)


def title_vectors(model: Word2VecModel, docs: DataFrame, id_col: str = S.PRODUCT_NO,
                  tokens: str = "tokens") -> DataFrame:
    """``(id, vector array<double>)`` for any documents, seen or not."""
    model = model.copy({model.inputCol: tokens, model.outputCol: "_vec"})
    return model.transform(docs).select(id_col, vector_to_array("_vec").alias("vector"))
