"""Item vectors from titles (T1 -> T2/T3 -> K8 -> T4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..operators.text import (VECTOR_SIZE, cooccurrence_vectors, hashed_title_vectors, mean_title_vectors, title_vectors,
                              tokenize, train_title_model)
from .recommend import similar_items


def item_title_vectors(products: DataFrame, stop_words=(), vector_size: int = VECTOR_SIZE, learned: bool | str = False,
                       seed: int = 42, **params) -> DataFrame:
    """Tokens and one vector per product row ``(prod_no, title, vector)``.

    Hashed token vectors by default (one projection, no shuffle). ``learned``
    takes them from co-occurrences with ``seed`` and ``params`` (window, nonzero);
    ``learned="word2vec"`` trains Word2Vec (window, epochs, ...) instead.
    """
    docs = tokenize(products.select(S.PRODUCT_NO, products[S.PRODUCT_NAME].alias("title")), "title", stop_words=stop_words)
    keyed = docs.withColumn("_key", F.struct(S.PRODUCT_NO, "title"))
    if learned and learned != "word2vec":
        words = cooccurrence_vectors(docs, vector_size=vector_size, seed=seed, **params)
        vecs = mean_title_vectors(keyed, words, "_key", vector_size=vector_size)
    elif learned:
        vecs = title_vectors(train_title_model(docs, vector_size=vector_size, seed=seed, **params), keyed, "_key")
    else:
        vecs = hashed_title_vectors(keyed, "_key", vector_size=vector_size)
    return vecs.select("_key.*", "vector")


def title_neighbours(vectors: DataFrame, k: int = 11, exclude_self: bool = False,
                     rank_decimals: int | None = None) -> DataFrame:
    """T4 over title vectors keyed by product number."""
    return similar_items(vectors.withColumnRenamed(S.PRODUCT_NO, S.PROD_IDX), k, exclude_self, rank_decimals)
