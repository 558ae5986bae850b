"""Quality rules: hashed n-gram log-likelihood ratio between two multinomials.

Every word and word pair is hashed into one of ``buckets`` features. Feature
counts of the trusted documents and of the raw corpus give two smoothed
multinomials; a document's score is the mean over its features of
log(p_trusted / p_raw), and documents below a fixed threshold go. Plain text
rules (length, repetition) come first.

Only DataFrame and SQL functions run here. The corpus counts cover every
document; what leaves the executors is one row per bucket.

Defined cases: a null or empty text has no words, fails the length rule and
has score 0; repeated rows are scored each; an empty corpus gives no rows; a
corpus without trusted documents has equal multinomials up to smoothing, so
only the base rules decide; a null id counts for the corpus and is never
trusted. Only the id and text columns are read, so others may clash freely.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, bounded_share, hash32, whole

BUCKETS = 32768
#: Mean log ratio (natural log) below which a document is not kept.
THRESHOLD = -0.1
#: At most about so many labelled rows say which documents are trusted.
MAX_TRUSTED = 20_000
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = r"[#*$%&|<>]"


def with_hashes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc id, text, words, word hashes ``h`` and hashes ``pairs`` of neighbouring words."""
    return (
        docs.select(F.col(id_col).alias("doc_id"), whole(F.col(text_col)).alias("text"))
        .withColumn("words", F.array_remove(F.split("text", SPACE), ""))
        .withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
        .withColumn("n", F.size("h"))
        .withColumn("pairs", zipped("h", 1, "h", 2, F.col("n") - 1))
    )


def zipped(a: str, i: int, b: str, j: int, length) -> Column:
    """Hashes of a[i], b[j] and the following elements side by side, ``length`` of them (none if negative)."""
    m = F.greatest(length, F.lit(0))
    return F.zip_with(F.slice(a, i, m), F.slice(b, j, m), lambda x, y: F.xxhash64(x, y))


def trusted_ids(labels: DataFrame, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """Distinct ids labelled good; a hash sample of about ``max_trusted`` where there are more."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    share = bounded_share(good.count(), max_trusted)
    return good.where(hash32(F.col("doc_id")) < share)


def fit(hashed: DataFrame, trusted: DataFrame, buckets: int) -> list[float]:
    """Log ratio per feature from counts over the whole corpus, one pass."""
    marked = hashed.join(F.broadcast(trusted.withColumn("good", F.lit(1))), "doc_id", "left")
    counts = (
        # explode_outer: the filter that explode infers would recompute the arrays inside their own lambdas
        marked.select(F.coalesce("good", F.lit(0)).alias("good"), F.explode_outer(F.concat("h", "pairs")).alias("x"))
        .where("x is not null")
        .groupBy(F.pmod("x", F.lit(buckets)).alias("feature")).agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("good"))
    )
    got = {r.feature: (r.raw, r.good) for r in counts.collect()}  # at most one row per bucket
    raw, good = (sum(v[i] for v in got.values()) + buckets for i in (0, 1))
    base = math.log(raw / good)
    return [math.log((got.get(b, (0, 0))[1] + 1) / (got.get(b, (0, 0))[0] + 1)) + base for b in range(buckets)]


def repeated_words() -> str:
    """SQL: words covered by 5-word windows that occur twice or more, first ones included."""
    return f"""case when size(windows) = size(array_distinct(windows)) then 0L else
      aggregate(
        transform(
          transform(array(sort_array(transform(windows, (x, i) -> named_struct('x', x, 'i', i)))),
            s -> sort_array(transform(
              filter(s, (v, k) -> coalesce(v.x = get(s, k - 1).x, false) or coalesce(v.x = get(s, k + 1).x, false)),
              v -> v.i))),
          p -> aggregate(
            transform(p, (v, k) -> cast(least({WINDOW}, coalesce(get(p, k + 1) - v, {WINDOW})) as bigint)),
            0L, (a, b) -> a + b)),
        0L, (a, b) -> a + b) end"""


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS,
                  threshold: float = THRESHOLD, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """One row per document: base counts, ``base_failed``, the length-normalised ``llr`` and ``kept``."""
    hashed = with_hashes(docs, id_col, text_col)
    ratios = fit(hashed, trusted_ids(labels, max_trusted), buckets)
    table = F.split(F.lit(",".join(f"{x:.17g}" for x in ratios)), ",").cast("array<double>")
    total = lambda hashes: F.aggregate(hashes, F.lit(0.0), lambda a, x: a + F.get(table, F.pmod(x, F.lit(buckets))))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (
        hashed
        .withColumn("lines", lines)
        .withColumn("fours", zipped("pairs", 1, "pairs", 3, F.col("n") - WINDOW + 1))
        .withColumn("windows", zipped("fours", 1, "h", 5, F.col("n") - WINDOW + 1))
        .withColumn("total", total("h") + total("pairs"))
        .select(
            "doc_id",
            F.col("n").cast("long").alias("n_words"),
            F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
            F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            F.expr(repeated_words()).alias("n_repeat_words"),
            F.when(F.col("n") > 0, F.col("total") / (F.col("n") + F.size("pairs"))).otherwise(F.lit(0.0)).alias("llr"))
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
    )
