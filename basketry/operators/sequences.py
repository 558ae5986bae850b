"""Per-user event sequences.

Any single user may own a large share of the log, so nothing here puts all
rows of one user into one task:

* ``first_per_group`` keeps one row per group with a ``min(struct(...))``
  aggregate (or ``row_number() == 1``, a partial WindowGroupLimit), so a hot
  group is cut to one row per input partition before the shuffle.
* ``sequence_context`` numbers rows within a user and collects the preceding
  values in two levels: windows run per (user, chunk of time), so a hot user is
  spread over as many tasks as its log has chunks; one summary row per (user,
  chunk), its number of rows and last values, is scanned over the user's
  chunks and joined back on (user, chunk), where the rows already are. The
  rows cross one hash shuffle and nothing is collected. The summaries read
  the input a second time, so ``order_instances`` stores its few columns first.
* per-day click lists keep the newest N per (user, day) with a partial
  WindowGroupLimit as well, so a hot day is reduced before its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .. import schemas as S
from ..functions.arrays import PAD, left_pad
from ..session import materialize, stored
from ..functions.time import KST_OFFSET, DAY_SPLIT_OFFSET, LATE_HOUR, click_day, yesterday_day

# Split presets (start of validation, start of test), epoch seconds.
SPLIT_PRESETS = {
    "1w": (1554476400, 1554562800),
    "2w": (1554908400, 1555081200),
    "6w": (1554044400, 1554649200),
}
#: width of a chunk of a user's log, in seconds
CHUNK = 6 * 3600
TRAINING, VALIDATION, TEST = "training", "validation", "test"


def split_bounds(version: str) -> tuple[int, int]:
    """W8 presets by name."""
    if version not in SPLIT_PRESETS:
        raise ValueError(version)
    return SPLIT_PRESETS[version]


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row of each ``keys`` group by ``order`` (ties must be broken by ``order``).

    For ascending column orders this is ``min(struct(order..., rest...))`` per
    group, an aggregate whose partial (map-side) step already keeps one row
    per group and input partition; struct comparison is field by field with
    nulls first, the same order as the window form used for other orders.
    """
    if all(isinstance(c, str) for c in order):
        rest = [c for c in df.columns if c not in keys and c not in order]
        best = F.min(F.struct(*[F.col(c) for c in [*order, *rest]])).alias("_first")
        return df.groupBy(*keys).agg(best).select(*keys, "_first.*").select(*df.columns)
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    return df.withColumn("_first", F.row_number().over(w)).where(F.col("_first") == 1).drop("_first")


def _last(arr: Column, n: int) -> Column:
    return F.when(F.size(arr) > n, F.slice(arr, -n, n)).otherwise(arr)


def _chunk_of(column: str, dtype: T.DataType, width: int) -> Column:
    """The number of the chunk of ``width`` (seconds for times) that a value lies in; nulls come first, as in the order."""
    c = F.col(column)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        c = F.unix_timestamp(c.cast("timestamp"))
    elif isinstance(dtype, T.DateType):
        c = F.unix_date(c).cast("long") * 86400
    elif not isinstance(dtype, T.NumericType):
        raise ValueError(f"{column}: the first order column must be a number, a date or a timestamp")
    return F.coalesce(F.floor(c / F.lit(width)).cast("long"), F.lit(-2**63).cast("long"))


def sequence_context(df: DataFrame, key: str, order: Sequence[str], value: str | None = None,
                     history: int = 0, pos_col: str = "pos", history_col: str = "history",
                     partitions: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """Add each row's 0-based position within ``key`` (ascending ``order``) and,
    when ``history > 0``, the up-to-``history`` preceding ``value``s, oldest first.

    ``order`` must be a total order within a key; its first column is a number,
    a date or a timestamp and is cut into chunks of width ``chunk``. A chunk of a
    key is one window, and a key's chunks are one row each in another; take a
    smaller width for hotter keys. ``partitions`` fixes the number of tasks of
    the hash shuffle (default: the session's).
    """
    tail_len = max(history, 0)
    # a struct equals itself with a null inside, so null keys need no special join
    rows = df.withColumn("_k", F.struct(key)).withColumn("_chunk", _chunk_of(order[0], df.schema[order[0]].dataType, chunk))
    if partitions:
        rows = rows.repartition(partitions, "_k", "_chunk")
    ordered = Window.partitionBy("_k", "_chunk").orderBy(*_cols(order))
    # collect structs: collect_list skips nulls, a wrapped null value is kept
    before = F.transform(F.collect_list(F.struct(F.col(value).alias("_v"))).over(ordered.rowsBetween(-tail_len, -1)),
                         lambda s: s["_v"]) if tail_len else F.array()
    local = rows.withColumn("_rn", F.row_number().over(ordered) - 1).withColumn("_lh", before)
    tail = _last(F.concat("_lh", F.array(F.col(value))), tail_len) if tail_len else F.array()
    ends = rows.withColumn("_rn", F.row_number().over(ordered) - 1).withColumn("_lh", before).select("_k", "_chunk", "_rn", tail.alias("_t")) \
        .groupBy("_k", "_chunk").agg((F.max("_rn") + 1).alias("_n"), F.max_by("_t", "_rn").alias("_t"))
    scan = Window.partitionBy("_k").orderBy("_chunk")
    carry = ends.withColumn("_off", F.sum("_n").over(scan.rowsBetween(Window.unboundedPreceding, -1)))
    if tail_len:  # every chunk has a row, so the last values lie in as many chunks before
        carry = carry.withColumn("_carry", _last(F.flatten(F.collect_list("_t").over(scan.rowsBetween(-tail_len, -1))), tail_len))
    carry = carry.where(F.col("_off").isNotNull()).drop("_n", "_t")
    out = local.join(carry, ["_k", "_chunk"], "left")
    out = out.withColumn(pos_col, (F.col("_rn") + F.coalesce(F.col("_off"), F.lit(0))).cast("long"))
    if tail_len:
        out = out.withColumn(history_col, F.when(F.col("_carry").isNotNull(), _last(F.concat("_carry", "_lh"), tail_len))
                             .otherwise(F.col("_lh")))
    kept = [c for c in df.columns if c not in (pos_col, history_col)]
    return out.select(*kept, pos_col, *([history_col] if tail_len else []))


def remove_repeats(df: DataFrame, key: str, order: Sequence[str], value: str,
                   partitions: int | None = None) -> DataFrame:
    """Drop a row when the previous row of the same key has the same ``value``."""
    ctx = sequence_context(df, key, order, value, history=1, history_col="_prev", pos_col="_pos",
                           partitions=partitions)
    keep = (F.size("_prev") == 0) | (F.try_element_at("_prev", F.lit(-1)) != F.col(value)) | F.col(value).isNull() \
        | F.try_element_at("_prev", F.lit(-1)).isNull()
    return ctx.where(keep).drop("_prev", "_pos")


def aggregate_behaviour(df: DataFrame, user: str = S.COMP_MEMBER_ID, ts: str = S.TIMESTAMP,
                        item: str = S.PRODUCT_NO, tiebreak: Sequence[str] | None = None,
                        partitions: int | None = None) -> DataFrame:
    """W1 then W2 (P3 core): one row per (user, timestamp), then no consecutive repeats.

    On (user, timestamp) ties the row first by ``tiebreak`` (default: item,
    then the remaining columns) is kept.
    """
    rest = [c for c in df.columns if c not in (user, ts, item)]
    tb = list(tiebreak) if tiebreak is not None else [item, *rest]
    # W2 reads these rows at both levels of its scan: stored once, not joined and grouped twice
    dedup = stored(first_per_group(df, [user, ts], tb), "first-rows")
    return remove_repeats(dedup, user, [ts], item, partitions=partitions)


def order_instances(orders: DataFrame, ts_val: int, ts_test: int, min_orders: int = 4, max_orders: int = 8,
                    user: str = S.USER_IDX, ts: str = S.TIMESTAMP, item: str = S.PROD_IDX,
                    tiebreak: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """W3+W4+W8: one instance per order at position >= ``min_orders`` of its user.

    ``orders`` holds the up-to-``max_orders`` previous items (oldest first,
    left-padded with -1), ``label`` the ordered item, ``split`` is training /
    validation / test by the label's time. History crosses split boundaries,
    as in three cumulative passes.
    """
    if min_orders > max_orders:
        raise ValueError("min_orders must not exceed max_orders")
    # both levels of the scan read the orders: their few columns are stored once rather than computed twice
    orders = materialize(orders.select(*dict.fromkeys([user, ts, item, *tiebreak])))
    # the item closes the order: equal (time, tiebreak) rows still get one fixed order
    ctx = sequence_context(orders, user, [ts, *tiebreak, item], item, history=max_orders, pos_col="_pos",
                           history_col="_hist", partitions=partitions)
    split = (F.when(F.col(ts) < ts_val, F.lit(TRAINING))
             .when(F.col(ts) < ts_test, F.lit(VALIDATION)).otherwise(F.lit(TEST)))
    return ctx.where(F.col("_pos") >= min_orders).select(
        F.col(user), F.col(ts), F.col("_pos").alias("position"),
        left_pad("_hist", max_orders).alias("orders"), F.col(item).alias("label"), split.alias("split"))


def daily_last_clicks(clicks: DataFrame, max_clicks: int = 16, user: str = S.USER_IDX, ts: str = S.TIMESTAMP,
                      item: str = S.PROD_IDX, tiebreak: Sequence[str] = (),
                      bounds_offset: int = KST_OFFSET) -> DataFrame:
    """Per (user, local day) the newest ``max_clicks`` clicked items, oldest first.

    Ties on time keep the row first by ``tiebreak``; the kept rows are listed
    in the reverse of the selection order. Returns ``(user, click_day, clicks)``.
    """
    day = clicks.withColumn("click_day", click_day(ts, bounds_offset))
    w = Window.partitionBy(user, "click_day").orderBy(F.col(ts).desc(), *_cols(tiebreak), F.col(item))
    top = day.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= max_clicks)
    newest_first = F.array_sort(F.collect_list(F.struct("_r", F.col(item).alias("_i"))))
    return top.groupBy(user, "click_day").agg(
        F.reverse(F.transform(newest_first, lambda s: s["_i"])).alias("clicks"))


def attach_yesterday_clicks(instances: DataFrame, daily_clicks: DataFrame, max_clicks: int = 16,
                            user: str = S.USER_IDX, ts: str = S.TIMESTAMP,
                            split_offset: int = DAY_SPLIT_OFFSET, late_hour: int = LATE_HOUR) -> DataFrame:
    """The clicks of each instance's "yesterday" (D4), left-padded to ``max_clicks``.

    The time window is one whole local day, so this is an equi-join on
    (user, day) instead of a range join.
    """
    inst = instances.withColumn("_yday", yesterday_day(ts, split_offset, late_hour))
    dc = daily_clicks.select(F.col(user), F.col("click_day").alias("_yday"), F.col("clicks").alias("_clicks"))
    out = inst.join(dc, on=[user, "_yday"], how="left")
    empty = F.array().cast("array<int>")
    return out.withColumn("clicks", left_pad(F.coalesce(F.col("_clicks"), empty), max_clicks, PAD)) \
        .drop("_yday", "_clicks")
