"""Dense indices and member codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions.codes import CODE_SPACE, code_of_index
from ..session import materialize
from .joins import join_mapping

_ROW_BITS = 33  # monotonically_increasing_id = partition id << 33 | row number in partition


def _partitions(df: DataFrame, n: int | None) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dense_index(df: DataFrame, column: str, index_col: str, partitions: int | None = None) -> DataFrame:
    """Number the distinct values of ``column`` 0..n-1 in ascending order.

    The distinct values are range-partitioned and sorted within partitions;
    ``monotonically_increasing_id`` then carries (partition, row in partition)
    in sorted order, and the per-partition counts (one number per partition,
    collected to the driver) give each partition's offset, broadcast back by
    partition id (bounded by the partition count). The numbered ids are
    checkpointed so counts and rows share one partitioning. No step puts all
    values into one task.
    """
    n = _partitions(df, partitions)
    ids = df.select(column).where(F.col(column).isNotNull()).distinct()
    ranked = (ids.repartitionByRange(n, F.col(column)).sortWithinPartitions(column)
              .withColumn("_mid", F.monotonically_increasing_id())
              .withColumn("_pid", F.shiftright(F.col("_mid"), _ROW_BITS).cast("int"))
              .withColumn("_rn", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _ROW_BITS))
              .drop("_mid"))
    # counts and numbering must come from the same partitioning: materialise once
    ranked = materialize(ranked)
    # one count per range partition (bounded by the partition count) -> offsets
    counts = sorted(tuple(r) for r in ranked.groupBy("_pid").count().collect())
    offsets, total = [], 0
    for pid, cnt in counts:
        offsets.append((pid, total))
        total += cnt
    off = df.sparkSession.createDataFrame(offsets, "_pid int, _off long")
    return (ranked.join(F.broadcast(off), on="_pid")
            .select(column, (F.col("_off") + F.col("_rn")).cast("int").alias(index_col)))


def _codes(index: DataFrame, seed: int, key: str, code_col: str, offset: int) -> DataFrame:
    """(key, code) of a dense index ``_code_idx``, counted from ``offset``."""
    n = F.col("_code_idx").cast("long") + F.lit(offset)
    return index.select(
        key,
        F.when(n < CODE_SPACE, code_of_index(n, seed))
        .otherwise(F.raise_error(F.lit("more members than available codes"))).alias(code_col))


def assign_codes(df: DataFrame, seed: int, key: str = S.MEMBER_ID, code_col: str = S.COMP_MEMBER_ID,
                 offset: int = 0, partitions: int | None = None) -> DataFrame:
    """Give every distinct ``key`` a unique pseudo-random 5-character base-36 code.

    Codes are a seeded affine bijection of ``offset`` + the dense index, so they
    are unique without enumerating the code space; more members than codes is
    an error.
    """
    idx = dense_index(df, key, "_code_idx", partitions)
    return df.join(_codes(idx, seed, key, code_col, offset), on=key, how="inner")


def _pass_over(codes: DataFrame, taken: DataFrame, seed: int, key: str, code_col: str, first: int, end: int) -> DataFrame:
    """``codes`` (key, code) with those in ``taken`` replaced by the free codes of the next indices from ``first`` on, in order of the keys."""
    codes = materialize(codes)
    clash = codes.join(taken, on=code_col, how="left_semi").select(key)
    wanted = clash.count()
    if not wanted:
        return codes
    room, free = 2 * wanted, None
    while free is None or free.count() < wanted:
        if free is not None and first + room >= end:
            raise RuntimeError("more members than available codes")
        room *= 2
        free = codes.sparkSession.range(first, min(first + room, end)).select("id", code_of_index("id", seed).alias(code_col)) \
            .join(taken, on=code_col, how="left_anti")
    free = materialize(free)
    new = dense_index(clash, key, "_n").join(dense_index(free, "id", "_n").join(free, on="id"), on="_n").select(key, F.col(code_col).alias("_new"))
    return codes.join(new, on=key, how="left").select(key, F.coalesce("_new", code_col).alias(code_col))


def member_codes(users: DataFrame, seed: int, mapping: DataFrame | None = None, extend: bool = False,
                 key: str = S.MEMBER_ID, code_col: str = S.COMP_MEMBER_ID, pass_over_taken: bool = False) -> DataFrame:
    """Reuse an existing (key, code) mapping when given, else create codes.

    With a mapping, users absent from it are dropped (inner join, as the
    original preparation does) unless ``extend`` is set: new users then get
    the codes that follow the mapping's own, which keeps codes unique when the
    mapping was made by :func:`assign_codes` with the same seed. A mapping made
    elsewhere may already use a new code, the more likely the larger it is: that
    stops the job, or with ``pass_over_taken`` such a user gets the next free
    code after all new ones, and the others keep theirs.
    """
    if mapping is None:
        return assign_codes(users, seed, key, code_col)
    known = join_mapping(users, mapping.select(key, code_col), on=key)
    if not extend:
        return known
    fresh = users.join(mapping.select(key), on=key, how="left_anti")
    used = mapping.select(key).distinct().count()
    if pass_over_taken:
        idx = dense_index(fresh, key, "_code_idx")
        taken = mapping.select(code_col).where(F.col(code_col).isNotNull()).distinct()
        codes = _pass_over(_codes(idx, seed, key, code_col, used), taken, seed, key, code_col, used + idx.count(), used + CODE_SPACE)
        return known.unionByName(fresh.join(codes, on=key, how="inner").select(*known.columns))
    new = assign_codes(fresh, seed, key, code_col, offset=used)
    # a mapping made elsewhere may already hold one of the new codes: fail rather than duplicate
    taken = mapping.select(F.col(code_col), F.lit(True).alias("_taken")).distinct()
    checked = new.join(taken, on=code_col, how="left").withColumn(
        code_col, F.when(F.col("_taken").isNull(), F.col(code_col))
        .otherwise(F.raise_error(F.concat(F.lit("code already in use: "), F.col(code_col))))).drop("_taken")
    return known.unionByName(checked.select(*new.columns))
