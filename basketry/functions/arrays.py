"""Array and vector expressions (V1-V6, A5-A7, T10) built from higher-order functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

PAD = -1  # marker of an empty slot in fixed-width sequences


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it, also inside its lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def left_pad(arr: str | Column, width: int, pad: int = PAD) -> Column:
    """Keep the last ``width`` elements and left-pad with ``pad`` to exactly ``width``."""
    a = _c(arr)
    tail = F.when(F.size(a) > width, F.slice(a, -width, width)).otherwise(a)
    fill = F.array_repeat(F.lit(pad), F.greatest(F.lit(width) - F.size(tail), F.lit(0)))
    return F.concat(fill, tail)


def right_pad(arr: str | Column, width: str | int | Column, pad: int = 0) -> Column:
    """Right-pad to ``width`` with ``pad``."""
    a = _c(arr)
    w = F.lit(width) if isinstance(width, int) else _c(width)
    return F.concat(a, F.array_repeat(F.lit(pad), F.greatest(w - F.size(a), F.lit(0))))


def drop_pads(arr: str | Column, pad: int = PAD) -> Column:
    return F.filter(_c(arr), lambda x: x != F.lit(pad))


def dot(a: str | Column, b: str | Column) -> Column:
    """Dot product of two equal-length numeric arrays (V1)."""
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def vec_scale(a: str | Column, s: Column) -> Column:
    return F.transform(_c(a), lambda x: x * s)


def vec_sum(arr_of_vecs: str | Column) -> Column:
    """Element-wise sum of a non-empty array of equal-length vectors."""
    def total(a: Column) -> Column:
        zero = F.array_repeat(F.lit(0.0), F.size(F.element_at(a, 1)))
        return F.aggregate(a, zero, lambda acc, v: F.zip_with(acc, v, lambda x, y: x + y.cast("double")))
    return let(_c(arr_of_vecs), total)


def is_nonzero(vec: str | Column) -> Column:
    """A vector with any non-zero entry (sign of its max-abs)."""
    return F.exists(_c(vec), lambda x: x != F.lit(0))


def valid_length(arr_of_vecs: str | Column) -> Column:
    """Number of positions whose vector has a non-zero entry."""
    return F.size(F.filter(_c(arr_of_vecs), is_nonzero))


def softmax(scores: str | Column) -> Column:
    """Numerically stable softmax over an array of doubles (V2)."""
    def shares(exps: Column) -> Column:
        return let(F.aggregate(exps, F.lit(0.0), lambda acc, x: acc + x), lambda total: F.transform(exps, lambda x: x / total))
    return let(_c(scores), lambda s: let(F.array_max(s), lambda m: let(F.transform(s, lambda x: F.exp(x - m)), shares)))


def row_normalise(vec: str | Column) -> Column:
    """Divide by the row sum; a zero row stays zero (A5)."""
    def shares(v: Column) -> Column:
        total = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
        return let(F.when(total > 0, total).otherwise(F.lit(1.0)), lambda t: F.transform(v, lambda x: x.cast("double") / t))
    return let(_c(vec), shares)


def unit(vec: str | Column) -> Column:
    """The vector divided by its length; null for a zero one."""
    def scaled(v: Column) -> Column:
        norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
        return let(norm, lambda n: F.when(n > 0, F.transform(v, lambda x: x.cast("double") / n)))
    return let(_c(vec), scaled)


def multi_hot(indices: str | Column, width: int | Column) -> Column:
    """Dense 0/1 vector of length ``width`` with ones at ``indices`` (A4 dense form)."""
    idx = _c(indices)
    w = F.lit(width) if isinstance(width, int) else width
    places = F.slice(F.sequence(F.lit(0), w), F.lit(1), w)    # none for width 0: a sequence to -1 would count down
    return F.transform(places, lambda i: F.array_contains(idx, i).cast("int"))


def join_ints(arr: str | Column, sep: str = ",") -> Column:
    """Array of numbers as a delimited string (stable text form for exports and checks)."""
    return F.array_join(F.transform(_c(arr), lambda x: x.cast("string")), sep)
